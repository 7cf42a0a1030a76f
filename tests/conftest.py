"""Shared session and small ledgers for the tests."""

from __future__ import annotations

import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom import storage  # noqa: E402
from ledgerloom.session import build_session  # noqa: E402
from ledgerloom.sources.documents import read_documents  # noqa: E402

STAMP = "2024-01-01T00:00:00+00:00"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", {
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    return lambda label="t": storage.new_dir(spark, label)


def spend(prev: str, vout: int = 0, script: str | None = "ab") -> dict:
    vin = {"txid": prev, "vout": vout, "sequence": 4294967294}
    if script is not None:
        vin["scriptSig"] = {"hex": script}
    return vin


def mint(script: str = "00") -> dict:
    return {"coinbase": script, "sequence": 4294967295}


def pay(n: int, coins: str, address: str | None = None, script: str | None = "51") -> dict:
    spk = {}
    if script is not None:
        spk["hex"] = script
    if address is not None:
        spk["address"] = address
    return {"value": coins, "n": n, "scriptPubKey": spk}


def tx(txid: str, vin: list, vout: list, version: int = 1, locktime: int = 0) -> dict:
    return {"txid": txid, "version": version, "locktime": locktime, "vin": vin, "vout": vout}


def block(height: int, txs: list, prev: str | None = None, name: str | None = None,
          bits: str = "1d00ffff", time: int | None = None, nonce: int = 7) -> dict:
    doc = {"hash": name or f"b{height}", "height": height, "version": 1, "size": 285,
           "merkleroot": f"m{height}", "bits": bits, "nonce": nonce,
           "time": 1231006505 + 600 * height if time is None else time, "tx": txs,
           "confirmations": 12, "difficulty": 1.0}
    if prev is not None:
        doc["previousblockhash"] = prev
    return doc


def chain(n: int) -> list[dict]:
    """``n`` blocks with one coinbase transaction each."""
    return [block(h, [tx(f"c{h}", [mint()], [pay(0, "50.0", f"a{h}")])],
                  prev=f"b{h - 1}" if h else None) for h in range(n)]


def to_line(doc: dict) -> str:
    """JSON text in which coin values are bare numbers, exactly as written."""
    text = json.dumps(doc)
    for t in doc["tx"]:
        for v in t["vout"]:
            text = text.replace(f'"value": "{v["value"]}"', f'"value": {v["value"]}')
    return text


@pytest.fixture
def documents(spark, folder):
    def make(docs: list[dict]):
        path = folder("docs")
        spark.createDataFrame([(to_line(d),) for d in docs], "value string").write.text(path)
        return read_documents(spark, path)
    return make


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted([tuple(r) for r in picked.collect()], key=lambda r: tuple(map(str, r)))
