"""The derived ledger in ANSI SQL, for the side-by-side checks."""

from __future__ import annotations

_VIEWS = {
    "o": ((), """
        SELECT o_orderkey, o_custkey,
               CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS h
        FROM orders"""),
    "tip": (("o",), "SELECT max(h) AS tip FROM o"),
    "blocks": (("o", "tip"), """
        SELECT md5('block:' || h) AS block_hash, h AS height, 1 AS version,
               h % 1000 + 285 AS blocksize,
               CASE WHEN h = 0 THEN repeat('0', 64) ELSE md5('block:' || (h - 1)) END AS hashPrev,
               md5('merkle:' || h) AS hashMerkleRoot,
               788918400 + 86400 * CAST(h AS BIGINT) AS nTime, 486604799 AS nBits,
               (CAST(h AS BIGINT) * 2654435761) % 4294967296 AS nNonce,
               strftime(TIMESTAMP '1995-01-01 00:00:00' + to_days(h), '%Y-%m-%d %H:%M:%S')
                   AS block_timestamp,
               CASE WHEN h % 97 = 0 THEN 'REORGED' WHEN h <= tip - 6 THEN 'CONFIRMED'
                    ELSE 'OBSERVED' END AS finality_status
        FROM (SELECT DISTINCT h FROM o) d, tip"""),
    "transactions": (("o",), """
        SELECT md5('tx:' || o_orderkey) AS txid, md5('block:' || h) AS hashBlock,
               1 + o_orderkey % 2 AS version, o_orderkey AS lockTime, h AS block_height,
               strftime(TIMESTAMP '1995-01-01 00:00:00' + to_days(h), '%Y-%m-%d %H:%M:%S')
                   AS block_timestamp
        FROM o"""),
    "tx_in": (("o",), """
        SELECT md5('tx:' || o_orderkey) AS txid,
               CASE WHEN prev IS NULL THEN repeat('0', 64) ELSE md5('tx:' || prev) END
                   AS hashPrevOut,
               CASE WHEN prev IS NULL THEN 4294967295 ELSE 0 END AS indexPrevOut,
               md5('sig:' || o_orderkey) AS scriptSig, 4294967295 AS sequence,
               md5('block:' || h) AS block_hash, h AS block_height
        FROM (SELECT *, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY h, o_orderkey)
                        AS prev FROM o) l"""),
    "tx_out": (("o",), """
        SELECT md5('tx:' || l_orderkey) AS txid, l_linenumber - 1 AS indexOut, h AS height,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS value,
               md5('pk:' || l_partkey) AS scriptPubKey,
               CASE WHEN l_suppkey % 13 = 0 THEN '' ELSE 's' || l_suppkey END AS address,
               md5('block:' || h) AS block_hash,
               strftime(TIMESTAMP '1995-01-01 00:00:00' + to_days(h), '%Y-%m-%d %H:%M:%S')
                   AS block_timestamp
        FROM lineitem JOIN o ON l_orderkey = o_orderkey"""),
    "control": ((), """
        SELECT event_id AS "offset",
               CASE event_type WHEN 'error' THEN 'reorg' WHEN 'click' THEN 'unknown'
                    ELSE 'finality' END AS type,
               CASE WHEN event_type = 'purchase' THEN md5('missing:' || event_id)
                    ELSE md5('block:' || (10 * user_id % 2405)) END AS block_hash,
               10 * user_id % 2405 AS height,
               CASE event_type WHEN 'error' THEN 'REORGED' WHEN 'view' THEN 'INVALID'
                    ELSE 'CONFIRMED' END AS finality_status
        FROM events"""),
    "notify": ((), """
        SELECT event_id AS seq, md5('block:' || (10 * user_id % 2405)) AS block_hash
        FROM events WHERE event_type = 'view'"""),
    "health": ((), """
        SELECT user_id % 11 AS service, CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'ok' END
               AS status, ts FROM events"""),
    "tx_out_unique": (("tx_out",), """
        SELECT txid, indexOut, height, value, scriptPubKey, address, block_hash
        FROM (SELECT *, row_number() OVER (PARTITION BY txid, indexOut
                 ORDER BY height DESC, value DESC, scriptPubKey DESC, address DESC) AS rn
              FROM tx_out) r WHERE rn = 1"""),
    "streams": (("o",), """
        SELECT 'blocks' AS topic_name, CAST(h AS BIGINT) AS "offset", h AS height
        FROM (SELECT DISTINCT h FROM o) d
        UNION ALL SELECT 'transactions', o_orderkey, h FROM o
        UNION ALL SELECT 'tx_in', o_orderkey, h FROM o
        UNION ALL SELECT 'tx_out', k, h FROM (
            SELECT DISTINCT l_orderkey * 8 + l_linenumber AS k, h
            FROM lineitem JOIN o ON l_orderkey = o_orderkey) u"""),
    "alive": (("blocks",), "SELECT * FROM blocks WHERE finality_status <> 'REORGED'"),
    "ic": (("tx_in",), """
        SELECT txid, count(*) AS input_count,
               string_agg(concat_ws(':', hashPrevOut, indexPrevOut, scriptSig, sequence), ','
                   ORDER BY hashPrevOut, indexPrevOut, scriptSig, sequence) AS inputs
        FROM tx_in GROUP BY txid"""),
    "oc": (("tx_out",), """
        SELECT txid, count(*) AS output_count, CAST(sum(value) AS BIGINT) AS total_output_value,
               string_agg(concat_ws(':', indexOut, value, scriptPubKey, address), ','
                   ORDER BY indexOut, value, scriptPubKey, address) AS outputs
        FROM tx_out GROUP BY txid"""),
    "flat": (("transactions", "alive", "ic", "oc"), """
        SELECT t.txid, CAST(a.height AS BIGINT) AS block_height, a.block_hash, a.block_timestamp,
               a.nTime, CAST(t.version AS BIGINT) AS tx_version, t.lockTime,
               coalesce(ic.input_count, 0) AS input_count, coalesce(ic.inputs, '') AS inputs,
               coalesce(oc.output_count, 0) AS output_count,
               coalesce(oc.total_output_value, 0) AS total_output_value,
               coalesce(oc.outputs, '') AS outputs, a.finality_status
        FROM transactions t JOIN alive a ON t.hashBlock = a.block_hash
        LEFT JOIN ic ON ic.txid = t.txid LEFT JOIN oc ON oc.txid = t.txid"""),
}

_PRINTED = {
    "blocks": "block_hash, height, version, blocksize, hashPrev, hashMerkleRoot, nTime, nBits, "
              "nNonce, block_timestamp",
    "transactions": "txid, hashBlock, version, lockTime, block_height, block_timestamp",
    "tx_in": "txid, hashPrevOut, indexPrevOut, scriptSig, sequence, block_hash, block_height",
    "tx_out": "txid, indexOut, height, value, scriptPubKey, address, block_hash, block_timestamp",
}
TABLES = tuple(_PRINTED)


def ledger(select: str, *names: str, **extra: str) -> str:
    """``select`` below the views it needs; ``extra`` adds views of its own."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for dep in _VIEWS[name][0]:
            add(dep)
        if name not in ordered:
            ordered.append(name)

    for n in names:
        add(n)
    parts = [f"{n} AS ({_VIEWS[n][1]})" for n in ordered]
    parts += [f"{n} AS ({text})" for n, text in extra.items()]
    return f"WITH {', '.join(parts)} {select}" if parts else select


def print_of(columns: str) -> str:
    return ("CAST(coalesce(sum(CAST('0x' || substr(md5(concat_ws('|', " + columns +
            ")), 1, 8) AS BIGINT)), 0) AS VARCHAR)")


def summary_of(tables: tuple[str, ...] = TABLES, source=lambda t: t) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, {print_of(_PRINTED[t])} "
        f"AS fingerprint FROM {source(t)}" for t in tables)
