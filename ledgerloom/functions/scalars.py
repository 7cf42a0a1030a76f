"""Column functions of the ledger model. All are built-in expressions on the JVM."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.schemas import SATOSHIS_PER_COIN

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def packed(text: Column | str) -> Column:
    """A text as bytes, half as many where it is lower-case hex; equal texts, and no others, are equal.

    Shuffles cannot compress hashes, but they need not send them as letters. The bytes'
    order is not that of the texts.
    """
    c = _col(text)
    is_hex = (F.length(c) % 2 == 0) & c.rlike(r"\A[0-9a-f]+\z")
    return F.when(is_hex, F.concat(F.lit(b"\x01"), F.unhex(c))).otherwise(
        F.concat(F.lit(b"\x00"), c.cast("binary")))


def unpacked(sent: Column | str) -> Column:
    """The text that ``packed`` was given."""
    c = _col(sent)
    rest = F.substr(c, F.lit(2))
    return F.when(F.substr(c, F.lit(1), F.lit(1)) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(
        rest.cast("string"))


def coin_to_satoshis(coins: Column | str) -> Column:
    """Exact decimal coins to whole satoshis, cut toward zero."""
    return (_col(coins) * F.lit(Decimal(SATOSHIS_PER_COIN))).cast("bigint")


def text_to_satoshis(text: Column | str) -> Column:
    """As ``coin_to_satoshis`` for the textual form, exponents included."""
    return coin_to_satoshis(_col(text).cast("decimal(28,18)"))


def compact_target(bits_hex: Column | str) -> Column:
    return F.conv(_col(bits_hex), 16, 10).cast("bigint")


def utc_wall_clock(epoch_seconds: Column | str) -> Column:
    """Epoch seconds to a zone-less UTC timestamp, whatever the session zone."""
    return F.timestamp_add("SECOND", _col(epoch_seconds), F.expr(_EPOCH))


def wire_timestamp(ts: Column | str) -> Column:
    """Whole seconds of a zone-less timestamp as text; free of the session zone."""
    return F.substring(_col(ts).cast("string"), 1, 19)


def default_if_missing(c: Column | str, default: str | int) -> Column:
    return F.coalesce(_col(c), F.lit(default))


def ingest_stamp() -> Column:
    """Processing time as ISO-8601 UTC text, one value per query execution."""
    micros = F.unix_micros(F.current_timestamp())
    now = wire_timestamp(F.timestamp_add("MICROSECOND", micros, F.expr(_EPOCH)))
    fraction = F.lpad((micros % 1000000).cast("string"), 6, "0")
    return F.concat(F.replace(now, F.lit(" "), F.lit("T")), F.lit("."), fraction, F.lit("+00:00"))


def parse_iso_timestamp(text: Column | str) -> Column:
    """ISO text to a zone-less UTC timestamp; NULL where it cannot be read."""
    c = _col(text)
    bare = F.regexp_replace(c, r"(Z|\+00:00)$", "")
    has_offset = bare.rlike(r"\d[+-]\d{2}:?\d{2}$") & bare.contains(":")
    as_instant = F.timestamp_add(
        "MICROSECOND", F.unix_micros(bare.try_cast("timestamp")), F.expr(_EPOCH))
    return F.when(has_offset, as_instant).otherwise(bare.try_cast("timestamp_ntz"))


def wrap_uint32(c: Column | str) -> Column:
    """Unsigned 32-bit value to the signed INT with the same bits."""
    value = _col(c).cast("bigint")
    return F.when(value > 2147483647, value - F.lit(4294967296)).otherwise(value).cast("int")


def composite_key(*cols: Column | str) -> Column:
    return F.concat_ws(":", *[_col(c).cast("string") for c in cols])


def short_hash(c: Column | str) -> Column:
    return F.concat(F.substring(_col(c), 1, 16), F.lit("..."))


def little_endian(hex_text: Column) -> Column:
    """Eight hex digits with their four bytes in opposite order."""
    return F.concat(*[F.substring(hex_text, i, 2) for i in (7, 5, 3, 1)])


def decode_notify(body: Column | str, seq: Column | str) -> tuple[Column, Column]:
    """Notification body to hex text, and its little-endian uint32 counter to a BIGINT."""
    block_hash = F.lower(F.hex(_col(body)))
    number = F.conv(little_endian(F.hex(_col(seq))), 16, 10).cast("bigint")
    return block_hash, number


def progress_percent(height: Column | str, start: Column, tip: Column) -> Column:
    return (_col(height) - start) / (tip - start + 1) * 100
