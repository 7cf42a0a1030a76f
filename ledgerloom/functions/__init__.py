from ledgerloom.functions.scalars import (
    coin_to_satoshis,
    compact_target,
    composite_key,
    decode_notify,
    default_if_missing,
    ingest_stamp,
    little_endian,
    packed,
    parse_iso_timestamp,
    progress_percent,
    short_hash,
    text_to_satoshis,
    unpacked,
    utc_wall_clock,
    wire_timestamp,
    wrap_uint32,
)

__all__ = [
    "coin_to_satoshis", "compact_target", "composite_key", "decode_notify",
    "default_if_missing", "ingest_stamp", "little_endian", "packed", "parse_iso_timestamp",
    "progress_percent", "short_hash", "text_to_satoshis", "unpacked", "utc_wall_clock", "wire_timestamp", "wrap_uint32",
]
