"""Fit records to a table's declared schema, strictly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import functions as L
from ledgerloom.schemas import RecordKind

_INT_MIN, _INT_MAX = -2147483648, 2147483647


def _fail(kind: RecordKind, name: str, reason: str) -> Column:
    return F.raise_error(F.lit(f"{kind.table}.{name}: {reason}"))


def _narrow(kind: RecordKind, name: str, source: T.DataType) -> Column:
    c = F.col(name)
    if isinstance(source, T.LongType):
        fits = c.isNull() | c.between(_INT_MIN, _INT_MAX)
        c = F.when(fits, c).otherwise(_fail(kind, name, "value does not fit INT"))
    return c.cast("int")


def conform(records: DataFrame, kind: RecordKind, wrap_unsigned: bool = False) -> DataFrame:
    """Table column order; absent columns NULL, foreign columns dropped.

    A NULL in a required column or a number too large for INT fails the write.
    ``wrap_unsigned`` stores over-large unsigned 32-bit numbers with the same
    bits instead of failing.
    """
    have = {f.name: f.dataType for f in records.schema}
    out = []
    for field in kind.schema:
        name = field.name
        if name not in have:
            c = F.lit(None).cast(field.dataType)
        elif isinstance(field.dataType, T.TimestampNTZType) and isinstance(have[name], T.StringType):
            c = L.parse_iso_timestamp(name)
        elif isinstance(field.dataType, T.IntegerType):
            c = L.wrap_uint32(name) if wrap_unsigned else _narrow(kind, name, have[name])
        else:
            c = F.col(name).cast(field.dataType)
        if name in kind.required:
            c = F.when(c.isNotNull(), c).otherwise(_fail(kind, name, "required value missing"))
        out.append(c.alias(name))
    return records.select(*out)


def decode(messages: DataFrame, kind: RecordKind, strict: bool = False) -> DataFrame:
    """Message values to wire records plus ``_corrupt``, the text of one set aside, and ``_reason``.

    A value is set aside when it is not JSON of the wire types, when it lacks a
    required field, or when a number does not fit its column. With ``strict``
    such numbers are left for ``conform``, which fails on them.
    """
    schema = T.StructType(list(kind.wire_schema.fields) + [T.StructField("_corrupt", T.StringType())])
    parsed = messages.select(
        "value",
        F.from_json("value", schema, {"mode": "PERMISSIVE",
                                      "columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    lacking = F.lit(False)
    for name in kind.required:
        lacking = lacking | F.col(f"r.{name}").isNull()
    too_large = F.lit(False)
    wire = {f.name: f.dataType for f in kind.wire_schema}
    for field in kind.schema:
        if isinstance(field.dataType, T.IntegerType) and isinstance(wire.get(field.name), T.LongType):
            too_large = too_large | ~F.coalesce(
                F.col(f"r.{field.name}").between(_INT_MIN, _INT_MAX), F.lit(True))
    reason = (F.when(F.col("r._corrupt").isNotNull(), "unreadable")
              .when(lacking, "required field missing"))
    reason = reason if strict else reason.when(too_large, "number too large")
    corrupt = F.when(reason.isNotNull(), F.coalesce(F.col("value"), F.lit("")))
    fields = [F.col(f"r.{f.name}").alias(f.name) for f in kind.wire_schema
              if f.name != "schema_version"]
    return parsed.select(*fields, corrupt.alias("_corrupt"), reason.alias("_reason"))


def schema_drift(payload_fields: DataFrame, declared: DataFrame) -> DataFrame:
    """Fields declared but never produced, or produced but not declared.

    Both inputs carry (table_name, field).
    """
    made = payload_fields.select("table_name", "field", F.lit(True).alias("made"))
    want = declared.select("table_name", "field", F.lit(True).alias("want"))
    joined = made.join(want, ["table_name", "field"], "full")
    return (joined.where(F.col("made").isNull() | F.col("want").isNull())
            .select("table_name", "field",
                    F.when(F.col("made").isNull(), "not produced")
                    .otherwise("not declared").alias("drift")))
