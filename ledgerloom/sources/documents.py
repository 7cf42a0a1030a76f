"""Block documents as JSON files, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.schemas import BLOCK_DOCUMENT

CORRUPT = "_corrupt"
_PERMISSIVE = T.StructType(list(BLOCK_DOCUMENT.fields) + [T.StructField(CORRUPT, T.StringType())])


def write_documents(documents: DataFrame, path: str) -> None:
    documents.write.mode("overwrite").option("compression", "gzip").json(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCK_DOCUMENT).json(path)


def stream_documents(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    return (spark.readStream.schema(BLOCK_DOCUMENT)
            .option("maxFilesPerTrigger", max_files).json(path))


def parse_documents(lines: DataFrame) -> DataFrame:
    """Text lines (column ``value``) to documents plus the text of unreadable ones.

    A line is unreadable when it is not a JSON document of the block shape or
    has no hash, height or transactions.
    """
    parsed = lines.select("value", F.from_json(
        "value", _PERMISSIVE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
        .alias("d"))
    broken = (F.col("d").isNull() | F.col(f"d.{CORRUPT}").isNotNull() | F.col("d.hash").isNull()
              | F.col("d.height").isNull() | F.col("d.tx").isNull())
    return parsed.select(
        *[F.col(f"d.{f.name}") for f in BLOCK_DOCUMENT],
        F.when(broken, F.col("value")).alias(CORRUPT))
