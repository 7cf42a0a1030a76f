"""Named tables over the lake: create, drop, describe, refresh, read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.schemas import BATCH_COL, BUCKET_COL, KINDS
from ledgerloom.sources.lake import Lake

CATALOG = "spark_catalog"


def create_tables(spark: SparkSession, lake: Lake, schema: str, drop: bool = False) -> None:
    """Create the schema and its four external tables; running it again changes nothing."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{lake.root}/_schema_{schema}'")
    for kind in KINDS.values():
        name = f"{schema}.{kind.table}"
        if drop:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kind.schema)
        spark.sql(f"""
            CREATE TABLE IF NOT EXISTS {name}
              ({columns}, {BUCKET_COL} INT, {BATCH_COL} STRING)
            USING parquet
            OPTIONS (compression 'zstd')
            PARTITIONED BY ({BUCKET_COL}, {BATCH_COL})
            LOCATION '{lake.path(kind.table)}'
            TBLPROPERTIES ('ledger.identity' = '{",".join(kind.key)}')""")
        refresh(spark, name)


def refresh(spark: SparkSession, name: str) -> None:
    """Make files written behind the catalog visible."""
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)


def read_table(spark: SparkSession, schema: str, table: str) -> DataFrame:
    return spark.table(f"{CATALOG}.{schema}.{table}").select(*KINDS[table].columns)


def identity_key(spark: SparkSession, schema: str, table: str) -> list[str]:
    row = (spark.sql(f"SHOW TBLPROPERTIES {schema}.{table}")
           .where(F.col("key") == "ledger.identity").first())
    return row["value"].split(",")


def describe(spark: SparkSession, schema: str) -> DataFrame:
    """(table_name, column_name, data_type) of every table in the schema."""
    rows = [(t.name, c.name, c.dataType)
            for t in spark.catalog.listTables(schema) if not t.isTemporary
            for c in spark.catalog.listColumns(f"{schema}.{t.name}")]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


def drop_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")
