"""Record topics: keyed JSON messages, one folder per topic.

With a message-broker connector on the class path the same frames go to
``format("kafka")``; the columns already have its names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import storage
from ledgerloom.schemas import KINDS, TABLE_OF_TOPIC, TOPIC_FIGURES

MESSAGE = "key STRING, value STRING"
FIGURES = ("block_hash STRING, slice INT, height INT, figures ARRAY<STRUCT<table_name: STRING, "
           "rows: BIGINT, digest: DECIMAL(38,0)>>")

MAX_TOPICS = 8  # files a task keeps open
MESSAGES_PER_FILE = 500_000


def topic_dir(root: str, topic: str) -> str:
    return f"{root}/topic={topic}"


def publish(messages: DataFrame, root: str) -> None:
    """Write (topic, key, value) messages into the topic folders.

    The rows stay in the partitions they are in; no shuffle is needed, since a
    consumer orders by a field of the record and never by file position. A task keeps a
    file open for each topic instead of sorting its messages by topic. Files are
    compressed and hold a bounded number of messages, as they cannot be split.
    """
    with storage.open_files(messages.sparkSession, MAX_TOPICS):
        (messages.select("topic", "key", "value").write.mode("append")
         .option("compression", "gzip").option("maxRecordsPerFile", MESSAGES_PER_FILE)
         .partitionBy("topic").json(root))


def publish_kafka(messages: DataFrame, servers: str) -> None:
    (messages.select("topic", "key", "value").write.format("kafka")
     .option("kafka.bootstrap.servers", servers)
     .option("kafka.acks", "all").option("kafka.enable.idempotence", "true").save())


def read_topic(spark: SparkSession, root: str, topic: str) -> DataFrame:
    return spark.read.schema(MESSAGE).json(topic_dir(root, topic))


def read_topics(spark: SparkSession, root: str) -> DataFrame:
    """All messages with their topic; the figures of the blocks are no records and stay out."""
    every = spark.read.schema(f"{MESSAGE}, topic STRING").json(root)
    return every.where(F.col("topic") != TOPIC_FIGURES)


def decode_figures(messages: DataFrame) -> DataFrame:
    """(block_hash, slice, height, table_name, rows, digest) of messages of the figures' topic."""
    told = F.from_json("value", FIGURES)
    return (messages.select(told.alias("m")).where(F.col("m.block_hash").isNotNull())
            .select("m.block_hash", "m.slice", "m.height", F.explode("m.figures").alias("f"))
            .select("block_hash", "slice", "height", "f.*"))


def stream_topic(spark: SparkSession, root: str, topic: str, max_files: int) -> DataFrame:
    return (spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", max_files)
            .json(topic_dir(root, topic)))


def with_table(messages: DataFrame) -> DataFrame:
    """Add ``table_name`` from the routing; messages of other topics are left out."""
    routing = F.create_map(*[F.lit(x) for pair in TABLE_OF_TOPIC.items() for x in pair])
    return (messages.where(F.col("topic").isin(list(TABLE_OF_TOPIC)))
            .withColumn("table_name", F.element_at(routing, F.col("topic"))))


def missing_fields(messages: DataFrame, required: dict[str, list[str]]) -> DataFrame:
    """Per topic and required field: messages, and how many of them lack the field."""
    return _field_counts(messages, required, present=False, name="missing")


def leaked_fields(messages: DataFrame, forbidden: dict[str, list[str]]) -> DataFrame:
    """Per topic and foreign field: messages, and how many of them carry the field."""
    return _field_counts(messages, forbidden, present=True, name="leaked")


def _field_counts(messages: DataFrame, fields: dict[str, list[str]], present: bool,
                  name: str) -> DataFrame:
    # One pass: a column per (topic, field), then unpivoted from a single row per topic.
    body = messages.select("topic", F.from_json("value", "map<string,string>").alias("m"))
    wanted = sorted({f for names in fields.values() for f in names})

    def hit(field: str):
        has = F.coalesce(F.map_contains_key("m", field), F.lit(False))
        return F.count_if(has if present else ~has).alias(field)

    per_topic = (body.where(F.col("topic").isin(list(fields)))
                 .groupBy("topic").agg(F.count("*").alias("messages"), *[hit(f) for f in wanted]))
    long = per_topic.unpivot(["topic", "messages"], wanted, "field", name)
    pairs = F.lit(False)
    for topic, names in fields.items():
        pairs = pairs | ((F.col("topic") == topic) & F.col("field").isin(names))
    return long.where(pairs)


def topic_of(table: str) -> str:
    return KINDS[table].topic
