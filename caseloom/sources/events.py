"""Event topics: publishing rows as keyed JSON, and reading them as a stream.

A topic is a Kafka topic or a folder of JSON messages with the same key, value and
timestamp columns; everything downstream is the same for both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom import schemas

CORRUPT = "_corrupt_record"
# Message times keep their microseconds in JSON.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
PARSED = schemas.T.StructType([*schemas.EVENT.fields,
                               schemas.T.StructField(CORRUPT, schemas.STR, True)])


def from_observations(rows: DataFrame) -> DataFrame:
    """Observations as events: the same fields, the rate under its event name."""
    return rows.select(
        F.col("epi_week").cast("int").alias("epi_week"), "state", "loc", "loc_type", "disease",
        F.col("cases").cast("int").alias("cases"),
        F.col("incidence_per_100000").cast("double").alias("incidence_rate"))


def as_messages(rows: DataFrame, limit: int = 0,
                fields: Sequence[str] = tuple(schemas.EVENT.fieldNames())) -> DataFrame:
    """Rows as (key, value) messages, ``fields`` in the value and other columns beside it.

    The key is state and week with an underscore between, an empty text for a missing one;
    the value holds every field, null ones too. ``limit`` > 0 takes a head only.
    """
    if limit > 0:
        rows = rows.limit(limit)
    return rows.select(
        F.concat(F.coalesce("state", F.lit("")), F.lit("_"),
                 F.coalesce(F.col("epi_week").cast("string"), F.lit(""))).alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
        *[c for c in rows.columns if c not in fields])


def publish_files(messages: DataFrame, path: str, mode: str = "append") -> None:
    """Adds messages to a folder topic; ``mode="overwrite"`` makes a repeated publish safe."""
    messages.write.mode(mode).option("timestampFormat", TIME_FORMAT).json(path)


def publish_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Needs the Kafka connector on the class path."""
    (messages.select("key", "value").write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def file_topic(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schemas.TOPIC).option("timestampFormat", TIME_FORMAT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def kafka_topic(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                max_offsets: int | None = None) -> DataFrame:
    """Newest events only by default. Needs the Kafka connector on the class path."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(F.col("key").cast("string").alias("key"),
                                F.col("value").cast("string").alias("value"), "timestamp")


def parsed_events(messages: DataFrame) -> DataFrame:
    """Event fields of each message; messages that do not decode are skipped."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    event = F.from_json("value", PARSED, options)
    others = [c for c in messages.columns if c not in ("key", "value")]
    rows = messages.select(*others, event.alias("event"))
    good = F.col("event").isNotNull() & F.col(f"event.{CORRUPT}").isNull()
    return rows.filter(good).select(
        *[F.col(f"event.{name}").alias(name) for name in schemas.EVENT.fieldNames()], *others)
