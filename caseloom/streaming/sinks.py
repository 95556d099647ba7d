"""Streaming sinks. Every sink is safe to retry after a lost executor or a restart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from caseloom.sources.events import TIME_FORMAT
from caseloom.sources.tables import child_names, remove_table, table_exists


def append_rows(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Appends finished rows to a Parquet table."""
    return (stream.writeStream.format("parquet").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def append_messages(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Publishes (key, value) rows to a derived topic that is a folder of JSON messages."""
    return (stream.writeStream.format("json").outputMode("append")
            .option("timestampFormat", TIME_FORMAT)
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def append_kafka(stream: DataFrame, servers: str, topic: str, checkpoint: str,
                 **trigger) -> StreamingQuery:
    """Publishes (key, value) rows to a derived topic. Needs the Kafka connector."""
    return (stream.select("key", "value").writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def record_changes(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Writes the groups changed by each micro-batch to a folder of its own.

    A repeated batch overwrites its folder, so a change is recorded exactly once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")

    return (stream.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _committed_changes(spark: SparkSession, path: str) -> list[int]:
    ids = (int(name.removeprefix("batch_id=")) for name in child_names(spark, f"{path}/changes")
           if name.startswith("batch_id="))
    return sorted(i for i in ids if table_exists(spark, f"{path}/changes/batch_id={i}"))


def current_state(spark: SparkSession, path: str, schema: T.StructType,
                  keys: Sequence[str]) -> DataFrame:
    """The table a change record stands for: the newest change per key.

    Reads the committed batches, so a batch that is being written is not seen.
    """
    batches = _committed_changes(spark, path)
    if not batches:
        return spark.createDataFrame([], schema).select(
            *keys, *[f.name for f in schema if f.name not in keys])
    recorded = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    folders = [f"{path}/changes/batch_id={i}" for i in batches]
    changes = spark.read.schema(recorded).option("basePath", f"{path}/changes").parquet(*folders)
    values = [f.name for f in schema if f.name not in keys]
    newest = F.max_by(F.struct(*values), "batch_id").alias("newest")
    return changes.groupBy(*keys).agg(newest).select(*keys, "newest.*")


def record_late(stream: DataFrame, time: str, delay_seconds: int, path: str, checkpoint: str,
                **trigger) -> StreamingQuery:
    """Writes rows that come after their time was closed to a table of their own.

    A row is late when its time is not after the newest time of earlier micro-batches less
    the delay: the rule by which a watermark of that delay drops it from a state. Each batch
    leaves the newest time so far beside its late rows, so a repeated batch decides the same.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = [v for v in versions(spark, f"{path}/marks") if v < batch_id]
        marks = spark.read.schema("newest long").parquet(f"{path}/marks/{earlier[-1]}") if earlier else None
        before = marks.first()["newest"] if marks else None
        at = F.unix_micros(F.col(time))
        late = F.lit(False) if before is None else at <= before - delay_seconds * 1_000_000
        batch.filter(late).write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")
        newest = F.greatest(F.max(at), F.lit(before).cast("long")).alias("newest")
        batch.agg(newest).write.mode("overwrite").parquet(f"{path}/marks/{batch_id}")
        for version in earlier[:-1]:
            remove_table(spark, f"{path}/marks/{version}")

    return (stream.writeStream.outputMode("append").foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def late_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All late rows of committed batches."""
    batches = _committed_changes(spark, path)
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/changes/batch_id={i}" for i in batches])


def keep_latest(stream: DataFrame, order: Sequence[str], n: int, path: str, checkpoint: str,
                **trigger) -> StreamingQuery:
    """Keeps the newest ``n`` rows.

    Each batch writes a version made from the one before it and removes older ones, so a
    repeated batch starts from the same rows and writes the same version again.
    """
    newest = [F.desc(c) for c in order]
    schema = stream.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        top = batch.orderBy(*newest).limit(n)
        earlier = [v for v in versions(spark, path) if v < batch_id]
        if earlier:
            previous = spark.read.schema(schema).parquet(f"{path}/{earlier[-1]}")
            top = previous.unionByName(top).orderBy(*newest).limit(n)
        top.write.mode("overwrite").parquet(f"{path}/{batch_id}")
        for version in earlier[:-1]:
            remove_table(spark, f"{path}/{version}")

    return (stream.writeStream.outputMode("append").foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions below ``path``, oldest first."""
    return sorted(int(name) for name in child_names(spark, path)
                  if name.isdigit() and table_exists(spark, f"{path}/{name}"))


def latest_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of the newest version; no rows before the first one."""
    done = versions(spark, path)
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{done[-1]}")


def finish(query: StreamingQuery, timeout: int | None = None) -> StreamingQuery:
    """Waits for a bounded run to end; with ``timeout`` seconds, stops it then and raises."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream did not finish within {timeout} s")
    return query
