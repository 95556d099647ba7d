"""Parquet table sinks and scans: full refresh, guarded load, merge-replace by table and by partition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _arranged(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str]) -> DataFrame:
    if not cluster_by:
        return df
    helpers = {f"_sort_{i}": F.col(c) for i, c in enumerate(cluster_by)}
    return (df.withColumns(helpers).hint("rebalance", *partition_by, "_sort_0")
            .sortWithinPartitions(*partition_by, *helpers).drop(*helpers))


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                cluster_by: Sequence[str] = ()) -> None:
    """Full refresh of one table.

    With ``cluster_by`` (columns or paths into structs) the rows are rebalanced on the
    partition columns and the first clustering column, so a folder gets few files while
    AQE still splits a hot key over several tasks; each file is sorted, so row-group
    statistics prune on those columns.

    The rows are written beside the table, which they may be read from, and take its place
    by a rename once they are complete: a write that fails leaves the table as it was.
    """
    spark, staged = df.sparkSession, f"{path.rstrip('/')}.next"
    writer = _arranged(df, partition_by, cluster_by).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(staged)
    _take_place(spark, staged, path)


def _take_place(spark: SparkSession, staged: str, path: str) -> None:
    system, target = _file_system(spark, path)
    _, source = _file_system(spark, staged)
    _, old = _file_system(spark, _set_aside(path))
    if system.exists(target):
        system.delete(old, True)
        if not system.rename(target, old):
            raise OSError(f"{path} could not be set aside")
    if not system.rename(source, target):
        raise OSError(f"{staged} could not take the place of {path}")
    system.delete(old, True)


def _set_aside(path: str) -> str:
    return f"{path.rstrip('/')}.old"


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    """Hadoop file system and path object, so any storage Spark can reach works."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    system, location = _file_system(spark, path)
    return system.exists(location)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when a committed table is at ``path`` (its success marker is present).

    A refresh that ended between setting the table aside and replacing it is undone.
    """
    if path_exists(spark, f"{path}/_SUCCESS"):
        return True
    aside = _set_aside(path)
    if path_exists(spark, path) or not path_exists(spark, f"{aside}/_SUCCESS"):
        return False
    system, location = _file_system(spark, aside)
    return system.rename(location, _file_system(spark, path)[1])


def child_names(spark: SparkSession, path: str) -> list[str]:
    system, location = _file_system(spark, path)
    if not system.exists(location):
        return []
    return [status.getPath().getName() for status in system.listStatus(location)]


def remove_table(spark: SparkSession, path: str) -> None:
    system, location = _file_system(spark, path)
    system.delete(location, True)


def load_if_empty(df: DataFrame, path: str, schema: T.StructType, **layout: Sequence[str]) -> bool:
    """Write ``df`` unless the target table already holds rows; tell whether it was written."""
    spark = df.sparkSession
    if table_exists(spark, path) and not read_table(spark, path, schema).isEmpty():
        return False
    write_table(df, path, **layout)
    return True


def _same_key(t: DataFrame, u: DataFrame, keys: Sequence[str]) -> Column:
    same = t[keys[0]].eqNullSafe(u[keys[0]])
    for key in keys[1:]:
        same = same & t[key].eqNullSafe(u[key])
    return same


def _matching(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose keys are updated."""
    t, u = target.alias("t"), updates.select(*keys).distinct().alias("u")
    return t.join(u, _same_key(t, u, keys), "left_semi")


def merged(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose keys are not updated, plus all updates. Null keys match null keys."""
    t, u = target.alias("t"), updates.select(*keys).distinct().alias("u")
    return t.join(u, _same_key(t, u, keys), "left_anti").select(*target.columns).unionByName(
        updates.select(*target.columns))


def merge_replace(updates: DataFrame, keys: Sequence[str], current: str, staged: str,
                  schema: T.StructType) -> None:
    """Write ``current`` merged with ``updates`` to ``staged``, replacing rows on key match.

    The current table stays untouched, so a reader or a retry never meets a half-written
    table; the caller switches to ``staged`` once this returns.
    """
    if staged.rstrip("/") == current.rstrip("/"):
        raise ValueError("the staged path must differ from the current one")
    spark = updates.sparkSession
    if table_exists(spark, current):
        write_table(merged(read_table(spark, current, schema), updates, keys), staged)
    else:
        write_table(updates, staged)


def _one_of(partitions: Sequence[Mapping | Row], partition_by: Sequence[str]) -> Column:
    """True for rows in one of the partitions; only literals, so the scan is pruned by it."""
    found = F.lit(False)
    for values in partitions:
        same = F.lit(True)
        for name in partition_by:
            same = same & F.col(name).eqNullSafe(F.lit(values[name]))
        found = found | same
    return found


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                       cluster_by: Sequence[str] = ()) -> None:
    """Writes the rows in place of the partitions they are in; all others are left as they are.

    The files are complete before the first partition is replaced. Repeating the write gives
    the same table.
    """
    (_arranged(df, partition_by, cluster_by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))


def merge_partitions(updates: DataFrame, keys: Sequence[str], path: str, schema: T.StructType,
                     partition_by: Sequence[str], cluster_by: Sequence[str] = ()) -> int:
    """Merges ``updates`` into a partitioned table in place; returns the partitions rewritten.

    Rows whose keys match (null keys match null keys) are replaced, other updates are added.
    Only partitions that get an update, or hold a row that one replaces, are read and
    written. Where the partition columns are keys, the updates alone tell which; else the
    keys of the table are looked up. The list of them is all that reaches the driver, as it
    does when a table is listed. A merge that fails may be repeated: before its last step
    the table is as it was, and replaced partitions merge to the same rows again.
    """
    spark = updates.sparkSession
    updates = updates.select(*schema.fieldNames())
    if not table_exists(spark, path):
        write_table(updates, path, partition_by, cluster_by)
        return updates.select(*partition_by).distinct().count()
    target = read_table(spark, path, schema)
    touched = updates.select(*partition_by)
    if not set(partition_by) <= set(keys):
        touched = touched.unionByName(_matching(target, updates, keys).select(*partition_by))
    partitions = touched.distinct().collect()
    if not partitions:
        return 0
    held = target.filter(_one_of(partitions, partition_by))
    refresh_partitions(merged(held, updates, keys), path, schema, partition_by, partitions, cluster_by)
    return len(partitions)


def refresh_partitions(df: DataFrame, path: str, schema: T.StructType, partition_by: Sequence[str],
                       partitions: Sequence[Mapping], cluster_by: Sequence[str] = ()) -> None:
    """Replaces whole partitions, named by their values, by the rows of ``df``, which are all in them.

    A partition that gets no row ends up empty.
    """
    spark = df.sparkSession
    left = set(df.select(*partition_by).distinct().collect())
    emptied = [p for p in partitions if tuple(p[c] for c in partition_by) not in left]
    folders = []
    if emptied:  # what loses its last row is not overwritten, so its folder goes
        folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("folder")
        old = read_table(spark, path, schema).filter(_one_of(emptied, partition_by))
        folders = [r["folder"] for r in old.select(folder).distinct().collect()]
    replace_partitions(df, path, partition_by, cluster_by)
    for folder in folders:  # an encoded URI, unlike the paths that callers give
        jvm = spark.sparkContext._jvm
        location = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)
    spark.catalog.refreshByPath(path)
