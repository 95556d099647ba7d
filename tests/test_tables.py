"""Refreshing and merging stored tables."""

import pathlib

import pytest
from pyspark.sql import functions as F

from caseloom.sources import observations, tables

SCHEMA = "part string, k long, v long"


def rows_in(spark, path, schema):
    return sorted((r["part"] or "", r["k"], r["v"]) for r in tables.read_table(spark, path, schema).collect())


def files_of(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in pathlib.Path(path).rglob("*.parquet")}


@pytest.fixture
def hundred(spark, tmp_path):
    """A table of 100 partitions with ten keys each."""
    df = spark.range(1_000).select(
        F.concat(F.lit("p"), F.lpad((F.col("id") % 100).cast("string"), 2, "0")).alias("part"),
        F.col("id").alias("k"), F.lit(0).cast("long").alias("v"))
    path = str(tmp_path / "t")
    tables.write_table(df, path, ["part"])
    return path, df.schema


def test_merge_rewrites_the_updated_partitions_only(spark, hundred):
    path, schema = hundred
    updates = spark.createDataFrame([("p03", 3, 7), ("p03", 1_003, 7), ("p50", 50, 7), ("p99", 2_099, 7)], SCHEMA)
    before, old = files_of(path), rows_in(spark, path, schema)
    for _ in range(2):  # a repeated merge gives the same table
        assert tables.merge_partitions(updates, ["part", "k"], path, schema, ["part"]) == 3
        after = files_of(path)
        same = {f for f in before if after.get(f) == before[f]}
        assert {f.split("/")[0] for f in before if f not in same} == {"part=p03", "part=p50", "part=p99"}
        changed = {("p03", 3, 7), ("p03", 1_003, 7), ("p50", 50, 7), ("p99", 2_099, 7)}
        gone = {("p03", 3, 0), ("p50", 50, 0)}
        assert rows_in(spark, path, schema) == sorted((set(old) - gone) | changed)
    assert tables.table_exists(spark, path)


def test_merge_scans_the_updated_partitions_only(spark, hundred):
    path, schema = hundred
    plan = tables.read_table(spark, path, schema).filter(
        tables._one_of([{"part": "p03"}, {"part": "p50"}], ["part"]))
    assert plan.select("k").distinct().count() == 20
    scan = next(line for line in plan._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in line)
    assert "PartitionFilters: [" in scan and "p03" in scan and "DataFilters: []" in scan


def test_rows_that_move_leave_their_old_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1, 0), ("b", 2, 0), ("b", 3, 0), (None, 4, 0), ("c/ä =", 5, 0)], SCHEMA)
    tables.write_table(df, path, ["part"])
    updates = spark.createDataFrame([("b", 1, 9), ("a b", 4, 9), ("z", 5, 9)], SCHEMA)
    assert tables.merge_partitions(updates, ["k"], path, df.schema, ["part"]) == 6
    assert rows_in(spark, path, df.schema) == [("a b", 4, 9), ("b", 1, 9), ("b", 2, 0), ("b", 3, 0), ("z", 5, 9)]
    assert len([p for p in pathlib.Path(path).iterdir() if p.name.startswith("part=")]) == 3
    assert tables.merge_partitions(updates.limit(0), ["k"], path, df.schema, ["part"]) == 0


def test_first_merge_makes_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1, 0)], SCHEMA)
    assert tables.merge_partitions(df, ["k"], path, df.schema, ["part"], ["k"]) == 1
    assert rows_in(spark, path, df.schema) == [("a", 1, 0)]


def test_a_failed_refresh_leaves_the_table(spark, hundred):
    path, schema = hundred
    old = rows_in(spark, path, schema)
    broken = tables.read_table(spark, path, schema).withColumn(
        "v", F.when(F.col("k") == 77, F.raise_error(F.lit("broken"))).otherwise(F.col("v")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        tables.write_table(broken, path, ["part"])
    assert rows_in(spark, path, schema) == old and tables.table_exists(spark, path)
    # A table may be refreshed from itself.
    tables.write_table(tables.read_table(spark, path, schema).withColumn("v", F.col("v") + 1), path, ["part"])
    assert rows_in(spark, path, schema) == [(p, k, 1) for p, k, _ in old]


def test_an_interrupted_refresh_is_undone(spark, hundred):
    path, schema = hundred
    old = rows_in(spark, path, schema)
    pathlib.Path(path).rename(f"{path}.old")
    assert tables.table_exists(spark, path) and rows_in(spark, path, schema) == old
    assert not tables.table_exists(spark, f"{path}-none")


def test_only_files_with_wrapped_cells_are_read_whole(spark, tmp_path):
    header = "epi_week,state,loc,loc_type,disease,cases,incidence_per_100000"
    (tmp_path / "plain.csv").write_text(header + "\n" + "".join(f'2001{k:02},AA,"A ""x"", b",STATE,FLU,{k},1\n' for k in range(10, 30)))
    (tmp_path / "wrapped é.csv").write_text(f'﻿{header}\n200101,AA,"two\nlines",STATE,FLU,1,1\n')
    (tmp_path / "empty.csv").write_text("")
    layout = observations.scan_layout(spark, str(tmp_path))
    names = {pathlib.PurePath(n).name: h for n, h in layout.headers.items()}
    assert names.pop("empty.csv") == [] and set(map(tuple, names.values())) == {tuple(header.split(","))}
    assert ["wrapped" in n for n in layout.wrapped] == [True]
    rows = observations.scan_observations(spark, str(tmp_path), layout)
    assert rows.count() == 21 and {r["loc"] for r in rows.select("loc").distinct().collect()} == {'A "x", b', "two\nlines"}
    size = (tmp_path / "plain.csv").stat().st_size
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // 3))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        split = observations.scan_observations(spark, str(tmp_path / "plain.csv"))
        assert split.rdd.getNumPartitions() > 1 and split.count() == 20
        again = observations.scan_layout(spark, str(tmp_path / "plain.csv"))
        assert [h for h in again.headers.values()] == [header.split(",")] and not again.wrapped
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_equal_observations_get_keys_of_their_own(spark, small):
    twice = small.obs.unionByName(small.obs)
    keys = [r["incidence_key"] for r in small.star(twice).fact.select("incidence_key").collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))
