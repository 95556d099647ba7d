"""Batch load from CSV files: scan, check, clean, build and store the three models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators import clean, quality
from caseloom.plans.warehouse import Sources, Warehouse
from caseloom.sources import observations as files


@dataclass(frozen=True)
class ReferencePaths:
    regions: str
    diseases: str
    populations: str
    borders: str


class QualityError(ValueError):
    """The raw data fails a check that must hold before a load."""


def read_sources(spark: SparkSession, path: str, reference: ReferencePaths,
                 layout: files.Layout | None = None) -> Sources:
    """Cleaned observations and the reference tables of one data set."""
    return Sources(
        clean.clean_observations(files.scan_observations(spark, path, layout)),
        files.scan_regions(spark, reference.regions),
        files.scan_diseases(spark, reference.diseases),
        files.scan_populations(spark, reference.populations),
        files.scan_borders(spark, reference.borders))


def check_raw(spark: SparkSession, path: str, reference: ReferencePaths,
              layout: files.Layout | None = None) -> DataFrame:
    """The one-row quality report; raises when a file lacks columns or the score is too low."""
    layout = layout or files.scan_layout(spark, path)
    missing = files.missing_by_file(spark, path, layout=layout)
    if missing:
        raise QualityError(f"missing columns: {missing}")
    report = quality.issue_counts(
        files.scan_observations(spark, path, layout), files.scan_regions(spark, reference.regions),
        files.scan_diseases(spark, reference.diseases))
    verdict = report.first()
    if not verdict["passed"]:
        raise QualityError(f"quality score {verdict['quality_score']} of "
                           f"{verdict['total_rows']} rows is below {quality.PASS_MARK}")
    return spark.createDataFrame([verdict], report.schema)


def load_files(spark: SparkSession, folder: str, reference: ReferencePaths, root: str,
               active: str = files.ACTIVE_FILE,
               fallbacks: Sequence[str] = files.FALLBACK_FILES,
               check: bool = True, full_refresh: bool = True) -> tuple[Warehouse, DataFrame]:
    """Loads the active data set of a folder into a warehouse at ``root``.

    Returns the warehouse and one status row per table, labelled with the kind of data set,
    and one per reason for which cleaning drops rows (status ``dropped``).
    """
    path = files.resolve_active(spark, folder, active, fallbacks)
    layout = files.scan_layout(spark, path)
    if check:
        check_raw(spark, path, reference, layout)
    warehouse = Warehouse(spark, root, lambda: read_sources(spark, path, reference, layout))
    label = files.source_label(F.lit(path))
    status = warehouse.load(full_refresh)
    dropped = clean.dropped_rows(files.scan_observations(spark, path, layout)).drop("rows_read")
    reasons = dropped.unpivot([], dropped.columns, "table_name", "row_count").select(
        "table_name", F.lit("dropped").alias("status"), "row_count",
        F.lit(0.0).alias("execution_time_ms"))
    return warehouse, status.unionByName(reasons).withColumn("source_label", label)
