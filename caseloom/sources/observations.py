"""Raw observation files and the four reference files."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom import schemas
from caseloom.sources.tables import path_exists

# Column that tells the file of a row.
FILE = "_file"
# File looked for first, then the ones that stand in for it, in order.
ACTIVE_FILE = "observations.csv"
FALLBACK_FILES = ("observations_real.csv", "observations_synthetic.csv")


def csv_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Data files of a path, a folder or a list of either."""
    return sorted(spark.read.text(path).inputFiles())


@dataclass(frozen=True)
class Layout:
    """What the first look at the files tells: their headers, and which hold line breaks in cells."""

    headers: Mapping[str, list[str]]
    wrapped: frozenset[str]


def scan_layout(spark: SparkSession, path: str | list[str]) -> Layout:
    """Headers and line breaks of all files by one distributed pass over their lines.

    A line with an odd number of quotes leaves a cell open, so the next line belongs to it.
    One row per file reaches the driver, as its name does.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), "value", (quotes % 2 == 1).alias("open"),
        F.struct(F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("line")).alias("place"))
    found = lines.groupBy("file").agg(
        F.min_by("value", "place").alias("first"), F.max("open").alias("open")).collect()
    by_path = {unquote(urlparse(r["file"]).path): r for r in found}
    headers, wrapped = {}, set()
    for name in csv_files(spark, path):
        row = by_path.get(unquote(urlparse(name).path))
        cells = next(csv.reader([row["first"] if row else ""]), [])
        headers[name] = [cell.strip().removeprefix("\ufeff") for cell in cells]
        if row and row["open"]:
            wrapped.add(name)
    return Layout(headers, frozenset(wrapped))


def scan_headers(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """Column names in the first line of every file; an empty file has none."""
    return dict(scan_layout(spark, path).headers)


def scan_csv(spark: SparkSession, path: str | list[str], schema: T.StructType,
             layout: Layout | None = None) -> DataFrame:
    """Columns of a schema by their names, whatever the order in each file.

    Files may hold further columns, quotes are doubled inside quoted cells, and quoted cells
    may hold line breaks. Only a file that has such cells is one task, all others are split.
    A file without one of the columns gives nulls there; ``missing_by_file`` tells which. Files
    with equal headers are read together. ``layout`` saves another look at the files.
    """
    layout = layout or scan_layout(spark, path)
    groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for name, header in layout.headers.items():
        if header:
            groups.setdefault((tuple(header), name in layout.wrapped), []).append(name)
    parts = None
    for (header, wrapped), names in groups.items():
        # Columns that are not asked for keep a place and nothing else.
        fields = [schema[c] if c in schema.fieldNames() and header.index(c) == place
                  else T.StructField(f"_unused_{place}", T.StringType())
                  for place, c in enumerate(header)]
        read = (spark.read.schema(T.StructType(fields)).option("header", True)
                .option("escape", '"').option("multiLine", wrapped).csv([unquote(n) for n in names]))
        part = read.select(*[F.col(f.name) if f.name in read.columns
                             else F.lit(None).cast(f.dataType).alias(f.name) for f in schema],
                           F.col("_metadata.file_path").alias(FILE))
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(FILE, T.StringType())]))
    return parts


def missing_by_file(spark: SparkSession, path: str | list[str],
                    required: Sequence[str] = schemas.RAW_COLUMNS,
                    layout: Layout | None = None) -> dict[str, list[str]]:
    """Required columns that a file lacks, for the files that lack any."""
    headers = (layout or scan_layout(spark, path)).headers
    lacking = {name: sorted(set(required) - set(header)) for name, header in headers.items()}
    return {name: columns for name, columns in lacking.items() if columns}


def scan_observations(spark: SparkSession, path: str | list[str], layout: Layout | None = None) -> DataFrame:
    """Raw observations as the texts in the cells; only empty cells are null."""
    return scan_csv(spark, path, schemas.RAW, layout).drop(FILE)


def source_label(file_name: Column) -> Column:
    """Which kind of data set a file belongs to, read off its name or its folder's."""
    own = F.lower(F.element_at(F.split(file_name, "/"), -1))
    folder = F.lower(F.get(F.split(file_name, "/"), F.size(F.split(file_name, "/")) - 2))

    def kind(name: Column) -> Column:
        return F.when(name.contains("real"), "real").when(name.contains("synth"), "synthetic")
    return F.coalesce(kind(own), kind(folder), F.lit("unspecified"))


def with_source_label(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return scan_csv(spark, path, schemas.RAW).withColumn(
        "source_label", source_label(F.col(FILE))).drop(FILE)


def resolve_active(spark: SparkSession, folder: str, active: str = ACTIVE_FILE,
                   fallbacks: Sequence[str] = FALLBACK_FILES) -> str:
    """Path of the data set to load: the active name, else the first fallback present."""
    for name in dict.fromkeys([active, *fallbacks]):
        path = f"{folder.rstrip('/')}/{name}"
        if path_exists(spark, path):
            return path
    raise FileNotFoundError(f"no observation file in {folder}")


def _reference(spark: SparkSession, path: str, schema) -> DataFrame:
    return scan_csv(spark, path, schema).drop(FILE)


def scan_regions(spark: SparkSession, path: str) -> DataFrame:
    return _reference(spark, path, schemas.REGIONS)


def scan_diseases(spark: SparkSession, path: str) -> DataFrame:
    return _reference(spark, path, schemas.DISEASES)


def scan_populations(spark: SparkSession, path: str) -> DataFrame:
    return _reference(spark, path, schemas.POPULATIONS)


def scan_borders(spark: SparkSession, path: str) -> DataFrame:
    return _reference(spark, path, schemas.BORDER_LISTS)
