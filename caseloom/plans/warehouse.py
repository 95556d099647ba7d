"""The stored warehouse: builds the three models once and hands out their tables.

Every table is written to the shared scratch folder and read back with a fixed schema, so
queries start from pruned Parquet columns with true sizes instead of recomputing the load.
"""

from __future__ import annotations

import hashlib
import threading
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from caseloom import schemas
from caseloom.operators import bucket, graph, partials, quality, star, summaries
from caseloom.operators.models import Buckets, Graph, Star
from caseloom.session import scratch_root
from caseloom.sources.tables import read_table, refresh_partitions, table_exists, write_table

# Physical layout (schema, partition columns, clustering columns) in the order of dependence.
LAYOUT = {
    "regions": (schemas.REGIONS, [], []),
    "diseases": (schemas.DISEASES, [], []),
    "populations": (schemas.POPULATIONS, [], []),
    "observations": (schemas.OBSERVATIONS, ["loc_type"], []),
    "dim_time": (schemas.DIM_TIME, [], []),
    "dim_location": (schemas.DIM_LOCATION, ["loc_type"], []),
    "dim_disease": (schemas.DIM_DISEASE, [], []),
    "fact": (schemas.FACT, ["loc_type", "decade", "disease_key"], ["time_key"]),
    "buckets": (schemas.BUCKETS, ["decade"], ["disease.name", "time_bucket.year"]),
    "bucket_rows": (schemas.BUCKET_ROWS, ["decade"], ["disease", "year"]),
    "observation_nodes": (schemas.OBSERVATION_NODES, [], []),
    "monthly_aggregates": (schemas.MONTHLY_AGGREGATES, ["decade"], ["disease", "year"]),
    "borders": (schemas.BORDERS, [], []),
}


@dataclass(frozen=True)
class Sources:
    """Inputs of one load: cleaned observations and the four reference tables."""

    observations: DataFrame
    regions: DataFrame
    diseases: DataFrame
    populations: DataFrame
    border_lists: DataFrame


def _raise(problems: list[str]) -> None:
    if problems:
        raise quality.IntegrityError("; ".join(problems))


@dataclass
class Warehouse:
    spark: SparkSession
    root: str
    sources: Callable[[], Sources]
    _frames: dict[str, DataFrame] = field(default_factory=dict)
    _opened: Sources | None = None
    _star: Star | None = None
    _lock: threading.RLock = field(default_factory=threading.RLock)
    _state_schemas: dict[str, T.StructType] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        """A stored table; built, with whatever it needs, on first use."""
        with self._lock:
            if name not in self._frames:
                schema, partitions, clustering = LAYOUT[name]
                if not table_exists(self.spark, self.path(name)):
                    self._write(name, partitions, clustering)
                self._frames[name] = read_table(self.spark, self.path(name), schema)
            return self._frames[name]

    def load(self, full_refresh: bool = True) -> DataFrame:
        """Writes every table in dependency order; one status row per table.

        Without ``full_refresh`` a table that already holds rows is left alone. Repeated keys
        in a reference table stop the load before anything is written; repeated or lost keys
        in what was built raise at its end. Both name the keys.
        """
        outcome = []
        self._opened = self._star = None
        inputs = self._inputs()
        _raise(quality.broken_keys({name: getattr(inputs, name) for name in quality.REFERENCE_KEYS},
                                   quality.REFERENCE_KEYS))
        for name, (schema, partitions, clustering) in LAYOUT.items():
            started = time.monotonic()
            with self._lock:
                filled = table_exists(self.spark, self.path(name)) and not read_table(
                    self.spark, self.path(name), schema).isEmpty()
                if full_refresh or not filled:
                    self._frames.pop(name, None)
                    self._write(name, partitions, clustering)
                    self.spark.catalog.refreshByPath(self.path(name))
                status = "loaded" if full_refresh or not filled else "kept"
            rows = self.table(name).count()
            outcome.append((name, status, rows, round((time.monotonic() - started) * 1000, 2)))
        _raise(self.broken_rules())
        return self.spark.createDataFrame(
            outcome, "table_name string, status string, row_count long, execution_time_ms double")

    def broken_rules(self) -> list[str]:
        """Key rules that the stored star and the graph's nodes break, a line each."""
        dims = {name: keys for name, keys in quality.UNIQUE_KEYS.items() if name in LAYOUT}
        frames = {**{name: self.table(name) for name in dims}, **self.full_graph().nodes}
        parents = {key: self.table(dim) for key, dim in quality.FOREIGN_KEYS.items()}
        return (quality.broken_keys(frames, {**dims, **quality.NODE_KEYS})
                + quality.lost_keys(self.table("fact"), parents))

    def _write(self, name: str, partitions: list[str], clustering: list[str]) -> None:
        df = self._build(name).select(*LAYOUT[name][0].fieldNames())
        write_table(df, self.path(name), partitions, clustering)

    def _inputs(self) -> Sources:
        """The inputs, listed and opened once per load."""
        if self._opened is None:
            self._opened = self.sources()
        return self._opened

    def _build(self, name: str) -> DataFrame:
        t = self.table
        builders: Mapping[str, Callable[[], DataFrame]] = {
            "observations": lambda: self._inputs().observations,
            "regions": lambda: self._inputs().regions,
            "diseases": lambda: self._inputs().diseases,
            "populations": lambda: self._inputs().populations,
            "borders": lambda: graph.border_edges(self._inputs().border_lists, t("regions")),
            "dim_time": lambda: star.build_dim_time(t("observations")),
            "dim_location": lambda: star.build_dim_location(t("observations"), t("regions")),
            "dim_disease": lambda: star.build_dim_disease(t("diseases")),
            "fact": lambda: star.build_fact(
                t("observations"), t("dim_time"), t("dim_location"), t("dim_disease"),
                t("populations")),
            "buckets": lambda: bucket.build_buckets(
                t("observations"), t("regions"), t("diseases")),
            "bucket_rows": lambda: bucket.bucket_rows(t("observations")),
            "observation_nodes": lambda: graph.observation_nodes(
                t("observations"), t("regions"), t("diseases")),
            "monthly_aggregates": lambda: graph.monthly_aggregates(
                t("observation_nodes"), t("regions")),
        }
        return builders[name]()

    def star(self) -> Star:
        if self._star is None:
            self._star = Star(
                *[self.table(n) for n in ("fact", "dim_time", "dim_location", "dim_disease")])
        return self._star

    def buckets(self) -> Buckets:
        return Buckets(self.table("buckets"), self.table("bucket_rows"))

    def graph(self) -> Graph:
        """Aggregates, disease nodes and borders: what the queries read."""
        nodes = {"MonthlyAggregate": self.table("monthly_aggregates"),
                 "Disease": graph.disease_nodes(self.table("diseases"))}
        return Graph(nodes, self.table("borders"), self.table("regions"))

    def full_graph(self) -> Graph:
        """All twelve node sets."""
        regions = self.table("regions")
        nodes = {"Disease": graph.disease_nodes(self.table("diseases")),
                 **graph.place_nodes(self.table("dim_location"), regions),
                 **graph.calendar_nodes(self.table("dim_time")),
                 "Observation": self.table("observation_nodes"),
                 "MonthlyAggregate": self.table("monthly_aggregates")}
        return Graph(nodes, self.table("borders"), regions)

    def edges(self, kind: str) -> DataFrame:
        full = self.full_graph()
        return graph.edges(kind, full.nodes, full.regions, full.borders)

    def write_graph(self, folder: str) -> None:
        """One table per node label and edge type below ``folder``."""
        full = self.full_graph()
        for label, nodes in full.nodes.items():
            write_table(nodes, f"{folder}/nodes/{label}")
        for kind in graph.EDGE_KINDS:
            write_table(graph.edges(kind, full.nodes, full.regions, full.borders),
                        f"{folder}/edges/{kind}")

    def summary_builders(self) -> dict[str, Callable[[], DataFrame]]:
        return {
            "mv_monthly_disease_state": lambda: summaries.monthly_disease_state(self.star()),
            "mv_yearly_disease_region": lambda: summaries.yearly_disease_region(self.star()),
            "mv_decade_disease_national": lambda: summaries.decade_disease_national(self.star()),
            "mv_yearly_disease_city": lambda: summaries.yearly_disease_city(self.star()),
            "summary_monthly_by_region": lambda: summaries.monthly_by_region(
                self.buckets(), state_only=False),
            "summary_decade_national": lambda: summaries.decade_national(self.buckets()),
            "summary_weekly_by_region": lambda: summaries.weekly_by_region(
                self.buckets(), self.table("regions")),
        }

    def refresh_summaries(self, folder: str | None = None) -> DataFrame:
        """Overwrites every summary table; one status row (outcome, rows, time) per table.

        A table that fails is reported and does not stop the others.
        """
        folder = folder or f"{self.root}/summaries"
        outcome = []
        for name, build in self.summary_builders().items():
            started = time.monotonic()
            try:
                df = build()
                write_table(df, f"{folder}/{name}")
                rows = read_table(self.spark, f"{folder}/{name}", df.schema).count()
                status, error = "success", None
            except Exception as exc:  # reported per table
                status, rows, error = "error", None, str(exc).splitlines()[0]
            elapsed = round((time.monotonic() - started) * 1000, 2)
            outcome.append((name, status, rows, elapsed, error))
        return self.spark.createDataFrame(
            outcome, "table_name string, status string, row_count long, "
                     "execution_time_ms double, error string")

    def _state_builders(self, decades: Sequence[int] | None) -> dict[str, Callable[[], DataFrame]]:
        """Tables kept per decade, in the order of dependence."""
        def kept(name: str) -> DataFrame:
            schema = self._state_schemas["place_months"]
            return partials._in_decades(read_table(self.spark, f"{self.root}/states/place_months", schema), decades)

        def summary(build):
            return lambda: build(kept("place_months"), self.star())
        return {"place_months": lambda: partials.place_months(self.star(), decades),
                "place_sketches": lambda: partials.place_sketches(kept("place_months"), self.star()),
                **{name: summary(build) for name, build in partials.FROM_STATES.items()}}

    def refresh_decades(self, decades: Sequence[int] | None = None) -> None:
        """Brings the partial states and the summaries made from them up to date.

        With ``decades`` only those partitions of the fact, of the states and of the summaries
        are read and replaced; without, or before the first refresh, everything is built. A
        refresh that fails may be repeated.
        """
        with self._lock:  # the fact's files may have been replaced since it was opened
            self._frames.pop("fact", None)
            self._star = None
        for name, build in self._state_builders(decades).items():
            path, df = f"{self.root}/states/{name}", build()
            self._state_schemas[name] = df.schema
            if decades is None or not table_exists(self.spark, path):
                write_table(self._state_builders(None)[name](), path, ["decade"])
            else:
                refresh_partitions(df, path, df.schema, ["decade"], [{"decade": d} for d in decades])

    def state_table(self, name: str) -> DataFrame:
        """A table kept by ``refresh_decades``: partial states, sketches, or a summary with its decade."""
        with self._lock:
            if name not in self._state_schemas or not table_exists(self.spark, f"{self.root}/states/{name}"):
                self.refresh_decades()
        return read_table(self.spark, f"{self.root}/states/{name}", self._state_schemas[name])


_open: dict[tuple[str, str], Warehouse] = {}
_open_lock = threading.Lock()


def open_warehouse(spark: SparkSession, source: str, sources: Callable[[], Sources]) -> Warehouse:
    """The warehouse of one source folder in this application; its tables are built on demand.

    The folder is taken to be unchanged while the application runs.
    """
    key = (spark.sparkContext.applicationId, source)
    with _open_lock:
        if key not in _open:
            digest = hashlib.sha1(source.encode()).hexdigest()[:12]
            _open[key] = Warehouse(spark, f"{scratch_root(spark)}/{digest}", sources)
        return _open[key]
