"""Every operator as a named query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom import schemas
from caseloom.functions import epiweek, guards, nested, rounding, text
from caseloom.operators import (
    clean, graph, olap, partials, population, quality, ranking, reconcile, summaries)
from caseloom.plans import catalog, graph_queries
from caseloom.plans.warehouse import Sources, Warehouse, open_warehouse
from caseloom.sources import binding, events, observations, tables
from caseloom.streaming import queries as stream_queries
from caseloom.streaming import sinks

DISEASE = "STANDARD"
YEAR = 1998
YEARS = {"start_year": 1996, "end_year": 2000}
SPAN = 2
COVERAGE_DENOMINATOR = 25 * 7

_registry: dict[str, Callable[[Warehouse, str], DataFrame]] = {}


def register(name: str):
    def add(function):
        _registry[name] = function
        return function
    return add


def bound_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    def sources() -> Sources:
        return Sources(
            clean.typed_observations(binding.observations(spark, sf_dir)),
            binding.regions(spark, sf_dir), binding.diseases(spark, sf_dir),
            binding.populations(spark, sf_dir), binding.border_lists(spark, sf_dir))
    return open_warehouse(spark, sf_dir, sources)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(function):
        return lambda spark, sf_dir: function(bound_warehouse(spark, sf_dir), sf_dir)
    return {name: bind(function) for name, function in _registry.items()}


# --- decision queries -------------------------------------------------------------------

_PARAMETERS = {
    "Q2": {"year": YEAR, "disease": DISEASE}, "Q3": {"disease": DISEASE, **YEARS},
    "Q4": {"disease": DISEASE}, "Q5": {"disease": DISEASE}, "Q7": {"disease": DISEASE},
    "Q8": {"span": SPAN}, "Q11": {"disease": DISEASE, "threshold": 50},
    "Q13": {"denominator": COVERAGE_DENOMINATOR},
}


def _decision(query_id: str, model: str) -> None:
    def answer(wh: Warehouse, sf_dir: str) -> DataFrame:
        df = catalog.run(wh, query_id, model, **_PARAMETERS.get(query_id, {}))
        if query_id == "Q12":
            return df.select("state", "code", F.inline("profile"))
        return df
    register(f"q{int(query_id[1:]):02d}_{model}")(answer)


for _query_id, _entry in catalog.CATALOG.items():
    for _model in _entry.models:
        _decision(_query_id, _model)


@register("q01_graph_paths")
def _q01_paths(wh, sf_dir):
    """Query 1 along explicit edges: month, quarter, year, decade.

    The disease and the month of an aggregate are its own columns, so those hops need no join.
    """
    def hop(kind, src, dst):
        return wh.edges(kind).select(F.col("src").alias(src), F.col("dst").alias(dst))
    month = (F.col("year") * 100 + F.col("month")).cast("string")
    rows = (wh.graph().aggregates.withColumn("m", month).withColumnRenamed("disease", "disease_name")
            .join(hop("IN_QUARTER", "m", "q"), "m").join(hop("IN_YEAR", "q", "y"), "q")
            .join(hop("IN_DECADE", "y", "d"), "y"))
    return rows.groupBy("disease_name", F.col("d").cast("int").alias("decade")).agg(
        F.sum("total_cases").alias("total_cases"),
        rounding.half_up(F.avg("avg_incidence"), 2).alias("avg_incidence"))


@register("q11_graph_all_pairs")
def _q11_all(wh, sf_dir):
    return graph_queries.q11_graph(wh.graph(), DISEASE, 50, k=None)


@register("border_lag_histogram")
def _lags(wh, sf_dir):
    return graph_queries.lag_histogram(graph_queries.q11_graph(wh.graph(), DISEASE, 50, k=None))


# --- generic operations -----------------------------------------------------------------

_SLICES = {"disease": "PROMO", "state": "NATION_7", "year": YEAR, "decade": 1990, "region": "ASIA"}


def _slice(dimension: str, value) -> None:
    register(f"olap_slice_{dimension}_summary")(
        lambda wh, _: olap.slice_summary(wh.star(), dimension, value).withColumn(
            "slice_key", F.col("slice_key").cast("string")))
    register(f"olap_slice_{dimension}_breakdown")(
        lambda wh, _: olap.slice_breakdown(wh.star(), dimension, value).withColumn(
            "slice_key", F.col("slice_key").cast("string")))


for _dimension, _value in _SLICES.items():
    _slice(_dimension, _value)
for _level in olap.FINER:
    register(f"olap_drilldown_{_level}")(
        lambda wh, _, level=_level: olap.drill_down(wh.star(), level))
for _level in olap.COARSER:
    register(f"olap_rollup_{_level}")(lambda wh, _, level=_level: olap.roll_up(wh.star(), level))


@register("olap_drilldown_one_year")
def _drill_year(wh, sf_dir):
    return olap.drill_down(wh.star(), "year", YEAR)


@register("olap_dice")
def _dice(wh, sf_dir):
    return olap.dice(wh.star(), {"disease": DISEASE, "region": "ASIA", "unknown": 1})


@register("olap_dice_state_year")
def _dice_state_year(wh, sf_dir):
    return olap.dice(wh.star(), {"state": "NATION_7", "year": YEAR, "decade": 1990})


@register("olap_pivot")
def _pivot(wh, sf_dir):
    return olap.pivot(wh.star(), list(binding.INTRODUCTION_YEARS))


# --- summaries --------------------------------------------------------------------------

def _summary(name: str) -> None:
    def answer(wh: Warehouse, sf_dir: str) -> DataFrame:
        df = wh.summary_builders()[name]()
        decimals = [f.name for f in df.schema if f.dataType.typeName() == "decimal"]
        return df.withColumns({c: F.round(F.col(c), 8).cast("double") for c in decimals})
    register(name)(answer)


for _name in ("mv_monthly_disease_state", "mv_yearly_disease_region", "mv_decade_disease_national",
              "mv_yearly_disease_city", "summary_monthly_by_region", "summary_decade_national",
              "summary_weekly_by_region"):
    _summary(_name)


def _summary_from_states(name: str) -> None:
    def answer(wh: Warehouse, sf_dir: str) -> DataFrame:
        """The same summary from stored partial states, two decades of which were refreshed alone."""
        wh.state_table(name)
        wh.refresh_decades([1990, 1880])
        df = wh.state_table(name)
        if "decade" not in wh.summary_builders()[name]().columns:
            df = df.drop("decade")
        decimals = [f.name for f in df.schema if f.dataType.typeName() == "decimal"]
        return df.withColumns({c: F.round(F.col(c), 8).cast("double") for c in decimals})
    register(f"{name}_from_states")(answer)


for _name in partials.FROM_STATES:
    _summary_from_states(_name)


@register("distinct_estimates")
def _distinct_estimates(wh, sf_dir):
    """Exact distinct states per disease and decade, and whether merged sketches come within 5 percent."""
    exact = wh.summary_builders()["mv_decade_disease_national"]().select("disease_name", "decade", "states_reporting")
    estimates = partials.estimated(wh.state_table("place_sketches"), "disease_name", "decade")
    near = F.abs(F.col("estimate") - F.col("states_reporting")) <= 0.05 * F.col("states_reporting")
    return exact.join(estimates, ["disease_name", "decade"], "left").select(
        "disease_name", "decade", "states_reporting", F.coalesce(near, F.lit(False)).alias("within_bound"))


@register("summary_monthly_by_region_states")
def _region_states(wh, sf_dir):
    return summaries.monthly_by_region(wh.buckets(), state_only=True)


@register("refresh_summaries")
def _refresh(wh, sf_dir):
    """Refreshes every summary table and reports outcome and size (the time is left out)."""
    return wh.refresh_summaries().select("table_name", "status", "row_count")


# --- cleaning and quality ---------------------------------------------------------------

def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a dirty text feed: padded names, bad numbers, unknown codes."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    n, user = F.col("event_id"), F.col("user_id")

    def pick(column, by, choices: dict, otherwise):
        chosen = None
        for key, value in choices.items():
            value = F.lit(value) if isinstance(value, str) or value is None else value
            chosen = (F.when(column % by == key, value) if chosen is None
                      else chosen.when(column % by == key, value))
        return chosen.otherwise(otherwise)

    week = binding.epi_week(F.col("ts"))
    state = F.concat(F.lit("NATION_"), (user % 25).cast("string"))
    disease = (F.when(n % 97 == 0, "NA").when(F.col("event_type") == "click", " standard ")
               .when(F.col("event_type") == "view", "SMALL")
               .when(F.col("event_type") == "purchase", "PROMO")
               .when(F.col("event_type") == "error", "UNKNOWN"))
    year_text = F.year("ts").cast("string")
    return rows.select(
        pick(n, 11, {0: F.concat(year_text, F.lit("00")), 1: "bad", 2: F.concat(year_text, F.lit("54"))},
             week.cast("string")).alias("epi_week"),
        F.when(user % 29 == 0, "XX").otherwise(state).alias("state"),
        pick(user, 7, {0: None, 1: 'A "B", C', 2: "Two\nlines"},
             F.concat(F.lit(" City "), (user % 5).cast("string"), F.lit(" "))).alias("loc"),
        F.when(F.col("event_type") == "purchase", " city").otherwise("State").alias("loc_type"),
        disease.alias("disease"),
        pick(n, 8, {0: None, 1: "abc", 2: "-3", 3: "0", 4: "0.5"},
             F.get_json_object("props", "$.k")).alias("cases"),
        F.when(n % 5 != 0, F.col("value").cast("string")).otherwise("n/a")
        .alias("incidence_per_100000"))


def _write_csv(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def _feed_files(wh: Warehouse, sf_dir: str) -> list[str]:
    """The dirty feed as CSV: half of it in another column order, with one more column."""
    folder = wh.path("feed_real.csv")
    plain, shuffled = f"{folder}/plain_real", f"{folder}/shuffled_real"
    if not tables.table_exists(wh.spark, shuffled):
        rows = raw_feed(wh.spark, sf_dir)
        first = F.pmod(F.xxhash64(*rows.columns), F.lit(2)) == 0
        _write_csv(rows.where(first), plain)
        _write_csv(rows.where(~first).select(
            "disease", "loc", F.lit("x, \"y\"").alias("note"), "cases", "epi_week", "state",
            "incidence_per_100000", "loc_type"), shuffled)
    return [plain, shuffled]


def _feed(wh: Warehouse, sf_dir: str) -> DataFrame:
    """The dirty feed's file set, scanned back as raw observations."""
    return observations.scan_observations(wh.spark, _feed_files(wh, sf_dir))


@register("scan_raw_csv")
def _scan_csv(wh, sf_dir):
    return _feed(wh, sf_dir)


@register("scan_reference_csv")
def _scan_reference(wh, sf_dir):
    """Every row of the four reference tables, written as CSV files and scanned back."""
    scans = {"regions": observations.scan_regions, "diseases": observations.scan_diseases,
             "populations": observations.scan_populations, "borders": observations.scan_borders}
    frames = {**{n: wh.table(n) for n in ("regions", "diseases", "populations")},
              "borders": binding.border_lists(wh.spark, sf_dir)}
    none, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    facts = {"regions": ("state_code", F.col("census_region"), F.col("census_division"),
                         F.col("latitude"), F.col("longitude")),
             "diseases": ("disease_name", F.col("disease_category"),
                          F.concat_ws(" ", "transmission_type", "is_vaccine_preventable"),
                          F.col("vaccine_intro_year"), number),
             "populations": ("state_code", F.col("source"), none, F.col("decade"), F.col("population")),
             "borders": ("state_code", F.col("borders"), none, number, number)}
    rows = None
    for name, scan in scans.items():
        path = wh.path(f"reference/{name}.csv")
        if not tables.table_exists(wh.spark, path):
            backwards = frames[name].columns[::-1]
            _write_csv(frames[name].select(*backwards), path)
        key, label, detail, x, y = facts[name]
        part = scan(wh.spark, path).select(
            F.lit(name).alias("file"), F.col(key).alias("key"), label.alias("name"),
            detail.alias("detail"), x.cast("double").alias("x"), y.cast("double").alias("y"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


@register("dropped_rows")
def _dropped(wh, sf_dir):
    """How many rows of the dirty feed cleaning drops, by reason."""
    return clean.dropped_rows(_feed(wh, sf_dir))


@register("clean_observations")
def _clean(wh, sf_dir):
    return clean.clean_observations(_feed(wh, sf_dir))


@register("rows_by_grain")
def _grain(wh, sf_dir):
    return clean.rows_by_grain(clean.clean_observations(_feed(wh, sf_dir)))


@register("source_labels")
def _labels(wh, sf_dir):
    """Row counts per source label; the label is read off the names of the files."""
    rows = observations.with_source_label(wh.spark, _feed_files(wh, sf_dir))
    return rows.groupBy("source_label").agg(F.count("*").alias("row_count"))


@register("quality_column_report")
def _columns(wh, sf_dir):
    """Required columns over a file set of which one part lacks two of them."""
    plain, _ = _feed_files(wh, sf_dir)
    short = wh.path("short_feed")
    if not tables.table_exists(wh.spark, short):
        _write_csv(raw_feed(wh.spark, sf_dir).drop("loc_type", "incidence_per_100000"), short)
    files = [plain, short]
    absent = {c for columns in observations.missing_by_file(wh.spark, files).values() for c in columns}
    return quality.column_report(observations.scan_observations(wh.spark, files), absent=sorted(absent)
                                 ).select("column_name", "present")


@register("quality_issue_counts")
def _issues(wh, sf_dir):
    return quality.issue_counts(_feed(wh, sf_dir), wh.table("regions"), wh.table("diseases"))


@register("quality_found_values")
def _found(wh, sf_dir):
    found = quality.found_values(_feed(wh, sf_dir), wh.table("regions"), wh.table("diseases"))
    return found.withColumns({c: F.concat_ws(",", c) for c in ("diseases", "states")})


@register("quality_duplicate_keys")
def _duplicates(wh, sf_dir):
    """Groups of feed rows that repeat a (disease, state, week) key."""
    rows = clean.clean_observations(_feed(wh, sf_dir))
    return quality.duplicate_keys(rows, ["disease", "state", "epi_week"])


@register("quality_unique_rules")
def _unique(wh, sf_dir):
    """Violations of each uniqueness rule of the star tables and the graph's nodes; all must be 0."""
    frames = {**{n: wh.table(n) for n in ("dim_time", "dim_location", "dim_disease")},
              "mv_monthly_disease_state": wh.summary_builders()["mv_monthly_disease_state"](),
              **wh.full_graph().nodes}
    return reconcile.profile({"unique": {
        name: quality.duplicate_keys(frames[name], keys)
        for name, keys in {**quality.UNIQUE_KEYS, **quality.NODE_KEYS}.items() if name in frames}}).select(
            F.col("name").alias("table_name"), F.col("row_count").alias("violations"))


@register("quality_fact_keys")
def _fact_keys(wh, sf_dir):
    """Rows of the fact, distinct keys, and the first and last key: 1 to the number of rows."""
    return wh.table("fact").agg(
        F.count("*").alias("row_count"), F.count_distinct("incidence_key").alias("key_count"),
        F.min("incidence_key").alias("first_key"), F.max("incidence_key").alias("last_key"))


@register("quality_orphans")
def _orphans(wh, sf_dir):
    """Fact rows per foreign key that miss their dimension row; all must be 0."""
    return reconcile.profile({"orphans": {
        key: quality.orphans(wh.table("fact"), wh.table(dim), key)
        for key, dim in quality.FOREIGN_KEYS.items()}}).select(
            F.col("name").alias("key_name"), F.col("row_count").alias("violations"))


@register("quality_unknown_states")
def _unknown(wh, sf_dir):
    """Anti join: cleaned feed rows whose state is not in the reference."""
    rows = clean.clean_observations(_feed(wh, sf_dir))
    known = wh.table("regions").select(F.col("state_code").alias("state"))
    return (quality.orphans(rows, known, "state").groupBy("state", "disease")
            .agg(F.count("*").alias("row_count")))


@register("quality_known_diseases")
def _known(wh, sf_dir):
    """Semi join: cleaned feed rows of reference diseases."""
    rows = clean.clean_observations(_feed(wh, sf_dir))
    known = wh.table("diseases").select(F.col("disease_name").alias("disease"))
    return rows.join(known, "disease", "left_semi").groupBy("disease").agg(
        F.count("*").alias("row_count"), F.sum("cases").alias("cases"))


@register("quality_null_counts")
def _nulls(wh, sf_dir):
    return quality.null_counts(_feed(wh, sf_dir), schemas.RAW_COLUMNS)


@register("quality_required_columns")
def _required(wh, sf_dir):
    """Null counts of every column of the star tables that must be set; all must be 0."""
    parts = None
    for name, columns in quality.REQUIRED_COLUMNS.items():
        part = quality.null_counts(wh.table(name), columns).withColumn("table_name", F.lit(name))
        parts = part if parts is None else parts.unionByName(part)
    return parts


@register("load_if_empty")
def _guarded(wh, sf_dir):
    """A guarded load: the second attempt leaves the table alone, so rows are not doubled."""
    path, schema = wh.path("guarded"), schemas.OBSERVATIONS
    rows = wh.table("observations")
    tables.remove_table(wh.spark, path)
    tables.load_if_empty(rows, path, schema)
    tables.load_if_empty(rows.filter(F.col("loc_type") == "CITY"), path, schema)
    return tables.read_table(wh.spark, path, schema).groupBy("disease").agg(
        F.count("*").alias("row_count"), F.sum("cases").alias("cases"))


# --- models -----------------------------------------------------------------------------

@register("observations")
def _observations(wh, sf_dir):
    return wh.table("observations")


@register("dim_time")
def _dim_time(wh, sf_dir):
    wide = ["week_number", "month", "quarter", "year", "decade", "century"]
    return wh.table("dim_time").withColumns({c: F.col(c).cast("int") for c in wide})


@register("dim_location")
def _dim_location(wh, sf_dir):
    return wh.table("dim_location").withColumns(
        {c: F.col(c).cast("double") for c in ("latitude", "longitude")})


@register("dim_disease")
def _dim_disease(wh, sf_dir):
    return wh.star().diseases


@register("fact")
def _fact(wh, sf_dir):
    """Every fact row, with natural keys in place of surrogate ones."""
    rows = wh.star().rows("time", "disease", "location", grain=None)
    return rows.select(
        "epi_week", "disease_name", "state_code", "city_name", "loc_type", "case_count",
        F.col("incidence_rate").cast("double").alias("incidence_rate"), "population")


@register("bucket_documents")
def _documents(wh, sf_dir):
    """Bucket attributes and summaries, flattened by path."""
    return wh.buckets().summaries().select(
        "disease.name", "disease.category", "disease.vaccine_preventable", "disease.vaccine_year",
        "location.city", "location.state_code", "location.region", "location.division",
        "location.loc_type", "location.coordinates.lat", "time_bucket.year", "time_bucket.month",
        "time_bucket.month_name", "time_bucket.quarter", "time_bucket.decade",
        "monthly_summary.total_cases", "monthly_summary.avg_incidence_rate",
        "monthly_summary.peak_weekly_cases", "monthly_summary.observation_count")


@register("bucket_weeks")
def _weeks(wh, sf_dir):
    """Weekly arrays unwound, with the position of each week in its array."""
    return wh.buckets().documents.select(
        F.col("disease.name").alias("name"), F.col("location.state_code").alias("state_code"),
        F.col("location.city").alias("city"),
        F.posexplode("weekly_observations").alias("position", "week")).select(
            "name", "state_code", "city", "position", "week.epi_week", "week.week", "week.cases",
            "week.incidence_rate")


@register("bucket_array_totals")
def _array_totals(wh, sf_dir):
    """Array expressions per bucket: reduce, first element, size test."""
    weeks = F.col("weekly_observations")
    return wh.buckets().documents.select(
        F.col("disease.name").alias("name"), F.col("location.state_code").alias("state_code"),
        F.col("location.city").alias("city"), F.col("time_bucket.year").alias("year"),
        F.col("time_bucket.month").alias("month"),
        nested.total_of(weeks, "cases").alias("array_total"),
        nested.first_of(weeks)["epi_week"].alias("first_week"),
        nested.has_at_least(weeks, 2).alias("several_weeks"))


@register("bucket_rows")
def _bucket_rows(wh, sf_dir):
    """Stored weekly rows against the summaries of their buckets: every total must agree."""
    weeks = wh.buckets().weeks().groupBy("bucket_key").agg(
        F.sum("cases").alias("week_cases"), F.count("*").alias("weeks"))
    return wh.buckets().summaries().join(weeks, "bucket_key").groupBy(
        F.col("disease.name").alias("name"), F.col("time_bucket.year").alias("year")).agg(
        F.sum("monthly_summary.total_cases").alias("total_cases"), F.count("*").alias("buckets"),
        F.sum("week_cases").alias("week_cases"))


@register("monthly_aggregates")
def _aggregates(wh, sf_dir):
    return wh.table("monthly_aggregates")


@register("monthly_aggregates_paths")
def _aggregate_paths(wh, sf_dir):
    """The aggregate along two optional routes to a state, coalesced."""
    nodes = wh.full_graph().nodes
    rows = graph.aggregate_over_paths(nodes["Observation"], nodes["State"], nodes["City"])
    mean = rounding.mean_of_units(F.col("units"), F.col("observation_count"))
    return rows.withColumn("avg_incidence", mean).drop("units")


@register("graph_observations")
def _graph_observations(wh, sf_dir):
    return wh.table("observation_nodes").drop("observation_id")


@register("borders")
def _borders(wh, sf_dir):
    return graph.borders(binding.border_lists(wh.spark, sf_dir))


def _node_and_edge_counts(nodes, edges) -> DataFrame:
    return reconcile.profile({"node": nodes, "edge": edges})


@register("graph_profile")
def _profile(wh, sf_dir):
    """Rows per node label and edge type."""
    full = wh.full_graph()
    edges = {k: graph.edges(k, full.nodes, full.regions, full.borders) for k in graph.EDGE_KINDS}
    return _node_and_edge_counts(full.nodes, edges)


@register("graph_write_profile")
def _written_profile(wh, sf_dir):
    """The same counts after writing one table per label and edge type."""
    folder = wh.path("graph")
    wh.write_graph(folder)
    full = wh.full_graph()
    edge_schema = "src string, dst string"
    nodes = {label: wh.spark.read.schema(df.schema).parquet(f"{folder}/nodes/{label}")
             for label, df in full.nodes.items()}
    edges = {kind: wh.spark.read.schema(edge_schema).parquet(f"{folder}/edges/{kind}")
             for kind in graph.EDGE_KINDS}
    return _node_and_edge_counts(nodes, edges)


@register("graph_place_edges")
def _place_edges(wh, sf_dir):
    kinds = ["IN_COUNTRY", "IN_REGION", "LOCATED_IN_STATE", "BORDERS"]
    rows = [wh.edges(kind).withColumn("kind", F.lit(kind)) for kind in kinds]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


@register("graph_calendar_edges")
def _calendar_edges(wh, sf_dir):
    kinds = ["IN_DECADE", "IN_YEAR", "IN_QUARTER", "IN_MONTH"]
    rows = [wh.edges(kind).withColumn("kind", F.lit(kind)) for kind in kinds]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


@register("model_profile")
def _models(wh, sf_dir):
    """Rows per star table, bucket table and summary."""
    star_tables = {n: wh.table(n) for n in ("dim_time", "dim_location", "dim_disease", "fact")}
    builders = wh.summary_builders()
    return reconcile.profile({
        "table": star_tables, "document": {"buckets": wh.buckets().summaries()},
        "summary": {name: build() for name, build in builders.items()}})


@register("merge_replace")
def _merge(wh, sf_dir):
    """State summaries replaced by all-grain summaries where keys match, others added."""
    current = summaries.monthly_by_region(wh.buckets(), state_only=True).filter(
        F.col("year") <= YEAR)
    updates = summaries.monthly_by_region(wh.buckets(), state_only=False).filter(
        F.col("year") >= YEAR)
    keys, base = ["disease", "region", "year", "month"], wh.path("merge")
    tables.merge_replace(current, keys, f"{base}/none", f"{base}/v1", current.schema)
    tables.merge_replace(updates, keys, f"{base}/v1", f"{base}/v2", current.schema)
    return tables.read_table(wh.spark, f"{base}/v2", current.schema)


@register("week_ranks")
def _week_ranks(wh, sf_dir):
    """Every reported week by its cases: RANK with its heavy ties, and the place in a total order."""
    weeks = wh.table("observations").select("disease", "state", "loc", "loc_type", "epi_week", "cases")
    names = [F.col(c).asc() for c in ("disease", "state", "loc", "loc_type", "epi_week")]
    ranked = ranking.ranks(weeks, ["cases"], descending=True, name="case_rank")
    return ranking.ordinals(ranked, [F.col("cases").desc(), *names], name="place")


@register("merge_partitions")
def _merge_partitions(wh, sf_dir):
    """The same merge in place, on a table stored by year: only the years updated are rewritten."""
    current = summaries.monthly_by_region(wh.buckets(), state_only=True).filter(F.col("year") <= YEAR)
    updates = summaries.monthly_by_region(wh.buckets(), state_only=False).filter(F.col("year") >= YEAR)
    path = wh.path("merge_by_year")
    tables.write_table(current, path, ["year"])
    tables.merge_partitions(updates, ["disease", "region", "year", "month"], path, current.schema, ["year"])
    return tables.read_table(wh.spark, path, current.schema)


# --- population and expectation ---------------------------------------------------------

@register("population_interpolated")
def _interpolated(wh, sf_dir):
    years = (wh.table("observations").filter(F.col("loc_type") == "STATE")
             .select("state", epiweek.year_of(F.col("epi_week")).alias("year")).distinct())
    return population.interpolated(years, wh.table("populations"))


@register("population_extrapolated")
def _extrapolated(wh, sf_dir):
    return population.extrapolated_backwards(
        wh.table("populations"), anchors=(1990, 2000), decades=(1980, 1970, 1890))


@register("population_left_lookup")
def _left_lookup(wh, sf_dir):
    """Observed state-decades with their population; states without one stay, with null."""
    rows = clean.clean_observations(_feed(wh, sf_dir)).select(
        "state", epiweek.decade_of(epiweek.year_of(F.col("epi_week"))).alias("decade")).distinct()
    people = wh.table("populations").select(
        F.col("state_code").alias("state"), "decade", "population")
    return rows.join(people, ["state", "decade"], "left")


def _scored(wh: Warehouse, sf_dir: str) -> DataFrame:
    rows = epiweek.with_year_month(
        wh.table("observations").filter(F.col("loc_type") == "STATE"))
    years = rows.select("state", "year").distinct()
    people = population.interpolated(years, wh.table("populations"))
    parameters = binding.expectation_parameters(wh.spark, sf_dir)
    return population.expected_cases(
        rows.join(people, ["state", "year"]), parameters, 1995, eradicated="ECONOMY")


@register("expected_cases")
def _expected(wh, sf_dir):
    return _scored(wh, sf_dir).select(
        "disease", "state", "epi_week", "cases", F.round("expected", 6).alias("expected"))


@register("observed_to_expected")
def _ratio(wh, sf_dir):
    rows = population.observed_to_expected(_scored(wh, sf_dir))
    return rows.withColumns({c: F.round(c, 6) for c in ("expected", "ratio")})


@register("incidence_per_100k")
def _incidence(wh, sf_dir):
    """Incidence recomputed from cases and population on the fact."""
    rows = wh.star().rows("time", "disease", "location", grain=None)
    scored = clean.incidence_per_100k(
        rows.withColumn("people", F.coalesce("population", F.lit(0))), "case_count", "people")
    return scored.select("disease_name", "state_code", "city_name", "epi_week", "case_count",
                         "incidence")


# --- comparison and overview ------------------------------------------------------------

@register("reconcile_q01")
def _reconcile(wh, sf_dir):
    """Query 1 on star and bucket side by side."""
    answers = catalog.run_all_models(wh, "Q1")
    return reconcile.side_by_side(answers["star"], answers["bucket"], ["disease_name", "decade"],
                                  ["total_cases"], ("star", "bucket"))


@register("reconcile_q03_differences")
def _differences(wh, sf_dir):
    """Rows of query 3 that only one of star and graph returns."""
    answers = catalog.run_all_models(wh, "Q3", disease="PROMO", **YEARS)
    return reconcile.row_differences(answers["star"], answers["graph"], ("star", "graph"))


@register("overview_by_disease")
def _by_disease(wh, sf_dir):
    return reconcile.totals_with_share(catalog.run(wh, "Q1", "bucket"), "disease_name")


@register("overview_by_decade")
def _by_decade(wh, sf_dir):
    return reconcile.totals_by(catalog.run(wh, "Q1", "bucket"), "decade")


# --- expression-level rows --------------------------------------------------------------

@register("time_fields")
def _time_fields(wh, sf_dir):
    """Calendar attributes of every distinct week number in the dirty feed, weeks 0 and 54 too."""
    weeks = clean.clean_observations(_feed(wh, sf_dir)).select("epi_week").distinct()
    return epiweek.with_time_fields(weeks)


@register("division_guards")
def _guards(wh, sf_dir):
    """The four guards on the same yearly totals with their previous year."""
    yearly = catalog.run(wh, "Q5", "star", disease=DISEASE).select(
        "state_name", "year", F.col("total_cases").alias("cur"),
        F.col("prev_year_cases").alias("prev"))
    zeroed = yearly.withColumn("prev", F.when(F.col("year") % 3 == 0, 0).otherwise(F.col("prev")))
    prev, cur = F.col("prev"), F.col("cur").cast("double")
    return zeroed.select(
        "state_name", "year", (cur / guards.null_if_zero(prev)).alias("null_guard"),
        (cur / guards.one_if_zero(prev)).alias("one_guard"),
        (cur / guards.at_least_one(prev)).alias("max_guard"),
        guards.when_usable(prev, F.col("cur") - prev).alias("usable_guard"))


@register("rounding_rules")
def _rounding(wh, sf_dir):
    """The three rounding rules on every distinct reported rate."""
    rate = F.col("incidence_per_100000")
    return wh.table("observations").select(rate.alias("rate")).distinct().select(
        "rate", F.col("rate").cast(schemas.RATE).cast("double").alias("half_up"),
        rounding.half_even(F.col("rate"), 4).alias("half_even"),
        rounding.scaled_even(F.col("rate"), 4).alias("scaled_even"))


@register("text_conversions")
def _text(wh, sf_dir):
    """Number, flag and name conversions on the raw feed's distinct texts."""
    rows = raw_feed(wh.spark, sf_dir)
    return rows.select("cases", "disease", "loc_type").distinct().select(
        "cases", F.col("disease").alias("raw_disease"), "loc_type",
        text.number_or_null(F.col("cases")).alias("number"),
        text.tidy(F.col("disease")).alias("name"),
        text.true_text(F.col("loc_type")).alias("flag"))


# --- events and streams -----------------------------------------------------------------

def _topic(wh: Warehouse, sf_dir: str) -> str:
    path = wh.path("topic")
    if not tables.table_exists(wh.spark, path):
        messages = events.as_messages(binding.event_rows(wh.spark, sf_dir)).repartition(4)
        events.publish_files(messages, path, "overwrite")
    return path


def _run_folder(wh: Warehouse, name: str) -> str:
    """The one folder of a query's stream, emptied for a run from the start."""
    folder = wh.path(f"stream/{name}")
    tables.remove_table(wh.spark, folder)
    return folder


def _event_stream(wh: Warehouse, sf_dir: str, max_files: int | None = None) -> DataFrame:
    return events.parsed_events(events.file_topic(wh.spark, _topic(wh, sf_dir), max_files))


def _appended(wh: Warehouse, stream: DataFrame, name: str) -> DataFrame:
    folder = _run_folder(wh, name)
    sinks.finish(sinks.append_rows(stream, f"{folder}/rows", f"{folder}/checkpoint"))
    return wh.spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def _state_of(wh: Warehouse, stream: DataFrame, keys: list[str], name: str) -> DataFrame:
    folder = _run_folder(wh, name)
    sinks.finish(sinks.record_changes(stream, f"{folder}/changes", f"{folder}/checkpoint"))
    return sinks.current_state(wh.spark, f"{folder}/changes", stream.schema, keys)


@register("publish_messages")
def _messages(wh, sf_dir):
    """Published messages decoded again."""
    messages = events.as_messages(binding.event_rows(wh.spark, sf_dir)).drop("timestamp")
    return events.parsed_events(messages.withColumn("message_key", F.col("key")))


@register("publish_observations")
def _published_observations(wh, sf_dir):
    """Stored observations published as events, decoded again and totalled."""
    messages = events.as_messages(events.from_observations(wh.table("observations")))
    decoded = events.parsed_events(messages)
    return decoded.groupBy("disease", "epi_week").agg(
        F.count("*").alias("events"), F.sum("cases").alias("cases"),
        F.min("incidence_rate").alias("lowest_rate"), F.max("incidence_rate").alias("highest_rate"))


@register("publish_head")
def _head(wh, sf_dir):
    """The head that a limited publish of the newest events emits, decoded again."""
    rows = binding.event_rows(wh.spark, sf_dir).orderBy(F.desc("timestamp"), F.desc("event_id"))
    return events.parsed_events(events.as_messages(rows, limit=500)).select(
        "event_id", "disease", "state", "epi_week", "cases", "incidence_rate")


@register("stream_validated")
def _validated(wh, sf_dir):
    return _appended(wh, stream_queries.validated(_event_stream(wh, sf_dir)), "validated").drop("timestamp")


def _alert_rows(wh: Warehouse, sf_dir: str) -> DataFrame:
    return stream_queries.alerts(stream_queries.validated(_event_stream(wh, sf_dir)))


@register("stream_alerts")
def _alerts(wh, sf_dir):
    return _appended(wh, _alert_rows(wh, sf_dir).select(
        "disease", "state", "epi_week", "cases", "incidence_rate", "alert_type"), "alerts")


@register("stream_derived_topics")
def _derived(wh, sf_dir):
    """Validated events published again, alerts made from that topic and published, then decoded."""
    folder = _run_folder(wh, "derived")
    valid = events.as_messages(stream_queries.validated(_event_stream(wh, sf_dir)))
    sinks.finish(sinks.append_messages(valid, f"{folder}/validated", f"{folder}/checkpoint-1"))
    again = events.parsed_events(events.file_topic(wh.spark, f"{folder}/validated"))
    alerts = events.as_messages(stream_queries.alerts(again).drop("alert_type"))
    sinks.finish(sinks.append_messages(alerts, f"{folder}/alerts", f"{folder}/checkpoint-2"))
    messages = wh.spark.read.schema(schemas.TOPIC).option(
        "timestampFormat", events.TIME_FORMAT).json(f"{folder}/alerts")
    return events.parsed_events(messages.withColumn("message_key", F.col("key"))).drop("timestamp")


@register("stream_national_totals")
def _national(wh, sf_dir):
    totals = stream_queries.national_totals(
        stream_queries.validated(_event_stream(wh, sf_dir, max_files=1)))
    return _state_of(wh, totals, ["disease", "epi_week"], "national").withColumn(
        "avg_national_incidence", F.round("avg_national_incidence", 6))


@register("stream_national_totals_bounded")
def _national_bounded(wh, sf_dir):
    """The same table with weeks closed ten weeks after the newest one."""
    totals = stream_queries.national_totals(
        stream_queries.validated(_event_stream(wh, sf_dir)), late_weeks=10)
    return _state_of(wh, totals, ["disease", "epi_week"], "national_bounded").drop("week_start").withColumn(
        "avg_national_incidence", F.round("avg_national_incidence", 6))


@register("stream_closed_weeks")
def _closed_weeks(wh, sf_dir):
    """Totals of closed weeks, each emitted once, and how many late events came after, over five deliveries.

    Events are delivered every six days; each tenth comes two deliveries late.
    """
    folder = _run_folder(wh, "closed_weeks")
    rows = binding.event_rows(wh.spark, sf_dir)
    sixth = F.floor((F.dayofmonth("timestamp") - 1) / 6) + F.when(F.col("event_id") % 10 == 0, 2).otherwise(0)
    rows = rows.withColumn("delivery", F.least(sixth, F.lit(4)))
    schema = None
    for delivery in range(5):
        events.publish_files(events.as_messages(rows.filter(F.col("delivery") == delivery).drop("delivery")),
                             f"{folder}/topic")
        valid = stream_queries.validated(events.parsed_events(events.file_topic(wh.spark, f"{folder}/topic")))
        weeks = stream_queries.national_totals(valid, late_weeks=1)
        sinks.finish(sinks.append_rows(weeks, f"{folder}/weeks", f"{folder}/checkpoint"))
        timed = stream_queries.with_week_start(valid)
        sinks.finish(sinks.record_late(timed, "week_start", 7 * 86_400, f"{folder}/late", f"{folder}/late_checkpoint"))
        schema = weeks.schema, timed.schema
    late = sinks.late_rows(wh.spark, f"{folder}/late", schema[1]).groupBy("disease", "epi_week").agg(
        F.count("*").alias("late_events"))
    weeks = wh.spark.read.schema(schema[0]).parquet(f"{folder}/weeks").drop("week_start")
    return weeks.join(late, ["disease", "epi_week"], "left").withColumns({
        "late_events": F.coalesce("late_events", F.lit(0)),
        "avg_national_incidence": F.round("avg_national_incidence", 6)})


@register("stream_event_rate_panes")
def _rate_panes(wh, sf_dir):
    """The rate of every window from one stored count per second: no event is copied per window."""
    panes = stream_queries.pane_counts(_event_stream(wh, sf_dir, max_files=1))
    seconds = _state_of(wh, panes, ["pane_start"], "rate_panes")
    return _as_texts(stream_queries.rates_of_panes(seconds))


@register("stream_event_rate_closed")
def _rate_closed(wh, sf_dir):
    """Rates of windows that have closed, by two chained aggregations in append mode."""
    rates = stream_queries.closed_event_rates(_event_stream(wh, sf_dir), lateness="0 seconds")
    return _as_texts(_appended(wh, rates, "rate_closed"))


def _as_texts(rates: DataFrame) -> DataFrame:
    return rates.withColumns({
        c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("window_start", "window_end")})


@register("stream_event_rate")
def _rate(wh, sf_dir):
    rates = stream_queries.event_rates(_event_stream(wh, sf_dir, max_files=1))
    return _state_of(wh, rates, ["window_start"], "rate").withColumns({
        c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("window_start", "window_end")})


def _latest(wh: Warehouse, stream: DataFrame, n: int, name: str) -> DataFrame:
    folder = _run_folder(wh, name)
    sinks.finish(sinks.keep_latest(
        stream, ["timestamp", "event_id"], n, f"{folder}/versions", f"{folder}/checkpoint"))
    return sinks.latest_rows(wh.spark, f"{folder}/versions", stream.schema)


@register("stream_latest_events")
def _latest_events(wh, sf_dir):
    return _latest(wh, _event_stream(wh, sf_dir), 50, "latest_events").select(
        "event_id", "disease", "state", "epi_week", "cases", "incidence_rate")


@register("stream_latest_alerts")
def _latest_alerts(wh, sf_dir):
    return _latest(wh, _alert_rows(wh, sf_dir), 20, "latest_alerts").select(
        "event_id", "disease", "state", "epi_week", "cases", "incidence_rate", "alert_type")


@register("stream_running_count")
def _count(wh, sf_dir):
    totals = (_event_stream(wh, sf_dir, max_files=1).groupBy(F.lit("all").alias("topic"))
              .agg(F.count("*").alias("event_count")))
    return _state_of(wh, totals, ["topic"], "count")
