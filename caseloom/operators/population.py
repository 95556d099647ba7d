"""Population between decade anchors and expected weekly cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom.functions.epiweek import decade_of
from caseloom.functions.guards import null_if_zero

POPULATION_FLOOR = 30_000
ANCHOR_DECADES = (1930, 1940)
EXTRAPOLATED_DECADES = (1920, 1910)
# Disease, base rate, seasonal amplitude, peak week, vaccine year, yearly decay.
EXPECTATION_PARAMETERS = [
    ("MEASLES", 4.0, 0.6, 12, 1963, 0.15),
    ("PERTUSSIS", 1.5, 0.3, 28, 1948, 0.10),
    ("POLIO", 0.8, 0.7, 32, 1955, 0.25),
    ("DIPHTHERIA", 1.2, 0.4, 8, 1923, 0.08),
    ("SMALLPOX", 0.5, 0.3, 10, 1796, 0.05),
    ("HEPATITIS A", 0.6, 0.2, 42, 1995, 0.12),
    ("MUMPS", 1.0, 0.5, 14, 1967, 0.13),
    ("RUBELLA", 0.9, 0.5, 16, 1969, 0.18),
]
EXPECTATION_SCHEMA = ("disease string, base_rate double, seasonal_amp double, peak_week int, "
                      "vaccine_year int, decay double")
ERADICATED = "SMALLPOX"


def expectation_parameters(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EXPECTATION_PARAMETERS, EXPECTATION_SCHEMA)


def interpolated(state_years: DataFrame, populations: DataFrame) -> DataFrame:
    """Adds ``population`` to (state, year) rows, linear between anchors, clamped outside.

    Each anchor opens a bracket up to the next one. A year is looked up by the decade it
    falls in, so the join is an equality on (state, decade) for every row.
    """
    by_decade = Window.partitionBy("state_code").orderBy("decade")
    anchors = populations.select("state_code", "decade", "population")
    brackets = anchors.select(
        F.col("state_code").alias("state"), F.col("decade").alias("start"),
        F.col("population").alias("low"),
        F.lead("decade").over(by_decade).alias("stop"),
        F.lead("population").over(by_decade).alias("high"))
    # A bracket longer than ten years serves every decade inside it.
    last_decade = F.coalesce(F.col("stop") - 10, F.col("start"))
    per_decade = brackets.withColumn("bracket_decade", F.explode(F.sequence(
        F.col("start"), F.greatest(F.col("start"), last_decade), F.lit(10))))
    ends = anchors.groupBy(F.col("state_code").alias("state")).agg(
        F.min_by("population", "decade").alias("first_population"),
        F.min("decade").alias("first_decade"),
        F.max_by("population", "decade").alias("last_population"),
        F.max("decade").alias("last_decade"))
    rows = (state_years.withColumn("bracket_decade", decade_of(F.col("year")))
            .join(ends, "state").join(per_decade, ["state", "bracket_decade"], "left"))
    gain = (F.col("year") - F.col("start")) * (F.col("high") - F.col("low")).cast("long")
    between = (F.col("low") + F.floor(gain / (F.col("stop") - F.col("start")))).cast("int")
    value = (F.when(F.col("year") <= F.col("first_decade"), F.col("first_population"))
             .when(F.col("year") >= F.col("last_decade"), F.col("last_population"))
             .otherwise(between))
    return rows.withColumn("population", value).select(*state_years.columns, "population")


def extrapolated_backwards(populations: DataFrame,
                           anchors: tuple[int, int] = ANCHOR_DECADES,
                           decades: tuple[int, ...] = EXTRAPOLATED_DECADES,
                           floor: int = POPULATION_FLOOR) -> DataFrame:
    """Earlier decades from the slope between two anchor decades, never below the floor."""
    first, second = anchors

    def at(decade: int) -> Column:
        return F.max(F.when(F.col("decade") == decade, F.col("population")))

    slopes = populations.groupBy("state_code").agg(
        at(first).alias("base"), (at(second) - at(first)).alias("slope"))
    target = F.explode(F.array(*[F.lit(d) for d in decades])).alias("decade")
    steps = ((F.col("decade") - first) / (second - first)).cast("int")
    return slopes.filter(F.col("slope").isNotNull()).select("*", target).select(
        "state_code", "decade",
        F.greatest(F.lit(floor), F.col("base") + F.col("slope") * steps).cast("int")
        .alias("population"),
        F.lit(f"extrapolated_from_{first}_{second}").alias("source"))


def expected_cases(rows: DataFrame, parameters: DataFrame, baseline_year: int,
                   eradicated: str = ERADICATED) -> DataFrame:
    """Adds ``expected`` to rows with disease, population, year and week_number.

    Base rate by population, a yearly cosine, exponential decline after the vaccine and a
    slow decline of the baseline. One disease follows its own eradication curve.
    """
    year, vaccine = F.col("year"), F.col("vaccine_year")
    base = F.col("base_rate") * (F.col("population") / F.lit(100000.0))
    angle = 2 * F.pi() * (F.col("week_number") - F.col("peak_week")) / F.lit(52.0)
    seasonal = 1.0 + F.col("seasonal_amp") * F.cos(angle)
    eradication = (F.when(year >= 1949, F.lit(0.001))
                   .when(year >= 1900, F.greatest(F.lit(0.01), 1.0 - (year - 1900) * F.lit(0.018)))
                   .otherwise(F.lit(1.0)))
    decline = F.when(year > vaccine, F.exp(-F.col("decay") * (year - vaccine))).otherwise(F.lit(1.0))
    effect = F.when(F.col("disease") == eradicated, eradication).otherwise(decline)
    trend = F.when(year > vaccine, F.greatest(
        F.lit(0.3), 1.0 - (year - baseline_year) * F.lit(0.003))).otherwise(F.lit(1.0))
    expected = F.greatest(F.lit(0.0), base * seasonal * effect * trend)
    return rows.join(parameters, "disease").withColumn("expected", expected).drop(
        *[c for c in parameters.columns if c != "disease"])


def observed_to_expected(rows: DataFrame) -> DataFrame:
    """Ratio of observed to expected cases per disease and year."""
    return rows.groupBy("disease", "year").agg(
        F.sum("cases").alias("observed"), F.sum("expected").alias("expected"),
    ).withColumn("ratio", F.col("observed") / null_if_zero(F.col("expected")))
