import math

from pyspark.sql import functions as F

from caseloom.operators import population


def _interpolate(anchors, year):
    decades = sorted(anchors)
    if year <= decades[0]:
        return anchors[decades[0]]
    if year >= decades[-1]:
        return anchors[decades[-1]]
    for a, b in zip(decades, decades[1:]):
        if a <= year < b:
            return anchors[a] + (year - a) * (anchors[b] - anchors[a]) // (b - a)


def test_interpolation_against_brute_force(spark, small):
    # The second state skips a decade and shrinks.
    anchors = {"AA": {1950: 1_000_000, 1960: 1_200_000, 1970: 1_100_005},
               "BB": {1930: 900_001, 1960: 500_000, 1970: 500_007}}
    rows = [(s, d, p, "x") for s, v in anchors.items() for d, p in v.items()]
    pops = spark.createDataFrame(rows, small.populations.schema)
    years = [(s, y) for s in anchors for y in (1900, 1929, 1930, 1931, 1944, 1949, 1950, 1953, 1959, 1960, 1965, 1969, 1970, 1999)]
    got = population.interpolated(spark.createDataFrame(years, "state string, year int"), pops).collect()
    assert len(got) == len(years)
    for r in got:
        assert r.population == _interpolate(anchors[r.state], r.year), r


def test_backward_extrapolation(spark, small):
    rows = [("AA", 1930, 2_646_000, "c"), ("AA", 1940, 2_833_000, "c"), ("BB", 1930, 91_000, "c"),
            ("BB", 1940, 150_000, "c"), ("CC", 1930, 5, "c")]
    got = {(r.state_code, r.decade): r.population for r in population.extrapolated_backwards(
        spark.createDataFrame(rows, small.populations.schema)).collect()}
    assert got == {("AA", 1920): 2_459_000, ("AA", 1910): 2_272_000, ("BB", 1920): 32_000, ("BB", 1910): 30_000}


def _expected(params, pop, year, week, baseline):
    disease, base, amp, peak, vaccine, decay = params
    effect = 1.0
    if disease == "SMALLPOX":
        effect = 0.001 if year >= 1949 else max(0.01, 1 - (year - 1900) * 0.018) if year >= 1900 else 1.0
    elif year > vaccine:
        effect = math.exp(-decay * (year - vaccine))
    trend = max(0.3, 1 - (year - baseline) * 0.003) if year > vaccine else 1.0
    season = 1 + amp * math.cos(2 * math.pi * (week - peak) / 52)
    return max(0.0, base * pop / 1e5 * season * effect * trend)


def test_expected_cases(spark):
    rows = [(p[0], 1_500_000, year, week, 3) for p in population.EXPECTATION_PARAMETERS
            for year in (1890, 1916, 1948, 1949, 1963, 1964, 2000, 2300) for week in (1, 12, 53)]
    df = spark.createDataFrame(rows, "disease string, population int, year int, week_number int, cases int")
    scored = population.expected_cases(df, population.expectation_parameters(spark), 1916)
    params = {p[0]: p for p in population.EXPECTATION_PARAMETERS}
    got = scored.collect()
    assert len(got) == len(rows)
    for r in got:
        assert math.isclose(r.expected, _expected(params[r.disease], r.population, r.year, r.week_number, 1916),
                            rel_tol=1e-12), r
    ratio = population.observed_to_expected(scored).filter("disease = 'MEASLES' AND year = 1963").first()
    assert ratio.observed == 9 and math.isclose(ratio.ratio, 9 / ratio.expected)
    assert population.observed_to_expected(scored.withColumn("expected", F.lit(0.0))).first().ratio is None
