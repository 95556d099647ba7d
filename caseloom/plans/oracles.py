"""SQL that computes the same answers as the registered queries, for DuckDB."""

from __future__ import annotations

# --- rounding, written in SQL ------------------------------------------------------------


def half_up_ratio(numerator: str, denominator: str, digits: int) -> str:
    """Half-up quotient of whole numbers; the denominator is positive."""
    n, d, s = f"({numerator})", f"({denominator})", 10 ** digits
    return f"(CAST(sign{n} * ((2 * abs{n} * {s} + {d}) // (2 * {d})) AS DOUBLE) / {s}e0)"


def half_up(x: str, digits: int) -> str:
    """Half-up on the shortest text of a double."""
    return f"CAST(CAST(CAST({x} AS VARCHAR) AS DECIMAL(30,{digits})) AS DOUBLE)"


def half_even(x: str, digits: int) -> str:
    """Ties to even on the exact product of a double and a power of ten."""
    s = f"{10 ** digits}e0"
    high = f"({x} * 134217729e0 - ({x} * 134217729e0 - {x}))"
    product = f"({x} * {s})"
    error = f"(({high} * {s} - {product}) + ({x} - {high}) * {s})"
    floor = f"floor({product})"
    over = f"((({product} - {floor}) - 5e-1) + {error})"
    return (f"(({floor} + CASE WHEN {over} > 0 OR ({over} = 0 AND abs({floor} % 2) = 1) "
            f"THEN 1e0 ELSE 0e0 END) / {s})")


def scaled_even(x: str) -> str:
    return f"(round_even({x} * 1e4, 0) / 1e4)"


# --- shared tables -----------------------------------------------------------------------

_DISEASES = "('STANDARD','SMALL','MEDIUM','LARGE','ECONOMY','PROMO')"
_MONTHS = ("['January','February','March','April','May','June','July','August','September',"
           "'October','November','December']")


def _week(ts: str) -> str:
    return (f"CAST(year({ts})*100 + least(53, floor((dayofyear({ts})-1)/7)+1) AS INT)")


_CTES = {
    "obs": f"""
SELECT p_type AS disease, n_name AS state, r_name AS region,
       CASE WHEN p_type='PROMO' THEN s_name ELSE n_name END AS loc,
       CASE WHEN p_type='PROMO' THEN 'CITY' ELSE 'STATE' END AS loc_type,
       {_week('l_shipdate')} AS epi_week,
       CAST(sum(CAST(l_quantity AS INT)) AS INT) AS cases,
       CAST(sum(CAST(round(l_extendedprice*100) AS BIGINT)) AS DOUBLE) / (1e5 * count(*)) AS rate
FROM lineitem JOIN part ON p_partkey=l_partkey JOIN supplier ON s_suppkey=l_suppkey
JOIN nation ON n_nationkey=s_nationkey JOIN region ON r_regionkey=n_regionkey
GROUP BY 1,2,3,4,5,6""",
    "dz": f"""
SELECT DISTINCT p_type AS disease,
       CASE p_type WHEN 'STANDARD' THEN 1998 WHEN 'SMALL' THEN 1999 WHEN 'MEDIUM' THEN 1997
            WHEN 'LARGE' THEN 1995 WHEN 'ECONOMY' THEN 1796 ELSE 1998 END AS vy,
       CASE WHEN p_type IN ('STANDARD','SMALL','MEDIUM') THEN 'Viral' ELSE 'Bacterial' END AS category,
       CASE WHEN p_type='ECONOMY' THEN 'Contact' ELSE 'Airborne' END AS transmission,
       p_type <> 'ECONOMY' AS preventable
FROM part WHERE p_type IN {_DISEASES}""",
    "rg": """
SELECT n_nationkey AS nk, n_name AS state, r_name AS region, r_name || ' ' || (n_nationkey % 2) AS division,
       n_nationkey + 25e-2 AS lat, -n_nationkey - 5e-1 AS lng
FROM nation JOIN region ON r_regionkey=n_regionkey""",
    "pop": """
SELECT n_name AS state, decade, CAST(1000 * count(*) * tenths // 10 AS INT) AS population
FROM customer JOIN nation ON n_nationkey=c_nationkey,
     (VALUES (1990, 10), (2000, 11)) d(decade, tenths)
GROUP BY n_name, decade, tenths""",
    "bd": """
SELECT a.n_name AS src, 'NATION_' || ((a.n_nationkey + k) % 25) AS dst
FROM nation a, (VALUES (1),(24),(5),(20)) o(k)""",
    "t0": """
SELECT disease, state, region, upper(loc) AS loc, loc_type, epi_week, cases, rate,
       CASE WHEN loc_type='CITY' THEN upper(loc) END AS city,
       epi_week // 100 AS year, epi_week % 100 AS week,
       CAST(least(12, greatest(1, ((epi_week % 100 - 1) * 12) // 52 + 1)) AS INT) AS month
FROM obs""",
    "t": f"""
SELECT *, (month - 1) // 3 + 1 AS quarter, year - year % 10 AS decade, {_MONTHS}[month] AS month_name,
       CAST(CAST(CAST(rate AS VARCHAR) AS DECIMAL(12,4)) * 10000 AS BIGINT) AS ru
FROM t0""",
    "st": "SELECT * FROM t WHERE loc_type = 'STATE'",
    "bk0": """
SELECT disease, state, region, loc, loc_type, city, year, month, quarter, decade, month_name,
       CAST(sum(cases) AS BIGINT) AS total_cases,
       (CAST(sum(CAST(round_even(rate * 1e4, 0) AS BIGINT)) AS DOUBLE) / 1e4) / count(*) AS m,
       max(cases) AS peak, count(*) AS n
FROM t GROUP BY ALL""",
    "bk": f"SELECT * EXCLUDE (m), {half_even('m', 4)} AS avg_rate FROM bk0",
    "bku": "SELECT *, CAST(round(avg_rate * 1e4) AS BIGINT) AS au FROM bk",
    "gr": f"""
SELECT disease, state, year, month, month_name, quarter, decade,
       CAST(sum(cases) AS BIGINT) AS total_cases,
       (CAST(sum(CAST(round({half_even('rate', 4)} * 1e4) AS BIGINT)) AS DOUBLE) / 1e4) / count(*)
         AS avg_incidence,
       count(*) AS n
FROM t GROUP BY ALL""",
    "feed": f"""
SELECT event_id, CASE event_id % 11 WHEN 0 THEN year(ts) || '00' WHEN 1 THEN 'bad' WHEN 2 THEN year(ts) || '54'
            ELSE CAST({_week('ts')} AS VARCHAR) END AS epi_week,
       CASE WHEN user_id % 29 = 0 THEN 'XX' ELSE 'NATION_' || (user_id % 25) END AS state,
       CASE user_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'A "B", C' WHEN 2 THEN 'Two' || chr(10) || 'lines'
            ELSE ' City ' || (user_id % 5) || ' ' END AS loc,
       CASE WHEN event_type = 'purchase' THEN ' city' ELSE 'State' END AS loc_type,
       CASE WHEN event_id % 97 = 0 THEN 'NA' WHEN event_type = 'click' THEN ' standard ' WHEN event_type = 'view' THEN 'SMALL'
            WHEN event_type = 'purchase' THEN 'PROMO' WHEN event_type = 'error' THEN 'UNKNOWN' END AS disease,
       CASE event_id % 8 WHEN 0 THEN NULL WHEN 1 THEN 'abc' WHEN 2 THEN '-3' WHEN 3 THEN '0'
            WHEN 4 THEN '0.5' ELSE json_extract_string(props, '$.k') END AS cases,
       CASE WHEN event_id % 5 <> 0 THEN CAST(value AS VARCHAR) ELSE 'n/a' END AS incidence_per_100000
FROM events""",
    "cl": """
SELECT CAST(TRY_CAST(epi_week AS DOUBLE) AS INT) AS epi_week, state,
       coalesce(upper(trim(loc)), 'NAN') AS loc, upper(trim(disease)) AS disease,
       CAST(trunc(TRY_CAST(cases AS DOUBLE)) AS INT) AS cases,
       coalesce(TRY_CAST(incidence_per_100000 AS DOUBLE), 0e0) AS incidence_per_100000,
       upper(trim(loc_type)) AS loc_type
FROM feed
WHERE TRY_CAST(cases AS DOUBLE) > 0 AND disease <> 'NA' AND TRY_CAST(epi_week AS DOUBLE) IS NOT NULL""",
    "ev": f"""
SELECT event_id, ts, {_week('ts')} AS epi_week, 'NATION_' || (user_id % 25) AS state,
       event_type AS disease, CAST(json_extract_string(props, '$.k') AS INT) AS cases,
       value AS incidence_rate
FROM events""",
}
# Which shared tables a shared table needs, in order.
_NEEDS = {
    "obs": [], "dz": [], "rg": [], "pop": [], "bd": [], "feed": [], "ev": [],
    "t0": ["obs"], "t": ["obs", "t0"], "st": ["obs", "t0", "t"], "bk0": ["obs", "t0", "t"],
    "bk": ["obs", "t0", "t", "bk0"], "bku": ["obs", "t0", "t", "bk0", "bk"],
    "gr": ["obs", "t0", "t"], "cl": ["feed"],
}


def _sql(tables: str, body: str) -> str:
    """``body`` behind the shared tables it names; ``body`` may open with more WITH entries."""
    names: list[str] = []
    for table in tables.split():
        for name in [*_NEEDS[table], table]:
            if name not in names:
                names.append(name)
    shared = ", ".join(f"{name} AS ({_CTES[name]})" for name in names)
    body = body.strip()
    if body.startswith("WITH "):
        return f"WITH {shared}, {body[5:]}"
    return f"WITH {shared} {body}"


def _total(column: str = "cases") -> str:
    return f"CAST(sum({column}) AS BIGINT)"


_STAR_RATE = half_up_ratio("sum(ru)", "count(*) * 10000", 2)
_BUCKET_RATE = "(CAST(sum(au) AS DOUBLE) / 1e4) / count(*)"
ORACLES: dict[str, str] = {}

# --- decision queries --------------------------------------------------------------------

ORACLES["q01_star"] = _sql("st", f"""
SELECT disease AS disease_name, decade, {_total()} AS total_cases, {_STAR_RATE} AS avg_incidence
FROM st GROUP BY disease, decade""")
ORACLES["q02_star"] = _sql("st", f"""
SELECT state AS state_name, {_total()} AS total_cases, {_STAR_RATE} AS avg_incidence
FROM st WHERE disease = 'STANDARD' AND year = 1998 GROUP BY state""")
ORACLES["q03_star"] = _sql("st", f"""
SELECT state AS state_name, {_total()} AS total_cases FROM st
WHERE disease = 'STANDARD' AND year BETWEEN 1996 AND 2000
GROUP BY state ORDER BY total_cases DESC, state LIMIT 10""")
ORACLES["q04_star"] = _sql("st", f"""
SELECT month, month_name, {half_up_ratio('sum(cases)', 'count(*)', 2)} AS avg_weekly_cases
FROM st WHERE disease = 'STANDARD' GROUP BY month, month_name""")

_YEARLY = """
WITH y AS (SELECT {state} AS state_name, year, CAST(sum({cases}) AS BIGINT) AS total_cases
           FROM {source} WHERE disease = 'STANDARD' GROUP BY 1, 2),
     l AS (SELECT *, lag(total_cases) OVER (PARTITION BY state_name ORDER BY year) AS prev_year_cases FROM y)
"""
ORACLES["q05_star"] = _sql("st", _YEARLY.format(state="state", cases="cases", source="st") + f"""
SELECT *, CASE WHEN prev_year_cases <> 0 THEN
  {half_up_ratio('(total_cases - prev_year_cases) * 100', 'prev_year_cases', 2)} END AS yoy_pct_change
FROM l""")
ORACLES["q06_star"] = _sql("st", f"""
WITH b AS (SELECT state, year, disease, {_total()} AS c FROM st GROUP BY 1, 2, 3 HAVING sum(cases) > 100)
SELECT x.disease AS disease_a, y.disease AS disease_b, count(*) AS co_occurrence_count,
       {half_up('corr(x.c, y.c)', 3)} AS correlation
FROM b x JOIN b y ON x.state = y.state AND x.year = y.year AND x.disease < y.disease
GROUP BY 1, 2 HAVING count(*) > 10""")
_FIRST = """
WITH f AS (SELECT state AS state_name, min(year) AS first_reported_year FROM {source}
           WHERE disease = 'STANDARD' AND {positive} GROUP BY 1)
"""
ORACLES["q07_star"] = _sql("st", _FIRST.format(source="st", positive="cases > 0") + """
SELECT *, CAST(rank() OVER (ORDER BY first_reported_year) AS INT) AS spread_rank FROM f""")

_WINDOWS = """
WITH y AS (SELECT disease, year, CAST(sum({cases}) AS BIGINT) AS c FROM {source} GROUP BY 1, 2),
     w AS (SELECT d.disease AS disease_name, d.vy AS vaccine_intro_year,
                  CAST(sum(c) FILTER (year BETWEEN vy - 2 AND vy - 1) AS BIGINT) AS a,
                  count(c) FILTER (year BETWEEN vy - 2 AND vy - 1) AS na,
                  CAST(sum(c) FILTER (year BETWEEN vy + 1 AND vy + 2) AS BIGINT) AS b,
                  count(c) FILTER (year BETWEEN vy + 1 AND vy + 2) AS nb
           FROM dz d {join} y ON y.disease = d.disease GROUP BY 1, 2)
"""
ORACLES["q08_star"] = _sql("st dz", _WINDOWS.format(
    cases="cases", source="st", join="LEFT JOIN") + f"""
SELECT disease_name, vaccine_intro_year,
       CAST(a AS DOUBLE) / nullif(na, 0) AS pre_vaccine_avg_annual_cases,
       CAST(b AS DOUBLE) / nullif(nb, 0) AS post_vaccine_avg_annual_cases,
       CASE WHEN a * nb <> 0 THEN {half_up_ratio('(b * na - a * nb) * 100', 'a * nb', 2)} END AS pct_change
FROM w""")

_ANOMALY = """
WITH s AS (SELECT disease AS disease_name, state AS state_name, year, CAST(sum({cases}) AS BIGINT) AS state_total
           FROM {source} GROUP BY 1, 2, 3),
     n AS (SELECT *, CAST(avg(state_total) OVER w AS DOUBLE) AS mean, {std}(state_total) OVER w AS std
           FROM s WINDOW w AS (PARTITION BY disease_name, year)),
     z AS (SELECT *, (state_total - mean) / std AS z FROM n WHERE std > 0)
"""
ORACLES["q09_star"] = _sql("st", _ANOMALY.format(cases="cases", source="st", std="stddev_samp") + f"""
SELECT disease_name, state_name, year, state_total, {half_up('mean', 0)} AS national_mean,
       {half_up('z', 2)} AS z_score
FROM z WHERE z > 2 ORDER BY z_score DESC, disease_name, state_name, year LIMIT 50""")
_PEAKS = """
WITH y AS (SELECT disease AS disease_name, year, CAST(sum({cases}) AS BIGINT) AS total_cases
           FROM {source} GROUP BY 1, 2),
     p AS (SELECT *, max(total_cases) OVER (PARTITION BY disease_name) AS peak FROM y)
"""
ORACLES["q10_star"] = _sql("st", _PEAKS.format(cases="cases", source="st") + f"""
SELECT disease_name, year, total_cases,
       {half_up_ratio('total_cases * 100', 'peak', 2)} AS normalized_index FROM p""")

ORACLES["q01_bucket"] = _sql("bku", f"""
WITH g AS (SELECT disease AS disease_name, decade, {_total('total_cases')} AS total_cases,
                  {_BUCKET_RATE} AS m FROM bku GROUP BY 1, 2)
SELECT disease_name, decade, total_cases, {half_even('m', 2)} AS avg_incidence FROM g""")
ORACLES["q02_bucket"] = _sql("bku", f"""
WITH g AS (SELECT state AS state_name, {_total('total_cases')} AS total_cases, {_BUCKET_RATE} AS m
           FROM bku WHERE disease = 'STANDARD' AND year = 1998 GROUP BY 1)
SELECT state_name, total_cases, {half_even('m', 2)} AS avg_incidence FROM g""")
ORACLES["q03_bucket"] = _sql("bk", f"""
SELECT state AS state_name, {_total('total_cases')} AS total_cases FROM bk
WHERE disease = 'STANDARD' AND year BETWEEN 1996 AND 2000
GROUP BY state ORDER BY total_cases DESC, state LIMIT 10""")
ORACLES["q04_bucket"] = _sql("t", f"""
WITH g AS (SELECT month, month_name, CAST(sum(cases) AS DOUBLE) / count(*) AS m
           FROM t WHERE disease = 'STANDARD' GROUP BY 1, 2)
SELECT month, month_name, {half_even('m', 2)} AS avg_weekly_cases FROM g""")
ORACLES["q05_bucket"] = _sql("bk", _YEARLY.format(state="state", cases="total_cases", source="bk") + f"""
, p AS (SELECT *, CASE WHEN prev_year_cases <> 0 THEN
        CAST(total_cases - prev_year_cases AS DOUBLE) / prev_year_cases * 100 END AS pct FROM l)
SELECT state_name, year, total_cases, prev_year_cases, {half_even('pct', 2)} AS yoy_pct_change FROM p""")
ORACLES["q06_bucket"] = _sql("bk", """
WITH b AS (SELECT state, year, disease FROM bk GROUP BY 1, 2, 3 HAVING sum(total_cases) > 100),
     n AS (SELECT *, count(*) OVER (PARTITION BY state, year) AS n FROM b)
SELECT disease AS disease_a, count(*) AS co_occurrence_count FROM n WHERE n >= 2 GROUP BY 1""")
ORACLES["q07_bucket"] = _sql("bk", _FIRST.format(source="bk", positive="total_cases > 0") + """
SELECT *, CAST(row_number() OVER (ORDER BY first_reported_year, state_name) AS INT) AS spread_rank FROM f""")
ORACLES["q08_bucket"] = _sql("bk dz", _WINDOWS.format(
    cases="total_cases", source="bk", join="JOIN") + f"""
, m AS (SELECT disease_name, vaccine_intro_year, coalesce(CAST(a AS DOUBLE) / nullif(na, 0), 0e0) AS pre,
               coalesce(CAST(b AS DOUBLE) / nullif(nb, 0), 0e0) AS post FROM w WHERE vaccine_intro_year >= 1900),
  p AS (SELECT *, (post - pre) / nullif(pre, 0) * 100 AS pct FROM m)
SELECT disease_name, vaccine_intro_year, {half_even('pre', 0)} AS pre_vaccine_avg_annual_cases,
       {half_even('post', 0)} AS post_vaccine_avg_annual_cases,
       coalesce({half_even('pct', 2)}, 0e0) AS pct_change FROM p""")
ORACLES["q09_bucket"] = _sql("bk", _ANOMALY.format(
    cases="total_cases", source="bk", std="stddev_pop") + f"""
SELECT disease_name, state_name, year, state_total, {half_even('mean', 0)} AS national_mean,
       {half_even('z', 2)} AS z_score
FROM z WHERE z > 2 ORDER BY round(z, 9) DESC, disease_name, state_name, year LIMIT 50""")
ORACLES["q10_bucket"] = _sql("bk", _PEAKS.format(cases="total_cases", source="bk") + f"""
, i AS (SELECT *, CAST(total_cases AS DOUBLE) / greatest(1, peak) * 100 AS i FROM p)
SELECT disease_name, year, total_cases, {half_even('i', 2)} AS normalized_index FROM i""")

_Q01_GRAPH = f"""
SELECT disease AS disease_name, decade, {_total('total_cases')} AS total_cases,
       {half_up('avg(avg_incidence)', 2)} AS avg_incidence FROM gr GROUP BY 1, 2"""
ORACLES["q01_graph"] = _sql("gr", _Q01_GRAPH)
ORACLES["q01_graph_paths"] = _sql("gr", _Q01_GRAPH)
ORACLES["q02_graph"] = _sql("gr", f"""
SELECT state AS state_name, {_total('total_cases')} AS total_cases,
       {half_up('avg(avg_incidence)', 2)} AS avg_incidence
FROM gr WHERE disease = 'STANDARD' AND year = 1998 GROUP BY 1""")
ORACLES["q03_graph"] = _sql("gr", f"""
SELECT state AS state_name, {_total('total_cases')} AS total_cases FROM gr
WHERE disease = 'STANDARD' AND year BETWEEN 1996 AND 2000
GROUP BY state ORDER BY total_cases DESC, state LIMIT 10""")
ORACLES["q04_graph"] = _sql("gr", f"""
SELECT month, month_name, {half_up('CAST(sum(total_cases // n) AS DOUBLE) / count(*)', 2)} AS avg_weekly_cases
FROM gr WHERE disease = 'STANDARD' GROUP BY 1, 2""")
ORACLES["q05_graph"] = _sql("gr", _YEARLY.format(state="state", cases="total_cases", source="gr") + f"""
SELECT state_name, year, total_cases, prev_year_cases,
       {half_up('CAST(total_cases - prev_year_cases AS DOUBLE) / CASE WHEN prev_year_cases = 0 THEN 1 ELSE prev_year_cases END * 100', 2)}
         AS yoy_pct_change
FROM l WHERE prev_year_cases IS NOT NULL""")
ORACLES["q06_graph"] = _sql("gr", """
WITH b AS (SELECT state, year, disease FROM gr GROUP BY 1, 2, 3 HAVING sum(total_cases) > 100)
SELECT x.disease AS disease_a, y.disease AS disease_b, count(*) AS co_occurrence_count
FROM b x JOIN b y ON x.state = y.state AND x.year = y.year AND x.disease < y.disease
GROUP BY 1, 2 ORDER BY co_occurrence_count DESC, disease_a, disease_b LIMIT 20""")
ORACLES["q07_graph"] = _sql("gr", _FIRST.format(source="gr", positive="total_cases > 0") + "SELECT * FROM f")
ORACLES["q08_graph"] = _sql("gr dz", _WINDOWS.format(
    cases="total_cases", source="gr", join="LEFT JOIN") + f"""
, m AS (SELECT disease_name, vaccine_intro_year, CAST(a AS DOUBLE) / nullif(na, 0) AS pre,
               CAST(b AS DOUBLE) / nullif(nb, 0) AS post FROM w WHERE vaccine_intro_year >= 1900)
SELECT disease_name, vaccine_intro_year, {half_up('pre', 0)} AS pre_vaccine_avg_annual_cases,
       {half_up('post', 0)} AS post_vaccine_avg_annual_cases,
       {half_up('(post - pre) / CASE WHEN pre = 0 THEN 1 ELSE pre END * 100', 2)} AS pct_change FROM m""")
ORACLES["q09_graph"] = _sql("gr", _ANOMALY.format(
    cases="total_cases", source="gr", std="stddev_samp") + f"""
SELECT disease_name, state_name, year, state_total, {half_up('mean', 0)} AS national_mean,
       {half_up('z', 2)} AS z_score
FROM z WHERE z > 2 ORDER BY z_score DESC, disease_name, state_name, year LIMIT 50""")
ORACLES["q10_graph"] = _sql("gr", _PEAKS.format(cases="total_cases", source="gr") + f"""
SELECT disease_name, year, total_cases,
       {half_up('CAST(total_cases AS DOUBLE) / CASE WHEN peak = 0 THEN 1 ELSE peak END * 100', 2)}
         AS normalized_index FROM p""")

_SPREAD = """
WITH m AS (SELECT state, year, month, year * 12 + month AS i FROM gr
           WHERE disease = 'STANDARD' AND total_cases > 50),
     pairs AS (SELECT a.state AS origin, b.state AS destination, a.year AS origin_year,
                      a.month AS origin_month, b.year AS dest_year, b.month AS dest_month,
                      b.i - a.i AS lag_months
               FROM m a JOIN bd ON bd.src = a.state
               JOIN m b ON b.state = bd.dst AND b.i - a.i BETWEEN 1 AND 6)
"""
ORACLES["q11_graph"] = _sql("gr bd", _SPREAD + """
SELECT * FROM pairs ORDER BY lag_months, origin, destination, origin_year, origin_month LIMIT 50""")
ORACLES["q11_graph_all_pairs"] = _sql("gr bd", _SPREAD + "SELECT * FROM pairs")
ORACLES["border_lag_histogram"] = _sql("gr bd", _SPREAD + """
SELECT lag_months, count(*) AS pair_count FROM pairs GROUP BY 1""")
ORACLES["q12_graph"] = _sql("gr", f"""
WITH c AS (SELECT state, disease, {_total('total_cases')} AS c FROM gr GROUP BY 1, 2),
     g AS (SELECT *, sum(c) OVER (PARTITION BY state) AS g FROM c)
SELECT state, state AS code, disease,
       {half_up('CAST(c AS DOUBLE) / CASE WHEN g = 0 THEN 1 ELSE g END * 100', 1)} AS pct FROM g""")
ORACLES["q13_graph"] = _sql("gr", f"""
WITH p AS (SELECT disease AS disease_name, count(DISTINCT state || year) AS state_year_presence
           FROM gr WHERE total_cases > 100 GROUP BY 1)
SELECT *, {half_up('CAST(state_year_presence AS DOUBLE) / (25 * 7) * 100', 2)} AS coverage_pct FROM p""")

# --- generic operations ------------------------------------------------------------------

for _name, (_column, _value) in {
    "disease": ("disease", "'PROMO'"), "state": ("state", "'NATION_7'"), "year": ("year", "1998"),
    "decade": ("decade", "1990"), "region": ("region", "'ASIA'"),
}.items():
    ORACLES[f"olap_slice_{_name}_summary"] = _sql("t", f"""
SELECT CAST({_column} AS VARCHAR) AS slice_key, {_total()} AS total_cases, count(*) AS record_count
FROM t WHERE {_column} = {_value} GROUP BY 1""")
    ORACLES[f"olap_slice_{_name}_breakdown"] = _sql("t", f"""
SELECT CAST({_column} AS VARCHAR) AS slice_key, year, {_total()} AS total_cases
FROM t WHERE {_column} = {_value} GROUP BY 1, 2""")
for _coarse, _fine in {"decade": "year", "year": "quarter", "quarter": "month", "month": "week"}.items():
    ORACLES[f"olap_drilldown_{_coarse}"] = _sql("st", f"""
SELECT disease AS disease_name, {_coarse}, {_fine}, {_total()} AS total_cases FROM st GROUP BY 1, 2, 3""")
    ORACLES[f"olap_rollup_{_fine}"] = _sql("st", f"""
SELECT disease AS disease_name, {_coarse}, {_total()} AS total_cases FROM st GROUP BY 1, 2""")
ORACLES["olap_drilldown_one_year"] = _sql("st", f"""
SELECT disease AS disease_name, year, quarter, {_total()} AS total_cases FROM st
WHERE year = 1998 GROUP BY 1, 2, 3""")
_DICE = f"SELECT disease AS disease_name, state AS state_name, year, {_total()} AS total_cases FROM st"
ORACLES["olap_dice"] = _sql("st", f"{_DICE} WHERE disease = 'STANDARD' AND region = 'ASIA' GROUP BY 1, 2, 3")
ORACLES["olap_dice_state_year"] = _sql(
    "st", f"{_DICE} WHERE state = 'NATION_7' AND year = 1998 AND decade = 1990 GROUP BY 1, 2, 3")
ORACLES["olap_pivot"] = _sql("st", "SELECT decade, " + ", ".join(
    f"CAST(sum(CASE WHEN disease = '{d}' THEN cases ELSE 0 END) AS BIGINT) AS {d.lower()}"
    for d in ("STANDARD", "SMALL", "MEDIUM", "LARGE", "ECONOMY", "PROMO")) + " FROM st GROUP BY decade")

# --- summaries ---------------------------------------------------------------------------

_MEAN8 = half_up_ratio("sum(ru)", "count(*) * 10000", 8)
ORACLES["mv_monthly_disease_state"] = _sql("st", f"""
SELECT disease AS disease_name, state AS state_name, region AS census_region, year, month, month_name,
       {_total()} AS total_cases, {_MEAN8} AS avg_incidence_rate, count(*) AS record_count
FROM st GROUP BY 1, 2, 3, 4, 5, 6""")
ORACLES["mv_yearly_disease_region"] = _sql("st dz", f"""
SELECT st.disease AS disease_name, category AS disease_category, region AS census_region, year, decade,
       {_total()} AS total_cases, {_MEAN8} AS avg_incidence_rate, max(cases) AS peak_weekly_cases,
       count(DISTINCT state) AS reporting_locations
FROM st JOIN dz ON dz.disease = st.disease GROUP BY 1, 2, 3, 4, 5""")
ORACLES["mv_decade_disease_national"] = _sql("t", f"""
SELECT disease AS disease_name, decade, {_total()} AS total_cases, {_MEAN8} AS avg_incidence_rate,
       count(DISTINCT state) AS states_reporting,
       CAST(sum(CASE WHEN loc_type = 'CITY' THEN cases ELSE 0 END) AS BIGINT) AS cases_reported_at_city_grain
FROM t GROUP BY 1, 2""")
ORACLES["mv_yearly_disease_city"] = _sql("t", f"""
SELECT disease AS disease_name, city AS city_name, state AS state_code, year, {_total()} AS total_cases,
       {_MEAN8} AS avg_incidence_rate
FROM t WHERE loc_type = 'CITY' GROUP BY 1, 2, 3, 4""")
for _name in ("mv_monthly_disease_state", "mv_yearly_disease_region", "mv_decade_disease_national",
              "mv_yearly_disease_city"):
    ORACLES[f"{_name}_from_states"] = ORACLES[_name]
ORACLES["distinct_estimates"] = _sql("t", """
SELECT disease AS disease_name, decade, count(DISTINCT state) AS states_reporting, true AS within_bound
FROM t GROUP BY 1, 2""")
_BY_REGION = f"""
SELECT disease, region, year, month, {_total('total_cases')} AS total_cases,
       {_BUCKET_RATE} AS avg_incidence_rate, count(DISTINCT state) AS states_reporting
FROM bku {{where}} GROUP BY 1, 2, 3, 4"""
ORACLES["summary_monthly_by_region"] = _sql("bku", _BY_REGION.format(where=""))
ORACLES["summary_monthly_by_region_states"] = _sql(
    "bku", _BY_REGION.format(where="WHERE loc_type = 'STATE'"))
ORACLES["merge_replace"] = _sql("bku", f"""
WITH c AS ({_BY_REGION.format(where="WHERE loc_type = 'STATE' AND year <= 1998")}),
     u AS ({_BY_REGION.format(where="WHERE year >= 1998")})
SELECT * FROM u UNION ALL
SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.disease = c.disease AND u.region = c.region
                                  AND u.year = c.year AND u.month = c.month)""")
ORACLES["week_ranks"] = _sql("t", """
SELECT disease, state, loc, loc_type, epi_week, cases, rank() OVER (ORDER BY cases DESC) AS case_rank,
       row_number() OVER (ORDER BY cases DESC, disease, state, loc, loc_type, epi_week) AS place FROM t""")
ORACLES["merge_partitions"] = ORACLES["merge_replace"]
ORACLES["summary_decade_national"] = _sql("bku", f"""
SELECT disease, decade, {_total('total_cases')} AS total_cases, {_BUCKET_RATE} AS avg_incidence_rate,
       count(DISTINCT state) AS states_reporting
FROM bku GROUP BY 1, 2""")
ORACLES["summary_weekly_by_region"] = _sql("t", f"""
SELECT disease, year, month, region, {_total()} AS total_cases,
       (CAST(sum(CAST(round_even(rate * 1e4, 0) AS BIGINT)) AS DOUBLE) / 1e4) / count(*) AS avg_incidence,
       count(*) AS weeks_reporting
FROM t GROUP BY 1, 2, 3, 4""")


def _distinct_rows(table: str, columns: str, where: str = "true") -> str:
    return f"(SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {table} WHERE {where}) d)"


_SUMMARY_SIZES = {
    "mv_monthly_disease_state": _distinct_rows("st", "disease, state, year, month"),
    "mv_yearly_disease_region": _distinct_rows("st", "disease, region, year"),
    "mv_decade_disease_national": _distinct_rows("t", "disease, decade"),
    "mv_yearly_disease_city": _distinct_rows("t", "disease, city, state, year", "loc_type = 'CITY'"),
    "summary_monthly_by_region": _distinct_rows("t", "disease, region, year, month"),
    "summary_decade_national": _distinct_rows("t", "disease, decade"),
    "summary_weekly_by_region": _distinct_rows("t", "disease, region, year, month"),
}
ORACLES["refresh_summaries"] = _sql("st", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, 'success' AS status, {size} AS row_count"
    for name, size in _SUMMARY_SIZES.items()))

# --- cleaning and quality ----------------------------------------------------------------

ORACLES["scan_raw_csv"] = _sql("feed", "SELECT * EXCLUDE (event_id) FROM feed")
ORACLES["clean_observations"] = _sql("cl", "SELECT * FROM cl")
ORACLES["scan_reference_csv"] = _sql("rg pop dz", """
SELECT 'regions' AS file, state AS key, region AS name, division AS detail, lat AS x, lng AS y FROM rg
UNION ALL SELECT 'diseases', disease, category, transmission || ' ' || CASE WHEN preventable THEN 'TRUE' ELSE 'False' END,
       CAST(vy AS DOUBLE), NULL FROM dz
UNION ALL SELECT 'populations', state, 'customers', NULL, CAST(decade AS DOUBLE), CAST(population AS DOUBLE) FROM pop
UNION ALL SELECT 'borders', state, 'NATION_' || ((nk + 1) % 25) || ' NATION_' || ((nk + 24) % 25) || ' NATION_'
       || ((nk + 5) % 25) || ' NATION_' || ((nk + 20) % 25), NULL, NULL, NULL FROM rg""")
ORACLES["rows_by_grain"] = _sql("cl", "SELECT loc_type, count(*) AS row_count FROM cl GROUP BY 1")
ORACLES["source_labels"] = "SELECT 'real' AS source_label, count(*) AS row_count FROM events"
_CHECKED = f"""
WITH k AS (SELECT trim(coalesce(disease, '')) AS disease, state, trim(coalesce(cases, '')) AS cases,
                  CASE WHEN regexp_matches(epi_week, '^[0-9]+$') THEN CAST(epi_week AS INT) END AS wk
           FROM feed),
     c AS (SELECT CAST(NOT regexp_matches(cases, '^[+-]?[0-9]+$') AS INT) AS null_cases,
                  CAST(regexp_matches(cases, '^-[0-9]+$') AS INT) AS negative_cases,
                  CAST(state NOT IN (SELECT state FROM rg) AS INT) AS invalid_state,
                  CAST(disease <> '' AND disease NOT IN (SELECT disease FROM dz) AS INT) AS invalid_disease,
                  CAST(NOT coalesce(wk % 100 BETWEEN 1 AND 53 AND wk // 100 BETWEEN 1800 AND 2100, false) AS INT)
                    AS invalid_epi_week,
                  CAST(disease = '' AS INT) AS null_disease, disease, state, wk // 100 AS year
           FROM k)
"""
_ISSUES = ["null_cases", "negative_cases", "invalid_state", "invalid_disease", "invalid_epi_week",
           "null_disease"]
_FOUND = {"disease": "disease <> '' AND invalid_disease = 0", "state": "invalid_state = 0",
          "year": "invalid_epi_week = 0"}
ORACLES["quality_issue_counts"] = _sql("feed rg dz", _CHECKED + f"""
, s AS (SELECT count(*) AS total_rows, {', '.join(f'CAST(sum({i}) AS BIGINT) AS {i}' for i in _ISSUES)},
               count(DISTINCT disease) FILTER ({_FOUND['disease']}) AS diseases_found,
               count(DISTINCT state) FILTER ({_FOUND['state']}) AS states_found,
               min(year) FILTER ({_FOUND['year']}) AS first_year, max(year) FILTER ({_FOUND['year']}) AS last_year,
               CAST({' + '.join(f'sum({i})' for i in _ISSUES)} AS BIGINT) AS total_issues FROM c),
  p AS (SELECT *, (1 - CAST(total_issues AS DOUBLE) / total_rows) * 100 AS q FROM s)
SELECT * EXCLUDE (q), {half_even('q', 2)} AS quality_score, {half_even('q', 2)} >= 95 AS passed FROM p""")
ORACLES["quality_column_report"] = """
SELECT column_name, column_name NOT IN ('loc_type', 'incidence_per_100000') AND count(*) > 0 AS present
FROM events, (VALUES ('epi_week'), ('state'), ('loc'), ('loc_type'), ('disease'), ('cases'),
                     ('incidence_per_100000')) c(column_name) GROUP BY 1"""
ORACLES["quality_found_values"] = _sql("feed rg dz", _CHECKED + f"""
SELECT (SELECT string_agg(disease, ',' ORDER BY disease) FROM
          (SELECT DISTINCT disease FROM c WHERE {_FOUND['disease']}) d) AS diseases,
       (SELECT string_agg(state, ',' ORDER BY state) FROM
          (SELECT DISTINCT state FROM c WHERE {_FOUND['state']}) s) AS states,
       min(year) FILTER ({_FOUND['year']}) AS first_year, max(year) FILTER ({_FOUND['year']}) AS last_year
FROM c""")
ORACLES["quality_duplicate_keys"] = _sql("cl", """
SELECT disease, state, epi_week, count(*) AS row_count FROM cl GROUP BY 1, 2, 3 HAVING count(*) > 1""")


# The rules below hold on loaded tables, so the expected answer is a zero per rule, computed
# from the source tables where the rule can be restated on them.
ORACLES["quality_unique_rules"] = _sql("st dz rg", """
WITH v AS (
 SELECT 'dim_time' AS table_name, (SELECT count(*) - count(DISTINCT w) FROM (SELECT DISTINCT epi_week AS w FROM t) x) AS v
 UNION ALL SELECT 'dim_location', (SELECT count(*) FROM (SELECT city, state, loc_type FROM
     (SELECT DISTINCT city, state, loc_type FROM t) x GROUP BY ALL HAVING count(*) > 1) d)
 UNION ALL SELECT 'dim_disease', (SELECT count(*) - count(DISTINCT p) FROM (SELECT DISTINCT p_type AS p FROM part) x)
 UNION ALL SELECT 'mv_monthly_disease_state', (SELECT count(*) FROM (SELECT disease, state, year, month FROM
     (SELECT DISTINCT disease, state, region, year, month, month_name FROM st) x GROUP BY ALL HAVING count(*) > 1) d)
 UNION ALL SELECT 'Disease', (SELECT count(*) - count(DISTINCT disease) FROM dz)
 UNION ALL SELECT 'State', (SELECT count(*) - count(DISTINCT state) FROM rg)
 UNION ALL SELECT 'Region', (SELECT count(*) - count(DISTINCT r_name) FROM region)
 UNION ALL SELECT 'City', (SELECT count(*) FROM (SELECT state, city FROM
     (SELECT DISTINCT state, loc, city FROM t WHERE loc_type = 'CITY') x GROUP BY ALL HAVING count(*) > 1) d))
SELECT table_name, CAST(v AS BIGINT) AS violations FROM v""")
ORACLES["quality_fact_keys"] = _sql("t", """
SELECT count(*) AS row_count, count(*) AS key_count, CAST(1 AS BIGINT) AS first_key, count(*) AS last_key FROM t""")
ORACLES["quality_orphans"] = _sql("t dz rg", """
SELECT 'time_key' AS key_name, (SELECT count(*) FROM t WHERE epi_week IS NULL) AS violations
UNION ALL SELECT 'location_key', (SELECT count(*) FROM t WHERE state NOT IN (SELECT state FROM rg))
UNION ALL SELECT 'disease_key', (SELECT count(*) FROM t WHERE disease NOT IN (SELECT disease FROM dz))""")
ORACLES["quality_unknown_states"] = _sql("cl rg", """
SELECT state, disease, count(*) AS row_count FROM cl WHERE state NOT IN (SELECT state FROM rg) GROUP BY 1, 2""")
ORACLES["quality_known_diseases"] = _sql("cl dz", f"""
SELECT disease, count(*) AS row_count, {_total()} AS cases FROM cl
WHERE disease IN (SELECT disease FROM dz) GROUP BY 1""")
ORACLES["quality_null_counts"] = _sql("feed", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM feed"
    for c in ("epi_week", "state", "loc", "loc_type", "disease", "cases", "incidence_per_100000")))
# Each column of a star table next to the column of the source that it is made from.
_MADE_FROM = {
    ("dim_time", "t"): {
        "time_key": "epi_week", "epi_week": "epi_week", "week_number": "week", "month": "month",
        "month_name": "month_name", "quarter": "quarter", "year": "year", "decade": "decade",
        "century": "year", "is_summer": "month", "is_flu_season": "month"},
    ("dim_location", "(SELECT t.state, loc_type, rg.state AS name, rg.region, division FROM t "
                     "LEFT JOIN rg ON rg.state = t.state) x"): {
        "location_key": "state", "state_code": "state", "state_name": "name",
        "census_region": "region", "census_division": "division", "loc_type": "loc_type"},
    ("dim_disease", "dz"): {
        "disease_key": "disease", "disease_name": "disease", "disease_category": "category",
        "transmission_type": "transmission", "is_vaccine_preventable": "preventable"},
    ("fact", "t"): {
        "incidence_key": "cases", "time_key": "epi_week", "location_key": "state",
        "disease_key": "disease", "case_count": "cases"},
}
ORACLES["quality_required_columns"] = _sql("t rg dz", " UNION ALL ".join(
    f"SELECT '{column}' AS column_name, count(*) - count({made}) AS null_count, '{table}' AS table_name FROM {source}"
    for (table, source), columns in _MADE_FROM.items() for column, made in columns.items()))
_INCOMPLETE = "(cases IS NULL OR disease IS NULL OR disease = 'NA')"
ORACLES["dropped_rows"] = _sql("feed", f"""
SELECT count(*) AS rows_read, count(*) FILTER ({_INCOMPLETE}) AS incomplete,
       count(*) FILTER (NOT {_INCOMPLETE} AND NOT coalesce(TRY_CAST(cases AS DOUBLE) > 0, false)) AS no_positive_cases,
       count(*) FILTER (NOT {_INCOMPLETE} AND TRY_CAST(cases AS DOUBLE) > 0 AND TRY_CAST(epi_week AS DOUBLE) IS NULL)
         AS week_not_a_number
FROM feed""")
ORACLES["load_if_empty"] = _sql("t", f"""
SELECT disease, count(*) AS row_count, {_total()} AS cases FROM t GROUP BY 1""")

# --- models ------------------------------------------------------------------------------

ORACLES["observations"] = _sql("t", """
SELECT epi_week, state, loc, disease, cases, rate AS incidence_per_100000, loc_type FROM t""")
_TIME = f"""
SELECT {{key}} epi_week, week AS week_number, month, {_MONTHS}[month] AS month_name,
       (month - 1) // 3 + 1 AS quarter, year, year - year % 10 AS decade, year // 100 AS century,
       month IN (6, 7, 8) AS is_summer, month IN (10, 11, 12, 1, 2, 3) AS is_flu_season
FROM (SELECT DISTINCT epi_week, epi_week // 100 AS year, epi_week % 100 AS week,
             CAST(least(12, greatest(1, CAST(floor((epi_week % 100 - 1) * 12 / 52) AS INT) + 1)) AS INT) AS month
      FROM {{source}}) x"""
ORACLES["dim_time"] = _sql("t", _TIME.format(
    key="CAST(row_number() OVER (ORDER BY epi_week) AS INT) AS time_key,", source="t"))
ORACLES["time_fields"] = _sql("cl", _TIME.format(key="", source="cl"))
ORACLES["dim_location"] = _sql("t rg", """
WITH p AS (SELECT DISTINCT city AS city_name, state AS state_code, loc_type FROM t)
SELECT CAST(row_number() OVER (ORDER BY loc_type DESC, state_code, substr(md5(city_name), 1, 2), city_name) AS INT) AS location_key,
       city_name, state_code, rg.state AS state_name, region AS census_region,
       division AS census_division, lat AS latitude, lng AS longitude, loc_type
FROM p LEFT JOIN rg ON rg.state = p.state_code""")
ORACLES["dim_disease"] = _sql("dz", """
SELECT CAST(row_number() OVER (ORDER BY disease) AS INT) AS disease_key, disease AS disease_name,
       category AS disease_category, transmission AS transmission_type,
       preventable AS is_vaccine_preventable, vy AS vaccine_intro_year FROM dz""")
ORACLES["fact"] = _sql("t pop", """
SELECT epi_week, disease AS disease_name, t.state AS state_code, city AS city_name, loc_type,
       cases AS case_count, CAST(ru AS DOUBLE) / 1e4 AS incidence_rate,
       CASE WHEN loc_type = 'STATE' THEN population END AS population
FROM t LEFT JOIN pop ON pop.state = t.state AND pop.decade = t.decade""")
ORACLES["bucket_documents"] = _sql("bk dz rg", """
SELECT bk.disease AS name, category, preventable AS vaccine_preventable, vy AS vaccine_year, city,
       bk.state AS state_code, bk.region, division, loc_type, lat, year, month, month_name, quarter,
       decade, total_cases, avg_rate AS avg_incidence_rate, peak AS peak_weekly_cases,
       n AS observation_count
FROM bk JOIN dz ON dz.disease = bk.disease JOIN rg ON rg.state = bk.state""")
ORACLES["bucket_weeks"] = _sql("t", f"""
SELECT disease AS name, state AS state_code, city,
       CAST(row_number() OVER (PARTITION BY disease, state, loc, loc_type, year, month ORDER BY epi_week) - 1 AS INT)
         AS position, epi_week, week, cases, {scaled_even('rate')} AS incidence_rate
FROM t""")
ORACLES["bucket_array_totals"] = _sql("t", f"""
SELECT disease AS name, state AS state_code, city, year, month, {_total()} AS array_total,
       min(epi_week) AS first_week, count(*) >= 2 AS several_weeks
FROM t GROUP BY disease, state, loc, loc_type, city, year, month""")
ORACLES["bucket_rows"] = _sql("bk", f"""
SELECT disease AS name, year, {_total('total_cases')} AS total_cases, count(*) AS buckets,
       {_total('total_cases')} AS week_cases FROM bk GROUP BY 1, 2""")
ORACLES["monthly_aggregates"] = _sql("gr", """
SELECT disease, state AS state_code, state AS state_name, year, month, month_name, quarter,
       total_cases, avg_incidence, n AS observation_count, decade FROM gr""")
ORACLES["monthly_aggregates_paths"] = _sql("gr", """
SELECT disease, state, year, month, total_cases, n AS observation_count, avg_incidence FROM gr""")
ORACLES["graph_observations"] = _sql("t", f"""
SELECT cases AS case_count, {half_even('rate', 4)} AS incidence_rate, loc_type AS grain, disease,
       state AS state_code, city AS city_name, epi_week, year, month FROM t""")
ORACLES["borders"] = _sql("bd", "SELECT DISTINCT src, dst FROM bd")

_GRAPH_COUNTS = {
    ("node", "Disease"): _distinct_rows("dz", "disease"),
    ("node", "Region"): _distinct_rows("rg", "region"),
    ("node", "Country"): "CAST(1 AS BIGINT)",
    ("node", "State"): _distinct_rows("rg", "state"),
    ("node", "City"): _distinct_rows("t", "state, loc", "loc_type = 'CITY'"),
    ("node", "Decade"): _distinct_rows("t", "decade"),
    ("node", "Year"): _distinct_rows("t", "year"),
    ("node", "Quarter"): f"4 * {_distinct_rows('t', 'year')}",
    ("node", "Month"): _distinct_rows("t", "year, month"),
    ("node", "Week"): _distinct_rows("t", "epi_week"),
    ("node", "Observation"): "(SELECT count(*) FROM t)",
    ("node", "MonthlyAggregate"): _distinct_rows("t", "disease, state, year, month"),
    ("edge", "IN_COUNTRY"): _distinct_rows("rg", "region"),
    ("edge", "IN_REGION"): _distinct_rows("rg", "state"),
    ("edge", "LOCATED_IN_STATE"): _distinct_rows("t", "state, loc", "loc_type = 'CITY'"),
    ("edge", "BORDERS"): _distinct_rows("bd", "src, dst"),
    ("edge", "IN_DECADE"): _distinct_rows("t", "year"),
    ("edge", "IN_YEAR"): f"4 * {_distinct_rows('t', 'year')}",
    ("edge", "IN_QUARTER"): _distinct_rows("t", "year, month"),
    ("edge", "IN_MONTH"): _distinct_rows("t", "epi_week"),
    ("edge", "AFFECTS"): "(SELECT count(*) FROM t)",
    ("edge", "OBSERVED_IN"): "(SELECT count(*) FROM st)",
    ("edge", "OBSERVED_IN_CITY"): "(SELECT count(*) FROM t WHERE loc_type = 'CITY')",
    ("edge", "OBSERVED_AT"): "(SELECT count(*) FROM t)",
    ("edge", "SUMMARIZES_DISEASE"): _distinct_rows("t", "disease, state, year, month"),
    ("edge", "SUMMARIZES_STATE"): _distinct_rows("t", "disease, state, year, month"),
    ("edge", "SUMMARIZES_MONTH"): _distinct_rows("t", "disease, state, year, month"),
}
ORACLES["graph_profile"] = _sql("st dz rg bd", " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, '{name}' AS name, CAST({count} AS BIGINT) AS row_count"
    for (kind, name), count in _GRAPH_COUNTS.items()))
ORACLES["graph_write_profile"] = ORACLES["graph_profile"]
ORACLES["graph_place_edges"] = _sql("t rg bd", """
SELECT DISTINCT region AS src, 'USA' AS dst, 'IN_COUNTRY' AS kind FROM rg
UNION ALL SELECT state, region, 'IN_REGION' FROM rg
UNION ALL SELECT DISTINCT state || '|' || loc, state, 'LOCATED_IN_STATE' FROM t WHERE loc_type = 'CITY'
UNION ALL SELECT DISTINCT src, dst, 'BORDERS' FROM bd""")
ORACLES["graph_calendar_edges"] = _sql("t", """
WITH y AS (SELECT DISTINCT year, decade FROM t), m AS (SELECT DISTINCT year, month, quarter FROM t),
     w AS (SELECT DISTINCT epi_week, year, month FROM t),
     e AS (SELECT year AS src, decade AS dst, 'IN_DECADE' AS kind FROM y
           UNION ALL SELECT year * 10 + q, year, 'IN_YEAR' FROM y, (VALUES (1),(2),(3),(4)) v(q)
           UNION ALL SELECT year * 100 + month, year * 10 + quarter, 'IN_QUARTER' FROM m
           UNION ALL SELECT epi_week, year * 100 + month, 'IN_MONTH' FROM w)
SELECT CAST(src AS VARCHAR) AS src, CAST(dst AS VARCHAR) AS dst, kind FROM e""")
ORACLES["model_profile"] = _sql("st dz", f"""
SELECT 'table' AS kind, 'dim_time' AS name, {_distinct_rows('t', 'epi_week')} AS row_count
UNION ALL SELECT 'table', 'dim_location', {_distinct_rows('t', 'city, state, loc_type')}
UNION ALL SELECT 'table', 'dim_disease', (SELECT count(*) FROM dz)
UNION ALL SELECT 'table', 'fact', (SELECT count(*) FROM t)
UNION ALL SELECT 'document', 'buckets', {_distinct_rows('t', 'disease, state, loc, loc_type, year, month')}
{" ".join(f"UNION ALL SELECT 'summary', '{name}', {size}" for name, size in _SUMMARY_SIZES.items())}""")

# --- population and expectation ----------------------------------------------------------

_PEOPLE = """
yp AS (SELECT s.state, s.year, CASE WHEN s.year >= 2000 THEN b.population
              ELSE CAST(a.population + (s.year - 1990) * (b.population - a.population) // 10 AS INT) END AS population
       FROM (SELECT DISTINCT state, year FROM st) s
       JOIN pop a ON a.state = s.state AND a.decade = 1990
       JOIN pop b ON b.state = s.state AND b.decade = 2000)"""
ORACLES["population_interpolated"] = _sql("st pop", f"WITH {_PEOPLE} SELECT * FROM yp")
ORACLES["population_extrapolated"] = _sql("pop", """
SELECT a.state AS state_code, d AS decade,
       CAST(greatest(30000, a.population + (b.population - a.population) * ((d - 1990) // 10)) AS INT) AS population,
       'extrapolated_from_1990_2000' AS source
FROM pop a JOIN pop b ON b.state = a.state AND b.decade = 2000, (VALUES (1980), (1970), (1890)) v(d)
WHERE a.decade = 1990""")
ORACLES["population_left_lookup"] = _sql("cl pop", """
SELECT c.state, c.decade, population
FROM (SELECT DISTINCT state, epi_week // 100 - (epi_week // 100) % 10 AS decade FROM cl) c
LEFT JOIN pop ON pop.state = c.state AND pop.decade = c.decade""")
_SCORED = f"""
WITH {_PEOPLE},
 pr(disease, base, amp, peak, decay) AS (VALUES
   ('ECONOMY', 25e-1, 25e-2, 6, 2e-2), ('LARGE', 325e-2, 5e-1, 17, 35e-2), ('MEDIUM', 6e0, 1e-1, 22, 7e-2),
   ('PROMO', 3e-1, 55e-2, 49, 4e-1), ('SMALL', 95e-1, 45e-2, 36, 18e-2), ('STANDARD', 7e0, 15e-2, 3, 22e-2)),
 x AS (SELECT st.disease, st.state, st.epi_week, st.year, st.cases,
         greatest(0e0, base * (population / 1e5) * (1 + amp * cos(2 * pi() * (week - peak) / 52e0))
           * CASE WHEN st.disease = 'ECONOMY' THEN
               CASE WHEN st.year >= 1949 THEN 1e-3 WHEN st.year >= 1900 THEN greatest(1e-2, 1 - (st.year - 1900) * 18e-3)
                    ELSE 1e0 END
             WHEN st.year > vy THEN exp(-decay * (st.year - vy)) ELSE 1e0 END
           * CASE WHEN st.year > vy THEN greatest(3e-1, 1 - (st.year - 1995) * 3e-3) ELSE 1e0 END) AS expected
       FROM st JOIN yp ON yp.state = st.state AND yp.year = st.year
       JOIN pr ON pr.disease = st.disease JOIN dz ON dz.disease = st.disease)
"""
ORACLES["expected_cases"] = _sql("st pop dz", _SCORED + """
SELECT disease, state, epi_week, cases, round(expected, 6) AS expected FROM x""")
ORACLES["observed_to_expected"] = _sql("st pop dz", _SCORED + f"""
SELECT disease, year, {_total()} AS observed, round(sum(expected), 6) AS expected,
       round(sum(cases) / sum(expected), 6) AS ratio FROM x GROUP BY 1, 2""")
ORACLES["incidence_per_100k"] = _sql("t pop", f"""
WITH i AS (SELECT t.*, CASE WHEN loc_type = 'STATE' AND population > 0 THEN cases * 1e5 / population END AS i
           FROM t LEFT JOIN pop ON pop.state = t.state AND pop.decade = t.decade)
SELECT disease AS disease_name, state AS state_code, city AS city_name, epi_week, cases AS case_count,
       coalesce({half_even('i', 4)}, 0e0) AS incidence FROM i""")

# --- comparison and overview -------------------------------------------------------------

ORACLES["reconcile_q01"] = _sql("t st", f"""
WITH a AS (SELECT disease, decade, {_total()} AS c FROM st GROUP BY 1, 2),
     b AS (SELECT disease, decade, {_total()} AS c FROM t GROUP BY 1, 2)
SELECT coalesce(a.disease, b.disease) AS disease_name, coalesce(a.decade, b.decade) AS decade,
       a.c AS star_total_cases, b.c AS bucket_total_cases, b.c - a.c AS delta_total_cases,
       CASE WHEN b.c IS NULL THEN 'star' WHEN a.c IS NULL THEN 'bucket' ELSE 'both' END AS present_in
FROM a FULL JOIN b ON a.disease = b.disease AND a.decade = b.decade""")
ORACLES["reconcile_q03_differences"] = _sql("t", f"""
WITH g AS (SELECT state AS state_name, {_total()} AS total_cases FROM t
           WHERE disease = 'PROMO' AND year BETWEEN 1996 AND 2000
           GROUP BY 1 ORDER BY total_cases DESC, state_name LIMIT 10),
     s AS (SELECT state AS state_name, {_total()} AS total_cases FROM t
           WHERE disease = 'PROMO' AND year BETWEEN 1996 AND 2000 AND loc_type = 'STATE'
           GROUP BY 1 ORDER BY total_cases DESC, state_name LIMIT 10)
SELECT *, 'star' AS only_in FROM (SELECT * FROM s EXCEPT ALL SELECT * FROM g) x
UNION ALL SELECT *, 'graph' FROM (SELECT * FROM g EXCEPT ALL SELECT * FROM s) y""")
ORACLES["overview_by_disease"] = _sql("t", f"""
WITH d AS (SELECT disease AS disease_name, {_total()} AS total_cases FROM t GROUP BY 1)
SELECT *, {half_up('CAST(total_cases AS DOUBLE) / sum(total_cases) OVER () * 100', 0)} AS share_pct FROM d""")
ORACLES["overview_by_decade"] = _sql("t", f"""
SELECT decade, {_total()} AS total_cases FROM t GROUP BY 1""")

# --- expression-level rows ---------------------------------------------------------------

ORACLES["division_guards"] = _sql("st", f"""
WITH y AS (SELECT state, year, {_total()} AS cur FROM st WHERE disease = 'STANDARD' GROUP BY 1, 2),
     l AS (SELECT *, lag(cur) OVER (PARTITION BY state ORDER BY year) AS p0 FROM y),
     z AS (SELECT *, CASE WHEN year % 3 = 0 THEN 0 ELSE p0 END AS prev, CAST(cur AS DOUBLE) AS c FROM l)
SELECT state AS state_name, year, c / nullif(prev, 0) AS null_guard,
       c / CASE WHEN prev = 0 THEN 1 ELSE prev END AS one_guard, c / greatest(1, prev) AS max_guard,
       CASE WHEN prev <> 0 THEN cur - prev END AS usable_guard FROM z""")
ORACLES["rounding_rules"] = _sql("t", f"""
SELECT DISTINCT rate, CAST(ru AS DOUBLE) / 1e4 AS half_up, {half_even('rate', 4)} AS half_even,
       {scaled_even('rate')} AS scaled_even FROM t""")
ORACLES["text_conversions"] = _sql("feed", """
SELECT DISTINCT cases, disease AS raw_disease, loc_type, TRY_CAST(cases AS DOUBLE) AS number,
       upper(trim(disease)) AS name, coalesce(lower(loc_type) = 'true', false) AS flag FROM feed""")

# --- events and streams ------------------------------------------------------------------

ORACLES["publish_messages"] = _sql("ev", """
SELECT epi_week, state, state AS loc, 'STATE' AS loc_type, disease, cases, incidence_rate, event_id,
       state || '_' || epi_week AS message_key FROM ev""")
ORACLES["publish_observations"] = _sql("t", f"""
SELECT disease, epi_week, count(*) AS events, {_total()} AS cases,
       min(rate) AS lowest_rate, max(rate) AS highest_rate
FROM t GROUP BY 1, 2""")
ORACLES["publish_head"] = _sql("ev", """
SELECT event_id, disease, state, epi_week, cases, incidence_rate FROM ev ORDER BY ts DESC, event_id DESC LIMIT 500""")
ORACLES["stream_validated"] = _sql("ev", """
SELECT epi_week, state, state AS loc, 'STATE' AS loc_type, disease, cases, incidence_rate, event_id
FROM ev WHERE cases >= 0 AND disease IS NOT NULL""")
ORACLES["stream_alerts"] = _sql("ev", """
SELECT disease, state, epi_week, cases, incidence_rate, 'HIGH_INCIDENCE' AS alert_type
FROM ev WHERE cases >= 0 AND disease IS NOT NULL AND incidence_rate > 50""")
ORACLES["stream_national_totals"] = _sql("ev", f"""
SELECT disease, epi_week, {_total()} AS national_cases, count(*) AS states_reporting,
       round(avg(incidence_rate), 6) AS avg_national_incidence
FROM ev WHERE cases >= 0 AND disease IS NOT NULL GROUP BY 1, 2""")
ORACLES["stream_derived_topics"] = _sql("ev", """
SELECT epi_week, state, state AS loc, 'STATE' AS loc_type, disease, cases, incidence_rate, event_id,
       state || '_' || epi_week AS message_key
FROM ev WHERE cases >= 0 AND disease IS NOT NULL AND incidence_rate > 50""")
ORACLES["stream_national_totals_bounded"] = ORACLES["stream_national_totals"]
ORACLES["stream_event_rate"] = """
WITH w AS (SELECT date_trunc('second', ts) - i * INTERVAL 1 SECOND AS s FROM events, range(10) r(i))
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(s + INTERVAL 10 SECOND, '%Y-%m-%d %H:%M:%S') AS window_end,
       count(*) AS events, round(count(*) / 10e0, 1) AS rate
FROM w GROUP BY s"""
ORACLES["stream_event_rate_panes"] = ORACLES["stream_event_rate"]
ORACLES["stream_event_rate_closed"] = f"""
SELECT * FROM ({ORACLES["stream_event_rate"]})
WHERE window_end <= (SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') FROM events)"""
ORACLES["stream_closed_weeks"] = _sql("ev", f"""
, v AS (SELECT *, least(4, (dayofmonth(ts) - 1) // 6 + CASE WHEN event_id % 10 = 0 THEN 2 ELSE 0 END) AS delivery,
              make_date(CAST(epi_week // 100 AS INT), 1, 1) + CAST((epi_week % 100 - 1) * 7 AS INT) AS starts
       FROM ev WHERE cases >= 0 AND disease IS NOT NULL),
 m AS (SELECT v.*, (SELECT max(o.starts) FROM v o WHERE o.delivery < v.delivery) - 7 AS closed FROM v),
 l AS (SELECT *, coalesce(starts <= closed, false) AS late FROM m)
SELECT disease, epi_week, CAST(sum(cases) FILTER (NOT late) AS BIGINT) AS national_cases,
       count(*) FILTER (NOT late) AS states_reporting,
       round(avg(incidence_rate) FILTER (NOT late), 6) AS avg_national_incidence, count(*) FILTER (late) AS late_events
FROM l WHERE starts <= (SELECT max(starts) - 7 FROM v) GROUP BY 1, 2 HAVING count(*) FILTER (NOT late) > 0""")
ORACLES["stream_latest_events"] = _sql("ev", """
SELECT event_id, disease, state, epi_week, cases, incidence_rate
FROM ev ORDER BY ts DESC, event_id DESC LIMIT 50""")
ORACLES["stream_latest_alerts"] = _sql("ev", """
SELECT event_id, disease, state, epi_week, cases, incidence_rate, 'HIGH_INCIDENCE' AS alert_type
FROM ev WHERE cases >= 0 AND incidence_rate > 50 ORDER BY ts DESC, event_id DESC LIMIT 20""")
ORACLES["stream_running_count"] = "SELECT 'all' AS topic, count(*) AS event_count FROM events"
