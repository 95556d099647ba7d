import pytest
from pyspark.sql import functions as F

from caseloom import schemas
from caseloom.operators import clean, quality
from caseloom.sources import observations, tables
from tests.small_data import DROPPED, RAW


def test_cleaning_drops_and_normalises(small):
    rows = small.obs.collect()
    assert len(rows) == len(RAW) - DROPPED
    second = [r for r in rows if r.epi_week == 196002][0]
    assert (second.state, second.loc, second.loc_type, second.disease) == ("AA", "NAN", "STATE", "MEASLES")
    assert second.incidence_per_100000 == 0.0
    half = [r for r in rows if r.disease == "MUMPS" and r.state == "CC"][0]
    assert half.cases == 0


def test_typed_rows_clean_like_text(spark):
    rows = spark.createDataFrame(
        [(196001, " aa", None, "State", "flu", 3, None), (196002, "AA", "x", "CITY", "FLU", 0, 1.5),
         (196003, "AA", "x", "CITY", None, 4, 1.5)],
        "epi_week int, state string, loc string, loc_type string, disease string, cases long, "
        "incidence_per_100000 double")
    as_text = rows.select(*[F.col(c).cast("string").alias(c) for c in schemas.RAW_COLUMNS])
    typed = clean.typed_observations(rows).collect()
    assert typed == clean.clean_observations(as_text).collect()
    assert [tuple(r) for r in typed] == [(196001, "AA", "NAN", "FLU", 3, 0.0, "STATE")]


def test_rows_by_grain(small):
    counts = {r.loc_type: r.row_count for r in clean.rows_by_grain(small.obs).collect()}
    assert counts == {"STATE": 15, "CITY": 3, "COUNTY": 2}


def test_incidence(spark):
    df = spark.createDataFrame([(10, 300_000), (10, 0), (10, None)], "c int, p int")
    rates = [r.incidence for r in clean.incidence_per_100k(df, "c", "p").collect()]
    assert rates == [round(10 * 100000.0 / 300_000, 4), 0.0, 0.0]


def _brute(raw, states, diseases):
    issues = dict.fromkeys(quality.ISSUES, 0)
    for week, state, _, _, disease, cases, _ in raw:
        disease, state = (disease or "").strip(), (state or "").strip()
        if not disease:
            issues["null_disease"] += 1
        elif disease not in diseases:
            issues["invalid_disease"] += 1
        if state not in states:
            issues["invalid_state"] += 1
        try:
            issues["negative_cases"] += int((cases or "").strip()) < 0
        except ValueError:
            issues["null_cases"] += 1
        try:
            year, number = divmod(int((week or "").strip()), 100)
            issues["invalid_epi_week"] += not (1 <= number <= 53 and 1800 <= year <= 2100)
        except ValueError:
            issues["invalid_epi_week"] += 1
    return issues


def test_issue_counts_match_a_row_by_row_check(small):
    extra = [("17990_1", "AA", "AA", "STATE", "MEASLES", "1_000", "1"),
             ("-196001", "AA", "AA", "STATE", "MEASLES", "-0", "1"),
             (" 210053 ", "AA", "AA", "STATE", "MEASLES", " +5 ", "1")]
    raw = small.raw.union(small.spark.createDataFrame(extra, schemas.RAW))
    report = quality.issue_counts(raw, small.regions, small.diseases).first()
    expected = _brute(RAW + extra, {"AA", "BB", "CC", "DD"},
                      {"MEASLES", "MUMPS", "DIPHTHERIA", "SMALLPOX"})
    assert {name: report[name] for name in quality.ISSUES} == expected
    total = sum(expected.values())
    assert report.total_issues == total
    assert report.quality_score == round((1 - total / (len(RAW) + 3)) * 100, 2)
    assert report.passed is False
    assert (report.first_year, report.last_year) == (1960, 2100)


def test_empty_data_fails(small):
    report = quality.issue_counts(small.raw.limit(0), small.regions, small.diseases).first()
    assert report.passed is False and report.total_rows == 0


def test_score_passes_at_the_mark(small):
    good = ("196001", "AA", "AA", "STATE", "MEASLES", "1", "1")
    raw = small.spark.createDataFrame([good] * 19 + [(*good[:5], "x", "1")], schemas.RAW)
    report = quality.issue_counts(raw, small.regions, small.diseases).first()
    assert report.quality_score == 95.0 and report.passed is True


def test_found_values(small):
    found = quality.found_values(small.raw, small.regions, small.diseases).first()
    assert found.diseases == ["DIPHTHERIA", "MEASLES", "MUMPS"]
    assert found.states == ["AA", "BB", "CC"]


def test_missing_columns():
    assert quality.missing_columns(["epi_week", "state", "cases"]) == [
        "disease", "incidence_per_100000", "loc", "loc_type"]


def test_integrity_rules_hold_on_the_star(small):
    star = small.star()
    frames = {"dim_time": star.dim_time, "dim_location": star.dim_location,
              "dim_disease": star.dim_disease}
    for name, df in frames.items():
        assert quality.duplicate_keys(df, quality.UNIQUE_KEYS[name]).isEmpty()
    for key, name in quality.FOREIGN_KEYS.items():
        assert quality.orphans(star.fact, frames[name], key).isEmpty()
    assert quality.orphans(star.fact, star.dim_time.limit(1), "time_key").count() > 0
    nulls = {r.column_name: r.null_count for r in quality.null_counts(
        star.dim_location, quality.REQUIRED_COLUMNS["dim_location"]).collect()}
    assert nulls["state_name"] == 2 and nulls["state_code"] == 0


def test_csv_round_trip(spark, small, tmp_path):
    folder = str(tmp_path / "in")
    small.raw.coalesce(1).write.option("header", True).csv(f"{folder}/observations_synthetic.csv")
    path = observations.resolve_active(spark, folder)
    assert path.endswith("observations_synthetic.csv")
    assert all(sorted(h) == sorted(schemas.RAW_COLUMNS) for h in observations.scan_headers(spark, path).values())
    assert observations.missing_by_file(spark, path) == {}
    back = clean.clean_observations(observations.scan_observations(spark, path))
    assert back.exceptAll(small.obs).isEmpty() and small.obs.exceptAll(back).isEmpty()
    label = spark.range(1).select(observations.source_label(F.lit(path))).first()[0]
    assert label == "synthetic"
    with pytest.raises(FileNotFoundError):
        observations.resolve_active(spark, str(tmp_path))


def test_source_label_per_file(spark, small, tmp_path):
    path = str(tmp_path / "data_real.csv")
    small.raw.toPandas().to_csv(path, index=False)
    labels = observations.with_source_label(spark, path).select("source_label").distinct().collect()
    assert [r[0] for r in labels] == ["real"]


def test_source_label_of_a_folder(spark, small, tmp_path):
    path = str(tmp_path / "data_synthetic.csv")
    small.raw.write.option("header", True).csv(path)
    labels = observations.with_source_label(spark, path).select("source_label").distinct().collect()
    assert [r[0] for r in labels] == ["synthetic"]


def test_missing_tokens_are_null_after_cleaning_only(spark, small, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("epi_week,state,loc,loc_type,disease,cases,incidence_per_100000\n"
                    "196001,AA,,STATE,NA,null,N/A\n196001,AA,nan,STATE,FLU,3,\n")
    raw = observations.scan_observations(spark, str(path))
    rows = raw.collect()
    assert (rows[0].loc, rows[0].disease, rows[0].cases, rows[0].incidence_per_100000) == (None, "NA", "null", "N/A")
    assert rows[1].loc == "nan" and rows[1].cases == "3"
    cells = clean.missing_cells(raw).collect()
    assert (cells[0].loc, cells[0].disease, cells[0].cases, cells[1].loc) == (None,) * 4
    issues = quality.issue_counts(raw, small.regions, small.diseases).first()
    assert issues.null_disease == 0 and issues.invalid_disease >= 1


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "disease,state,loc,loc_type,cases,epi_week,note,incidence_per_100000\n"
        'MEASLES,AA,"A ""B"", C",CITY,5,196001,"x, y",1.5\nMUMPS,BB,"two\nlines",CITY,7,196002,,2\n')
    (tmp_path / "b.csv").write_text("epi_week,state,loc,loc_type,disease,cases\n196003,CC,CC,STATE,POLIO,9\n")
    (tmp_path / "c.csv").write_text("")
    rows = observations.scan_observations(spark, str(tmp_path)).orderBy("epi_week").collect()
    assert [(r.epi_week, r.disease, r.loc, r.cases, r.incidence_per_100000) for r in rows] == [
        ("196001", "MEASLES", 'A "B", C', "5", "1.5"), ("196002", "MUMPS", "two\nlines", "7", "2"),
        ("196003", "POLIO", "CC", "9", None)]
    missing = observations.missing_by_file(spark, str(tmp_path))
    assert {name.rsplit("/", 1)[1]: columns for name, columns in missing.items()} == {
        "b.csv": ["incidence_per_100000"], "c.csv": sorted(schemas.RAW_COLUMNS)}


def test_guarded_load_and_merge(spark, tmp_path):
    schema = schemas.BORDERS
    first = spark.createDataFrame([("a", "1"), ("b", "2"), (None, "3")], schema)
    second = spark.createDataFrame([("b", "9"), ("c", "8"), (None, "7")], schema)
    base = str(tmp_path)
    assert tables.load_if_empty(first, f"{base}/t", schema)
    assert not tables.load_if_empty(second, f"{base}/t", schema)
    tables.merge_replace(second, ["src"], f"{base}/t", f"{base}/t2", schema)
    rows = {(r.src, r.dst) for r in tables.read_table(spark, f"{base}/t2", schema).collect()}
    assert rows == {("a", "1"), ("b", "9"), ("c", "8"), (None, "7")}
    with pytest.raises(ValueError):
        tables.merge_replace(second, ["src"], f"{base}/t2", f"{base}/t2/", schema)
