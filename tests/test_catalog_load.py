import dataclasses

import pandas as pd
import pytest

from caseloom.operators.quality import IntegrityError
from caseloom.plans import catalog
from caseloom.plans.load import QualityError, ReferencePaths, check_raw, load_files
from caseloom.plans.warehouse import LAYOUT
from caseloom.session import scratch_root, shuffle_partitions
from tests.small_data import DROPPED


@pytest.fixture(scope="module")
def files(small, tmp_path_factory):
    base = tmp_path_factory.mktemp("csv")
    frames = {"observations_real": small.raw, "regions": small.regions, "diseases": small.diseases,
              "populations": small.populations, "borders": small.border_lists}
    for name, df in frames.items():
        df.toPandas().to_csv(base / f"{name}.csv", index=False)
    reference = ReferencePaths(*[str(base / f"{n}.csv") for n in ("regions", "diseases", "populations", "borders")])
    return str(base), reference


@pytest.fixture(scope="module")
def loaded(spark, files, tmp_path_factory):
    folder, reference = files
    return load_files(spark, folder, reference, str(tmp_path_factory.mktemp("wh")), check=False)


def test_load_writes_every_table(loaded, small):
    warehouse, status = loaded
    lines = status.collect()
    rows = {r.table_name: r for r in lines if r.status != "dropped"}
    assert set(rows) == set(LAYOUT)
    dropped = {r.table_name: r.row_count for r in lines if r.status == "dropped"}
    assert sum(dropped.values()) == DROPPED and dropped["week_not_a_number"] == 1
    assert all(r.status == "loaded" and r.source_label == "real" for r in rows.values())
    assert rows["fact"].row_count == small.star().fact.count()
    assert rows["buckets"].row_count == small.buckets().documents.count()


def test_repeated_reference_rows_stop_the_load(spark, files, small, tmp_path):
    folder, reference = files
    doubled = str(tmp_path / "regions.csv")
    twice = small.regions.toPandas()
    pd.concat([twice, twice.iloc[:1]]).to_csv(doubled, index=False)
    with pytest.raises(IntegrityError, match=twice.state_code.iloc[0]):
        load_files(spark, folder, dataclasses.replace(reference, regions=doubled), str(tmp_path / "wh"), check=False)


def test_second_load_keeps_filled_tables(loaded):
    warehouse, _ = loaded
    kept = {r.table_name: r.status for r in warehouse.load(full_refresh=False).collect()}
    assert set(kept.values()) == {"kept"}
    again = {r.table_name: r.row_count for r in warehouse.load(full_refresh=True).collect()}
    assert again["fact"] == warehouse.table("fact").count()


def test_loaded_models_answer_like_built_ones(loaded, small):
    warehouse, _ = loaded
    for query_id, model, handle in (("Q1", "star", small.star()), ("Q1", "bucket", small.buckets()),
                                    ("Q12", "graph", small.graph())):
        direct = catalog.query_function(query_id, model)(handle).collect()
        assert catalog.run(warehouse, query_id, model).collect() == direct


def test_every_query_runs_with_its_defaults(loaded):
    warehouse, _ = loaded
    for query_id, entry in catalog.CATALOG.items():
        for answer in catalog.run_all_models(warehouse, query_id).values():
            assert answer.columns and answer.collect() is not None


def test_parameters_are_typed_and_checked(loaded):
    warehouse, _ = loaded
    text = catalog.run(warehouse, "Q2", "star", year="1960").collect()
    assert text == catalog.run(warehouse, "Q2", "star", year=1960).collect() and text
    with pytest.raises(ValueError):
        catalog.run(warehouse, "Q2", "star", year="soon")
    with pytest.raises(KeyError):
        catalog.run(warehouse, "Q99", "star")
    with pytest.raises(KeyError):
        catalog.run(warehouse, "Q11", "star")


def test_refresh_reports_each_table(loaded, tmp_path, monkeypatch):
    warehouse, _ = loaded
    builders = warehouse.summary_builders()
    broken = {**builders, "mv_yearly_disease_city": lambda: warehouse.table("nothing")}
    monkeypatch.setattr(type(warehouse), "summary_builders", lambda self: broken)
    status = {r.table_name: r for r in warehouse.refresh_summaries(str(tmp_path)).collect()}
    assert status["mv_yearly_disease_city"].status == "error" and status["mv_yearly_disease_city"].error
    assert status["mv_monthly_disease_state"].status == "success"
    assert status["mv_monthly_disease_state"].row_count > 0


def test_timing(spark):
    result = catalog.timed(lambda: spark.range(10), runs=4, warm_ups=1)
    assert len(result["runs"]) == 4 and result["p25"] <= result["median"] <= result["p75"]


def test_quality_gate(spark, files, tmp_path):
    folder, reference = files
    with pytest.raises(QualityError, match="score"):
        check_raw(spark, f"{folder}/observations_real.csv", reference)
    (tmp_path / "bad.csv").write_text("epi_week,state\n196001,AA\n")
    with pytest.raises(QualityError, match="missing columns"):
        check_raw(spark, str(tmp_path / "bad.csv"), reference)
    good = "196001,AA,AA,STATE,MEASLES,3,1.5\n"
    (tmp_path / "good.csv").write_text(
        "epi_week,state,loc,loc_type,disease,cases,incidence_per_100000\n" + good * 3)
    assert check_raw(spark, str(tmp_path / "good.csv"), reference).first().quality_score == 100.0


def test_scratch_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    root = scratch_root(spark)
    assert root == scratch_root(spark)
    if shared:
        assert root.startswith(shared.rstrip("/"))


class _Session:
    """Just enough of a session to ask for its scratch folder."""

    def __init__(self, master, shared=None):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}"})()
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: shared)})()


def test_scratch_without_a_shared_folder():
    assert scratch_root(_Session("yarn", "hdfs://x/cp/")) == "hdfs://x/cp/caseloom-app-yarn"
    shared = _Session("yarn", "hdfs://x/wh")
    shared.conf.get = lambda key, default=None: "hdfs://x/wh" if key == "spark.sql.warehouse.dir" else default
    assert scratch_root(shared) == "hdfs://x/wh/caseloom-app-yarn"


def test_unset_settings_read_as_none(spark):
    assert spark.conf.get("spark.caseloom.unset", None) is None


def test_shuffle_partitions_follow_the_data():
    mb = 1024 * 1024
    assert shuffle_partitions(37 * mb, 8) == 1
    assert shuffle_partitions(300 * mb, 8) == 5
    assert shuffle_partitions(100 * 1024 * 1024 * mb, 4000) == 1_640_000
