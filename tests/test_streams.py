import datetime

import pytest
from pyspark.sql import functions as F

from caseloom import schemas
from caseloom.sources import events
from caseloom.streaming import queries, sinks

T0 = datetime.datetime(2024, 1, 1, 12, 0, 0, 250000)


def event(n, disease, week, cases, rate, seconds=0.0, state="AA"):
    return (week, state, state, "STATE", disease, cases, rate, T0 + datetime.timedelta(seconds=seconds), n)


FIRST = [event(1, "FLU", 202401, 5, 60.0, 0), event(2, "FLU", 202401, 0, 10.0, 1),
         event(3, "FLU", 202402, -1, 99.0, 2), event(4, None, 202402, 3, 99.0, 3)]
SECOND = [event(5, "FLU", 202401, 7, 20.0, 4), event(6, "POX", 202403, None, 70.0, 12),
          event(7, "POX", 202403, 2, 50.0, 12.5), event(8, "POX", 202403, 2, 50.1, 30)]


EVENT_ROWS = schemas.T.StructType([*schemas.EVENT.fields, *schemas.TOPIC.fields[2:]])


def rows(spark, data):
    return spark.createDataFrame(data, EVENT_ROWS)


class Topic:
    def __init__(self, spark, path):
        self.spark, self.path = spark, str(path)

    def publish(self, data):
        events.publish_files(events.as_messages(rows(self.spark, data)).coalesce(1), self.path)

    def publish_raw(self, values):
        df = self.spark.createDataFrame([("k", v, T0, 100 + i) for i, v in enumerate(values)], schemas.TOPIC)
        events.publish_files(df.coalesce(1), self.path)

    def stream(self, max_files=1):
        return events.parsed_events(events.file_topic(self.spark, self.path, max_files))


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


def test_message_shape(spark):
    message = events.as_messages(rows(spark, FIRST[:1])).first()
    assert message.key == "AA_202401"
    assert message.value == ('{"epi_week":202401,"state":"AA","loc":"AA","loc_type":"STATE","disease":"FLU",'
                             '"cases":5,"incidence_rate":60.0}')
    assert events.as_messages(rows(spark, FIRST), limit=2).count() == 2


def test_malformed_messages_are_skipped(topic, spark, tmp_path):
    topic.publish_raw(["not json", "{\"epi_week\": 202401", "", "{\"cases\": \"many\", \"disease\": \"FLU\"}",
                       "{\"disease\": \"FLU\", \"cases\": 4, \"extra\": 1}"])
    sinks.finish(sinks.append_rows(topic.stream(), str(tmp_path / "out"), str(tmp_path / "cp")))
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r.disease, r.cases) for r in got] == [("FLU", 4)]


def test_times_keep_microseconds(topic, spark, tmp_path):
    topic.publish(FIRST[:1])
    sinks.finish(sinks.append_rows(topic.stream(), str(tmp_path / "out"), str(tmp_path / "cp")))
    assert spark.read.parquet(str(tmp_path / "out")).first().timestamp == T0


def test_stream_equals_batch_over_restarts(topic, spark, tmp_path):
    """Two runs with a shared checkpoint see every message once; state carries over."""
    out = {name: str(tmp_path / name) for name in ("valid", "alerts", "totals")}
    for data in (FIRST, SECOND):
        topic.publish(data)
        valid = queries.validated(topic.stream())
        totals = queries.national_totals(valid)
        sinks.finish(sinks.append_rows(valid, out["valid"], out["valid"] + "-cp"))
        sinks.finish(sinks.append_rows(queries.alerts(valid), out["alerts"], out["alerts"] + "-cp"))
        sinks.finish(sinks.record_changes(totals, out["totals"], out["totals"] + "-cp"))
    batch = queries.validated(rows(spark, FIRST + SECOND))
    assert sorted(r.event_id for r in spark.read.parquet(out["valid"]).collect()) == [1, 2, 5, 7, 8]
    alerts = spark.read.parquet(out["alerts"]).collect()
    assert sorted((r.event_id, r.alert_type) for r in alerts) == [(1, "HIGH_INCIDENCE"), (8, "HIGH_INCIDENCE")]
    state = sinks.current_state(spark, out["totals"], totals.schema, ["disease", "epi_week"])
    expected = queries.national_totals(batch)
    assert sorted(map(tuple, state.select(expected.columns).collect())) == sorted(map(tuple, expected.collect()))
    flu = state.filter("epi_week = 202401").first()
    assert (flu.national_cases, flu.states_reporting, flu.avg_national_incidence) == (12, 3, 30.0)


def test_every_event_counts_however_the_topic_is_batched(topic, spark, tmp_path):
    for data in (SECOND, FIRST, [event(9, "FLU", 202401, 8, 4.0)]):
        topic.publish(data)
    answers = []
    for max_files in (None, 1):
        out = str(tmp_path / f"out{max_files}")
        rates = queries.event_rates(topic.stream(max_files=max_files))
        sinks.finish(sinks.record_changes(rates, out, out + "-cp"))
        state = sinks.current_state(spark, out, rates.schema, ["window_start"])
        answers.append(sorted(map(tuple, state.collect())))
    assert answers[0] == answers[1] and sum(r[2] for r in answers[0]) == 10 * (len(FIRST) + len(SECOND) + 1)
    assert sinks.current_state(spark, str(tmp_path / "none"), rates.schema, ["window_start"]).isEmpty()


def test_repeated_batch_is_recorded_once(topic, spark, tmp_path):
    topic.publish(FIRST)
    totals = queries.national_totals(queries.validated(topic.stream()))
    for checkpoint in ("cp1", "cp2"):
        # A fresh checkpoint replays batch 0 into the same change record.
        sinks.finish(sinks.record_changes(totals, str(tmp_path / "out"), str(tmp_path / checkpoint)))
    state = sinks.current_state(spark, str(tmp_path / "out"), totals.schema, ["disease", "epi_week"])
    assert state.first().national_cases == 5 and state.count() == 1


def test_bounded_state_drops_late_weeks(topic, spark, tmp_path):
    out = str(tmp_path / "out")
    # The watermark moves after a batch: week 30 closes everything before week 20.
    for data in ([event(1, "FLU", 202401, 5, 1.0)], [event(2, "FLU", 202430, 5, 1.0)],
                 [event(3, "FLU", 202401, 7, 1.0), event(4, "FLU", 202425, 7, 1.0)]):
        topic.publish(data)
        totals = queries.national_totals(queries.validated(topic.stream()), late_weeks=10)
        sinks.finish(sinks.record_changes(totals, out, out + "-cp"))
    state = sinks.current_state(spark, out, totals.schema, ["disease", "epi_week"])
    assert {r.epi_week: r.national_cases for r in state.collect()} == {202401: 5, 202430: 5, 202425: 7}


def test_event_rate_equals_brute_force(topic, spark, tmp_path):
    topic.publish(FIRST + SECOND)
    rates = queries.event_rates(topic.stream(max_files=None))
    sinks.finish(sinks.record_changes(rates, str(tmp_path / "out"), str(tmp_path / "cp")))
    got = {r.window_start: (r.events, r.rate) for r in sinks.current_state(
        spark, str(tmp_path / "out"), rates.schema, ["window_start"]).collect()}
    times = [r[7] for r in FIRST + SECOND]
    expected = {}
    for step in range(-15, 40):
        start = T0.replace(microsecond=0) + datetime.timedelta(seconds=step)
        n = sum(start <= t < start + datetime.timedelta(seconds=10) for t in times)
        if n:
            expected[start] = (n, round(n / 10, 1))
    assert got == expected


def test_latest_rows(topic, spark, tmp_path):
    out = str(tmp_path / "out")
    assert sinks.latest_rows(spark, out, EVENT_ROWS).isEmpty()
    for data in (SECOND, FIRST, [event(9, "FLU", 202402, 1, 1.0, 20)]):
        topic.publish(data)
        sinks.finish(sinks.keep_latest(topic.stream(), ["timestamp", "event_id"], 3, out, out + "-cp"))
    assert sorted(r.event_id for r in sinks.latest_rows(spark, out, EVENT_ROWS).collect()) == [7, 8, 9]
    assert sinks.versions(spark, out) == [1, 2]


def test_repeated_batch_keeps_the_same_latest_rows(topic, spark, tmp_path):
    out = str(tmp_path / "out")
    for data in (FIRST, SECOND):
        topic.publish(data)
    for checkpoint in ("a", "b"):
        # The second run replays batches 0 and 1 over the versions of the first.
        sinks.finish(sinks.keep_latest(topic.stream(), ["timestamp", "event_id"], 2, out, f"{out}-{checkpoint}"))
    latest = sinks.latest_rows(spark, out, EVENT_ROWS)
    assert sorted(r.event_id for r in latest.collect()) == [7, 8]


def test_queries_also_run_on_batches(spark):
    batch = rows(spark, FIRST + SECOND)
    assert queries.alerts(batch).count() == 5
    assert queries.event_rates(batch).agg(F.sum("events")).first()[0] == 80


def test_closed_weeks_are_emitted_once_and_leave_the_state(topic, spark, tmp_path):
    out, late = str(tmp_path / "out"), str(tmp_path / "late")
    held, emitted = [], []
    for data in ([event(1, "FLU", 202401, 5, 1.0), event(2, "FLU", 202402, 1, 1.0)],
                 [event(3, "FLU", 202405, 5, 1.0), event(4, "POX", 202405, 5, 1.0), event(5, "FLU", 202402, 2, 1.0)],
                 [event(6, "FLU", 202402, 7, 1.0), event(7, "FLU", 202406, 1, 1.0), event(8, "FLU", 202401, 1, 1.0)],
                 [event(9, "FLU", 202410, 1, 1.0), event(10, "FLU", 202405, 9, 1.0)]):
        topic.publish(data)
        valid = queries.validated(topic.stream(max_files=None))
        weeks = queries.national_totals(valid, late_weeks=2)
        query = sinks.finish(sinks.append_rows(weeks, out, out + "-cp"))
        progress = [o for p in query.recentProgress for o in p["stateOperators"]]
        held.append(progress[-1]["numRowsTotal"])
        emitted.append(spark.read.schema(weeks.schema).parquet(out).count())
        timed = queries.with_week_start(valid)
        sinks.finish(sinks.record_late(timed, "week_start", 14 * 86_400, late, late + "-cp"))
    got = {(r.disease, r.epi_week): (r.national_cases, r.states_reporting)
           for r in spark.read.schema(weeks.schema).parquet(out).collect()}
    # Weeks 1 and 2 close with week 5; the events of both that come later are late. Week 10 closes the rest.
    assert got == {("FLU", 202401): (5, 1), ("FLU", 202402): (3, 2), ("FLU", 202405): (14, 2),
                   ("POX", 202405): (5, 1), ("FLU", 202406): (1, 1)}
    assert emitted == [0, 2, 2, 5] and held == [2, 2, 3, 1]
    assert sorted(r.event_id for r in sinks.late_rows(spark, late, timed.schema).collect()) == [6, 8]
    assert sinks.late_rows(spark, str(tmp_path / "none"), timed.schema).isEmpty()


def test_repeated_batch_has_the_same_late_rows(topic, spark, tmp_path):
    for data in ([event(1, "FLU", 202410, 5, 1.0)], [event(2, "FLU", 202401, 1, 1.0)], [event(3, "FLU", 202409, 1, 1.0)]):
        topic.publish(data)
    timed = queries.with_week_start(topic.stream())
    for checkpoint in ("a", "b"):
        sinks.finish(sinks.record_late(timed, "week_start", 14 * 86_400, str(tmp_path / "late"), str(tmp_path / checkpoint)))
    late = sinks.late_rows(spark, str(tmp_path / "late"), timed.schema)
    assert [r.event_id for r in late.collect()] == [2]


def test_panes_give_the_rates_of_events(topic, spark, tmp_path):
    for data in (SECOND, FIRST, [event(9, "FLU", 202402, 1, 1.0, 20)]):
        topic.publish(data)
    out = str(tmp_path / "panes")
    panes = queries.pane_counts(topic.stream())
    sinks.finish(sinks.record_changes(panes, out, out + "-cp"))
    stored = sinks.current_state(spark, out, panes.schema, ["pane_start"])
    batch = rows(spark, FIRST + SECOND + [event(9, "FLU", 202402, 1, 1.0, 20)])
    want = sorted(map(tuple, queries.event_rates(batch).collect()))
    assert sorted(map(tuple, queries.rates_of_panes(stored).collect())) == want
    assert sorted(map(tuple, queries.rates_of_panes(queries.pane_counts(batch)).collect())) == want
    plan = queries.rates_of_panes(queries.pane_counts(batch))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and plan.index("Expand") < plan.rindex("Aggregate")  # above the first one


def test_closed_rates_of_chained_aggregations(topic, spark, tmp_path):
    topic.publish(FIRST + SECOND)
    out = str(tmp_path / "out")
    closed = queries.closed_event_rates(topic.stream(max_files=None), lateness="5 seconds")
    sinks.finish(sinks.append_rows(closed, out, out + "-cp"))
    end = max(r[7] for r in FIRST + SECOND) - datetime.timedelta(seconds=5)
    want = {tuple(r) for r in queries.event_rates(rows(spark, FIRST + SECOND)).collect() if r.window_end <= end}
    assert want and {tuple(r) for r in spark.read.schema(closed.schema).parquet(out).collect()} == want
