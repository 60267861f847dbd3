"""Incremental aggregates against full refreshes; states, retraction and repeated loads."""

import random

import pytest
from pyspark.sql import functions as F

from moodline.operators import dashboard, facts, incremental, quality, staging
from moodline.plans import incremental as plan
from moodline.sources import derived
from moodline.sources.sinks import TableStore
from tests.conftest import SF_SMALL

RAW = ("ticket_id string, customer_id string, created_at timestamp, sentiment_score double, customer_region string, "
       "_load_id string, _row_id string")


def _rows(rnd, n, load):
    import datetime as dt
    scores = [0.1, -0.3, 1e-12, 1e12, -0.0, None, float("nan"), float("inf"), float("-inf"), 0.7]
    return [(str(rnd.randrange(40)), f"c{rnd.randrange(4)}", dt.datetime(2024, 1, 1 + rnd.randrange(6), rnd.randrange(24)), rnd.choice(scores),
             rnd.choice(["north", "", None]), load, f"{load}-{k}") for k in range(n)]


def _same(a, b):
    """Rows alike, means to nine digits."""
    def told(df):
        return sorted(repr(tuple(f"{v:.9g}" if isinstance(v, float) else v for v in r)) for r in df.select(sorted(df.columns)).collect())
    assert told(a) == told(b)


def test_loads_equal_a_full_refresh(spark, scratch):
    rnd = random.Random(11)
    store = TableStore(spark, f"{scratch}/wh", merge_buckets=4)
    for k in range(4):
        batch = spark.createDataFrame(_rows(rnd, 60 if k == 0 else 12, f"l{k}"), RAW)
        plan.merge_and_refresh_tickets(store, batch, f"{scratch}-{k}".replace("/", "_"))
        stg = staging.stg_tickets(store.read("raw_zone", "raw_tickets"))
        _same(plan.result(store, "_sentiment_state"), facts.fact_sentiment_daily(stg))
        _same(plan.result(store, "_heatmap_state"), dashboard.sentiment_heatmap(stg, ordered=False))


def test_only_touched_days_are_read_and_written(spark, scratch):
    import glob
    import os
    store = TableStore(spark, f"{scratch}/wh", merge_buckets=4)
    raw = derived.raw_tickets_at(spark, SF_SMALL)
    stg = staging.stg_tickets(raw).select("ticket_id", "customer_id", "created_at", "sentiment_score", "customer_region",
                                          F.lit("0").alias("_load_id"), F.col("ticket_id").alias("_row_id"))
    name = os.path.basename(scratch)
    plan.merge_and_refresh_tickets(store, stg, f"{name}-0")

    def files():
        return {f for f in glob.glob(f"{scratch}/wh/core/_sentiment_state/v*/sentiment_date=*/*.parquet")}

    before = files()
    one = stg.where("ticket_id = '1'").withColumn("sentiment_score", F.lit(0.25))
    days = plan.merge_and_refresh_tickets(store, one, f"{name}-1")["_sentiment_state"]
    changed = {os.path.dirname(f) for f in before ^ files()}
    assert len(days) == 1 == len(changed) < len({os.path.dirname(f) for f in before})
    state = store.read("core", "_sentiment_state").where(F.col("sentiment_date").isin(days))
    text = state._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and "PartitionFilters: []" not in text


def test_a_repeated_load_counts_once(spark, scratch):
    import os
    rnd = random.Random(5)
    store = TableStore(spark, f"{scratch}/wh", merge_buckets=4)
    name = os.path.basename(scratch)
    plan.merge_and_refresh_tickets(store, spark.createDataFrame(_rows(rnd, 50, "a"), RAW), f"{name}-a")
    batch = spark.createDataFrame(_rows(rnd, 20, "b"), RAW)
    # The load dies after its merge and one day of one state; it is then run again.
    added, replaced = incremental.merge_changes(store.read("raw_zone", "raw_tickets"), batch, "ticket_id",
                                                [F.col("created_at").desc(), F.col("_row_id").desc()])
    changes = \
        incremental.sentiment_state(staging.stg_tickets(added), staging.stg_tickets(replaced))
    first_day = changes.agg(F.min("sentiment_date")).first()[0]
    assert plan.update_state(store, "_sentiment_state", changes.where(F.col("sentiment_date") == first_day), f"{name}-b") == [first_day]
    days = plan.merge_and_refresh_tickets(store, batch, f"{name}-b")["_sentiment_state"]
    assert first_day not in days
    _same(plan.result(store, "_sentiment_state"), facts.fact_sentiment_daily(staging.stg_tickets(store.read("raw_zone", "raw_tickets"))))


def test_empty_load_and_emptied_group(spark, scratch):
    import datetime as dt
    import os
    store = TableStore(spark, f"{scratch}/wh", merge_buckets=4)
    name = os.path.basename(scratch)
    row = ("1", "c", dt.datetime(2024, 1, 1, 5), 0.1, "r", "0", "x")
    plan.merge_and_refresh_tickets(store, spark.createDataFrame([], RAW), f"{name}-0")
    plan.merge_and_refresh_tickets(store, spark.createDataFrame([row], RAW), f"{name}-1")
    plan.merge_and_refresh_tickets(store, spark.createDataFrame([(*row[:2], dt.datetime(2024, 2, 1), *row[3:])], RAW), f"{name}-2")
    got = plan.result(store, "_sentiment_state").collect()
    assert [(r.sentiment_date, r.ticket_count) for r in got] == [(dt.date(2024, 2, 1), 1)]


def test_bucketed_tables_need_no_exchange(spark, scratch):
    store = TableStore(spark, f"{scratch}/wh")
    raw = derived.raw_tickets_at(spark, SF_SMALL)
    stored = store.overwrite_bucketed(raw, "raw_zone", "raw_tickets", "ticket_id", 4)
    staged = staging.stg_tickets(stored)
    assert "Exchange" not in staged._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, staged.collect())) == sorted(map(tuple, staging.stg_tickets(raw).collect()))
    again = store.overwrite_bucketed(raw.limit(3), "raw_zone", "raw_tickets", "ticket_id", 4)
    assert again.count() == 3 and len(store.versions("raw_zone", "raw_tickets")) == 2


def test_shape_and_drift(spark):
    def records(*texts):
        return spark.createDataFrame([(t,) for t in texts], "j string").select(F.parse_json("j").alias("record"))
    shape = quality.payload_shape(records('{"a":1,"b":{"c":"x","d":null},"l":[1]}', '{"a":2,"b":{"c":"y"},"l":[]}'))
    assert shape == {"a": "BIGINT", "b": "OBJECT", "b.c": "STRING", "b.d": "VOID", "l": "ARRAY", "l[]": "BIGINT"}
    drift = quality.payload_drift(records('{"a":"1","b":{"c":"x","d":5},"e f":true}'), shape).collect()
    assert [tuple(r) for r in drift] == [("a", "retyped", "BIGINT", "STRING"), ("e f", "added", None, "BOOLEAN"),
                                         ("l", "missing", "ARRAY", None), ("l[]", "missing", "BIGINT", None)]
    assert quality.payload_shape(records().where("false")) == {}


def test_failure_templates_and_flag_changes(spark):
    failed = spark.createDataFrame([("p", f"Bad row {k} of 'x{k}': v{k}", d) for k in range(20) for d in ("2024-01-01", "2024-01-02")],
                                   "pipeline_name string, error_message string, failed_at string").withColumn("failed_at", F.to_timestamp("failed_at"))
    sketches = quality.failure_sketches(failed)
    assert sketches.count() == 2
    assert [tuple(r) for r in quality.failure_patterns_of(sketches).collect()] == [("p", "Bad row # of ?", 40)]
    old = spark.createDataFrame([("a", 1, "high"), ("b", 1, "high"), ("c", 1, None)], "customer_id string, snapshot_date int, risk_band string")
    new = spark.createDataFrame([("b", 1, "critical"), ("c", 1, None), ("d", 2, "medium")], old.schema)
    assert sorted((r.customer_id, r.change) for r in quality.flag_changes(old, new).collect()) == [
        ("a", "left"), ("b", "band_changed"), ("d", "entered")]


@pytest.mark.parametrize("keep_days", [30, 0])
def test_newest_ticket_wins_across_epochs(spark, scratch, keep_days):
    """Also when the state has been dropped: the merge holds an old copy against the stored row."""
    import datetime as dt
    import json
    import os

    from moodline.plans import pipelines
    from moodline.streaming.newest import start_newest_tickets
    store = TableStore(spark, f"{scratch}/wh", merge_buckets=4)
    os.makedirs(f"{scratch}/land")

    def land(name, *copies):
        with open(f"{scratch}/land/{name}.json", "w") as fh:
            json.dump([{"ticket_id": i, "customer_id": "c", "created_at": t, "sentiment_score": s} for i, t, s in copies], fh)
        start_newest_tickets(spark, store, f"{scratch}/land", checkpoint_location=f"{scratch}/ck",
                             keep=dt.timedelta(days=keep_days)).awaitTermination()
        return {r.ticket_id: r.sentiment_score for r in store.read("raw_zone", "raw_tickets").collect()}

    assert land("a", (1, "2026-03-02", 0.1), (1, "2026-03-01", 0.2), (2, "2026-03-01", 0.3), (3, "no time", 0.3)) == {"1": 0.1, "2": 0.3}
    assert land("b", (1, "2026-03-01T12:00:00", 0.4), (2, "2026-03-05", 0.5)) == {"1": 0.1, "2": 0.5}
    assert land("c", (4, "2026-01-01", 0.6), (2, "2026-03-04", 0.7), (3, "no time", 0.3)) == {"1": 0.1, "2": 0.5, "4": 0.6}
    assert [r.error_message for r in pipelines.read_failed(store).collect()] == ["Unsupported timestamp format: no time"]
