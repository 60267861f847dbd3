"""A key holding a third of all rows: correct result, pre-shuffle reduction."""

import contextlib
import io

from pyspark.sql import functions as F

from moodline.operators import facts, staging
from moodline.sources import derived
from tests.conftest import SF_SMALL


def _skewed_raw(spark):
    raw = derived.raw_tickets_at(spark, SF_SMALL)
    hot = F.col("_row_id").cast("long") % 3 == 0
    return raw.withColumn("ticket_id", F.when(hot, F.lit("hot")).otherwise(F.col("ticket_id"))) \
              .withColumn("customer_id", F.when(hot, F.lit("hot-customer")).otherwise(F.col("customer_id")))


def test_hot_key_dedupe_matches_brute_force(spark):
    raw = _skewed_raw(spark)
    out = staging.stg_tickets(raw).filter(F.col("ticket_id") == "hot").collect()
    assert len(out) == 1
    # Brute force: latest by (_load_id, created_at, _row_id) among parseable rows.
    rows = [r for r in raw.filter(F.col("ticket_id") == "hot").collect() if r.created_at != "invalid-ts"]
    best = max(rows, key=lambda r: (r._load_id, r.created_at, r._row_id))
    assert out[0].created_at.strftime("%Y-%m-%d %H:%M:%S.%f") == best.created_at


def test_dedupe_limits_before_the_shuffle(spark):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        staging.stg_tickets(_skewed_raw(spark)).explain()
    plan = buf.getvalue()
    assert "Partial" in plan and "Final" in plan
    # Plans print top-down: the partial limit (last WindowGroupLimit) sits below the exchange.
    assert plan.rindex("Exchange") < plan.rindex("WindowGroupLimit")


def test_hot_customer_aggregates_partially(spark):
    fact = facts.fact_sentiment_daily(staging.stg_tickets(_skewed_raw(spark)))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        fact.explain()
    assert "partial_avg" in buf.getvalue() and "partial_count" in buf.getvalue()
    hot = fact.filter(F.col("customer_id") == "hot-customer").agg(F.sum("ticket_count")).first()[0]
    assert hot == 1  # all hot copies collapse to one ticket
