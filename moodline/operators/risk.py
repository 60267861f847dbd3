"""Risk scoring: J1 ``risk_joined`` and M4 ``high_risk_customers``.

Same-day LEFT join of daily sentiment with daily orders on
``(customer_id, day)``. Both inputs are aggregates unique on the key, so
the join cannot fan out. The gate (F3) rejects NULLs on the order side,
so Catalyst turns the outer join into an inner one; the ungated view
keeps the outer join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.functions.casts import least_strict

# Fixed values of the scoring rule.
SENTIMENT_WEIGHT = 0.7
DELAY_WEIGHT = 0.3
DELAY_CAP_DAYS = 10
DELAY_SCALE = 10.0
GATE_MAX_SENTIMENT = -0.20
GATE_MIN_DELAY_DAYS = 2
BAND_CRITICAL = 0.65
BAND_HIGH = 0.45
BANDS = ("critical", "high", "medium")


def as_of_column(as_of: dt.datetime | str | None) -> Column:
    """Refresh time: one value per query (``current_timestamp()`` if None)."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(str(as_of)).cast("timestamp")


def risk_score(sentiment: Column, delay: Column) -> Column:
    """``|min(s, 0)| * 0.7 + min(delay, 10) / 10 * 0.3``; NULL-strict LEAST."""
    return (F.abs(least_strict(sentiment, 0.0)) * F.lit(SENTIMENT_WEIGHT)
            + least_strict(delay, float(DELAY_CAP_DAYS)) / F.lit(DELAY_SCALE) * F.lit(DELAY_WEIGHT))


def risk_band(score: Column) -> Column:
    return (F.when(score >= BAND_CRITICAL, F.lit(BANDS[0]))
            .when(score >= BAND_HIGH, F.lit(BANDS[1]))
            .otherwise(F.lit(BANDS[2])))


def risk_joined(fact: DataFrame, orders_daily: DataFrame) -> DataFrame:
    """Every sentiment day with its same-day order figures (0 if none)."""
    s = fact.select("customer_id", "sentiment_date", "avg_sentiment_score", "ticket_count")
    o = orders_daily.withColumnRenamed("customer_id", "o_customer_id")
    j = s.join(o, (s.customer_id == o.o_customer_id) & (s.sentiment_date == o.order_date), "left")
    delay = F.coalesce(F.col("avg_delivery_delay_days"), F.lit(0.0))
    return j.select(
        "customer_id", "sentiment_date", "avg_sentiment_score", "ticket_count",
        delay.alias("avg_delivery_delay_days"),
        F.coalesce(F.col("delayed_order_count"), F.lit(0)).alias("delayed_order_count"),
        F.coalesce(F.col("order_count"), F.lit(0)).alias("order_count"),
        risk_score(F.col("avg_sentiment_score"), delay).alias("risk_score"),
    )


def high_risk_customers(fact: DataFrame, orders_daily: DataFrame,
                        as_of: dt.datetime | str | None = None) -> DataFrame:
    """M4: gated (score <= -0.20 and delay >= 2 days, both inclusive), banded."""
    j = risk_joined(fact, orders_daily)
    gated = j.filter((F.col("avg_sentiment_score") <= GATE_MAX_SENTIMENT)
                     & (F.col("avg_delivery_delay_days") >= GATE_MIN_DELAY_DAYS))
    return gated.select(
        "customer_id", F.col("sentiment_date").alias("snapshot_date"),
        "avg_sentiment_score", "avg_delivery_delay_days", "delayed_order_count",
        "order_count", "ticket_count", "risk_score",
        risk_band(F.col("risk_score")).alias("risk_band"),
        as_of_column(as_of).alias("refreshed_at"),
    )
