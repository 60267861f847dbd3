"""Incremental maintenance of the daily aggregates (A1, A2, A3; M3, M6).

A merge (S6) replaces some rows and adds others. Instead of aggregating the
whole staged table again, the aggregates are kept as mergeable states per
group (sums and counts), and a load adds the states of its new rows and
retracts those of the rows they replace. Only groups that the changes touch
change, and only their days' partitions are read and rewritten.

Retraction is exact: finite scores are summed as decimals (18 places,
magnitudes below 10^19), NaN and the infinities are counted, so a row that is
added and retracted leaves nothing behind, as it would in floating point.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.operators.staging import keep_latest

EXACT = "decimal(38,18)"
SENTIMENT_KEYS = ("customer_id", "sentiment_date")
HEATMAP_KEYS = ("region", "sentiment_date", "sentiment_hour")
ORDER_KEYS = ("customer_id", "order_date")
SCORE_STATE = ("rows", "scores", "score_sum", "nan_scores", "high_scores", "low_scores", "negative_rows")
ORDER_STATE = ("rows", "delay_days", "delayed_rows")


def merge_changes(target: DataFrame | None, batch: DataFrame, key: str | Sequence[str],
                  order: Sequence[Column]) -> tuple[DataFrame, DataFrame | None]:
    """(rows that a merge of ``batch`` adds, rows of ``target`` that they replace)."""
    keys = [key] if isinstance(key, str) else list(key)
    added = keep_latest(batch, keys, list(order))
    return added, None if target is None else target.join(batch.select(*keys), keys, "left_semi")


def _signed(added: DataFrame, replaced: DataFrame | None) -> DataFrame:
    plus = added.withColumn("_sign", F.lit(1))
    return plus if replaced is None else plus.unionByName(replaced.withColumn("_sign", F.lit(-1)))


def _score_state(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    score, sign = F.col("sentiment_score"), F.col("_sign").cast("long")
    infinite = F.lit(float("inf"))
    finite = score.isNotNull() & ~F.isnan(score) & (F.abs(score) != infinite)

    def tally(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, sign)), F.lit(0))

    exact = F.sum(F.when(finite, score.cast(EXACT) * F.col("_sign").cast("decimal(1,0)"))).cast(EXACT)
    return rows.groupBy(*keys).agg(
        F.sum(sign).alias("rows"), tally(finite).alias("scores"), F.coalesce(exact, F.lit(0).cast(EXACT)).alias("score_sum"),
        tally(F.isnan(score)).alias("nan_scores"), tally(score == infinite).alias("high_scores"),
        tally(score == -infinite).alias("low_scores"), tally(score < 0).alias("negative_rows"))


def sentiment_state(added: DataFrame, replaced: DataFrame | None = None) -> DataFrame:
    """A1: state per customer and day of staged tickets that come and go."""
    rows = _signed(added, replaced).select("customer_id", F.to_date("created_at").alias("sentiment_date"), "sentiment_score", "_sign")
    return _score_state(rows, SENTIMENT_KEYS)


def heatmap_state(added: DataFrame, replaced: DataFrame | None = None) -> DataFrame:
    """A3: state per region, day and hour of staged tickets that come and go."""
    rows = _signed(added, replaced).select(
        F.col("customer_region").alias("region"), F.to_date("created_at").alias("sentiment_date"),
        F.hour("created_at").cast("int").alias("sentiment_hour"), "sentiment_score", "_sign")
    return _score_state(rows, HEATMAP_KEYS)


def order_state(added: DataFrame, replaced: DataFrame | None = None) -> DataFrame:
    """A2: state per customer and purchase day of staged orders that come and go."""
    sign = F.col("_sign").cast("long")
    rows = _signed(added, replaced).select("customer_id", F.to_date("order_purchase_timestamp").alias("order_date"),
                                           "delivery_delay_days", "is_delayed_order", "_sign")
    return rows.groupBy(*ORDER_KEYS).agg(
        F.sum(sign).alias("rows"), F.sum(F.coalesce("delivery_delay_days", F.lit(0)) * sign).alias("delay_days"),
        F.coalesce(F.sum(F.when(F.col("is_delayed_order"), sign)), F.lit(0)).alias("delayed_rows"))


def combined(states: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States with changes added; a group without rows stays, so that its partition is written."""
    sums = [F.sum(c).cast(states.schema[c].dataType).alias(c) for c in states.columns if c not in keys]
    return states.unionByName(changes).groupBy(*keys).agg(*sums)


def _mean(total: Column, count: Column) -> Column:
    return F.try_divide(total.cast("double"), count.cast("double"))


def _average_score() -> Column:
    high, low = F.col("high_scores") > 0, F.col("low_scores") > 0
    return (F.when((F.col("nan_scores") > 0) | (high & low), F.lit(float("nan"))).when(high, F.lit(float("inf")))
            .when(low, F.lit(float("-inf"))).otherwise(_mean(F.col("score_sum"), F.col("scores"))).alias("avg_sentiment_score"))


def fact_of(states: DataFrame) -> DataFrame:
    """M3 of its states."""
    return states.where("rows > 0").select(
        *SENTIMENT_KEYS, _average_score(), F.col("rows").alias("ticket_count"), F.col("negative_rows").alias("negative_ticket_count"),
        _mean(F.col("negative_rows"), F.col("rows")).alias("negative_ticket_ratio"))


def heatmap_of(states: DataFrame) -> DataFrame:
    """M6 of its states (without an order)."""
    return states.where("rows > 0").select(*HEATMAP_KEYS, _average_score(), F.col("rows").alias("ticket_count"))


def order_daily_of(states: DataFrame) -> DataFrame:
    """A2 of its states."""
    return states.where("rows > 0").select(
        *ORDER_KEYS, _mean(F.col("delay_days"), F.col("rows")).alias("avg_delivery_delay_days"),
        F.col("delayed_rows").alias("delayed_order_count"), F.col("rows").alias("order_count"))
