"""Dashboard models M5 ``high_risk_table`` and M6 ``sentiment_heatmap``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOP_RISK_ROWS = 500  # fixed value: size of the served risk queue

HIGH_RISK_TABLE_COLUMNS = (
    "customer_id", "avg_sentiment_score", "avg_delivery_delay_days",
    "delayed_order_count", "order_count", "ticket_count", "risk_score",
    "risk_band", "event_timestamp",
)


def high_risk_table(high_risk: DataFrame, k: int = TOP_RISK_ROWS) -> DataFrame:
    """M5/O1: top ``k`` by risk, newest refresh first.

    ``orderBy().limit()`` plans as ``TakeOrderedAndProject``: each
    partition keeps its own top ``k`` and only those meet, so the cost is
    bounded by ``k x partitions`` rows, not the input size. The refresh
    time is constant per run, so ``customer_id`` and ``snapshot_date``
    break ties to make the cut deterministic.
    """
    ranked = high_risk.orderBy(
        F.col("risk_score").desc_nulls_last(), F.col("refreshed_at").desc_nulls_last(),
        F.col("customer_id").asc_nulls_last(), F.col("snapshot_date").desc_nulls_last())
    return ranked.limit(k).select(
        *HIGH_RISK_TABLE_COLUMNS[:-1], F.col("refreshed_at").alias("event_timestamp"))


def sentiment_heatmap(stg_tickets: DataFrame, ordered: bool = True) -> DataFrame:
    """M6/A3: region x UTC day x UTC hour -> mean score, tickets.

    Output is bounded by regions x days x 24 whatever the input size, and
    the aggregation is partial map-side, so hot regions cost nothing extra.
    """
    out = (stg_tickets
           .select(F.col("customer_region").alias("region"),
                   F.to_date("created_at").alias("sentiment_date"),
                   F.hour("created_at").cast("int").alias("sentiment_hour"),
                   "sentiment_score")
           .groupBy("region", "sentiment_date", "sentiment_hour")
           .agg(F.avg("sentiment_score").alias("avg_sentiment_score"),
                F.count(F.lit(1)).alias("ticket_count")))
    if ordered:
        out = out.orderBy(F.col("sentiment_date").desc_nulls_last(),
                          F.col("sentiment_hour").desc_nulls_last(),
                          F.col("region").asc_nulls_last())
    return out
