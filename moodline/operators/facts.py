"""Daily aggregates: M3 ``fact_sentiment_daily`` and A2 ``order_daily``.

Both group on ``(customer_id, day)``. Spark aggregates partially before the
shuffle (one row per group per map partition), so a customer holding a
third of all rows still shuffles only its per-partition partials. The two
outputs are hash-partitioned on the same keys the risk join uses, so the
join (J1) adds no exchange of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fact_sentiment_daily(stg_tickets: DataFrame) -> DataFrame:
    """M3: per customer and UTC day: mean score, tickets, negative share.

    ``avg`` skips NULL scores while ``count(*)`` counts their rows, so an
    all-NULL group has a NULL mean and a positive ``ticket_count``.
    """
    agg = (stg_tickets
           .select("customer_id", F.to_date("created_at").alias("sentiment_date"), "sentiment_score")
           .groupBy("customer_id", "sentiment_date")
           .agg(F.avg("sentiment_score").alias("avg_sentiment_score"),
                F.count(F.lit(1)).alias("ticket_count"),
                F.count_if(F.col("sentiment_score") < 0).alias("negative_ticket_count")))
    return agg.select(
        "customer_id", "sentiment_date", "avg_sentiment_score", "ticket_count",
        "negative_ticket_count",
        F.try_divide(F.col("negative_ticket_count").cast("double"),
                     F.col("ticket_count").cast("double")).alias("negative_ticket_ratio"),
    )


def order_daily(stg_orders: DataFrame) -> DataFrame:
    """A2: per customer and purchase day: mean delay (undelivered = 0),
    delayed orders, orders."""
    return (stg_orders
            .select("customer_id", F.to_date("order_purchase_timestamp").alias("order_date"),
                    "delivery_delay_days", "is_delayed_order")
            .groupBy("customer_id", "order_date")
            .agg(F.avg(F.coalesce(F.col("delivery_delay_days"), F.lit(0))).alias("avg_delivery_delay_days"),
                 F.count_if(F.col("is_delayed_order")).alias("delayed_order_count"),
                 F.count(F.lit(1)).alias("order_count")))
