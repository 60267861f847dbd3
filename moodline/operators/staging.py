"""Staging models M1 ``stg_tickets`` and M2 ``stg_orders``.

Cast -> drop rows whose event time does not parse (F1, *before* the
dedupe so a bad newer copy cannot shadow a good older one) -> keep the
latest copy per key (W1/W2 + F2) -> fixed output columns.

Scale: the keep-latest is ``row_number() == 1`` over a window partitioned
by the key. Catalyst plans it as a partial ``WindowGroupLimit`` before the
shuffle and a final one after, so even a key holding a third of all rows
sends at most one row per map partition across the network.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, TimestampType

from moodline.functions.casts import as_type, blank_to
from moodline.sources.schemas import RAW_ORDERS, RAW_TICKETS, conform

STG_TICKETS_COLUMNS = (
    "ticket_id", "customer_id", "created_at", "sentiment_score", "sentiment_label",
    "ticket_status", "channel", "priority", "customer_region", "customer_tier",
)
STG_ORDERS_COLUMNS = (
    "order_id", "customer_id", "order_status", "order_purchase_timestamp",
    "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
    "order_estimated_delivery_date", "price", "freight_value", "order_total_amount",
    "is_delayed_order", "delivery_delay_days",
)


def keep_latest(df: DataFrame, key: str | list[str], order: list[Column]) -> DataFrame:
    """One row per ``key``: the first under ``order`` (ROW_NUMBER() = 1).

    Used by both staging models and by the ingestion dedupe (I3).
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("row_num", F.row_number().over(w)).filter(F.col("row_num") == 1).drop("row_num")


def stg_tickets(raw: DataFrame) -> DataFrame:
    """M1: typed, defaulted, one row per ``ticket_id`` (latest load wins)."""
    raw = conform(raw, RAW_TICKETS)
    types = {f.name: f.dataType for f in raw.schema.fields}
    casted = raw.select(
        F.col("ticket_id").cast("string").alias("ticket_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        as_type(types["created_at"], "created_at", TimestampType()).alias("created_at"),
        as_type(types["sentiment_score"], "sentiment_score", DoubleType()).alias("sentiment_score"),
        blank_to("sentiment_label", "unknown").alias("sentiment_label"),
        blank_to("status", "unknown").alias("ticket_status"),
        blank_to("channel", "unknown").alias("channel"),
        blank_to("priority", "normal").alias("priority"),
        blank_to("customer_region", "unknown").alias("customer_region"),
        blank_to("customer_tier", "unknown").alias("customer_tier"),
        F.col("_load_id"), F.col("_row_id"),
    ).filter(F.col("created_at").isNotNull())
    latest = keep_latest(casted, "ticket_id", [
        F.col("_load_id").desc(), F.col("created_at").desc(), F.col("_row_id").desc()])
    return latest.select(*STG_TICKETS_COLUMNS)


def stg_orders(raw: DataFrame) -> DataFrame:
    """M2: typed orders, one row per ``order_id``, delay indicators."""
    raw = conform(raw, RAW_ORDERS)
    types = {f.name: f.dataType for f in raw.schema.fields}
    ts = TimestampType()
    casted = raw.select(
        F.col("order_id").cast("string").alias("order_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        blank_to("order_status", "unknown").alias("order_status"),
        as_type(types["order_purchase_timestamp"], "order_purchase_timestamp", ts).alias("order_purchase_timestamp"),
        as_type(types["order_approved_at"], "order_approved_at", ts).alias("order_approved_at"),
        as_type(types["order_delivered_carrier_date"], "order_delivered_carrier_date", ts).alias("order_delivered_carrier_date"),
        as_type(types["order_delivered_customer_date"], "order_delivered_customer_date", ts).alias("order_delivered_customer_date"),
        as_type(types["order_estimated_delivery_date"], "order_estimated_delivery_date", ts).alias("order_estimated_delivery_date"),
        as_type(types["price"], "price", DoubleType()).alias("price"),
        as_type(types["freight_value"], "freight_value", DoubleType()).alias("freight_value"),
        as_type(types["is_delayed_order"], "is_delayed_order", BooleanType()).alias("is_delayed_order"),
        F.col("_load_id"), F.col("_row_id"),
    ).filter(F.col("order_purchase_timestamp").isNotNull())
    latest = keep_latest(casted, "order_id", [
        F.col("_load_id").desc(), F.col("order_purchase_timestamp").desc(), F.col("_row_id").desc()])
    delivered = F.col("order_delivered_customer_date")
    estimated = F.col("order_estimated_delivery_date")
    price = F.coalesce(F.col("price"), F.lit(0.0))
    freight = F.coalesce(F.col("freight_value"), F.lit(0.0))
    return latest.select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
        price.alias("price"), freight.alias("freight_value"),
        (price + freight).alias("order_total_amount"),
        F.coalesce(F.col("is_delayed_order"), delivered > estimated).alias("is_delayed_order"),
        F.when(delivered.isNotNull() & estimated.isNotNull(),
               F.datediff(F.to_date(delivered), F.to_date(estimated))).alias("delivery_delay_days"),
    )
