"""Declared schemas of the raw zone and the typed layers.

Raw tables keep source text as text; staging applies guarded casts. A raw
scan conforms whatever columns exist to these schemas: a missing column is
added as a typed NULL, so models always see a fixed input shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

S = StringType()

RAW_TICKETS = StructType([
    StructField("ticket_id", S), StructField("customer_id", S),
    StructField("created_at", S), StructField("sentiment_score", S),
    StructField("sentiment_label", S), StructField("status", S),
    StructField("channel", S), StructField("priority", S),
    StructField("customer_region", S), StructField("customer_tier", S),
    StructField("_load_id", S), StructField("_row_id", S),
])

# Orders CSV columns, all text as landed (plus computed is_delayed_order).
ORDER_CSV_COLUMNS = (
    "order_id", "customer_id", "order_status", "order_purchase_timestamp",
    "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
    "price", "freight_value",
)
ORDERS_CSV = StructType([StructField(c, S) for c in ORDER_CSV_COLUMNS])

RAW_ORDERS = StructType(
    [StructField(c, S) for c in ORDER_CSV_COLUMNS[:-2]]
    + [StructField("price", DoubleType()), StructField("freight_value", DoubleType()),
       StructField("is_delayed_order", BooleanType()),
       StructField("_load_id", S), StructField("_row_id", S)]
)

FAILED_RECORDS = StructType([
    StructField("record_hash", S), StructField("pipeline_name", S),
    StructField("source_name", S), StructField("raw_record", S),
    StructField("error_message", S), StructField("failed_at", TimestampType()),
])

AUDIT_EVENTS = StructType([
    StructField("timestamp", TimestampType()), StructField("pipeline_name", S),
    StructField("run_id", S), StructField("event_type", S), StructField("status", S),
    StructField("control_set", S), StructField("compliance_tags", ArrayType(S)),
    StructField("details", S),
])


def conform(df: DataFrame, schema: StructType, keep_extra: bool = False) -> DataFrame:
    """Project ``df`` onto ``schema``: absent columns become typed NULLs.

    Present columns keep their own type (staging casts them); extra
    columns are dropped unless ``keep_extra``.
    """
    have = set(df.columns)
    cols = [F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields]
    if keep_extra:
        wanted = {f.name for f in schema.fields}
        cols += [F.col(c) for c in df.columns if c not in wanted]
    return df.select(*cols)
