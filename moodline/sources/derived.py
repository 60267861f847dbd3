"""Raw-zone views derived from the driver's tables.

The driver's data carries no tickets or delivery dates, so the raw zone is
derived with fixed formulas: tickets from ``events`` and orders from
``orders`` plus a per-order ``lineitem`` aggregate. Both land in 2024-01 on
shared customer ids, with deliberate bad rows (unparseable timestamps,
blank scores) and duplicate copies per key. Every row of the input tables
is used; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Fixed values of the derivation (see FIXTURES.md section 2).
TICKET_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
ORDER_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
ORDER_BASE = "2024-01-01 00:00:00"
PRIORITY_BY_MOD3 = ("", "high", "urgent")
BAD_TICKET_TS_MOD = 97
BLANK_SCORE_MOD = 89
BAD_ORDER_TS_MOD = 101


# Declared input schemas (the columns the derivations use): no footer
# sampling to infer types, and a type change upstream fails loudly.
INPUT_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string",
    "lineitem": "l_orderkey bigint, l_extendedprice double, l_tax double",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table; Catalyst prunes columns and pushes filters."""
    reader = spark.read
    if name in INPUT_SCHEMAS:
        reader = reader.schema(INPUT_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_tickets(events: DataFrame) -> DataFrame:
    """``raw_zone.raw_tickets`` as landed text, two copies per ticket id."""
    eid = F.col("event_id")
    ts_text = F.date_format(F.col("ts").cast("timestamp"), TICKET_TS_FORMAT)
    k = ((eid * 37) % 103) - 64
    score_text = (k.cast("double") / F.lit(64.0)).cast("string")
    prio = eid % 3
    return events.select(
        F.expr("event_id div 2").cast("string").alias("ticket_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.when(eid % BAD_TICKET_TS_MOD == 0, F.lit("invalid-ts")).otherwise(ts_text).alias("created_at"),
        F.when(eid % BLANK_SCORE_MOD == 0, F.lit("")).otherwise(score_text).alias("sentiment_score"),
        F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.col("event_type")).alias("sentiment_label"),
        F.when(eid % 5 == 0, F.lit(None).cast("string")).otherwise(F.lit("open")).alias("status"),
        F.col("event_type").alias("channel"),
        F.when(prio == 0, F.lit(PRIORITY_BY_MOD3[0]))
         .when(prio == 1, F.lit(PRIORITY_BY_MOD3[1]))
         .otherwise(F.lit(PRIORITY_BY_MOD3[2])).alias("priority"),
        F.concat(F.lit("R"), (F.col("user_id") % 5).cast("string")).alias("customer_region"),
        F.when(F.col("user_id") % 4 == 0, F.lit("gold")).alias("customer_tier"),
        F.lpad(F.expr("(event_id div 3) % 4").cast("string"), 4, "0").alias("_load_id"),
        F.lpad(eid.cast("string"), 10, "0").alias("_row_id"),
    )


def _order_ts(day_expr: str, hour_expr: str) -> F.Column:
    ts = F.expr(f"timestamp'{ORDER_BASE}' + make_dt_interval({day_expr}, {hour_expr}, 0, 0)")
    return F.date_format(ts, ORDER_TS_FORMAT)


def raw_orders(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """``raw_zone.raw_orders``: text timestamps, typed price / freight.

    ``lineitem`` is reduced per order before the join (partial aggregation
    map-side), so the join moves one row per order, not per line.
    """
    per_order = lineitem.groupBy("l_orderkey").agg(
        F.min("l_extendedprice").alias("_p"), F.max("l_tax").alias("_f"))
    joined = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
    k = F.col("o_orderkey")
    return joined.select(
        F.expr("o_orderkey div 2").cast("string").alias("order_id"),
        F.expr("o_custkey div 10").cast("string").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.when(k % BAD_ORDER_TS_MOD == 0, F.lit("invalid-ts"))
         .otherwise(_order_ts("cast((o_orderkey * 7) % 30 as int)", "cast(o_orderkey % 24 as int)"))
         .alias("order_purchase_timestamp"),
        F.lit(None).cast("string").alias("order_approved_at"),
        F.lit(None).cast("string").alias("order_delivered_carrier_date"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
         .otherwise(_order_ts("cast((o_orderkey * 7) % 30 + o_orderkey % 13 as int)",
                              "cast(o_orderkey % 24 as int)"))
         .alias("order_delivered_customer_date"),
        F.date_format(F.expr(f"timestamp'{ORDER_BASE}' + make_dt_interval("
                             "cast((o_orderkey * 7) % 30 + 4 as int), 12, 0, 0)"),
                      ORDER_TS_FORMAT).alias("order_estimated_delivery_date"),
        F.col("_p").alias("price"),
        F.col("_f").alias("freight_value"),
        F.lit(None).cast("boolean").alias("is_delayed_order"),
        F.lpad(F.expr("(o_orderkey div 3) % 3").cast("string"), 4, "0").alias("_load_id"),
        F.lpad(k.cast("string"), 10, "0").alias("_row_id"),
    )


def raw_tickets_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_tickets(read_table(spark, sf_dir, "events"))


def raw_orders_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_orders(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem"))


# ------------------------------------------------------------------
# Landed forms: ticket payload pages and orders CSV rows.

# Fixed values of the landed derivation.
PAGE_SIZE = 50                      # records per payload page (one API page)
BARE_ITEM_MOD = 13                  # these events land as a bare string item
NO_CUSTOMER_OBJECT_MOD = 7          # region given top-level, no customer object
MALFORMED_SCORE_MOD = 83            # score text 'n/a'
MALFORMED_PRICE_MOD = 211           # price text 'n/a'
PAYLOAD_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def ticket_items(events: DataFrame) -> DataFrame:
    """One payload item per event: ``(event_id, page, item)`` JSON text.

    Most items are ticket objects with nested ``customer`` / ``metadata``;
    every key is present (NULLs as JSON null). Some land as bare strings.
    """
    eid, uid = F.col("event_id"), F.col("user_id")
    k = ((eid * 37) % 103) - 64
    prio = eid % 3
    region = F.concat(F.lit("R"), (uid % 5).cast("string"))
    no_obj = eid % NO_CUSTOMER_OBJECT_MOD == 0
    record = F.struct(
        F.when(eid % BAD_TICKET_TS_MOD == 0, F.lit("invalid-ts"))
         .otherwise(F.date_format(F.col("ts").cast("timestamp"), PAYLOAD_TS_FORMAT)).alias("created_at"),
        F.when(no_obj, F.lit(None)).otherwise(F.struct(
            region.alias("region"),
            F.when(uid % 4 == 0, F.lit("gold")).alias("tier"))).alias("customer"),
        uid.cast("string").alias("customer_id"),
        F.when(no_obj, region).alias("customer_region"),
        F.struct(F.col("event_type").alias("channel"),
                 F.when(prio == 0, F.lit(PRIORITY_BY_MOD3[0]))
                  .when(prio == 1, F.lit(PRIORITY_BY_MOD3[1]))
                  .otherwise(F.lit(PRIORITY_BY_MOD3[2])).alias("priority")).alias("metadata"),
        F.col("event_type").alias("sentiment_label"),
        F.when(eid % BLANK_SCORE_MOD == 0, F.lit(""))
         .when(eid % MALFORMED_SCORE_MOD == 0, F.lit("n/a"))
         .otherwise((k.cast("double") / F.lit(64.0)).cast("string")).alias("sentiment_score"),
        F.when(eid % 5 == 0, F.lit(None).cast("string")).otherwise(F.lit("open")).alias("status"),
        F.expr("event_id div 2").alias("ticket_id"),
    )
    item = (F.when(eid % BARE_ITEM_MOD == 0, F.concat(F.lit('"e'), eid.cast("string"), F.lit('"')))
            .otherwise(F.to_json(record, {"ignoreNullFields": "false"})))
    return events.select(eid.alias("event_id"), F.expr(f"event_id div {PAGE_SIZE}").alias("page"),
                         item.alias("item"))


def ticket_payloads(events: DataFrame) -> DataFrame:
    """Landed payload documents, one row per page: ``value``, ``_source``.

    Pages rotate through the accepted envelope shapes: a root list,
    ``data`` (beside an empty ``tickets``), ``tickets`` (beside a non-list
    ``data``), ``results`` and ``items`` with paging keys. A page holds at
    most ``PAGE_SIZE`` items by construction, so gathering one is bounded.
    """
    items = ticket_items(events)
    pages = items.groupBy("page").agg(
        F.sort_array(F.collect_list(F.struct("event_id", "item"))).alias("its"))
    body = F.concat(F.lit("["), F.array_join(F.transform("its", lambda x: x["item"]), ","), F.lit("]"))
    shape = F.col("page") % 5
    nxt = (F.col("page") + 1).cast("string")
    value = (F.when(shape == 0, body)
             .when(shape == 1, F.concat(F.lit('{"data":'), body, F.lit(',"tickets":[]}')))
             .when(shape == 2, F.concat(F.lit('{"data":"n/a","tickets":'), body, F.lit("}")))
             .when(shape == 3, F.concat(F.lit('{"next_page_token":"p'), nxt, F.lit('","results":'), body, F.lit("}")))
             .otherwise(F.concat(F.lit('{"has_more":false,"items":'), body, F.lit("}"))))
    return pages.select(value.alias("value"),
                        F.concat(F.lit("page-"), F.col("page").cast("string")).alias("_source"))


def landed_order_rows(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Orders as landed CSV text (every column text, money with 2 decimals),
    plus ``_ordinal`` = file order. Some prices land as 'n/a'."""
    raw = raw_orders(orders, lineitem)
    key = F.col("_row_id").cast("long")
    money = {c: F.col(c).cast("decimal(12,2)").cast("string") for c in ("price", "freight_value")}
    price = F.when(key % MALFORMED_PRICE_MOD == 0, F.lit("n/a")).otherwise(money["price"])
    return raw.select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
        "order_estimated_delivery_date", price.alias("price"),
        money["freight_value"].alias("freight_value"), key.alias("_ordinal"))
