"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables at ``sf_dir`` (or data Spark derives
from them) and runs over whole tables. Results are lazy DataFrames; the
caller decides the action.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodline.functions.casts import safe_timestamp
from moodline.functions.records import canonical_text
from moodline.operators import dashboard, facts, ingest, merge, quality, risk, staging
from moodline.plans import dag
from moodline.plans import incremental as incremental_plan
from moodline.plans import pipelines
from moodline.session import checkpoint_dir, configure
from moodline.sources import derived, landed, pages, sinks
from moodline.sources.sinks import TableStore
from moodline.streaming.newest import ProgressAudit, start_newest_tickets, stream_progress
from moodline.streaming.tickets import start_heatmap, start_ticket_merge

# Fixed refresh time injected into M4/M5 so results are reproducible
# (production passes None -> current_timestamp()).
AS_OF = "2024-02-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return run
    return deco


# ---------------------------------------------------------------- models

def _stg_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_tickets(derived.raw_tickets_at(spark, sf_dir))


def _stg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_orders(derived.raw_orders_at(spark, sf_dir))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_sentiment_daily(_stg_tickets(spark, sf_dir))


def _order_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.order_daily(_stg_orders(spark, sf_dir))


def _high_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk.high_risk_customers(_fact(spark, sf_dir), _order_daily(spark, sf_dir), as_of=AS_OF)


@query("stg_tickets")
def q_stg_tickets(spark, sf_dir):
    """M1: staged tickets, latest copy per ticket."""
    return _stg_tickets(spark, sf_dir)


@query("stg_orders")
def q_stg_orders(spark, sf_dir):
    """M2: staged orders with delay indicators."""
    return _stg_orders(spark, sf_dir)


@query("fact_sentiment_daily")
def q_fact(spark, sf_dir):
    """M3: daily sentiment per customer."""
    return _fact(spark, sf_dir)


@query("order_daily")
def q_order_daily(spark, sf_dir):
    """A2: daily order delay per customer."""
    return _order_daily(spark, sf_dir)


@query("risk_joined")
def q_risk_joined(spark, sf_dir):
    """Same-day sentiment x orders, ungated."""
    return risk.risk_joined(_fact(spark, sf_dir), _order_daily(spark, sf_dir))


@query("high_risk_customers")
def q_high_risk(spark, sf_dir):
    """M4 (flagship): gated, scored, banded customers."""
    return _high_risk(spark, sf_dir)


@query("high_risk_table")
def q_high_risk_table(spark, sf_dir):
    """M5: top-500 risk queue."""
    return dashboard.high_risk_table(_high_risk(spark, sf_dir))


@query("high_risk_top100")
def q_high_risk_top100(spark, sf_dir):
    """O1 with a cut that bites at sf0.01."""
    return dashboard.high_risk_table(_high_risk(spark, sf_dir), k=100)


@query("sentiment_heatmap")
def q_heatmap(spark, sf_dir):
    """M6: region x day x hour heatmap."""
    return dashboard.sentiment_heatmap(_stg_tickets(spark, sf_dir))


# ------------------------------------------------------------- ingestion

# Fixed parameters of the registered ingestion runs.
TICKET_LOAD_ID = "20240201T000000"
ORDER_LOAD_ID = "20240201T000000"
TICKET_CURSOR = "2024-01-15T00:00:00Z"        # I1, boundary kept
ORDER_CURSOR = "2024-01-15T00:00:00+00:00"    # I2, strictly newer
FIRST_LOAD_BEFORE = "2024-01-20 00:00:00"      # merge target: earlier load
SECOND_LOAD_FROM = "2024-01-10 00:00:00"       # merge batch: overlapping re-delivery
PAGE_CURSOR = "2024-01-15 00:00:00"          # the same instant, as a condition
RERUN_AT = "2024-02-02 00:00:00"
TICKET_PIPELINE, TICKET_SOURCE = "tickets_pipeline", "ticket_api"
ORDER_PIPELINE, ORDER_SOURCE = "orders_pipeline", "orders_csv"

TICKET_OUT = ingest.TICKET_COLUMNS + ("_load_id", "_row_id")
ORDER_OUT = ("order_id", "customer_id", "order_status", "order_purchase_timestamp",
             "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
             "order_estimated_delivery_date", "price", "freight_value", "is_delayed_order",
             "_load_id", "_row_id")


def _ticket_records(spark, sf_dir):
    payloads = derived.ticket_payloads(derived.read_table(spark, sf_dir, "events"))
    records, _bad = landed.unwrap_envelope(payloads)
    return records


def _normalized_tickets(spark, sf_dir):
    return ingest.normalize_tickets(_ticket_records(spark, sf_dir), load_id=TICKET_LOAD_ID)


def _good_tickets(spark, sf_dir):
    return ingest.good_rows(_normalized_tickets(spark, sf_dir))


def _landed_orders(spark, sf_dir):
    return derived.landed_order_rows(derived.read_table(spark, sf_dir, "orders"),
                                     derived.read_table(spark, sf_dir, "lineitem"))


def _normalized_orders(spark, sf_dir):
    return ingest.normalize_orders(_landed_orders(spark, sf_dir), load_id=ORDER_LOAD_ID)


def _good_orders(spark, sf_dir):
    return ingest.good_rows(_normalized_orders(spark, sf_dir))


def _scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _staged(spark, rows: DataFrame) -> DataFrame:
    """Rows written once, for a merge that reads them more than once: else each read parses all records again."""
    path = _scratch(spark, "merge_input/rows")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _ts(text):
    return F.lit(text).cast("timestamp")


def _ticket_order():
    return [F.col("created_at").desc(), F.col("_row_id").desc()]


def _order_order():
    return [F.col("order_purchase_timestamp").desc(), F.col("_ordinal").asc()]


@query("unwrap_envelope")
def q_unwrap(spark, sf_dir):
    """S3 + F5: payload pages -> object records, canonical text, position."""
    recs = _ticket_records(spark, sf_dir)
    return recs.select("_source", F.col("_ordinal.p").alias("_pos"),
                       canonical_text(F.col("record")).alias("record_text"))


PAGE_NAME = r"page=([^/]+)\.json$"


@query("whole_file_payloads")
def q_whole_files(spark, sf_dir):
    """S1 in its default form: each payload page is a file of its own, read whole."""
    records, _ = landed.unwrap_envelope(landed.read_ticket_payloads(spark, f"{_land_pages(spark, sf_dir)}/*"))
    return records.select(F.regexp_extract("_source", PAGE_NAME, 1).alias("page"), F.col("_ordinal.p").alias("_pos"),
                          canonical_text(F.col("record")).alias("record_text"))


def _land_pages(spark, sf_dir) -> str:
    path = _scratch(spark, "landing/pages")
    payloads = derived.ticket_payloads(derived.read_table(spark, sf_dir, "events"))
    pages.land(payloads.select("value", F.coalesce("_source", F.lit("__HIVE_DEFAULT_PARTITION__")).alias("page")), path)
    return path


@query("page_source_after_cursor")
def q_page_source(spark, sf_dir):
    """S1 + S3 + I1 as a data source: the cursor is a condition pushed into it."""
    pages.register(spark)
    rows = spark.read.format(pages.FORMAT).load(_land_pages(spark, sf_dir)).where(F.col("created_at") >= _ts(PAGE_CURSOR))
    return rows.select(F.regexp_extract("_source", PAGE_NAME, 1).alias("page"), "_pos", "created_at",
                       canonical_text(F.try_parse_json("record")).alias("record_text"))


@query("page_source_ingestion")
def q_page_ingestion(spark, sf_dir):
    """S1 + I1 + A6: a run over whole-file pages through the data source; its audit event counts what the cursor skipped."""
    root = _scratch(spark, "warehouse")
    pipelines.run_ticket_ingestion(spark, TableStore(spark, root, merge_buckets=8), f"{_land_pages(spark, sf_dir)}/*",
                                   audit_path=f"{root}/audit", run_id="pages-1", load_id="load-1", page_source=True,
                                   initial_cursor=TICKET_CURSOR)
    done = spark.read.json(f"{root}/audit").where("event_type = 'pipeline_completed'")
    return done.select("status", *(F.col(f"details.records_{c}").cast("long").alias(c) for c in ("processed", "failed", "skipped")))


@query("normalized_tickets")
def q_normalized_tickets(spark, sf_dir):
    """V1 + V3 + P4: every record, typed, with its first error (or NULL)."""
    return _normalized_tickets(spark, sf_dir).select(*TICKET_OUT, "error_message")


@query("flatten_ticket")
def q_flatten(spark, sf_dir):
    """Nested customer / metadata flattened onto accepted tickets."""
    return _good_tickets(spark, sf_dir).select(
        "ticket_id", "customer_id", "customer_region", "customer_tier", "channel", "priority")


@query("failed_tickets")
def q_failed_tickets(spark, sf_dir):
    """V5 + V6: rejected ticket records as dead letters."""
    return ingest.failed_records(_normalized_tickets(spark, sf_dir), TICKET_PIPELINE,
                                 TICKET_SOURCE, failed_at=_ts(AS_OF))


@query("timestamp_forms")
def q_timestamp_forms(spark, sf_dir):
    """Each event's time written in one of twelve forms (two of them not accepted), and parsed."""
    events = derived.read_table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("t"))
    clock, day = F.date_format("t", "HH:mm:ss"), F.date_format("t", "yyyy-MM-dd")
    week = F.concat(F.expr("extract(YEAROFWEEK FROM t)").cast("string"), F.lit("-W"), F.lpad(F.expr("extract(WEEK FROM t)").cast("string"), 2, "0"),
                    F.lit("-"), F.expr("extract(DAYOFWEEK_ISO FROM t)").cast("string"))
    compact = F.date_format("t", "yyyyMMdd'T'HHmmss")
    forms = [F.concat(day, F.lit("T"), clock, F.lit("Z")), F.concat(week, F.lit("T"), clock), F.concat(day, F.lit(" "), clock, F.lit(" +00:00")),
             compact, F.concat(day, F.lit("T"), F.date_format("t", "HHmm")), F.concat(day, F.lit("T"), clock, F.lit(",5")),
             F.concat(compact, F.lit("Z")), F.concat(day, F.lit("X"), clock), F.concat(day, F.lit("T"), clock, F.lit("+05:30:15")),
             F.concat(F.lit("\t"), day, F.lit("T"), F.date_format("t", "HH"), F.lit(" ")), F.concat(day, F.lit("T"), clock, F.lit("+24:00")),
             F.concat(day, F.lit("T"), clock, F.lit("z"))]
    k = F.col("event_id") % len(forms)
    text = F.coalesce(*[F.when(k == i, form) for i, form in enumerate(forms)])
    return events.select("event_id", text.alias("text")).select("event_id", "text", safe_timestamp("text").alias("instant"))


@query("tickets_after_cursor")
def q_tickets_after_cursor(spark, sf_dir):
    """Accepted tickets at or after the cursor."""
    good = _good_tickets(spark, sf_dir)
    return ingest.after_cursor(good, "created_at", TICKET_CURSOR, inclusive=True).select(*TICKET_OUT)


@query("merge_tickets")
def q_merge_tickets(spark, sf_dir):
    """A re-delivery batch merged into an earlier load by ticket_id."""
    good = _staged(spark, _good_tickets(spark, sf_dir).select(*TICKET_OUT))
    target = staging.keep_latest(good.filter(F.col("created_at") < _ts(FIRST_LOAD_BEFORE)),
                                 "ticket_id", _ticket_order())
    batch = good.filter(F.col("created_at") >= _ts(SECOND_LOAD_FROM))
    return merge.merge_by_key(target, batch, "ticket_id", _ticket_order())


@query("normalized_orders")
def q_normalized_orders(spark, sf_dir):
    """V2 + V4: every CSV row, typed, with its first error (or NULL)."""
    return _normalized_orders(spark, sf_dir).select(*ORDER_OUT, "error_message")


@query("failed_orders")
def q_failed_orders(spark, sf_dir):
    """V5 + V6: rejected order rows as dead letters."""
    return ingest.failed_records(_normalized_orders(spark, sf_dir), ORDER_PIPELINE,
                                 ORDER_SOURCE, failed_at=_ts(AS_OF))


@query("latest_orders")
def q_latest_orders(spark, sf_dir):
    """I3 + O3: newest row per order (first seen on ties), in time order."""
    latest = ingest.latest_per_key(_good_orders(spark, sf_dir), "order_id", "order_purchase_timestamp")
    return latest.orderBy("order_purchase_timestamp", "_ordinal").select(*ORDER_OUT)


@query("orders_after_cursor")
def q_orders_after_cursor(spark, sf_dir):
    """I2 then I3: strictly newer than the cursor, newest per order."""
    newer = ingest.after_cursor(_good_orders(spark, sf_dir), "order_purchase_timestamp",
                                ORDER_CURSOR, inclusive=False)
    return ingest.latest_per_key(newer, "order_id", "order_purchase_timestamp").select(*ORDER_OUT)


@query("merge_orders")
def q_merge_orders(spark, sf_dir):
    """A later order batch merged into an earlier load by order_id."""
    good = _good_orders(spark, sf_dir)
    ts = F.col("order_purchase_timestamp")
    target = staging.keep_latest(good.filter(ts < _ts(FIRST_LOAD_BEFORE)), "order_id", _order_order())
    batch = good.filter(ts >= _ts(SECOND_LOAD_FROM))
    return merge.merge_by_key(target, batch, "order_id", _order_order()).select(*ORDER_OUT)


@query("merge_failed")
def q_merge_failed(spark, sf_dir):
    """S6 on dead letters: a rerun of the ticket load maps onto the same keys."""
    first = ingest.failed_records(_normalized_tickets(spark, sf_dir), TICKET_PIPELINE, TICKET_SOURCE,
                                  failed_at=_ts(AS_OF)).unionByName(
        ingest.failed_records(_normalized_orders(spark, sf_dir), ORDER_PIPELINE, ORDER_SOURCE,
                              failed_at=_ts(AS_OF)))
    rerun = ingest.failed_records(_normalized_tickets(spark, sf_dir), TICKET_PIPELINE, TICKET_SOURCE,
                                  failed_at=_ts(RERUN_AT))
    return merge.merge_by_key(first, rerun, "record_hash", [F.col("failed_at").desc()])


@query("orders_csv_roundtrip")
def q_orders_csv(spark, sf_dir):
    """Orders landed as CSV files with different headers, read by name, normalised, newest per order.

    Even keys land in the declared column order, odd ones reversed and with a
    further column, whose text holds quotes, commas and line breaks for some
    rows (Spark's reader of whole lines would break them); the row hash leaves
    that column out. Lines equal to a file's header are rows without a valid
    time, hence rejected.
    """
    path = _scratch(spark, "landing/orders")
    rows = _landed_orders(spark, sf_dir)
    key = F.col("_ordinal") % 2
    even, odd = rows.filter(key == 0).drop("_ordinal"), rows.filter(key == 1)
    even.write.option("header", True).csv(path)
    n = F.col("_ordinal") % 10
    note = (F.when(n == 1, "two\nlines").when(n == 3, 'a "quoted" word,\n\nand "more"\n').when(n == 5, ",").otherwise(F.col("_ordinal").cast("string")))
    (odd.select(*reversed(even.columns), note.alias("note"))
     .write.mode("append").option("header", True).option("escape", '"').csv(path))
    header = even.limit(0).unionByName(even.sparkSession.createDataFrame([tuple(even.columns)] * 2, even.schema))
    header.coalesce(1).write.mode("append").option("header", True).csv(path)
    rows = landed.read_orders_csv(spark, path)
    repeated = rows.where(F.col("order_id") == "order_id").count()
    if repeated != 2:
        raise ValueError(f"{repeated} of 2 lines equal to the header were read")
    rows = rows.drop("note")
    good = ingest.good_rows(ingest.normalize_orders(rows, load_id=ORDER_LOAD_ID))
    # Copies of an order are told apart by their rows here, as they lie in different files.
    latest = staging.keep_latest(good, "order_id", [F.col("order_purchase_timestamp").desc(), F.col("_row_id").asc()])
    return latest.select(*ORDER_OUT)


@query("rejected_payloads")
def q_rejected_payloads(spark, sf_dir):
    """S3, bad branch: cut-off JSON and unknown envelopes among good payloads, each one bad row."""
    payloads = derived.ticket_payloads(derived.read_table(spark, sf_dir, "events"))
    page = F.expr("cast(substring(_source, 6) as long)")
    broken = (F.when(page % 4 == 0, F.expr("left(value, cast(length(value) - 1 as int))"))
              .when(page % 4 == 1, F.concat(F.lit('{"rows":'), "value", F.lit("}"))).otherwise(F.col("value")))
    rows = landed.unwrap_payloads(payloads.select(broken.alias("value"), "_source"))
    return rows.groupBy("_source").agg(
        F.max("_bad_error").alias("error_message"), F.count("record").alias("records"))


@query("record_passthrough")
def q_record_passthrough(spark, sf_dir):
    """P5: keys that no column names stay queryable in the stored record."""
    store = TableStore(spark, _scratch(spark, "warehouse"))
    path = store.overwrite(_good_tickets(spark, sf_dir).drop("_source", "_ordinal"), "raw_zone", "raw_tickets")
    stored = spark.read.parquet(path)
    return stored.select("_row_id", canonical_text(F.col("_record")).alias("record_text"),
                         F.try_variant_get("_record", "$.metadata.channel", "string").alias("record_channel"))


@query("text_booleans")
def q_text_booleans(spark, sf_dir):
    """C4: delay flags that landed as text; only true and false in any case count, else the times decide."""
    raw = derived.raw_orders_at(spark, sf_dir)
    k = F.col("_row_id").cast("long") % 6
    text = (F.when(k == 0, "true").when(k == 1, "FALSE").when(k == 2, "yes").when(k == 3, "").when(k == 4, "False"))
    return staging.stg_orders(raw.withColumn("is_delayed_order", text)).select("order_id", "is_delayed_order")


def _first_and_second(spark, sf_dir):
    good = _good_orders(spark, sf_dir)
    ts = F.col("order_purchase_timestamp")
    return [part.select(*ORDER_OUT, "_ordinal") for part in (
        good.filter(ts < _ts(FIRST_LOAD_BEFORE)), good.filter(ts >= _ts(SECOND_LOAD_FROM)))]


@query("bucketed_merge_orders")
def q_bucketed_merge_orders(spark, sf_dir):
    """S6 through the table store: two loads merged into a key-bucketed table."""
    store = TableStore(spark, _scratch(spark, "warehouse"), merge_buckets=8)
    for part in _first_and_second(spark, sf_dir):
        store.merge(part, "raw_zone", "raw_orders", "order_id", _order_order())
    return store.read("raw_zone", "raw_orders").select(*ORDER_OUT)


@query("mixed_layout_merge")
def q_mixed_layout_merge(spark, sf_dir):
    """A plain table merged into as bucketed, then by stores that ask for other layouts."""
    root = _scratch(spark, "warehouse")
    first, second = _first_and_second(spark, sf_dir)
    half = F.pmod(F.xxhash64("order_id"), F.lit(2)) == 0
    for part, buckets in ((first, None), (second.filter(half), 8), (second.filter(~half), None), (second.limit(0), 16)):
        TableStore(spark, root, merge_buckets=buckets).merge(part, "raw_zone", "raw_orders", "order_id", _order_order())
    return TableStore(spark, root).read("raw_zone", "raw_orders").select(*ORDER_OUT)


def _two_ticket_loads(spark, sf_dir):
    good = _staged(spark, _good_tickets(spark, sf_dir).drop("_source", "_ordinal"))
    return good.filter(F.col("created_at") < _ts(FIRST_LOAD_BEFORE)), good.filter(F.col("created_at") >= _ts(SECOND_LOAD_FROM))


def _incremental_tickets(spark, sf_dir, table):
    store = TableStore(spark, _scratch(spark, "warehouse"), merge_buckets=8)
    for i, part in enumerate(_two_ticket_loads(spark, sf_dir), 1):
        incremental_plan.merge_and_refresh_tickets(store, part, f"{table}-load-{i}-{uuid.uuid4().hex}")
    return incremental_plan.result(store, table)


@query("incremental_fact")
def q_incremental_fact(spark, sf_dir):
    """A1 / M3 kept up to date over two overlapping loads: new rows added, replaced ones retracted."""
    return _incremental_tickets(spark, sf_dir, "_sentiment_state")


@query("incremental_heatmap")
def q_incremental_heatmap(spark, sf_dir):
    """A3 / M6 kept up to date over two overlapping loads."""
    return _incremental_tickets(spark, sf_dir, "_heatmap_state")


@query("incremental_order_daily")
def q_incremental_orders(spark, sf_dir):
    """A2 kept up to date over two overlapping loads."""
    store = TableStore(spark, _scratch(spark, "warehouse"), merge_buckets=8)
    for i, part in enumerate(_first_and_second(spark, sf_dir), 1):
        latest = staging.keep_latest(part, "order_id", _order_order()).drop("_ordinal")
        incremental_plan.merge_and_refresh_orders(store, latest, f"load-{i}-{uuid.uuid4().hex}")
    return incremental_plan.result(store, "_order_state")


TWO_LOAD_INITIAL = "2024-01-05T00:00:00Z"


def _land_lines(payloads: DataFrame, path: str) -> None:
    payloads.select("value").write.mode("append").text(path)


def _two_load_run(spark, sf_dir) -> tuple[TableStore, str]:
    """Tickets landed and ingested in two overlapping drops; returns the store and the audit path."""
    root = _scratch(spark, "warehouse")
    store, landing, audit = TableStore(spark, root, merge_buckets=8), f"{root}/landing", f"{root}/audit"
    events = derived.read_table(spark, sf_dir, "events")
    drops = (F.col("ts") < _ts(FIRST_LOAD_BEFORE), F.col("ts") >= _ts(SECOND_LOAD_FROM))
    for i, drop in enumerate(drops, 1):
        _land_lines(derived.ticket_payloads(events.filter(drop)), landing)
        pipelines.run_ticket_ingestion(spark, store, landing, audit_path=audit, run_id=f"tickets-{i}", load_id=f"load-{i}",
                                       whole_files=False, initial_cursor=TWO_LOAD_INITIAL)
    return store, audit


@query("two_load_ingestion")
def q_two_load_ingestion(spark, sf_dir):
    """I1 + I4 + S6: two landing drops, each file read once, the second from the first one's cursor on."""
    store, _ = _two_load_run(spark, sf_dir)
    return store.read("raw_zone", "raw_tickets").select(*TICKET_OUT)


@query("published_dashboards")
def q_published(spark, sf_dir):
    """S5 + S10: the dashboard table stored, exported as JSON and read back."""
    root = _scratch(spark, "warehouse")
    store = TableStore(spark, root)
    table = dashboard.sentiment_heatmap(_stg_tickets(spark, sf_dir), ordered=False)
    store.overwrite(table.limit(0), "dashboard", "sentiment_heatmap")
    store.overwrite(table, "dashboard", "sentiment_heatmap")
    sinks.export_extract(store.read("dashboard", "sentiment_heatmap"), f"{root}/extract")
    return spark.read.schema(table.schema).json(f"{root}/extract")


# ---------------------------------------------------------------- quality

def _failed_all(spark, sf_dir):
    return ingest.failed_records(_normalized_tickets(spark, sf_dir), TICKET_PIPELINE, TICKET_SOURCE,
                                 failed_at=_ts(AS_OF)).unionByName(
        ingest.failed_records(_normalized_orders(spark, sf_dir), ORDER_PIPELINE, ORDER_SOURCE,
                              failed_at=_ts(AS_OF)))


@query("contract_check")
def q_contract(spark, sf_dir):
    """V7: required keys present across all landed ticket records."""
    return quality.contract_check(_ticket_records(spark, sf_dir), ingest.TICKET_REQUIRED)


@query("failed_ratio")
def q_failed_ratio(spark, sf_dir):
    """K1: failed-record ratio per pipeline against the 1% guardrail."""
    return quality.failed_ratio((TICKET_PIPELINE, _normalized_tickets(spark, sf_dir)),
                                (ORDER_PIPELINE, _normalized_orders(spark, sf_dir)))


@query("failure_patterns")
def q_failure_patterns(spark, sf_dir):
    """K2: top failure classes across both pipelines."""
    return quality.failure_patterns(_failed_all(spark, sf_dir), k=10)


@query("freshness")
def q_freshness(spark, sf_dir):
    """K3: newest event per table against its SLA at the refresh time."""
    sla = quality.FRESHNESS_SLA_MINUTES
    return quality.freshness([
        ("stg_tickets", _stg_tickets(spark, sf_dir), "created_at", sla["tickets"]),
        ("stg_orders", _stg_orders(spark, sf_dir), "order_purchase_timestamp", sla["orders"]),
        ("high_risk_customers", _high_risk(spark, sf_dir), "refreshed_at", sla["platform"]),
    ], as_of=_ts(AS_OF))


@query("layer_counts")
def q_layer_counts(spark, sf_dir):
    """K4: rows per layer table (raw vs staging reconciliation)."""
    hr = _high_risk(spark, sf_dir)
    return quality.layer_counts([
        ("raw_zone", "raw_tickets", derived.raw_tickets_at(spark, sf_dir)),
        ("raw_zone", "raw_orders", derived.raw_orders_at(spark, sf_dir)),
        ("staging", "stg_tickets", _stg_tickets(spark, sf_dir)),
        ("staging", "stg_orders", _stg_orders(spark, sf_dir)),
        ("core", "fact_sentiment_daily", _fact(spark, sf_dir)),
        ("enrichment", "high_risk_customers", hr),
        ("dashboard", "high_risk_table", dashboard.high_risk_table(hr)),
        ("dashboard", "sentiment_heatmap", dashboard.sentiment_heatmap(_stg_tickets(spark, sf_dir), ordered=False)),
    ])


@query("staging_reconciliation")
def q_reconcile(spark, sf_dir):
    """K4: raw -> staging reconciliation for both raw tables."""
    return quality.staging_reconciliation([
        ("raw_tickets", derived.raw_tickets_at(spark, sf_dir), _stg_tickets(spark, sf_dir), "created_at"),
        ("raw_orders", derived.raw_orders_at(spark, sf_dir), _stg_orders(spark, sf_dir),
         "order_purchase_timestamp"),
    ])


@query("sentiment_dod")
def q_sentiment_dod(spark, sf_dir):
    """K5: daily mean sentiment with day-over-day change."""
    return quality.sentiment_dod(_stg_tickets(spark, sf_dir))


@query("newly_flagged")
def q_newly_flagged(spark, sf_dir):
    """K6: customers flagged on a day and not on the day before."""
    return quality.newly_flagged(_high_risk(spark, sf_dir))


@query("newly_flagged_by_run")
def q_newly_flagged_by_run(spark, sf_dir):
    """K6 between two runs of the models: over the tickets of the first load, then over all."""
    store = TableStore(spark, _scratch(spark, "warehouse"))
    store.overwrite(derived.raw_orders_at(spark, sf_dir), "raw_zone", "raw_orders")
    events = derived.read_table(spark, sf_dir, "events")
    for part in (events.filter(F.col("ts") < _ts(FIRST_LOAD_BEFORE)), events):
        store.overwrite(derived.raw_tickets(part), "raw_zone", "raw_tickets")
        dag.run_models(spark, store, as_of=AS_OF)
    before, after = (spark.read.parquet(v) for v in store.versions("enrichment", "high_risk_customers"))
    return quality.flag_changes(before, after)


@query("payload_drift")
def q_payload_drift(spark, sf_dir):
    """V7 + P5: the second landing drop against the first one's shape; its records rename a key and retype another."""
    events = derived.read_table(spark, sf_dir, "events")

    def records(drop):
        return landed.unwrap_envelope(derived.ticket_payloads(events.filter(drop)))[0]

    first, second = records(F.col("ts") < _ts(FIRST_LOAD_BEFORE)), records(F.col("ts") >= _ts(FIRST_LOAD_BEFORE))
    text = F.regexp_replace(F.replace(F.to_json("record"), F.lit('"status":'), F.lit('"state":')), '"ticket_id":([0-9]+)', '"ticket_id":"$1"')
    return quality.payload_drift(second.select(F.parse_json(text).alias("record")), quality.payload_shape(first))


@query("failure_templates")
def q_failure_templates(spark, sf_dir):
    """K2 from daily heavy-hitter sketches over message templates, combined; exact at these sizes."""
    days = ingest.failed_records(_normalized_tickets(spark, sf_dir), TICKET_PIPELINE, TICKET_SOURCE, failed_at=_ts(AS_OF)).unionByName(
        ingest.failed_records(_normalized_orders(spark, sf_dir), ORDER_PIPELINE, ORDER_SOURCE, failed_at=_ts(RERUN_AT)))
    return quality.failure_patterns_of(quality.failure_sketches(days), k=50)


@query("bucketed_staging")
def q_bucketed_staging(spark, sf_dir):
    """M1 over a raw table that is stored by ticket: no exchange below the dedupe."""
    store = TableStore(spark, _scratch(spark, "warehouse"))
    return staging.stg_tickets(store.overwrite_bucketed(derived.raw_tickets_at(spark, sf_dir), "raw_zone", "raw_tickets", "ticket_id", 8))


@query("delayed_orders_dod")
def q_delayed_dod(spark, sf_dir):
    """K7: delayed orders per day with day-over-day change."""
    return quality.delayed_orders_dod(_stg_orders(spark, sf_dir))


@query("owner_queue")
def q_owner_queue(spark, sf_dir):
    """K8: risk queue with the owning team per band."""
    return quality.owner_queue(dashboard.high_risk_table(_high_risk(spark, sf_dir)), spark)


@query("contract_check_missing")
def q_contract_missing(spark, sf_dir):
    """V7 on records that lack a key: the check fails with the number of such records."""
    records = _ticket_records(spark, sf_dir)
    cut = F.when(F.col("_ordinal.p") % 10 == 3, F.parse_json(F.expr(
        "regexp_replace(to_json(record), '\"customer_id\":\"[^\"]*\",', '')"))).otherwise(F.col("record"))
    return quality.contract_check(records.withColumn("record", cut), ingest.TICKET_REQUIRED)


@query("run_durations")
def q_run_durations(spark, sf_dir):
    """V8 + V9 + A6: the audit files of two ticket runs and an order run, correlated per run.

    Times differ between runs and stay out of the result.
    """
    store, audit = _two_load_run(spark, sf_dir)
    path = _scratch(spark, "landing/orders")
    _landed_orders(spark, sf_dir).drop("_ordinal").write.option("header", True).csv(path)
    pipelines.run_order_ingestion(spark, store, path, audit_path=audit, run_id="orders-1", initial_cursor=ORDER_CURSOR)
    return quality.run_durations(quality.read_audit(spark, audit)).select(
        "pipeline_name", "run_id", "outcome", "records_processed", "records_failed",
        (F.col("duration_seconds") > 0).alias("took_time"))


@query("default_refresh_time")
def q_default_refresh(spark, sf_dir):
    """Without a given time, M4 carries the time of the query, one for all rows."""
    found = risk.high_risk_customers(_fact(spark, sf_dir), _order_daily(spark, sf_dir))
    now = F.current_timestamp()
    return found.select("customer_id", "snapshot_date", (F.col("refreshed_at") == now).alias("one_time"),
                        F.col("refreshed_at").between(F.lit("2024-01-01").cast("timestamp"), now).alias("not_ahead"))


@query("generated_run_ids")
def q_generated_run_ids(spark, sf_dir):
    """Runs without a given id make their own, one for both events of a run."""
    root = _scratch(spark, "warehouse")
    store, landing, audit = TableStore(spark, root, merge_buckets=8), f"{root}/landing", f"{root}/audit"
    events = derived.read_table(spark, sf_dir, "events")
    for half in (0, 1):
        _land_lines(derived.ticket_payloads(events.filter(F.expr("event_id div 50 % 2") == half)), landing)
        pipelines.run_ticket_ingestion(spark, store, landing, audit_path=audit, whole_files=False, initial_cursor=None)
    is_uuid = F.col("run_id").rlike(r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    events = quality.read_audit(spark, audit).groupBy("pipeline_name", "run_id").agg(F.count("*").alias("events"))
    return events.groupBy("pipeline_name").agg(F.count("*").alias("runs"), F.min("events").alias("events_per_run"),
                                               F.bool_and(is_uuid).alias("all_uuid"))


# ------------------------------------------------------------ end to end

@query("e2e_high_risk_customers")
def q_e2e(spark, sf_dir):
    """Landed payloads + CSV rows -> ingestion (validate, newest per key) ->
    typed raw tables -> staging -> facts -> risk, as one lazy plan."""
    tickets = merge.merge_by_key(None, _good_tickets(spark, sf_dir).drop("_record", "_source", "_ordinal"),
                                 "ticket_id", _ticket_order())
    orders = ingest.latest_per_key(_good_orders(spark, sf_dir), "order_id", "order_purchase_timestamp")
    fact = facts.fact_sentiment_daily(staging.stg_tickets(tickets))
    return risk.high_risk_customers(fact, facts.order_daily(staging.stg_orders(orders)), as_of=AS_OF)


# -------------------------------------------------------------- streaming

@query("stream_ticket_merge")
def q_stream_merge(spark, sf_dir):
    """Payload files streamed in micro-batches, merged into raw_tickets.

    The two copies of a ticket land in different drops, each drained by its
    own run on one checkpoint: the copy of the later drop replaces the other.
    """
    root = _scratch(spark, "warehouse")
    store, landing = TableStore(spark, root, merge_buckets=8), f"{root}/landing"
    events = derived.read_table(spark, sf_dir, "events")
    for copy in (0, 1):
        _land_lines(derived.ticket_payloads(events.filter(F.col("event_id") % 2 == copy)), landing)
        start_ticket_merge(spark, store, landing, checkpoint_location=f"{root}/_checkpoints/t1",
                           whole_files=False).awaitTermination()
    out = [c for c in TICKET_OUT if c != "_load_id"]
    return store.read("raw_zone", "raw_tickets").select(*out)


@query("stream_ticket_newest")
def q_stream_newest(spark, sf_dir):
    """T1, newest wins: the newer copy of every other ticket lands in the first drop, the older one later."""
    root = _scratch(spark, "warehouse")
    store, landing = TableStore(spark, root, merge_buckets=8), f"{root}/landing"
    events = derived.read_table(spark, sf_dir, "events")
    drop = F.expr("(event_id + event_id div 2) % 2")
    for copy in (0, 1):
        _land_lines(derived.ticket_payloads(events.filter(drop == copy)), landing)
        start_newest_tickets(spark, store, landing, checkpoint_location=f"{root}/_checkpoints/newest",
                             whole_files=False).awaitTermination()
    return store.read("raw_zone", "raw_tickets").select(*[c for c in TICKET_OUT if c != "_load_id"])


LATE_FROM = "2024-01-20 00:00:00"


@query("stream_late_rows")
def q_stream_late(spark, sf_dir):
    """T2 + V8: a drop of new events, then one of old events; rows the watermark drops are counted per drop."""
    root = _scratch(spark, "heatmap")
    events = derived.read_table(spark, sf_dir, "events")
    out = None
    for name, drop in (("new", F.col("ts") >= _ts(LATE_FROM)), ("old", F.col("ts") < _ts(LATE_FROM))):
        _land_lines(derived.ticket_payloads(events.filter(drop)), f"{root}/landing")
        listener = ProgressAudit(spark, f"{root}/audit/{name}")
        spark.streams.addListener(listener)
        try:
            start_heatmap(spark, f"{root}/landing", f"{root}/out", checkpoint_location=f"{root}/_ckpt",
                          whole_files=False).awaitTermination()
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        finally:
            spark.streams.removeListener(listener)
        progress = stream_progress(quality.read_audit(spark, f"{root}/audit/{name}"))
        told = progress.agg(F.sum("late_rows").alias("late_rows")).select(F.lit(name).alias("landed"), "late_rows")
        out = told if out is None else out.unionByName(told)
    return out


@query("stream_heatmap_hourly")
def q_stream_heatmap(spark, sf_dir):
    """Watermarked hourly heatmap over the streamed payloads.

    All copies of a ticket land in one payload, hence in one micro-batch,
    where the first by time is kept; the windows that the final watermark has
    passed are emitted.
    """
    root = _scratch(spark, "heatmap")
    events = derived.read_table(spark, sf_dir, "events")
    _land_lines(derived.ticket_payloads(events), f"{root}/landing")
    start_heatmap(spark, f"{root}/landing", f"{root}/out", checkpoint_location=f"{root}/_ckpt",
                  whole_files=False).awaitTermination()
    return spark.read.parquet(f"{root}/out")


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
