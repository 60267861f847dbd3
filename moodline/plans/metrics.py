"""Operational metrics over the stored tables (K1-K8, V7, V9).

Every figure reads tables that ingestion and the model DAG have written; no
model is computed again. Row counts come from Parquet footers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodline.operators import ingest, quality
from moodline.plans.pipelines import RAW, read_failed
from moodline.sources.sinks import TableStore

# The tables of each layer.
LAYER_TABLES = (
    (RAW, "raw_tickets"), (RAW, "raw_orders"), ("staging", "stg_tickets"), ("staging", "stg_orders"),
    ("core", "fact_sentiment_daily"), ("enrichment", "high_risk_customers"),
    ("dashboard", "high_risk_table"), ("dashboard", "sentiment_heatmap"),
)


def failed_ratio(store: TableStore) -> DataFrame:
    """K1 per pipeline: dead letters against stored raw rows."""
    failed = read_failed(store)
    parts = []
    for pipeline, table in (("tickets_pipeline", "raw_tickets"), ("orders_pipeline", "raw_orders")):
        own = failed.filter(F.col("pipeline_name") == pipeline).select("error_message")
        raw = store.read(RAW, table)
        if raw is not None:
            own = own.unionByName(raw.select(F.lit(None).cast("string").alias("error_message")))
        parts.append((pipeline, own))
    return quality.failed_ratio(*parts)


def warehouse_metrics(spark: SparkSession, store: TableStore, as_of: str | None = None,
                      audit_path: str | None = None) -> dict[str, DataFrame]:
    """All metrics whose tables exist, by name."""
    at = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    have = {t: df for layer, t in LAYER_TABLES if (df := store.read(layer, t)) is not None}
    sla = quality.FRESHNESS_SLA_MINUTES
    timed = [(t, have[t], c, s) for t, c, s in (
        ("stg_tickets", "created_at", sla["tickets"]), ("stg_orders", "order_purchase_timestamp", sla["orders"]),
        ("high_risk_customers", "refreshed_at", sla["platform"])) if t in have]
    pairs = [(raw, have[raw], have[stg], c) for raw, stg, c in (
        ("raw_tickets", "stg_tickets", "created_at"), ("raw_orders", "stg_orders", "order_purchase_timestamp"))
        if raw in have and stg in have]
    out = {"failed_ratio": failed_ratio(store), "failure_patterns": quality.failure_patterns(read_failed(store))}
    if have:
        out["layer_counts"] = quality.layer_counts([(layer, t, have[t]) for layer, t in LAYER_TABLES if t in have])
    if timed:
        out["freshness"] = quality.freshness(timed, as_of=at)
    if pairs:
        out["staging_reconciliation"] = quality.staging_reconciliation(pairs)
    if "raw_tickets" in have and "_record" in have["raw_tickets"].columns:
        out["contract_check"] = quality.contract_check(have["raw_tickets"], ingest.TICKET_REQUIRED, "_record")
    if "stg_tickets" in have:
        out["sentiment_dod"] = quality.sentiment_dod(have["stg_tickets"])
    if "stg_orders" in have:
        out["delayed_orders_dod"] = quality.delayed_orders_dod(have["stg_orders"])
    if "high_risk_customers" in have:
        out["newly_flagged"] = quality.newly_flagged(have["high_risk_customers"])
    runs = store.versions("enrichment", "high_risk_customers")
    if len(runs) > 1:
        out["newly_flagged_by_run"] = quality.flag_changes(*(spark.read.parquet(run) for run in runs[-2:]))
    if "high_risk_table" in have:
        out["owner_queue"] = quality.owner_queue(have["high_risk_table"], spark)
    if audit_path:
        out["run_durations"] = quality.run_durations(quality.read_audit(spark, audit_path))
    return out
