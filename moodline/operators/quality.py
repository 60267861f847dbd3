"""Data-quality, audit and operational metrics (V7-V9, K1-K8).

All metrics are aggregations or equi-joins; none gathers a group into one
task. Day-over-day figures join each day with the previous calendar day on
the date key instead of a window without partitioning, so they stay
distributed however long the history grows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from moodline.functions.records import variant_path
from moodline.sources.schemas import AUDIT_EVENTS

# Guardrail, freshness SLAs (minutes) and band owners.
FAILED_RATIO_GUARDRAIL = 0.01
FRESHNESS_SLA_MINUTES = {"tickets": 15, "orders": 24 * 60, "platform": 30}
BAND_OWNERS = (
    ("critical", "Customer Success L2"),
    ("high", "Fulfillment Ops"),
    ("medium", "Automated Follow-up"),
)
CONTROL_SET = "enterprise-baseline-v1"
# Audit event types of a run.
STARTED, COMPLETED = "pipeline_started", "pipeline_completed"


# ---------------------------------------------------------------- V7

def contract_check(records: DataFrame, required: Sequence[str], record_col: str = "record") -> DataFrame:
    """V7: payload contract over *all* landed records, in one pass.

    One row per check: ``records_present`` and ``has_<key>`` per required
    key (present even if null), with checked / failed row counts.
    """
    r = F.col(record_col)
    absent = {k: F.try_variant_get(r, variant_path(k), "variant").isNull() for k in required}
    agg = records.agg(F.count(F.lit(1)).alias("n"),
                      *[F.count_if(absent[k]).alias(f"miss_{k}") for k in required])
    rows = [F.struct(F.lit("records_present").alias("check_name"), F.col("n").alias("checked_rows"),
                     F.lit(0).cast("long").alias("failed_rows"), (F.col("n") > 0).alias("passed"))]
    rows += [F.struct(F.lit(f"has_{k}").alias("check_name"), F.col("n").alias("checked_rows"),
                      F.col(f"miss_{k}").alias("failed_rows"), (F.col(f"miss_{k}") == 0).alias("passed"))
             for k in required]
    return agg.select(F.explode(F.array(*rows)).alias("c")).select("c.*")


def payload_shape(records: DataFrame, record_col: str = "record") -> dict[str, str]:
    """Path -> type of all records together (``a.b`` for nested keys, ``a[]`` for list items).

    One aggregate; what reaches the driver is one type, as large as the
    number of different paths. A path whose records differ in type has the
    common one, VARIANT where there is none.
    """
    told = records.agg(F.schema_of_variant_agg(record_col).alias("s")).first().s
    kind = records.sparkSession.createDataFrame([], f"r {told.replace('OBJECT<', 'STRUCT<')}").schema["r"].dataType
    out: dict[str, str] = {}

    def walk(path: str, t: DataType) -> None:
        if isinstance(t, StructType):
            out[path] = "OBJECT"
            for f in t.fields:
                walk(f"{path}.{f.name}" if path else f.name, f.dataType)
        elif isinstance(t, ArrayType):
            out[path] = "ARRAY"
            walk(f"{path}[]", t.elementType)
        else:
            out[path] = t.simpleString().upper()

    walk("", kind)
    out.pop("", None)
    return out


def payload_drift(records: DataFrame, contract: dict[str, str], record_col: str = "record") -> DataFrame:
    """V7 / P5: paths of a landing drop that the contract (path -> type) lacks, misses or types otherwise.

    Rows of path, change (added, missing, retyped), declared and found type;
    paths that hold only nulls have no type to compare and count as present.
    """
    found = payload_shape(records, record_col)
    rows = [(p, "added", None, t) for p, t in found.items() if p not in contract]
    rows += [(p, "missing", t, None) for p, t in contract.items() if p not in found]
    rows += [(p, "retyped", contract[p], t) for p, t in found.items() if p in contract and t != contract[p] and "VOID" not in (t, contract[p])]
    return records.sparkSession.createDataFrame(sorted(rows, key=lambda r: r[:2]), "path string, change string, declared string, found string")


# ---------------------------------------------------------------- V8 / V9

def audit_event(spark: SparkSession, pipeline_name: str, run_id: str, event_type: str, status: str,
                details: dict | None = None, compliance_tags: Sequence[str] = (),
                at: str | None = None, control_set: str = CONTROL_SET) -> DataFrame:
    """V8: one audit event as a one-row DataFrame (``details`` as VARIANT)."""
    import json
    ts = F.lit(at).cast("timestamp") if at else F.current_timestamp()
    return spark.range(1).select(
        ts.alias("timestamp"), F.lit(pipeline_name).alias("pipeline_name"),
        F.lit(run_id).alias("run_id"), F.lit(event_type).alias("event_type"),
        F.lit(status).alias("status"), F.lit(control_set).alias("control_set"),
        F.array(*[F.lit(t) for t in compliance_tags]).cast("array<string>").alias("compliance_tags"),
        F.parse_json(F.lit(json.dumps(details or {}, sort_keys=True, default=str))).alias("details"),
    )


def read_audit(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Audit events as runs wrote them: declared columns, ``details`` as VARIANT."""
    return spark.read.schema(AUDIT_EVENTS).json(path).withColumn("details", F.try_parse_json("details"))


def run_durations(audit: DataFrame) -> DataFrame:
    """V9: correlate started / completed events per run id; a run without a completed event is ``running``."""
    started, completed = F.col("event_type") == STARTED, F.col("event_type") == COMPLETED

    def counter(*names: str) -> Column:
        found = [F.try_variant_get(F.col("details"), f"$.{n}", "long") for n in names]
        return F.max(F.when(completed, F.coalesce(*found)))

    per = audit.groupBy("pipeline_name", "run_id").agg(
        F.min(F.when(started, F.col("timestamp"))).alias("started_at"),
        F.max(F.when(completed, F.col("timestamp"))).alias("completed_at"),
        F.max(F.when(completed, F.col("status"))).alias("outcome"),
        counter("records_processed", "rows_processed").alias("records_processed"),
        counter("records_failed", "rows_failed").alias("records_failed"))
    return per.select(
        "pipeline_name", "run_id", "started_at", "completed_at",
        ((F.unix_micros("completed_at") - F.unix_micros("started_at")) / F.lit(1e6)).alias("duration_seconds"),
        F.coalesce(F.col("outcome"), F.lit("running")).alias("outcome"), "records_processed", "records_failed")


# ---------------------------------------------------------------- K1-K4

def failed_ratio(*normalized: tuple[str, DataFrame]) -> DataFrame:
    """K1: failed / (failed + processed) per pipeline against the guardrail."""
    parts = [df.agg(F.count_if(F.col("error_message").isNull()).alias("processed"),
                    F.count_if(F.col("error_message").isNotNull()).alias("failed"))
             .select(F.lit(name).alias("pipeline_name"), "processed", "failed")
             for name, df in normalized]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    ratio = F.try_divide(F.col("failed").cast("double"), (F.col("failed") + F.col("processed")).cast("double"))
    return out.select("pipeline_name", "processed", "failed", ratio.alias("failed_ratio"),
                      (F.coalesce(ratio, F.lit(0.0)) < FAILED_RATIO_GUARDRAIL).alias("within_guardrail"))


def error_class(message: Column) -> Column:
    """Message text before the first ':' (the rule, without the value)."""
    return F.regexp_extract(message, r"^([^:]*)", 1)


def failure_patterns(failed: DataFrame, k: int = 10) -> DataFrame:
    """K2: most frequent failure classes per pipeline (top ``k`` overall)."""
    counts = (failed.groupBy("pipeline_name", error_class(F.col("error_message")).alias("error_class"))
              .agg(F.count(F.lit(1)).alias("failures")))
    return counts.orderBy(F.col("failures").desc(), "pipeline_name", "error_class").limit(k)


def message_template(message: Column) -> Column:
    """An error text without its values: numbers, quoted text and what follows the rule's colon."""
    return F.regexp_replace(F.regexp_replace(error_class(message), r"""'[^']*'|"[^"]*\"""", "?"), r"\d+", "#")


def failure_sketches(failed: DataFrame, items: int = 10_000) -> DataFrame:
    """K2 on unbounded error texts: per day of failure, a heavy-hitter sketch of pipeline and message template.

    A sketch holds at most ``items`` templates whatever the number of texts;
    sketches of days are kept and combined (:func:`failure_patterns_of`).
    """
    item = F.concat_ws("\x1f", "pipeline_name", message_template(F.col("error_message")))
    return (failed.select(F.to_date("failed_at").alias("failed_on"), item.alias("_item")).groupBy("failed_on")
            .agg(F.expr(f"approx_top_k_accumulate(_item, {int(items)})").alias("sketch")))


def failure_patterns_of(sketches: DataFrame, k: int = 10, items: int = 10_000) -> DataFrame:
    """K2 from kept sketches: the ``k`` most frequent templates of all days.

    Counts are exact while the days together hold fewer than three quarters
    of ``items`` templates; beyond that a count is too high by at most the
    rows divided by a third of ``items``.
    """
    top = (sketches.agg(F.expr(f"approx_top_k_combine(sketch, {int(items)})").alias("sketch"))
           .select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {int(k)})")).alias("t")))
    parts = F.split("t.item", "\x1f")
    return top.select(parts[0].alias("pipeline_name"), parts[1].alias("message_template"), F.col("t.count").alias("failures"))


def freshness(sources: Sequence[tuple[str, DataFrame, str, int]], as_of: Column) -> DataFrame:
    """K3: per table, newest event time, lag behind ``as_of`` and SLA check.

    ``sources`` holds ``(table_name, frame, time_column, sla_minutes)``.
    """
    parts = [df.agg(F.max(F.col(c).cast("timestamp")).alias("latest_event_at"))
             .select(F.lit(name).alias("table_name"), "latest_event_at",
                     F.lit(sla).alias("sla_minutes"))
             for name, df, c, sla in sources]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    lag = (F.unix_micros(as_of) - F.unix_micros("latest_event_at")) / F.lit(60e6)
    return out.select("table_name", "latest_event_at", lag.alias("lag_minutes"), "sla_minutes",
                      (lag <= F.col("sla_minutes")).alias("within_sla"))


def layer_counts(tables: Sequence[tuple[str, str, DataFrame]]) -> DataFrame:
    """K4: row count per (layer, table); the caller reconciles raw vs staging."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count")
             for layer, name, df in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def staging_reconciliation(tables: Sequence[tuple[str, DataFrame, DataFrame, str]]) -> DataFrame:
    """K4: raw rows = rejected (event time does not parse) + duplicate copies + staged.

    ``tables`` holds ``(raw_name, raw, staged, event_time_column)``. One
    aggregate per frame; the two sides meet in one group per table name.
    """
    from pyspark.sql.types import TimestampType

    from moodline.functions.casts import as_type
    none = F.lit(None).cast("long")
    parts = []
    for name, raw, staged, ts_col in tables:
        parts.append(raw.select(as_type(raw, ts_col, TimestampType()).alias("_t"))
                     .agg(F.count(F.lit(1)).alias("raw_rows"), F.count_if(F.col("_t").isNull()).alias("rejected_rows"))
                     .select(F.lit(name).alias("table_name"), "raw_rows", "rejected_rows", none.alias("staged_rows")))
        parts.append(staged.agg(F.count(F.lit(1)).alias("staged_rows"))
                     .select(F.lit(name).alias("table_name"), none.alias("raw_rows"), none.alias("rejected_rows"),
                             "staged_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.groupBy("table_name").agg(*[F.max(c).alias(c) for c in ("raw_rows", "rejected_rows", "staged_rows")])
    dup = F.col("raw_rows") - F.col("rejected_rows") - F.col("staged_rows")
    return out.select("table_name", "raw_rows", "rejected_rows", dup.alias("duplicate_rows"), "staged_rows")


# ---------------------------------------------------------------- K5-K8

def with_previous_day(daily: DataFrame, date_col: str, value_col: str) -> DataFrame:
    """Attach the previous calendar day's value and the change (equi-join)."""
    prev = daily.select(F.date_add(F.col(date_col), 1).alias("_d"), F.col(value_col).alias("previous_value"))
    j = daily.join(prev, daily[date_col] == prev["_d"], "left").drop("_d")
    return j.withColumn("change", F.col(value_col) - F.col("previous_value"))


def sentiment_dod(stg_tickets: DataFrame) -> DataFrame:
    """K5: mean sentiment per UTC day with change against the day before."""
    daily = (stg_tickets.groupBy(F.to_date("created_at").alias("sentiment_date"))
             .agg(F.avg("sentiment_score").alias("avg_sentiment_score")))
    return with_previous_day(daily, "sentiment_date", "avg_sentiment_score")


def delayed_orders_dod(stg_orders: DataFrame) -> DataFrame:
    """K7: delayed orders per purchase day with change against the day before."""
    daily = (stg_orders.groupBy(F.to_date("order_purchase_timestamp").alias("order_date"))
             .agg(F.count_if(F.col("is_delayed_order")).alias("delayed_orders")))
    return with_previous_day(daily, "order_date", "delayed_orders")


def newly_flagged(high_risk: DataFrame) -> DataFrame:
    """K6: customers flagged on a day but not on the previous day."""
    prev = high_risk.select("customer_id", F.date_add("snapshot_date", 1).alias("snapshot_date"))
    return (high_risk.join(prev, ["customer_id", "snapshot_date"], "left_anti")
            .select("customer_id", "snapshot_date", "risk_score", "risk_band"))


def flag_changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """K6 against the previous run: customers and days that entered or left the flagged set, or changed band."""
    keys = ["customer_id", "snapshot_date"]
    before = previous.select(*keys, F.col("risk_band").alias("previous_band"), F.lit(True).alias("_was"))
    after = current.select(*keys, F.col("risk_band").alias("current_band"), F.lit(True).alias("_is"))
    change = (F.when(F.col("_was").isNull(), "entered").when(F.col("_is").isNull(), "left")
              .when(~F.col("previous_band").eqNullSafe(F.col("current_band")), "band_changed"))
    return (before.join(after, keys, "full").select(*keys, "previous_band", "current_band", change.alias("change"))
            .where("change is not null"))


def owner_queue(high_risk_table: DataFrame, spark: SparkSession) -> DataFrame:
    """K8: risk queue with the owning team per band (3-row broadcast map)."""
    owners = spark.createDataFrame(list(BAND_OWNERS), "risk_band string, owner string")
    return high_risk_table.join(F.broadcast(owners), "risk_band", "left")
