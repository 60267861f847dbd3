"""Record validation and normalisation (V1-V6) and recency.

The per-record Python checks of the source become one projection: every
rule is a Column, the first failing rule wins via ``coalesce`` over
``when(rule_fails, message)``, and good / bad rows are two filters of the
same frame. No UDF: everything runs in whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from moodline.functions.casts import is_missing, safe_double, safe_timestamp
from moodline.functions.records import canonical_text, field_text, is_object, row_hash
from moodline.operators.staging import keep_latest

# Required fields, in checking order, and message texts.
TICKET_REQUIRED = ("ticket_id", "customer_id", "created_at", "sentiment_score")
ORDER_REQUIRED = ("order_id", "customer_id", "order_purchase_timestamp")
MISSING_FIELD = "Missing required field: "
BAD_TIMESTAMP = "Unsupported timestamp format: "
MALFORMED = "Malformed {field}: "

TICKET_COLUMNS = (
    "ticket_id", "customer_id", "created_at", "sentiment_score", "sentiment_label",
    "status", "channel", "priority", "customer_region", "customer_tier",
)
INTERNAL = ("_source", "_ordinal", "_bad_text", "_bad_error", "_load_id", "_row_id", "_record", "raw_record", "error_message", "_seq")


def first_error(checks: Sequence[tuple[Column, Column]]) -> Column:
    """Message of the first failing check, NULL when all pass."""
    return F.coalesce(*[F.when(cond, msg) for cond, msg in checks])


def _check_policy(error: Column, on_malformed: str) -> Column:
    if on_malformed == "fail":
        return F.when(error.isNotNull(), F.raise_error(error))
    if on_malformed != "dead_letter":
        raise ValueError(f"on_malformed must be 'dead_letter' or 'fail', got {on_malformed!r}")
    return error


def _with_seq(df: DataFrame) -> DataFrame:
    """Add ``_seq``: first-seen order of the rows as read.

    It is the fallback tie-break for "first seen" (I3), and the good / bad
    split filters on it as well (see :func:`_accepted`). Streaming frames
    do not support it; there each micro-batch is split as it arrives.
    """
    if df.isStreaming:
        return df
    return df.withColumn("_seq", F.monotonically_increasing_id())


def _accepted(normalized: DataFrame, ok: bool) -> DataFrame:
    """Rows with (``ok``) or without an error.

    The condition also names ``_seq`` (always >= 0, which the optimizer
    cannot prove, unlike NOT NULL). Because that column is
    nondeterministic, Catalyst keeps the filter above the normalising
    projection instead of re-inlining every guarded cast into the
    predicate (and inferring copies of it across joins below), so each
    row is parsed once.
    """
    err = F.col("error_message").isNull() if ok else F.col("error_message").isNotNull()
    if "_seq" in normalized.columns:
        err = err & (F.col("_seq") >= 0)
    return normalized.filter(err)


def normalize_tickets(records: DataFrame, load_id: str | Column, record_col: str = "record",
                      on_malformed: str = "dead_letter") -> DataFrame:
    """V1 + V3 + P4: ticket records (VARIANT) -> typed rows + ``error_message``.

    Ids are cast to text untrimmed; ``created_at`` must be an accepted
    timestamp form (UTC if zone-less); a present but non-numeric score is
    its own error (``on_malformed='fail'`` aborts instead, as the source
    does). ``customer`` / ``metadata`` objects overwrite the top-level
    region, tier, channel and priority, even with NULL; when absent or not
    objects, top-level keys stay. The whole record stays in ``_record``;
    ``_row_id`` hashes its canonical text, so records that differ in any key
    have different ids.

    Three stacked projections (field text -> typed values -> checks): each
    field is read from the VARIANT once and each guarded cast runs once,
    because Catalyst does not merge a non-trivial expression into a
    projection that uses it more than once.
    """
    r = F.col(record_col)

    def nested(outer: str, inner: str, top: str) -> Column:
        return F.when(is_object(r, outer), field_text(r, outer, inner)).otherwise(field_text(r, top))

    load = load_id if isinstance(load_id, Column) else F.lit(load_id)
    extra = [c for c in records.columns if c in ("_source", "_ordinal")]
    # Rows that stand for a payload without records (see landed.unwrap_payloads).
    payload = [c for c in records.columns if c in ("_bad_text", "_bad_error")]
    texts = records.select(
        *[field_text(r, f).alias(f) for f in TICKET_REQUIRED],
        field_text(r, "sentiment_label").alias("sentiment_label"),
        field_text(r, "status").alias("status"),
        nested("metadata", "channel", "channel").alias("channel"),
        nested("metadata", "priority", "priority").alias("priority"),
        nested("customer", "region", "customer_region").alias("customer_region"),
        nested("customer", "tier", "customer_tier").alias("customer_tier"),
        r.alias("_record"), canonical_text(r).alias("_text"), *extra, *payload)
    typed = texts.select("*", safe_timestamp("created_at").alias("_ts"),
                         safe_double("sentiment_score").alias("_score"))
    checks = [(is_missing(F.col(f)), F.lit(MISSING_FIELD + f)) for f in TICKET_REQUIRED]
    checks.append((F.col("_ts").isNull(), F.concat(F.lit(BAD_TIMESTAMP), F.col("created_at"))))
    checks.append((F.col("_score").isNull(), F.concat(F.lit(MALFORMED.format(field="sentiment_score")),
                                                      F.col("sentiment_score"))))
    error = F.coalesce("_bad_error", first_error(checks)) if payload else first_error(checks)
    checked = typed.select("*", _check_policy(error, on_malformed).alias("error_message"))
    out = checked.select(
        "ticket_id", "customer_id", F.col("_ts").alias("created_at"),
        F.col("_score").alias("sentiment_score"), "sentiment_label", "status", "channel", "priority",
        "customer_region", "customer_tier",
        load.cast("string").alias("_load_id"),
        row_hash(F.col("_text")).alias("_row_id"),
        "_record",
        F.when(F.col("error_message").isNotNull(), F.coalesce("_bad_text", "_text") if payload else F.col("_text")
               ).alias("raw_record"),
        "error_message", *extra)
    return _with_seq(out)


def normalize_orders(rows: DataFrame, load_id: str | Column, on_malformed: str = "dead_letter",
                     strict_ids: bool = False) -> DataFrame:
    """V2 + V4: orders CSV rows (text) -> typed rows + ``error_message``.

    Order and customer ids are trimmed (an id of only blanks passes and
    becomes '', as in the source, unless ``strict_ids``); the purchase time must parse; a
    present price / freight must be numeric; ``is_delayed_order`` is
    ``delivered > estimated`` when both are present (NULL otherwise), and
    either of them failing to parse is an error. Extra columns pass
    through. Typed values are computed in their own projection, once.
    """
    data_cols = [c for c in rows.columns if c not in INTERNAL and c != "_seq"]
    have = set(data_cols)
    need = ("order_id", "customer_id", "order_purchase_timestamp", "price", "freight_value",
            "order_delivered_customer_date", "order_estimated_delivery_date")
    extra = [c for c in rows.columns if c in ("_source", "_ordinal")]
    texts = rows.select(
        *[F.col(f"`{c}`").cast("string").alias(c) for c in data_cols],
        *[F.lit(None).cast("string").alias(c) for c in need if c not in have],
        *extra)
    canon_cols = sorted(data_cols)
    typed = texts.select(
        "*",
        safe_timestamp("order_purchase_timestamp").alias("_purchase"),
        safe_double("price").alias("_price"), safe_double("freight_value").alias("_freight"),
        safe_timestamp("order_delivered_customer_date").alias("_delivered"),
        safe_timestamp("order_estimated_delivery_date").alias("_estimated"),
        canonical_text(F.struct(*[F.col(f"`{c}`") for c in canon_cols])).alias("raw_record"))
    delivered_text, estimated_text = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    both = ~is_missing(delivered_text) & ~is_missing(estimated_text)
    def absent(f: str) -> Column:
        c = F.col(f)
        return is_missing(F.trim(c)) if strict_ids and f in ("order_id", "customer_id") else is_missing(c)

    checks = [(absent(f), F.lit(MISSING_FIELD + f)) for f in ORDER_REQUIRED]
    checks += [
        (F.col("_purchase").isNull(), F.concat(F.lit(BAD_TIMESTAMP), F.col("order_purchase_timestamp"))),
        (~is_missing(F.col("price")) & F.col("_price").isNull(),
         F.concat(F.lit(MALFORMED.format(field="price")), F.col("price"))),
        (~is_missing(F.col("freight_value")) & F.col("_freight").isNull(),
         F.concat(F.lit(MALFORMED.format(field="freight_value")), F.col("freight_value"))),
        (both & F.col("_delivered").isNull(), F.concat(F.lit(BAD_TIMESTAMP), delivered_text)),
        (both & F.col("_estimated").isNull(), F.concat(F.lit(BAD_TIMESTAMP), estimated_text)),
    ]
    load = load_id if isinstance(load_id, Column) else F.lit(load_id)
    typed_names = ("order_id", "customer_id", "order_purchase_timestamp", "price", "freight_value",
                   "is_delayed_order")
    passthrough = [F.col(f"`{c}`") for c in data_cols if c not in typed_names]
    out = typed.select(
        F.trim(F.col("order_id")).alias("order_id"),
        F.trim(F.col("customer_id")).alias("customer_id"),
        F.col("_purchase").alias("order_purchase_timestamp"),
        F.col("_price").alias("price"), F.col("_freight").alias("freight_value"),
        *passthrough,
        F.when(both, F.col("_delivered") > F.col("_estimated")).alias("is_delayed_order"),
        load.cast("string").alias("_load_id"),
        row_hash(F.col("raw_record")).alias("_row_id"),
        "raw_record",
        _check_policy(first_error(checks), on_malformed).alias("error_message"),
        *extra,
    )
    return _with_seq(out)


def good_rows(normalized: DataFrame) -> DataFrame:
    """V5: accepted rows, without the validation columns."""
    return _accepted(normalized, True).drop("error_message", "raw_record", "_seq")


def failed_records(normalized: DataFrame, pipeline_name: str, source_name: str,
                   failed_at: Column | None = None) -> DataFrame:
    """V5 + V6: rejected rows as dead-letter records keyed by payload hash.

    The key is the payload only, so a rerun of the same bad row maps to
    the same record (the merge keeps one).
    """
    at = failed_at if failed_at is not None else F.current_timestamp()
    return (_accepted(normalized, False)
            .select(row_hash(F.col("raw_record")).alias("record_hash"),
                    F.lit(pipeline_name).alias("pipeline_name"),
                    F.lit(source_name).alias("source_name"),
                    F.col("raw_record"), F.col("error_message"),
                    at.alias("failed_at")))


def cursor_bound(spark: SparkSession, cursor: str) -> Column:
    """The instant a cursor text stands for; a text that is no accepted timestamp raises."""
    at = spark.createDataFrame([(cursor,)], "c string").select(safe_timestamp("c").alias("t")).first().t
    if at is None:
        raise ValueError(f"{BAD_TIMESTAMP}{cursor}")
    return safe_timestamp(F.lit(cursor))


def passes_cursor(df: DataFrame, ts_col: str, cursor: str | None, inclusive: bool) -> Column:
    """I1 / I2 as a condition: newer than the cursor; true for all rows when it is empty.

    Tickets keep the boundary (``inclusive``; the merge makes that
    idempotent), orders are strictly newer. Instants are compared, not text;
    a text column is read as a timestamp first. Rows without a value always
    pass when the column is not a required one: an undelivered order has no
    delivery time to compare, and merging it again changes nothing.
    """
    if not cursor:
        return F.lit(True)
    bound = cursor_bound(df.sparkSession, cursor)
    c = instant(df, ts_col)
    newer = c >= bound if inclusive else c > bound
    return newer if ts_col in (*TICKET_REQUIRED, *ORDER_REQUIRED) else c.isNull() | newer


def instant(df: DataFrame, ts_col: str) -> Column:
    """A timestamp column as it is, a text column as a guarded cast."""
    return safe_timestamp(ts_col) if isinstance(df.schema[ts_col].dataType, StringType) else F.col(ts_col)


def after_cursor(df: DataFrame, ts_col: str, cursor: str | None, inclusive: bool) -> DataFrame:
    """Rows newer than the cursor (see :func:`passes_cursor`)."""
    return df.filter(passes_cursor(df, ts_col, cursor, inclusive)) if cursor else df


def latest_per_key(df: DataFrame, key: str, ts_col: str, ordinal: str = "_ordinal") -> DataFrame:
    """Newest row per key; on equal times the first seen stays.

    Partial ``WindowGroupLimit`` before the shuffle: a hot key sends at
    most one row per map partition.
    """
    return keep_latest(df, key, [F.col(ts_col).desc(), F.col(ordinal).asc()])
