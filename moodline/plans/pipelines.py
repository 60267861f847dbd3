"""Ingestion runs (tickets, orders) over landed files, end to end.

One run: list the landed files that no earlier run has processed -> read them
once -> normalise, apply the cursor, and **stage** accepted and rejected rows
and unparseable payloads in one frame (Parquet under the shared checkpoint
folder, removed after the run; counters, also of the rows the cursor skips, taken by ``observe`` during that single write) -> good rows
merged into the raw table, bad rows merged into the source's dead letters ->
cursor state and file log advanced only after both merges -> audit events.
Staging cuts the lineage, so both branches read the same rows and a lost
executor recomputes from the staged files. Every write goes to a new table
version; a run that fails is repeated over the same files.

Each source has its own dead-letter, cursor and file-log tables, so the two
pipelines, on schedules of their own, never write one table.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from moodline.operators import ingest, quality
from moodline.session import checkpoint_dir, configure
from moodline.sources import landed, pages, sinks
from moodline.sources.schemas import FAILED_RECORDS

RAW = "raw_zone"
SOURCES = ("tickets", "orders")


def failed_table(source: str) -> str:
    return f"failed_records__{source}"


def state_table(source: str) -> str:
    return f"_cursor_state__{source}"


def log_table(source: str) -> str:
    return f"_landed_files__{source}"


# Cursor start points of the two sources.
INITIAL_TICKETS_CURSOR = "2026-01-01T00:00:00Z"
INITIAL_ORDERS_CURSOR = "2016-01-01T00:00:00Z"
STARTED, COMPLETED = quality.STARTED, quality.COMPLETED
# Compliance tags of ingestion runs.
COMPLIANCE_TAGS = ("soc2-cc7", "iso27001-a12")


@dataclass
class RunResult:
    run_id: str
    load_id: str
    received: int = 0
    processed: int = 0
    failed: int = 0
    skipped: int = 0  # accepted rows older than the cursor
    cursor: str | None = None
    tables: dict[str, str] = field(default_factory=dict)


def _now_id() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")


def read_failed(store: sinks.TableStore) -> DataFrame:
    """``failed_records`` of all sources."""
    parts = [store.read(RAW, failed_table(s), FAILED_RECORDS) for s in SOURCES]
    return parts[0].unionByName(parts[1])


def read_cursor(store: sinks.TableStore, source: str, initial: str | None) -> str | None:
    """I4: last committed cursor of ``source`` (one row), else ``initial``."""
    state = store.read(RAW, state_table(source))
    row = state.select("cursor").first() if state is not None else None
    return row.cursor if row and row.cursor else initial


def _advance_cursor(store: sinks.TableStore, accepted: DataFrame, source: str, ts_col: str) -> None:
    newest = accepted.agg(F.max(ingest.instant(accepted, ts_col)).alias("m")).select(
        F.date_format("m", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("cursor")).first().cursor
    old = read_cursor(store, source, None)
    # The old cursor stays when the run had no accepted rows, or only older ones that always pass.
    if newest is not None and (old is None or newest > old):
        store.overwrite(store.spark.createDataFrame([(source, newest)], "source string, cursor string")
                        .withColumn("updated_at", F.current_timestamp()), RAW, state_table(source))


def unprocessed(store: sinks.TableStore, source: str, paths: str | list[str]) -> DataFrame:
    """Landed files (path, modified, length) that no committed run has read; a changed file counts as new."""
    found = landed.landed_files(store.spark, paths)
    log = store.read(RAW, log_table(source))
    return found if log is None else found.join(log.select("path", "modified", "length"),
                                                ["path", "modified", "length"], "left_anti")


def _stage(spark: SparkSession, norm: DataFrame, passes: Column, res: RunResult) -> tuple[DataFrame, str]:
    """Rejected rows and accepted ones that pass the cursor, written once; the counters come from that write."""
    path = f"{checkpoint_dir(spark)}/staged/{res.run_id}-{uuid.uuid4().hex}"  # a repeated run id stages anew
    good, obs = F.col("error_message").isNull(), Observation(f"stage-{uuid.uuid4().hex}")
    (norm.withColumn("_passes", F.coalesce(passes, F.lit(False)))
     .observe(obs, F.count_if(good & F.col("_passes")).alias("accepted"), F.count_if(good & ~F.col("_passes")).alias("skipped"),
              F.count_if(~good).alias("failed"))
     .where(~good | F.col("_passes")).drop("_passes")
     .withColumn("raw_record", F.when(~good, F.col("raw_record")))  # only dead letters hold it
     .write.mode("errorifexists").parquet(path))
    res.processed, res.failed, res.skipped = (obs.get[c] for c in ("accepted", "failed", "skipped"))
    res.received = res.processed + res.failed + res.skipped
    return spark.read.schema(norm.schema).parquet(path), path


def merge_tickets(store: sinks.TableStore, staged: DataFrame, pipeline: str, source: str, newest: bool = False) -> dict[str, str]:
    """Merge staged tickets: accepted rows by ticket_id, rejected ones by payload hash.

    With ``newest`` a stored ticket that is newer than the staged copy stays.
    """
    return {"raw_tickets": store.merge(
                ingest.good_rows(staged).drop("_source", "_ordinal"), RAW, "raw_tickets", "ticket_id",
                [F.col("created_at").desc(), F.col("_row_id").desc()], newest),
            "failed_records": store.merge(
                ingest.failed_records(staged, pipeline, source).select(*FAILED_RECORDS.fieldNames()),
                RAW, failed_table("tickets"), "record_hash", [F.col("failed_at").desc()])}


def _audit(spark, audit_path, pipeline, run_id, event_type, status, details):
    if audit_path:
        sinks.append_json(quality.audit_event(spark, pipeline, run_id, event_type, status,
                                              details=details, compliance_tags=COMPLIANCE_TAGS),
                          audit_path)


def _run(spark: SparkSession, store: sinks.TableStore, source: str, pipeline: str, paths: str | list[str],
         audit_path: str | None, run_id: str | None, load_id: str | None, initial_cursor: str | None,
         work) -> RunResult:
    """Common frame of a run: audit events, new files, cursor, file log."""
    configure(spark)
    res = RunResult(run_id or str(uuid.uuid4()), load_id or _now_id())
    began = dt.datetime.now(dt.timezone.utc)

    def done(status: str, **more) -> None:
        elapsed = (dt.datetime.now(dt.timezone.utc) - began).total_seconds()
        _audit(spark, audit_path, pipeline, res.run_id, COMPLETED, status,
               {"records_processed": res.processed, "records_failed": res.failed, "records_skipped": res.skipped,
                "elapsed_seconds": elapsed, **more})

    _audit(spark, audit_path, pipeline, res.run_id, STARTED, "started", {"dataset": RAW, "source": str(paths)})
    try:
        cursor = read_cursor(store, source, initial_cursor)
        files = unprocessed(store, source, paths).collect()  # the run's file list, as a listing is
        if files:
            work(res, sorted(f.path for f in files), cursor)
            log = spark.createDataFrame([(f.path, f.modified, f.length, res.run_id) for f in files],
                                        "path string, modified timestamp, length long, run_id string")
            store.append(log.coalesce(1), RAW, log_table(source))
        res.cursor = read_cursor(store, source, None)
    except Exception as exc:
        done("failure", error=str(exc))
        raise
    done("success")
    return res


def run_ticket_ingestion(spark: SparkSession, store: sinks.TableStore, landing: str | list[str],
                         audit_path: str | None = None, run_id: str | None = None,
                         load_id: str | None = None, whole_files: bool = True,
                         on_malformed: str = "dead_letter",
                         initial_cursor: str | None = INITIAL_TICKETS_CURSOR, page_source: bool = False) -> RunResult:
    """T1 in batch form: new landed ticket payloads -> raw_tickets + dead letters.

    ``on_malformed='fail'`` raises while staging, before any merge. With
    ``page_source`` whole pages come through the ``ticket_pages`` data source,
    which applies the cursor itself: older records are skipped and counted
    there, before validation.
    """
    pipeline = "tickets_pipeline"

    def work(res: RunResult, files: list[str], cursor: str | None) -> None:
        seen = None
        if page_source:
            rows, seen = pages.read_pages(spark, files, cursor)
        else:
            payloads = (landed.read_ticket_payloads(spark, files) if whole_files else
                        spark.read.text(files).select("value", F.col("_metadata.file_path").alias("_source")))
            rows = landed.unwrap_payloads(payloads)
        norm = ingest.normalize_tickets(rows, res.load_id, on_malformed=on_malformed)
        staged, stage = _stage(spark, norm, ingest.passes_cursor(norm, "created_at", cursor, inclusive=True), res)
        if seen is not None:
            res.skipped += seen.get["skipped"]
            res.received += seen.get["skipped"]
        res.tables |= merge_tickets(store, staged, pipeline, "ticket_api")
        _advance_cursor(store, ingest.good_rows(staged), "tickets", "created_at")
        store.remove(stage)

    return _run(spark, store, "tickets", pipeline, landing, audit_path, run_id, load_id, initial_cursor, work)


def run_order_ingestion(spark: SparkSession, store: sinks.TableStore, csv_path: str | list[str],
                        audit_path: str | None = None, run_id: str | None = None,
                        load_id: str | None = None, on_malformed: str = "dead_letter",
                        cursor_column: str = "order_purchase_timestamp",
                        initial_cursor: str | None = INITIAL_ORDERS_CURSOR,
                        strict_ids: bool = False, multi_line: bool = False) -> RunResult:
    """New orders CSV files -> raw_orders + dead letters (strict cursor, newest per order).

    ``processed`` counts orders after cursor and dedupe. With another
    ``cursor_column`` rows without that value always pass.
    """
    pipeline = "orders_pipeline"

    def work(res: RunResult, files: list[str], cursor: str | None) -> None:
        rows = landed.read_orders_csv(spark, files, multi_line)
        norm = ingest.normalize_orders(rows, res.load_id, on_malformed=on_malformed, strict_ids=strict_ids)
        staged, stage = _stage(spark, norm, ingest.passes_cursor(norm, cursor_column, cursor, inclusive=False), res)
        good = ingest.good_rows(staged)
        res.processed = good.agg(F.count_distinct("order_id")).first()[0]
        latest = ingest.latest_per_key(good, "order_id", "order_purchase_timestamp")
        res.tables["raw_orders"] = store.merge(latest.drop("_source", "_ordinal"), RAW, "raw_orders", "order_id",
                                               empty=not res.processed)
        res.tables["failed_records"] = store.merge(
            ingest.failed_records(staged, pipeline, "orders_csv"), RAW, failed_table("orders"), "record_hash",
            [F.col("failed_at").desc()])
        _advance_cursor(store, good, "orders", cursor_column)
        store.remove(stage)

    return _run(spark, store, "orders", pipeline, csv_path, audit_path, run_id, load_id, initial_cursor, work)
