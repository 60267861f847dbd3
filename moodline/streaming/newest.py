"""T1 with newest-wins across epochs, and progress of streams as audit events.

``newest_tickets`` keeps, per ticket, the time and row id of the newest copy
seen so far in a RocksDB state store (``transformWithState``) and lets only
copies pass that are newer. A copy that arrives late, in whatever epoch, ends
there; it never reaches the merge. State that saw no newer copy for ``keep``
outlives its time to live and goes; should an old copy come after that, the
merge still holds it against the stored row. Tickets are grouped in ``BUCKETS``
buckets with an entry of map state each, as Python pays milliseconds per group.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery, StreamingQueryListener

from moodline.operators import ingest, quality
from moodline.plans.pipelines import merge_tickets
from moodline.session import checkpoint_dir, configure
from moodline.sources import landed, sinks
from moodline.streaming.tickets import PIPELINE, SOURCE, payload_stream

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Only what changed since the last snapshot is uploaded per epoch.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
BUCKETS = 4096
NO_DATA_EPOCHS = "spark.sql.streaming.noDataMicroBatches.enabled"
TICKET_ROW = ("_bucket int, ticket_id string, customer_id string, created_at long, sentiment_score double, sentiment_label string, "
              "status string, channel string, priority string, customer_region string, customer_tier string, _load_id string, "
              "_row_id string, _record string, raw_record string, error_message string")


class _Newest(StatefulProcessor):
    """Rows of one bucket of tickets: a ticket's newest one passes if it is newer than all before; rejected rows pass as they are."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "ticket_id string", "micros long, row_id string", ttlDurationMs=self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest: dict[str, tuple[tuple[int, str], Row]] = {}
        for row in rows:
            if row.error_message is not None:
                yield row
                continue
            at = (row.created_at, row._row_id)
            if row.ticket_id not in newest or at > newest[row.ticket_id][0]:
                newest[row.ticket_id] = at, row
        for ticket, (at, row) in newest.items():
            held = self.seen.getValue((ticket,))
            if held is None or at > tuple(held):
                self.seen.updateValue((ticket,), at)
                yield row

    def close(self) -> None:
        pass


def newest_tickets(normalized: DataFrame, keep: dt.timedelta = dt.timedelta(days=30)) -> DataFrame:
    """Normalised tickets of a stream -> rejected rows, and accepted ones newer than every earlier copy.

    Instants travel as microseconds, the record as text.
    """
    names = [f.split()[0] for f in TICKET_ROW.split(", ")[1:]]
    rejected = F.col("error_message").isNotNull()
    keyed = normalized.withColumns({
        "_bucket": F.pmod(F.xxhash64(F.when(rejected, F.col("raw_record")).otherwise(F.col("ticket_id"))), F.lit(BUCKETS)).cast("int"),
        "created_at": F.unix_micros("created_at"), "_record": F.to_json("_record", {"ignoreNullFields": "false"})}).select("_bucket", *names)
    out = keyed.groupBy("_bucket").transformWithState(
        _Newest(int(keep.total_seconds() * 1000)), TICKET_ROW, "Update", "processingTime")
    return out.drop("_bucket").withColumns({"created_at": F.timestamp_micros("created_at"), "_record": F.try_parse_json("_record")})


def start_newest_tickets(spark: SparkSession, store: sinks.TableStore, landing: str, checkpoint_location: str | None = None,
                         whole_files: bool = True, max_files_per_trigger: int | None = None,
                         keep: dt.timedelta = dt.timedelta(days=30), available_now: bool = True) -> StreamingQuery:
    """T1, the newest copy of a ticket wins whatever epoch it lands in; rejected rows go to the dead letters."""
    configure(spark)
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    ckpt = checkpoint_location or f"{checkpoint_dir(spark)}/streams/newest_tickets"
    payloads = payload_stream(spark, landing, whole_files, max_files_per_trigger)
    normalized = ingest.normalize_tickets(landed.unwrap_payloads(payloads), load_id="stream").drop("_source", "_ordinal")

    def process(batch: DataFrame, epoch_id: int) -> None:
        path = f"{ckpt}/_staged/epoch={epoch_id}"
        batch.write.mode("overwrite").parquet(path)  # a retried epoch rewrites its own stage
        staged = batch.sparkSession.read.schema(batch.schema).parquet(path).withColumn("_load_id", F.lit(f"{epoch_id:012d}"))
        merge_tickets(store, staged, PIPELINE, SOURCE, newest=True)
        store.remove(path)

    writer = (newest_tickets(normalized, keep).writeStream.outputMode("update").foreachBatch(process)
              .option("checkpointLocation", ckpt))
    if not available_now:
        return writer.trigger(processingTime="1 minute").start()
    # Timers ask for epoch after epoch, so a stream that drains its input and stops runs none without data.
    idle = spark.conf.get(NO_DATA_EPOCHS)
    spark.conf.set(NO_DATA_EPOCHS, "false")
    try:
        return writer.trigger(availableNow=True).start()  # the stream keeps the settings it started with
    finally:
        spark.conf.set(NO_DATA_EPOCHS, idle)


class ProgressAudit(StreamingQueryListener):
    """Audit events of every epoch of the session's streams: rows read, watermark, rows it dropped, state rows.

    ``spark.streams.addListener(ProgressAudit(spark, path))``; the events are one-row appends made after the epoch.
    """

    def __init__(self, spark: SparkSession, audit_path: str, pipeline: str = "stream"):
        self.spark, self.audit_path, self.pipeline = spark, audit_path, pipeline

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        states = progress.get("stateOperators", [])
        details = {
            "epoch": progress["batchId"], "rows": progress.get("numInputRows", 0), "watermark": progress.get("eventTime", {}).get("watermark"),
            "late_rows": sum(s.get("numRowsDroppedByWatermark", 0) for s in states), "state_rows": sum(s.get("numRowsTotal", 0) for s in states)}
        sinks.append_json(quality.audit_event(self.spark, self.pipeline, f"{progress['runId']}:{progress['batchId']}", "stream_progress",
                                              "success", details=details), self.audit_path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def stream_progress(audit: DataFrame) -> DataFrame:
    """V8: the progress events of :class:`ProgressAudit`, typed."""
    d = F.col("details")
    kinds = {"epoch": "long", "rows": "long", "watermark": "timestamp", "late_rows": "long", "state_rows": "long"}
    return audit.where("event_type = 'stream_progress'").select(
        "pipeline_name", "run_id", *[F.try_variant_get(d, f"$.{c}", t).alias(c) for c, t in kinds.items()])
