"""Structured Streaming forms of ticket ingestion (T1) and the heatmap.

T1: landed payload files -> ``readStream`` -> per micro-batch: unwrap,
normalise, stage, merge good rows into ``raw_tickets`` and bad rows into
``failed_records``. The stream checkpoint replaces the cursor: each file
is processed once, and a retried epoch re-merges the same rows, which
leaves the tables unchanged (merge by key into a new version). Copies of a
ticket in one epoch are reduced to the newest; a copy in a later epoch
replaces the stored one, whatever its time.

T2: hourly region heatmap with a watermark. A window is emitted once the
watermark passes its end, and duplicates are dropped within the watermark
(first copy kept), so it is a low-latency view; the batch model M6 stays
the source of truth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from moodline.functions.casts import blank_to
from moodline.operators import ingest, quality
from moodline.plans.pipelines import COMPLETED, COMPLIANCE_TAGS, STARTED, merge_tickets
from moodline.session import checkpoint_dir, configure
from moodline.sources import landed, sinks

PIPELINE, SOURCE = "tickets_pipeline", "ticket_api"


def payload_stream(spark: SparkSession, landing: str, whole_files: bool = True,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming S1: one row per payload (per file, or per line)."""
    reader = spark.readStream.format("text")
    if whole_files:
        reader = reader.option("wholetext", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(landing).select("value", F.col("_metadata.file_path").alias("_source"))


def merge_batch(store: sinks.TableStore, staging_root: str, audit_path: str | None = None,
                run_prefix: str = "stream"):
    """``foreachBatch`` body of T1 (usable on any payload micro-batch).

    With ``audit_path``, each epoch emits ``pipeline_started`` and
    ``pipeline_completed`` events (run id ``<prefix>:<epoch>``), its counts
    observed during the single staging write.
    """

    def audit(spark, epoch_id, event_type, status, details):
        if audit_path:
            sinks.append_json(quality.audit_event(
                spark, PIPELINE, f"{run_prefix}:{epoch_id}", event_type, status, details=details,
                compliance_tags=COMPLIANCE_TAGS), audit_path)

    def process(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        audit(spark, epoch_id, STARTED, "started", {"epoch": epoch_id})
        norm = ingest.normalize_tickets(landed.unwrap_payloads(batch), load_id=f"{epoch_id:012d}")
        path = f"{staging_root}/epoch={epoch_id}"
        obs = Observation(f"t1-{run_prefix}-{epoch_id}")
        # A retried epoch rewrites its own stage.
        norm.observe(obs, F.count_if(F.col("error_message").isNull()).alias("records_processed"),
                     F.count_if(F.col("error_message").isNotNull()).alias("records_failed")
                     ).write.mode("overwrite").parquet(path)
        merge_tickets(store, spark.read.schema(norm.schema).parquet(path), PIPELINE, SOURCE)
        store.remove(path)
        audit(spark, epoch_id, COMPLETED, "success", dict(obs.get))

    return process


def start_ticket_merge(spark: SparkSession, store: sinks.TableStore, landing: str,
                       checkpoint_location: str | None = None, whole_files: bool = True,
                       max_files_per_trigger: int | None = None,
                       available_now: bool = True, processing_time: str | None = None,
                       audit_path: str | None = None) -> StreamingQuery:
    """Start the micro-batch merge; ``availableNow`` drains and stops."""
    configure(spark)
    ckpt = checkpoint_location or f"{checkpoint_dir(spark)}/streams/ticket_merge"
    writer = (payload_stream(spark, landing, whole_files, max_files_per_trigger)
              .writeStream.foreachBatch(merge_batch(store, f"{ckpt}/_staged", audit_path))
              .option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time or "15 minutes")
    return writer.start()


def heatmap_stream(good_tickets: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Streaming region x hour heatmap over accepted tickets."""
    deduped = (good_tickets.withWatermark("created_at", watermark)
               .dropDuplicatesWithinWatermark(["ticket_id"]))
    agg = (deduped.groupBy(F.window("created_at", "1 hour").alias("w"),
                           blank_to("customer_region", "unknown").alias("region"))
           .agg(F.avg("sentiment_score").alias("avg_sentiment_score"),
                F.count(F.lit(1)).alias("ticket_count")))
    return agg.select("region", F.to_date(F.col("w.start")).alias("sentiment_date"),
                      F.hour(F.col("w.start")).cast("int").alias("sentiment_hour"),
                      "avg_sentiment_score", "ticket_count")


def start_heatmap(spark: SparkSession, landing: str, output: str, checkpoint_location: str | None = None,
                  watermark: str = "1 hour", max_files_per_trigger: int | None = None,
                  available_now: bool = True, whole_files: bool = True) -> StreamingQuery:
    """Landed payloads -> accepted tickets -> hourly heatmap, appended as Parquet."""
    configure(spark)
    ckpt = checkpoint_location or f"{checkpoint_dir(spark)}/streams/heatmap"
    records, _bad = landed.unwrap_envelope(payload_stream(spark, landing, whole_files, max_files_per_trigger))
    good = ingest.good_rows(ingest.normalize_tickets(records, load_id="stream").drop("_record"))
    writer = (heatmap_stream(good, watermark).writeStream.outputMode("append").format("parquet")
              .option("path", output).option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
