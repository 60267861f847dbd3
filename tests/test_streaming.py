"""T1 equals the batch merge; a restart on the same checkpoint changes nothing."""

from pyspark.sql import functions as F

from moodline.operators import ingest, staging
from moodline.sources import derived, landed
from moodline.sources.sinks import TableStore
from moodline.streaming.tickets import start_heatmap, start_ticket_merge
from tests.conftest import SF_SMALL


def test_stream_merge_matches_batch_and_restarts_cleanly(spark, scratch):
    events = derived.read_table(spark, SF_SMALL, "events")
    landing = f"{scratch}/landing"
    derived.ticket_payloads(events).repartition(4, "_source").select("value").write.text(landing)
    store = TableStore(spark, f"{scratch}/wh")
    ckpt = f"{scratch}/ckpt"
    audit = f"{scratch}/audit"
    start_ticket_merge(spark, store, landing, checkpoint_location=ckpt, max_files_per_trigger=1,
                       audit_path=audit, whole_files=False).awaitTermination()
    cols = ["ticket_id", "created_at", "sentiment_score", "_row_id"]
    streamed = sorted(map(tuple, store.read("raw_zone", "raw_tickets").select(*cols).collect()))
    recs, _ = landed.unwrap_envelope(derived.ticket_payloads(events))
    good = ingest.good_rows(ingest.normalize_tickets(recs, "x"))
    batch = staging.keep_latest(good, "ticket_id", [F.col("created_at").desc(), F.col("_row_id").desc()])
    assert streamed == sorted(map(tuple, batch.select(*cols).collect()))
    ev = spark.read.json(audit)
    done = ev.filter("event_type = 'pipeline_completed'")
    assert done.count() == 4 == ev.filter("event_type = 'pipeline_started'").count()  # 4 files, 1 per epoch
    assert done.agg(F.sum("details.records_processed")).first()[0] == good.count()
    versions = len(store.versions("raw_zone", "raw_tickets"))
    start_ticket_merge(spark, store, landing, checkpoint_location=ckpt, whole_files=False).awaitTermination()
    assert len(store.versions("raw_zone", "raw_tickets")) == versions  # nothing new to process


def test_stream_heatmap_emits_closed_windows(spark, scratch):
    events = derived.read_table(spark, SF_SMALL, "events")
    landing = f"{scratch}/landing"
    derived.ticket_payloads(events).repartition(2, "_source").select("value").write.text(landing)
    start_heatmap(spark, landing, f"{scratch}/out", checkpoint_location=f"{scratch}/ck",
                  whole_files=False).awaitTermination()
    out = spark.read.parquet(f"{scratch}/out")
    assert out.count() > 0
    assert out.agg(F.max("ticket_count")).first()[0] >= 1
    assert set(out.columns) == {"region", "sentiment_date", "sentiment_hour", "avg_sentiment_score", "ticket_count"}


def test_whole_files_stream_like_the_batch(spark, scratch):
    import json
    import os

    from moodline.plans import pipelines
    os.makedirs(f"{scratch}/land")
    with open(f"{scratch}/land/a.json", "w") as fh:
        json.dump({"data": [{"ticket_id": i, "customer_id": "c", "created_at": "2026-03-01T10:00:00Z",
                             "sentiment_score": s} for i, s in ((1, "0.5"), (2, ""))]}, fh, indent=2)
    store = TableStore(spark, f"{scratch}/wh")
    start_ticket_merge(spark, store, f"{scratch}/land", checkpoint_location=f"{scratch}/ck").awaitTermination()
    assert store.read("raw_zone", "raw_tickets").count() == 1 and pipelines.read_failed(store).count() == 1


def test_newest_copies_stay_when_tickets_share_a_bucket(spark, scratch, monkeypatch):
    import json

    from moodline.streaming import newest
    monkeypatch.setattr(newest, "BUCKETS", 2)
    store = TableStore(spark, f"{scratch}/wh", merge_buckets=2)
    for day in ({i: 5 for i in range(10)}, {i: 4 + 2 * (i % 2) for i in range(10)}):
        lines = [(json.dumps([{"ticket_id": i, "customer_id": "c", "created_at": f"2026-03-0{d}T10:00:00Z", "sentiment_score": s}
                              for s in ("0.5", "n/a")]),) for i, d in day.items()]
        spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(f"{scratch}/land")
        newest.start_newest_tickets(spark, store, f"{scratch}/land", checkpoint_location=f"{scratch}/ck", whole_files=False).awaitTermination()
    got = {int(r.ticket_id): r.created_at.day for r in store.read("raw_zone", "raw_tickets").collect()}
    assert got == {i: 6 if i % 2 else 5 for i in range(10)}
