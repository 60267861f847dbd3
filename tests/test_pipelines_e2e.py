"""Ingestion runs, reruns, cursors, audit and the model DAG end to end."""

import json
import os

from pyspark.sql import functions as F

from moodline.operators import ingest, quality
from moodline.plans import dag, pipelines
from moodline.session import checkpoint_dir
from moodline.sources import derived
from moodline.sources.sinks import TableStore
from tests.conftest import SF_SMALL


def _land_tickets(spark, scratch):
    path = f"{scratch}/landing/tickets"
    derived.ticket_payloads(derived.read_table(spark, SF_SMALL, "events")) \
        .repartition(4, "_source").select("value").write.text(path)
    with open(f"{scratch}/bad.json", "w") as fh:
        fh.write('{"unexpected": true}')
    return path


def _table(store, name):
    return store.read("raw_zone", name)


def test_ticket_ingestion_and_rerun(spark, scratch):
    landing = _land_tickets(spark, scratch)
    store = TableStore(spark, f"{scratch}/wh")
    audit = f"{scratch}/audit"
    r1 = pipelines.run_ticket_ingestion(spark, store, [landing], audit_path=audit, run_id="run-1",
                                        load_id="0001", whole_files=False, initial_cursor=None)
    assert r1.received == r1.processed + r1.failed and r1.failed > 0
    assert not os.listdir(f"{checkpoint_dir(spark).removeprefix('file:')}/staged")  # a run's stage goes with the run
    raw = _table(store, "raw_tickets")
    good_ids = raw.select("ticket_id").distinct().count()
    assert raw.count() == good_ids                       # one row per key
    fr = pipelines.read_failed(store)
    n_failed = fr.count()
    assert n_failed == r1.failed
    snapshot = sorted(map(tuple, raw.drop("_record", "_load_id").collect()))
    failed_at = {r.record_hash: r.failed_at for r in fr.collect()}
    # Rerun of the same files: nothing is read again, the tables do not change.
    r2 = pipelines.run_ticket_ingestion(spark, store, [landing], audit_path=audit, run_id="run-2",
                                        load_id="0002", whole_files=False, initial_cursor=None)
    assert (r2.received, r2.processed, r2.failed, r2.cursor) == (0, 0, 0, r1.cursor)
    assert {r.record_hash: r.failed_at for r in pipelines.read_failed(store).collect()} == failed_at
    raw2 = _table(store, "raw_tickets")
    assert sorted(map(tuple, raw2.drop("_record", "_load_id").collect())) == snapshot
    assert len(store.versions("raw_zone", "raw_tickets")) == 1
    # Extra keys stay queryable in the kept record.
    assert raw2.filter(F.try_variant_get("_record", "$.metadata.channel", "string").isNotNull()).count() > 0
    # Audit: a started and a completed event per run, as JSON lines.
    ev = spark.read.json(audit)
    assert ev.count() == 4
    done = ev.filter("event_type = 'pipeline_completed'").orderBy("run_id").collect()
    assert [d.status for d in done] == ["success", "success"]
    assert done[0].details.records_processed == r1.processed
    runs = {r.run_id: r for r in quality.run_durations(quality.read_audit(spark, audit)).collect()}
    assert (runs["run-1"].outcome, runs["run-1"].records_processed, runs["run-1"].records_failed) == (
        "success", r1.processed, r1.failed)
    assert runs["run-1"].duration_seconds > 0 and runs["run-2"].records_processed == 0
    stored = raw2.count()  # a merge replaces partitions in place, so a frame read before it ends with it
    # A file landed later is the only one staged by the next run.
    with open(f"{landing}/late.txt", "w") as fh:
        fh.write('{"tickets":[{"ticket_id":"late","customer_id":"c","created_at":"2099-01-01T00:00:00Z",'
                 '"sentiment_score":0.5},{"ticket_id":"old","customer_id":"c","created_at":"1999-01-01T00:00:00Z",'
                 '"sentiment_score":0.5}]}')
    r3 = pipelines.run_ticket_ingestion(spark, store, [landing], whole_files=False, initial_cursor=None)
    # The older ticket of that file is skipped, and counted.
    assert (r3.received, r3.processed, r3.failed, r3.skipped) == (2, 1, 0, 1) and r3.cursor.startswith("2099")
    assert _table(store, "raw_tickets").count() == stored + 1


def test_bad_payload_is_dead_lettered(spark, scratch):
    os.makedirs(f"{scratch}/land", exist_ok=True)
    with open(f"{scratch}/land/a.json", "w") as fh:
        json.dump({"tickets": [{"ticket_id": 1, "customer_id": "c", "created_at": "2026-03-01T10:00:00Z",
                                "sentiment_score": "-0.5"}]}, fh)
    with open(f"{scratch}/land/b.json", "w") as fh:
        fh.write('{"next_page_token": "x"}')
    store = TableStore(spark, f"{scratch}/wh")
    r = pipelines.run_ticket_ingestion(spark, store, f"{scratch}/land", initial_cursor=None)
    assert (r.processed, r.failed) == (1, 1)
    fr = pipelines.read_failed(store).collect()
    assert [f.error_message for f in fr] == ["Unsupported ticket API response shape"]
    assert r.cursor.startswith("2026-03-01T10:00:00")


def test_order_ingestion_cursor_is_strict(spark, scratch):
    path = f"{scratch}/landing/orders"
    derived.landed_order_rows(derived.read_table(spark, SF_SMALL, "orders"),
                              derived.read_table(spark, SF_SMALL, "lineitem")) \
        .drop("_ordinal").write.option("header", True).csv(path)
    store = TableStore(spark, f"{scratch}/wh")
    r1 = pipelines.run_order_ingestion(spark, store, path)
    raw = _table(store, "raw_orders")
    assert raw.count() == raw.select("order_id").distinct().count() == 750  # oracle latest_orders at sf0.001
    # Same file again: nothing is newer than the cursor, the table keeps its rows.
    r2 = pipelines.run_order_ingestion(spark, store, path)
    assert r2.cursor == r1.cursor and (r1.processed, r2.processed) == (750, 0)
    assert _table(store, "raw_orders").count() == 750  # oracle latest_orders at sf0.001


def test_model_dag_counts(spark, scratch):
    store = TableStore(spark, f"{scratch}/wh")
    store.overwrite(derived.raw_tickets_at(spark, SF_SMALL), "raw_zone", "raw_tickets")
    store.overwrite(derived.raw_orders_at(spark, SF_SMALL), "raw_zone", "raw_orders")
    paths = dag.run_models(spark, store, as_of="2024-02-01 00:00:00")
    counts = {name: spark.read.parquet(p).count() for name, p in paths.items()}
    assert counts == {"stg_tickets": 500, "stg_orders": 750, "fact_sentiment_daily": 306,
                      "high_risk_customers": 31, "high_risk_table": 31, "sentiment_heatmap": 487}
    bands = {r.risk_band: r["count"] for r in
             store.read("enrichment", "high_risk_customers").groupBy("risk_band").count().collect()}
    assert bands == {"critical": 7, "high": 9, "medium": 15}


def test_audit_event_one_json_line(spark, scratch):
    ev = quality.audit_event(spark, "orders_pipeline", "r-1", "pipeline_completed", "success",
                             details={"records_processed": 10}, compliance_tags=["soc2-cc7"])
    out = f"{scratch}/audit"
    ev.write.json(out)
    lines = [ln for f in os.listdir(out) if f.endswith(".json") for ln in open(f"{out}/{f}")]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["details"]["records_processed"] == 10 and rec["status"] == "success"


def test_dashboard_extract_and_versions(spark, scratch):
    from moodline.operators import dashboard
    from moodline.sources.sinks import export_extract
    store = TableStore(spark, f"{scratch}/wh")
    heat = dashboard.sentiment_heatmap(
        __import__("moodline.operators.staging", fromlist=["x"]).stg_tickets(derived.raw_tickets_at(spark, SF_SMALL)))
    p1 = store.overwrite(heat, "dashboard", "sentiment_heatmap")
    p2 = store.overwrite(heat, "dashboard", "sentiment_heatmap")
    assert store.versions("dashboard", "sentiment_heatmap") == [p1, p2] and store.current(
        "dashboard", "sentiment_heatmap") == p2
    export_extract(store.read("dashboard", "sentiment_heatmap"), f"{scratch}/extract", "csv")
    back = spark.read.option("header", True).csv(f"{scratch}/extract")
    assert back.count() == 487


def test_bucketed_merge_rewrites_only_touched_buckets(spark, scratch):
    from moodline.operators.merge import merge_by_key
    store = TableStore(spark, f"{scratch}/wh", merge_buckets=8)
    rows = derived.raw_tickets_at(spark, SF_SMALL).select("ticket_id", "_row_id", "created_at")
    order = [F.col("created_at").desc(), F.col("_row_id").desc()]
    first = rows.filter(F.col("_row_id") < "0000000600")
    store.merge(first, "raw_zone", "t", "ticket_id", order)
    small = rows.filter(F.col("ticket_id").isin("1", "2", "3"))
    store.merge(small, "raw_zone", "t", "ticket_id", order)
    got = sorted(map(tuple, store.read("raw_zone", "t").drop("_bucket").collect()))
    want = sorted(map(tuple, merge_by_key(merge_by_key(None, first, "ticket_id", order), small,
                                          "ticket_id", order).collect()))
    assert got == want
    # The second merge replaced only the partitions that the 3 keys hash to, in the one version there is.
    import glob
    assert len(store.versions("raw_zone", "t")) == 1
    files = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{scratch}/wh/raw_zone/t/v*/_bucket_8__ticket_id=*/*.parquet")}
    one = rows.filter(F.col("ticket_id") == "1")
    store.merge(one, "raw_zone", "t", "ticket_id", order)
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{scratch}/wh/raw_zone/t/v*/_bucket_8__ticket_id=*/*.parquet")}
    changed = {os.path.dirname(f) for f in files.keys() ^ after.keys() | {f for f in files if files[f] != after.get(f)}}
    assert len(changed) == 1 < len({os.path.dirname(f) for f in after})
    assert sorted(map(tuple, store.read("raw_zone", "t").collect())) == want
    # The merge target is a table of the session's catalog, with the same rows.
    assert spark.table(store.catalog_table("raw_zone", "t")).count() == len(want)


def test_merge_after_a_killed_commit(spark, scratch):
    """Partitions that were removed, but not yet replaced, come back from the pending rows."""
    import glob
    import shutil
    store = TableStore(spark, f"{scratch}/wh", merge_buckets=4)
    store.merge(spark.range(100).select("id", F.lit(1).alias("v")), "raw_zone", "t", "id")
    path = store.current("raw_zone", "t")
    newer = spark.range(50).select("id", F.lit(2).alias("v"))
    # As left behind by a driver that died while it replaced the partitions.
    spark.read.parquet(path).where("id >= 50").unionByName(newer.withColumn("_bucket_4__id", F.expr("pmod(xxhash64(id), 4)").cast("int"))) \
        .write.partitionBy("_bucket_4__id").parquet(f"{scratch}/wh/raw_zone/t/_pending")
    for part in glob.glob(f"{path}/_bucket_4__id=[01]"):
        shutil.move(part, f"{scratch}/lost-{os.path.basename(part)}")
    fresh = TableStore(spark, f"{scratch}/wh", merge_buckets=4)
    fresh.merge(spark.range(200, 201).select("id", F.lit(3).alias("v")), "raw_zone", "t", "id")
    got = {r.id: r.v for r in fresh.read("raw_zone", "t").collect()}
    assert got == {**{k: 2 for k in range(50)}, **{k: 1 for k in range(50, 100)}, 200: 3}


def test_a_large_bucket_is_written_by_many_tasks(spark, scratch):
    import glob
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "64k")
    try:
        store = TableStore(spark, f"{scratch}/wh", merge_buckets=1)
        rows = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
        store.merge(rows, "raw_zone", "t", "id")
        store.merge(rows.where("id < 10"), "raw_zone", "t", "id")
    finally:
        spark.conf.unset(size)
    assert len(glob.glob(f"{scratch}/wh/raw_zone/t/v*/_bucket_1__id=0/*.parquet")) > 4
    assert store.read("raw_zone", "t").count() == 60_000


def test_ticket_ingestion_bucketed_equals_plain(spark, scratch):
    landing = _land_tickets(spark, scratch)
    plain = TableStore(spark, f"{scratch}/plain", merge_buckets=None)
    bucketed = TableStore(spark, f"{scratch}/bucketed", merge_buckets=16)
    for store in (plain, bucketed):
        for run in ("a", "b"):  # second run = rerun of the same files
            pipelines.run_ticket_ingestion(spark, store, [landing], run_id=f"{run}-{id(store)}",
                                           load_id="0001", whole_files=False, initial_cursor=None)
    cols = ["ticket_id", "customer_id", "created_at", "sentiment_score", "_row_id"]
    assert sorted(map(tuple, bucketed.read("raw_zone", "raw_tickets").select(*cols).collect())) == \
        sorted(map(tuple, plain.read("raw_zone", "raw_tickets").select(*cols).collect()))
    assert pipelines.read_failed(bucketed).count() == pipelines.read_failed(plain).count() > 0
    assert pipelines.read_cursor(bucketed, "tickets", None) == pipelines.read_cursor(plain, "tickets", None)


def test_bucketed_read_merges_schemas(spark, scratch):
    store = TableStore(spark, f"{scratch}/wh", merge_buckets=4)
    a = spark.createDataFrame([("k1", 1), ("k2", 2)], "k string, v int")
    store.merge(a, "raw_zone", "t", "k")
    b = spark.createDataFrame([("k3", 3, "new")], "k string, v int, extra string")
    store.merge(b, "raw_zone", "t", "k")
    got = {r.k: r.extra for r in store.read("raw_zone", "t").collect()}
    assert got == {"k1": None, "k2": None, "k3": "new"}


def test_layouts_may_mix_without_losing_rows(spark, scratch):
    def rows(lo, hi):
        return spark.range(lo, hi).select(F.col("id").cast("string").alias("k"), "id")

    def store(name, buckets):
        return TableStore(spark, f"{scratch}/{name}", merge_buckets=buckets)

    store("a", None).merge(rows(0, 100), "raw_zone", "t", "k")
    store("a", 8).merge(rows(100, 110), "raw_zone", "t", "k")
    assert store("a", None).read("raw_zone", "t").count() == 110
    store("b", 8).merge(rows(0, 100), "raw_zone", "t", "k")
    store("b", None).merge(rows(100, 150), "raw_zone", "t", "k")
    assert store("b", 8).read("raw_zone", "t").count() == 150
    store("c", 8).merge(rows(0, 100), "raw_zone", "t", "k")
    store("c", 16).merge(rows(5, 6), "raw_zone", "t", "k")
    assert store("c", 8).read("raw_zone", "t").count() == 100
    # A full refresh of a bucketed table is what is read from then on.
    store("c", 8).overwrite(rows(0, 3), "raw_zone", "t")
    assert store("c", 8).read("raw_zone", "t").count() == 3
    # Without bucketing it is a plain table, which the next merge deals to buckets again.
    import pytest
    store("c", 8).merge(rows(3, 5), "raw_zone", "t", "k")
    assert store("c", 8).read("raw_zone", "t").count() == 5
    with pytest.raises(ValueError, match="bucketed by"):
        store("c", 8).merge(rows(0, 1), "raw_zone", "t", "id")
    # An empty first batch keeps its schema.
    store("d", 4).merge(rows(0, 0), "raw_zone", "t", "k")
    assert store("d", 4).read("raw_zone", "t").columns == ["k", "id"]
    store("d", 4).merge(rows(0, 2), "raw_zone", "t", "k")
    assert store("d", 4).read("raw_zone", "t").count() == 2


def test_retention_spares_what_is_read(spark, scratch):
    store = TableStore(spark, f"{scratch}/wh", merge_buckets=4)
    for i in range(5):
        store.merge(spark.createDataFrame([(f"k{j}", i) for j in range(i, 9)], "k string, v int"), "raw_zone", "t", "k")
        store.overwrite(spark.range(i + 1), "staging", "s")
    before = sorted(map(tuple, store.read("raw_zone", "t").collect()))
    assert store.expire("raw_zone", "t", keep=1) == [] and len(store.expire("staging", "s", keep=2)) == 3
    assert sorted(map(tuple, store.read("raw_zone", "t").collect())) == before
    assert len(store.versions("raw_zone", "t")) == 1 and len(store.versions("staging", "s")) == 2
    assert store.read("staging", "s").count() == 5


def test_sources_keep_their_own_state(spark, scratch):
    store = TableStore(spark, f"{scratch}/wh")
    os.makedirs(f"{scratch}/land")
    with open(f"{scratch}/land/a.json", "w") as fh:
        fh.write("not json")
    with open(f"{scratch}/land/b.json", "w") as fh:
        fh.write('[{"ticket_id":1,"customer_id":"c","created_at":"2026-03-01","sentiment_score":1}]')
    with open(f"{scratch}/orders.csv", "w") as fh:
        fh.write("order_id,customer_id,order_purchase_timestamp\n,c,2026-03-01\no,c,2026-03-02\n")
    t = pipelines.run_ticket_ingestion(spark, store, f"{scratch}/land")
    o = pipelines.run_order_ingestion(spark, store, f"{scratch}/orders.csv")
    assert (t.processed, t.failed, o.processed, o.failed) == (1, 1, 1, 1)
    assert pipelines.read_cursor(store, "tickets", None) == t.cursor != o.cursor
    assert sorted(r.pipeline_name for r in pipelines.read_failed(store).collect()) == [
        "orders_pipeline", "tickets_pipeline"]


def test_fail_policy_raises_before_any_merge_and_passes_clean_data(spark, scratch):
    import pytest
    good = '{"ticket_id":1,"customer_id":"c","created_at":"2026-03-01T00:00:00Z","sentiment_score":1}'
    for name, text in (("clean", f"[{good}]"), ("record", f'[{good},{{"ticket_id":2}}]'), ("payload", '{"x":1}')):
        os.makedirs(f"{scratch}/{name}")
        with open(f"{scratch}/{name}/a.json", "w") as fh:
            fh.write(text)
        store = TableStore(spark, f"{scratch}/wh-{name}")
        if name == "clean":
            assert pipelines.run_ticket_ingestion(spark, store, f"{scratch}/{name}", on_malformed="fail").processed == 1
            continue
        with pytest.raises(Exception, match="Missing required field|Unsupported ticket API"):
            pipelines.run_ticket_ingestion(spark, store, f"{scratch}/{name}", on_malformed="fail",
                                           audit_path=f"{scratch}/audit-{name}", run_id=name)
        assert store.read("raw_zone", "raw_tickets") is None and store.read("raw_zone", "failed_records__tickets") is None
        run = quality.run_durations(quality.read_audit(spark, f"{scratch}/audit-{name}")).first()
        assert run.outcome == "failure"


def test_cursor_text_and_cursor_column(spark, scratch):
    import pytest
    with open(f"{scratch}/orders.csv", "w") as fh:
        fh.write("order_id,customer_id,order_purchase_timestamp,order_delivered_customer_date\n"
                 "a,c,2026-01-01,2026-03-01\nb,c,2026-01-02,\nc,c,2026-01-03,2026-01-05\n")
    store = TableStore(spark, f"{scratch}/wh")
    with pytest.raises(ValueError, match="Unsupported timestamp format: 01/02/2026"):
        pipelines.run_order_ingestion(spark, store, f"{scratch}/orders.csv", initial_cursor="01/02/2026")
    r = pipelines.run_order_ingestion(spark, store, f"{scratch}/orders.csv", initial_cursor="2026-02-01",
                                      cursor_column="order_delivered_customer_date")
    assert sorted(x.order_id for x in store.read("raw_zone", "raw_orders").collect()) == ["a", "b"]
    assert r.cursor.startswith("2026-03-01")


def test_metrics_over_stored_tables(spark, scratch):
    from moodline.plans.metrics import warehouse_metrics
    store = TableStore(spark, f"{scratch}/wh")
    landing = _land_tickets(spark, scratch)
    r = pipelines.run_ticket_ingestion(spark, store, landing, audit_path=f"{scratch}/audit", whole_files=False,
                                       initial_cursor=None)
    store.overwrite(derived.raw_orders_at(spark, SF_SMALL), "raw_zone", "raw_orders")
    dag.run_models(spark, store, as_of="2024-02-01 00:00:00")
    got = {k: df.collect() for k, df in warehouse_metrics(spark, store, "2024-02-01 00:00:00", f"{scratch}/audit").items()}
    assert set(got) == {"failed_ratio", "failure_patterns", "layer_counts", "freshness", "staging_reconciliation",
                        "contract_check", "sentiment_dod", "delayed_orders_dod", "newly_flagged", "owner_queue",
                        "run_durations"}
    assert {x.pipeline_name: x.failed for x in got["failed_ratio"]} == {"tickets_pipeline": r.failed, "orders_pipeline": 0}
    assert all(x.passed for x in got["contract_check"]) and len(got["layer_counts"]) == 8


def test_stored_records_are_not_shredded(spark, scratch):
    """F8: a stored VARIANT is its value and metadata; no write takes it apart into columns."""
    from pyarrow.parquet import read_schema
    rows = spark.range(20).select(F.parse_json(F.concat(F.lit('{"a":'), F.col("id").cast("string"), F.lit(',"b":"x"}'))).alias("_record"))
    path = TableStore(spark, f"{scratch}/wh").overwrite(rows.coalesce(1), "raw_zone", "t")
    part = next(n for n in os.listdir(path) if n.endswith(".parquet"))
    stored = read_schema(f"{path}/{part}").field("_record").type
    assert sorted(f.name for f in stored) == ["metadata", "value"]
    assert spark.read.parquet(path).selectExpr("sum(variant_get(_record, '$.a', 'long'))").first()[0] == 190


def test_stage_holds_the_text_of_rejected_rows_only(spark, scratch):
    """F8: accepted order rows are staged without the text that only dead letters carry."""
    rows = spark.createDataFrame([("1", "c", "2026-01-02 00:00:00"), ("2", "c", "no time"), ("3", "c", "2025-01-01 00:00:00")],
                                 "order_id string, customer_id string, order_purchase_timestamp string")
    norm = ingest.normalize_orders(rows, "load")
    res = pipelines.RunResult("run", "load")
    staged, path = pipelines._stage(spark, norm, ingest.passes_cursor(norm, "order_purchase_timestamp", "2026-01-01T00:00:00Z", inclusive=False), res)
    assert (res.processed, res.failed, res.skipped) == (1, 1, 1)
    assert {r.order_id: r.raw_record for r in staged.collect()} == {
        "1": None, "2": '{"customer_id":"c","order_id":"2","order_purchase_timestamp":"no time"}'}
    TableStore(spark, scratch).remove(path)


def test_merge_asks_no_batch_known_to_hold_rows(spark, scratch, monkeypatch):
    """F8: with ``empty`` given, the first merge starts no job over the batch to learn it."""
    store = TableStore(spark, f"{scratch}/wh", merge_buckets=4)
    batch = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")

    def asked(self):
        raise AssertionError("isEmpty was called")

    monkeypatch.setattr(type(batch), "isEmpty", asked)
    store.merge(batch, "raw_zone", "t", "k", empty=False)
    assert sorted(map(tuple, store.read("raw_zone", "t").select("k", "v").collect())) == [("a", 1), ("b", 2)]
    store.merge(batch.limit(0), "raw_zone", "none", "k", empty=True)
    assert store.read("raw_zone", "none").count() == 0
