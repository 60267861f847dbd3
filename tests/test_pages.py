"""The page data source: cursor, pushed conditions, page shapes, groups, stream offsets."""

import json
import os

import pytest
from pyspark.sql import functions as F

from moodline.functions.records import canonical_text
from moodline.sources import landed, pages

PAGES = {
    "a.json": '[{"id": 1.10, "created_at": "2024-01-01T00:00:00Z"}, "bare", {"id": 12345678901234567890123, "created_at": "bad"}]',
    "b.json": '{"data": "n/a", "tickets": [{"b": 1, "a": [1, {"x": "]}"}], "created_at": "2024-01-03 05:00:00+05:00"}], "items": []}',
    "c.json": '{"data": [], "tickets": [{"id": 9}]}',
    "d.json": ' {"results" : [ {"t": "é \\" ]", "created_at": "2024-01-02T00:00:00"} , null, [1] ] , "next": {"data": [{}]} }\n',
    "e.json": '{"data": {"x": 1}}', "f.json": "[1, 2", "g.json": "", "h.json": '"text"', "i.json": "[] x",
    "_hidden.json": "[{}]",
}


@pytest.fixture()
def landing(scratch):
    for k, (name, text) in enumerate(PAGES.items()):
        with open(f"{scratch}/{name}", "w", encoding="utf-8") as f:
            f.write(text)
        os.utime(f"{scratch}/{name}", (1000 + k, 1000 + k))
    return scratch


def _rows(df):
    return sorted((os.path.basename(r["_source"]), r["_pos"], r["record"], r["skipped"], r["error"]) for r in df.collect()
                  if r["error"] is None)


def test_items_are_cut_out_as_they_stand(spark, landing):
    pages.register(spark)
    df = spark.read.format(pages.FORMAT).load(landing)
    got = {(f, p): t for f, p, t, _, _ in _rows(df)}
    assert set(got) == {("a.json", 0), ("a.json", 2), ("b.json", 0), ("d.json", 0)}
    assert got["a.json", 0].startswith('{"id": 1.10,') and "12345678901234567890123" in got["a.json", 2]
    assert json.loads(got["d.json", 0])["t"] == 'é " ]'
    errors = {os.path.basename(r["_source"]): (r["error"], r["record"]) for r in df.where("error is not null").collect()}
    assert set(errors) == {"e.json", "f.json", "g.json", "h.json", "i.json"}
    assert errors["e.json"] == (landed.BAD_SHAPE_MESSAGE, PAGES["e.json"])
    assert errors["h.json"][0] == landed.BAD_SHAPE_MESSAGE
    assert {errors[f"{k}.json"][0] for k in "fgi"} == {landed.MALFORMED_MESSAGE}


def test_same_records_as_the_text_reader(spark, landing):
    # Spark's text reader has no row for an empty file, its JSON parser ignores what follows the first value.
    names = [f"{landing}/{n}" for n in PAGES if n not in ("_hidden.json", "g.json", "i.json")]
    rows, _ = pages.read_pages(spark, names)
    text = landed.unwrap_payloads(landed.read_ticket_payloads(spark, names))

    def told(df):
        return sorted(map(str, df.select(F.regexp_extract("_source", "[^/]+$", 0).alias("f"), F.col("_ordinal.p").alias("p"),
                                         canonical_text(F.col("record")).alias("r"), "_bad_text", "_bad_error").collect()))
    assert told(rows) == told(text)


def test_cursor_skips_and_counts(spark, landing):
    rows, seen = pages.read_pages(spark, landing, "2024-01-02T00:00:00Z")
    kept = rows.where("_bad_error is null").select("_source", "_ordinal.p").collect()
    assert sorted((os.path.basename(r["_source"]), r["p"]) for r in kept) == [("a.json", 2), ("b.json", 0), ("d.json", 0)]
    assert rows.count() == 8
    all_rows, none = pages.read_pages(spark, landing)
    all_rows.collect()
    assert none.get["skipped"] == 0
    again, seen = pages.read_pages(spark, landing, "2024-01-02T00:00:01Z")
    again.collect()
    assert seen.get["skipped"] == 2
    with pytest.raises(Exception, match="no time"):
        pages.read_pages(spark, landing, "yesterday")[0].collect()


@pytest.mark.parametrize(("condition", "files"), [
    ("created_at >= timestamp'2024-01-02 00:00:00'", ["b.json", "d.json"]),
    ("created_at > timestamp'2024-01-02 00:00:00'", ["b.json"]),
    ("created_at > timestamp'2024-01-01 00:00:00' and created_at < timestamp'2024-01-03 00:00:00'", ["d.json"]),
    ("created_at >= timestamp'2025-01-01 00:00:00'", [])])
def test_pushed_conditions(spark, landing, condition, files):
    pages.register(spark)
    df = spark.read.format(pages.FORMAT).load(landing).where(condition)
    assert sorted(os.path.basename(r["_source"]) for r in df.collect()) == files
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert ("Filter" in plan.split("BatchScan")[0]) is True  # null checks and upper bounds stay with Spark
    if " and " not in condition:
        assert ">=" not in plan.split("BatchScan")[0]


def test_groups_by_bytes_and_missing_path(spark, landing):
    pages.register(spark)
    reader = spark.read.format(pages.FORMAT)
    assert reader.option("groupBytes", 1).load(landing).rdd.getNumPartitions() == len(PAGES) - 1
    assert spark.read.format(pages.FORMAT).load(landing).rdd.getNumPartitions() == 1
    with pytest.raises(Exception):
        spark.read.format(pages.FORMAT).load(f"{landing}/nowhere").collect()


def test_stream_reads_each_page_once(spark, landing, scratch):
    pages.register(spark)
    out, ckpt = f"{scratch}/_out", f"{scratch}/_ckpt"

    def drain():
        (spark.readStream.format(pages.FORMAT).load(landing).writeStream.format("parquet").option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start(out).awaitTermination())
        return sorted((os.path.basename(r["_source"]), r["_pos"]) for r in spark.read.parquet(out).where("error is null").collect())

    first = drain()
    assert first == [("a.json", 0), ("a.json", 2), ("b.json", 0), ("d.json", 0)]
    with open(f"{landing}/z.json", "w", encoding="utf-8") as f:
        f.write('[{"id": 5}]')
    assert drain() == [*first, ("z.json", 0)]
    assert drain() == [*first, ("z.json", 0)]


def test_landed_pages_lie_in_few_folders(spark, scratch):
    rows = [(f'[{{"id": {i}}}]', f"page-{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "value string, page string").repartition(3)
    for _ in range(2):  # landing again replaces files
        pages.land(df, f"{scratch}/land")
    found = [(d, n) for d, _, names in os.walk(f"{scratch}/land") for n in names if not n.startswith(".")]
    assert sorted(n for _, n in found) == sorted(f"page=page-{i}.json" for i in range(300))
    assert len({d for d, _ in found}) <= pages.FOLDERS
    texts = landed.read_ticket_payloads(spark, f"{scratch}/land/*")
    assert sorted(r.value.strip() for r in texts.collect()) == sorted(v for v, _ in rows)
    assert spark.read.format(pages.FORMAT).load(f"{scratch}/land").count() == 300
