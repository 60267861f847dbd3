"""CSV edge cases (empty vs quoted-empty, short / long rows, quoted newlines) and the CLI."""

import json
import os

from moodline.__main__ import main
from moodline.operators import ingest
from moodline.sources import landed

CSV = (
    "order_id,customer_id,order_purchase_timestamp,order_delivered_customer_date,"
    "order_estimated_delivery_date,price,freight_value,note\n"
    'o-1,c-1,2026-03-01 10:00:00,2026-03-03 10:00:00,2026-03-02 10:00:00,100.40,5.10,"multi\nline"\n'
    'o-2,"",2026-03-01 10:00:00,,,"",,x\n'
    "o-3,c-3,2026-03-01 10:00:00\n"
    "o-4,c-4,2026-03-02 10:00:00,,,abc,1.0,y,extra\n"
)


def test_csv_edge_cases(spark, scratch):
    path = f"{scratch}/orders.csv"
    with open(path, "w") as fh:
        fh.write(CSV)
    by_splits = landed.read_orders_csv(spark, path)
    rows = landed.read_orders_csv(spark, path, multi_line=True)
    data = [c for c in rows.columns if not c.startswith("_")]
    assert sorted(map(repr, by_splits.select(data).collect())) == sorted(map(repr, rows.select(data).collect()))
    norm = {r.order_id: r for r in ingest.normalize_orders(rows, "l").collect()}
    assert set(norm) == {"o-1", "o-2", "o-3", "o-4"}
    assert norm["o-1"].error_message is None and norm["o-1"].is_delayed_order is True
    assert norm["o-1"].note == "multi\nline"                       # extra column kept, quoted newline
    assert norm["o-2"].error_message == "Missing required field: customer_id"  # "" reads as missing
    assert norm["o-3"].error_message is None and norm["o-3"].price is None     # short row -> NULLs
    assert norm["o-4"].error_message == "Malformed price: abc"     # extra field dropped, bad price


def test_cli_ingest_and_models(spark, scratch):
    land = f"{scratch}/land"
    os.makedirs(land)
    with open(f"{land}/page1.json", "w") as fh:
        json.dump({"data": [{"ticket_id": 1, "customer_id": "c", "created_at": "2026-03-01T10:00:00Z",
                             "sentiment_score": "-0.9", "customer": {"region": "south"}}]}, fh)
    with open(f"{scratch}/orders.csv", "w") as fh:
        fh.write(CSV)
    wh = f"{scratch}/wh"
    assert main(["ingest-tickets", "--warehouse", wh, "--landing", land, "--initial-cursor", ""]) == 0
    assert main(["ingest-orders", "--warehouse", wh, "--csv", f"{scratch}/orders.csv", "--buckets", "4",
                 "--multi-line"]) == 0
    assert main(["run-models", "--warehouse", wh, "--as-of", "2026-03-05 00:00:00"]) == 0
    assert main(["export", "--warehouse", wh, "--table", "sentiment_heatmap", "--out", f"{scratch}/x"]) == 0
    out = spark.read.json(f"{scratch}/x").collect()
    assert [(r.region, r.ticket_count) for r in out] == [("south", 1)]
    assert main(["metrics", "--warehouse", wh, "--out", f"{scratch}/m", "--as-of", "2026-03-05 00:00:00"]) == 0
    assert spark.read.json(f"{scratch}/m/failed_ratio").count() == 2
    assert main(["expire", "--warehouse", wh, "--layer", "staging", "--table", "stg_tickets"]) == 0


def test_columns_go_by_each_files_header(spark, scratch):
    os.makedirs(f"{scratch}/in")
    with open(f"{scratch}/in/a.csv", "w") as fh:
        fh.write('order_id,customer_id,price\n1,c1,2.5\n2,"c,2",3\n')
    with open(f"{scratch}/in/b.csv", "w") as fh:
        fh.write("customer_id,note,order_id\r\nc3,n3,3\r\n\r\nc4,,4\r\n")
    got = {r.order_id: (r.customer_id, r.price, r.note) for r in landed.read_orders_csv(spark, f"{scratch}/in").collect()}
    assert got == {"1": ("c1", "2.5", None), "2": ("c,2", "3", None), "3": ("c3", None, "n3"), "4": ("c4", None, None)}
    with open(f"{scratch}/bad.csv", "w") as fh:
        fh.write("a,a\n1,2\n")
    import pytest
    with pytest.raises(ValueError, match="repeated column"):
        landed.read_orders_csv(spark, f"{scratch}/bad.csv")


def test_large_file_is_split(spark, scratch):
    with open(f"{scratch}/big.csv", "w") as fh:
        fh.write("order_id,customer_id\n")
        fh.writelines(f"{i},c{i}\n" for i in range(200_000))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        rows = landed.read_orders_csv(spark, f"{scratch}/big.csv")
        assert rows.rdd.getNumPartitions() > 4 and rows.select("order_id").distinct().count() == 200_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def _reader(text):
    """Rows as the csv module reads them: id -> other fields, empty ones as None."""
    import csv
    import io
    return sorted((tuple(v or None for v in r.values()) for r in csv.DictReader(io.StringIO(text))), key=repr)


def test_quoted_line_breaks_over_many_splits(spark, scratch):
    import random
    rnd = random.Random(7)
    rows = ["id,note,place"]
    for k in range(3000):
        note = rnd.choice(['plain', '"two\nlines"', '"a ""quoted""\n\nword, and\nmore"', '"in, one"', '5" wide', '', '"x\n"',
                           '"' + "long\n" * rnd.randrange(40) + '"'])
        rows.append(f"{k},{note},{rnd.choice(['p', '', chr(34) + 'q' + chr(10) + 'r' + chr(34)])}")
    text = "\n".join(rows) + "\n"
    with open(f"{scratch}/a.csv", "w") as fh:
        fh.write(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = landed.read_orders_csv(spark, f"{scratch}/a.csv")
        assert spark.read.text(f"{scratch}/a.csv").rdd.getNumPartitions() > 10
        assert sorted((tuple(v or None for v in r) for r in got.select("id", "note", "place").collect()), key=repr) == _reader(text)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_only_the_first_line_is_the_header(spark, scratch):
    import pytest
    for name, text in (("a", "id,note\n1,x\nid,note\n2,y\n"), ("b", '\nid,note\n3,"u\nv"\nid,note\n4,z\r\n')):
        with open(f"{scratch}/{name}.csv", "w") as fh:
            fh.write(text)
        got = sorted(tuple(r) for r in landed.read_orders_csv(spark, f"{scratch}/{name}.csv").select("id", "note").collect())
        assert got == _reader(text.lstrip("\n").replace("\r", ""))
    with open(f"{scratch}/c.csv", "w") as fh:
        fh.write('id,note\n1,"open\n2,x\n')
    with pytest.raises(Exception, match="unpaired quotes"):
        landed.read_orders_csv(spark, f"{scratch}/c.csv").collect()


def test_records_that_span_chunks_of_lines(spark, scratch, monkeypatch):
    import csv

    from moodline.sources import landed
    monkeypatch.setattr(landed, "CHUNK_LINES", 4)
    rows = [(str(i), "x" if i % 3 else "\n".join(f'l{k} "q",' for k in range(i % 11 + 1))) for i in range(60)]
    with open(f"{scratch}/c.csv", "w", newline="") as f:
        csv.writer(f, lineterminator="\n").writerows([("id", "note"), *rows])
    got = landed.read_orders_csv(spark, f"{scratch}/c.csv")
    assert got.schema["_ordinal"].dataType.fieldNames() == ["f", "b", "i"]
    assert sorted((r.id, r.note) for r in got.collect()) == sorted(rows)


def test_composed_steps_share_one_sort(spark):
    from pyspark.sql import functions as F

    from moodline.sources import landed
    steps = [(i, (None, None, 1, None, 0)[i % 5], (0, 1, 0, 1, 0)[i * 7 % 5] if i % 5 not in (2, 4) else 0) for i in range(40)]
    rows = spark.createDataFrame([("a", *s) for s in steps], "f string, n int, s int, x int")
    out = landed._composed(rows, ["f"], ["n"], F.col("s"), F.col("x"))
    assert out._jdf.queryExecution().sparkPlan().toString().count("Sort [") + out._jdf.queryExecution().executedPlan().toString().count("Sort [") == 1
    fixed, flips, told = None, 0, {}
    for n, s, x in steps:
        before = fixed, flips
        fixed, flips = (s, 0) if s is not None else (fixed, (flips + x) % 2)
        told[n] = (fixed, flips, *before)
    assert {r.n: (r._fixed, r._flips, r._fixed0, r._flips0) for r in out.collect()} == told
