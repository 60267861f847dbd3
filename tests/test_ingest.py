"""Validation, normalisation, dead letters and recency: cases written from the rules."""

import datetime as dt
import json


from pyspark.sql import functions as F

from moodline.operators import ingest
from moodline.sources import landed


def _payload_df(spark, *docs):
    return spark.createDataFrame([(json.dumps(d) if not isinstance(d, str) else d, f"f{i}")
                                  for i, d in enumerate(docs)], "value string, _source string")


def _tickets(spark, *records):
    recs, bad = landed.unwrap_envelope(_payload_df(spark, list(records)))
    return ingest.normalize_tickets(recs, load_id="0001")


def test_normalize_ticket_success(spark):
    rec = {"ticket_id": 70_001, "customer_id": 8.5, "created_at": "2031-12-31T23:30:00+02:00",
           "sentiment_score": "0.125", "status": "closed", "sentiment_label": "",
           "customer": {"tier": "basic", "region": "Åland"}, "metadata": {"priority": 3, "channel": "fax", "x": 1}}
    row = _tickets(spark, rec).collect()[0]
    got = row.asDict()
    want = {"error_message": None, "ticket_id": "70001", "customer_id": "8.5", "status": "closed",
            "sentiment_label": "", "customer_region": "Åland", "customer_tier": "basic", "priority": "3",
            "channel": "fax", "sentiment_score": 0.125, "created_at": dt.datetime(2031, 12, 31, 21, 30)}
    assert {k: got[k] for k in want} == want


def test_normalize_ticket_missing_field(spark):
    rows = _tickets(spark, {}, {"ticket_id": "x"}, {"sentiment_score": 1, "customer_id": "y", "ticket_id": "x"}).collect()
    assert [r.error_message for r in rows] == [
        f"Missing required field: {f}" for f in ("ticket_id", "customer_id", "created_at")]


def test_ticket_error_order_and_messages(spark):
    base = {"ticket_id": "t", "customer_id": "c", "created_at": "2026-03-01 10:00:00", "sentiment_score": 0.5}
    cases = [
        ({**base, "ticket_id": ""}, "Missing required field: ticket_id"),
        ({**base, "customer_id": None}, "Missing required field: customer_id"),
        ({**base, "created_at": " nope "}, "Unsupported timestamp format:  nope "),
        ({**base, "sentiment_score": ""}, "Missing required field: sentiment_score"),
        ({**base, "created_at": "bad", "sentiment_score": ""}, "Missing required field: sentiment_score"),
        ({**base, "sentiment_score": "abc"}, "Malformed sentiment_score: abc"),
        ({**base, "ticket_id": 0}, None),
        ({**base, "ticket_id": " 7 "}, None),
    ]
    rows = _tickets(spark, *[c for c, _ in cases]).orderBy("_ordinal").collect()
    assert [r.error_message for r in rows] == [m for _, m in cases]
    assert rows[-1].ticket_id == " 7 "  # ticket ids are not trimmed
    assert rows[-2].ticket_id == "0"


def test_flatten_overwrites_even_with_null(spark):
    recs = [
        {"ticket_id": 1, "customer_id": "c", "created_at": "2026-03-01", "sentiment_score": 1,
         "customer_region": "top", "customer": {"tier": "gold"}},
        {"ticket_id": 2, "customer_id": "c", "created_at": "2026-03-01", "sentiment_score": 1,
         "customer_region": "top", "customer": "not-an-object", "priority": "p0"},
    ]
    r1, r2 = _tickets(spark, *recs).orderBy("_ordinal").collect()
    assert r1.customer_region is None and r1.customer_tier == "gold"
    assert r2.customer_region == "top" and r2.priority == "p0"


def test_envelope_shapes(spark):
    rec = {"ticket_id": 1, "customer_id": "c", "created_at": "2026-03-01", "sentiment_score": 1}
    docs = [
        {"tickets": [rec]},
        {"data": [rec]},
        {"data": [], "tickets": [rec]},          # an empty list wins
        {"data": "x", "results": [rec, 5, "s"]},  # non-list skipped, non-objects dropped
        [rec, rec],
        {"items": [rec]},
        {"nothing": 1},
        "not json",
        "7",
    ]
    recs, bad = landed.unwrap_envelope(_payload_df(spark, *docs))
    per_source = {r["_source"]: r["count"] for r in recs.groupBy("_source").count().collect()}
    assert per_source == {"f0": 1, "f1": 1, "f3": 1, "f4": 2, "f5": 1}
    errs = {r._source: r.error_message for r in bad.collect()}
    assert errs == {"f6": landed.BAD_SHAPE_MESSAGE, "f7": "Malformed JSON payload",
                    "f8": landed.BAD_SHAPE_MESSAGE}


def _orders(spark, rows):
    cols = ["order_id", "customer_id", "order_purchase_timestamp", "order_delivered_customer_date",
            "order_estimated_delivery_date", "price", "freight_value"]
    df = spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows],
                               ", ".join(f"{c} string" for c in cols))
    return ingest.normalize_orders(df, load_id="0001")


def test_normalize_order_late(spark):
    def order(i, delivered, promised):
        return {"order_id": f"A{i}", "customer_id": "K", "order_purchase_timestamp": "2029-07-14T06:00:00Z",
                "order_delivered_customer_date": delivered, "order_estimated_delivery_date": promised,
                "price": "0.75", "freight_value": ""}
    rows = _orders(spark, [order(0, "2029-07-20 00:00:01", "2029-07-20"), order(1, "2029-07-20", "2029-07-20"),
                           order(2, "2029-07-19", "2029-07-20T10:00:00+09:00")]).orderBy("order_id").collect()
    assert [r.is_delayed_order for r in rows] == [True, False, False]
    assert {(r.error_message, r.price, r.freight_value) for r in rows} == {(None, 0.75, None)}


def test_normalize_order_bad_timestamp(spark):
    texts = ["soon", "14/07/2029", "2029-13-01"]
    rows = _orders(spark, [{"order_id": str(i), "customer_id": "K", "order_purchase_timestamp": t}
                           for i, t in enumerate(texts)]).orderBy("order_id").collect()
    assert [r.error_message for r in rows] == [f"Unsupported timestamp format: {t}" for t in texts]


def test_order_ids_trimmed_and_delay_null_without_both_dates(spark):
    row = _orders(spark, [{"order_id": " o-3 ", "customer_id": " c ",
                           "order_purchase_timestamp": "2026-03-01",
                           "order_delivered_customer_date": "2026-03-03"}]).collect()[0]
    assert (row.order_id, row.customer_id, row.is_delayed_order) == ("o-3", "c", None)


def test_cursor_is_strict_for_orders_and_inclusive_for_tickets(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 3, 2),), (dt.datetime(2026, 3, 1),)], "ts timestamp")
    assert ingest.after_cursor(df, "ts", "2026-03-01T00:00:00Z", inclusive=False).count() == 1
    assert ingest.after_cursor(df, "ts", "2026-03-01T00:00:00+00:00", inclusive=True).count() == 2
    assert ingest.after_cursor(df, "ts", None, inclusive=False).count() == 2


def test_select_latest_orders(spark):
    day = dt.datetime(2030, 5, 5)
    rows = [(key, day + dt.timedelta(minutes=m), i, f"{key}{m}#{i}") for i, (key, m) in enumerate(
        [("p", 5), ("q", 90), ("p", 40), ("p", 40), ("r", 40), ("q", 1), ("r", 39)])]
    df = spark.createDataFrame(rows, "order_id string, ts timestamp, _ordinal long, tag string")
    out = ingest.latest_per_key(df, "order_id", "ts").orderBy("ts", "_ordinal").collect()
    assert [r.tag for r in out] == ["p40#2", "r40#4", "q90#1"]


def test_failed_records_keyed_by_payload(spark):
    norm = _orders(spark, [{"order_id": "o-2", "customer_id": "c", "order_purchase_timestamp": "x"}] * 2)
    fr = ingest.failed_records(norm, "orders_pipeline", "orders_csv").collect()
    assert len({r.record_hash for r in fr}) == 1
    assert json.loads(fr[0].raw_record)["order_purchase_timestamp"] == "x"
    assert list(json.loads(fr[0].raw_record)) == sorted(json.loads(fr[0].raw_record))


def test_is_object(spark):
    from moodline.functions.records import is_object
    docs = ['{"a":1}', "{}", "[1]", "[]", '"s"', "5", "null", "true"]
    df = spark.createDataFrame([(d,) for d in docs], "j string")
    got = [r[0] for r in df.select(is_object(F.parse_json("j"))).collect()]
    assert got == [True, True, False, False, False, False, False, False]


def test_is_object_of_a_field(spark):
    """F8: a field is told by its path, without a copy of it; an absent one is no object."""
    from moodline.functions.records import is_object
    docs = ['{"a":{"b":1}}', '{"a":{}}', '{"a":[{}]}', '{"a":"{}"}', '{"a":null}', "{}", "[1]"]
    df = spark.createDataFrame([(d,) for d in docs], "j string")
    got = [r[0] for r in df.select(is_object(F.parse_json("j"), "a")).collect()]
    assert got == [True, True, False, False, False, False, False]


def test_contract_check_counts_absent_keys_only(spark):
    from moodline.operators import quality
    recs = [{"ticket_id": 1, "customer_id": "c", "created_at": None, "sentiment_score": 1},
            {"ticket_id": 2, "customer_id": "c", "sentiment_score": 1},
            {"ticket_id": 3, "customer_id": "c", "created_at": "2026-03-01", "sentiment_score": 1}]
    records, _ = landed.unwrap_envelope(_payload_df(spark, recs))
    out = {r.check_name: (r.checked_rows, r.failed_rows, r.passed)
           for r in quality.contract_check(records, ingest.TICKET_REQUIRED).collect()}
    assert out["records_present"] == (3, 0, True)
    assert out["has_created_at"] == (3, 1, False)   # null counts as present, absent does not
    assert out["has_ticket_id"] == (3, 0, True)


def test_blank_order_id_passes_unless_strict(spark):
    cols = "order_id string, customer_id string, order_purchase_timestamp string"
    df = spark.createDataFrame([("   ", "c", "2026-03-01")], cols)
    loose = ingest.normalize_orders(df, "l").first()
    strict = ingest.normalize_orders(df, "l", strict_ids=True).first()
    assert (loose.error_message, loose.order_id) == (None, "")
    assert strict.error_message == "Missing required field: order_id"


def test_duplicate_json_keys_are_a_bad_payload(spark):
    recs, bad = landed.unwrap_envelope(_payload_df(spark, '{"tickets": [{"ticket_id": 1}], "tickets": []}'))
    assert recs.count() == 0
    assert [r.error_message for r in bad.collect()] == ["Malformed JSON payload"]
