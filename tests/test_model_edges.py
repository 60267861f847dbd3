"""Edge rows of the models: band and gate edges, same-day lateness, NULL scores, NULL keys."""

import datetime as dt

from pyspark.sql import functions as F

from moodline.operators import facts, risk, staging

D = dt.date(2026, 3, 1)
FACT = "customer_id string, sentiment_date date, avg_sentiment_score double, ticket_count long"
ORDERS = "customer_id string, order_date date, avg_delivery_delay_days double, delayed_order_count long, order_count long"


def _risk(spark, fact_rows, order_rows):
    out = risk.high_risk_customers(spark.createDataFrame(fact_rows, FACT),
                                   spark.createDataFrame(order_rows, ORDERS), as_of="2026-03-02 00:00:00")
    return {r.customer_id: r for r in out.collect()}


def test_gate_edges_are_inclusive(spark):
    fact = [("gate", D, -0.20, 1), ("below", D, -0.19, 1), ("nodelay", D, -0.9, 1), ("top", D, -1.0, 1)]
    orders = [("gate", D, 2.0, 1, 1), ("below", D, 5.0, 1, 1), ("nodelay", D, 1.99, 1, 1),
              ("top", D, 12.0, 1, 1)]
    out = _risk(spark, fact, orders)
    assert set(out) == {"gate", "top"}                    # -0.20 and 2 days pass; -0.19 / 1.99 do not
    assert out["top"].risk_score == 1.0 and out["top"].risk_band == "critical"   # delay capped at 10
    assert out["gate"].risk_band == "medium"


def test_band_edges_are_inclusive(spark):
    # Exact scores: 0.65 and 0.45 belong to the higher band. (Computed scores
    # are doubles, e.g. 0.5 * 0.7 + 0.3 = 0.6499999999999999 is 'high'.)
    scores = [0.65, 0.6499999999999999, 0.45, 0.4499999999999999, 0.0]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    got = [r[0] for r in df.select(risk.risk_band(F.col("s"))).collect()]
    assert got == ["critical", "high", "high", "medium", "medium"]


def test_no_orders_means_zero_delay_and_null_customer_never_joins(spark):
    fact = [("a", D, -0.9, 2), (None, D, -0.9, 1)]
    orders = [(None, D, 9.0, 1, 1)]
    joined = risk.risk_joined(spark.createDataFrame(fact, FACT), spark.createDataFrame(orders, ORDERS)).collect()
    assert all(r.avg_delivery_delay_days == 0.0 and r.order_count == 0 for r in joined)


def test_same_day_late_order_and_null_scores(spark):
    raw_orders = spark.createDataFrame([
        ("o1", "c", "2026-03-01 08:00:00", "2026-03-01 18:00:00", "2026-03-01 12:00:00", "0001", "1"),
    ], "order_id string, customer_id string, order_purchase_timestamp string, "
       "order_delivered_customer_date string, order_estimated_delivery_date string, _load_id string, _row_id string")
    o = staging.stg_orders(raw_orders).first()
    assert o.is_delayed_order is True and o.delivery_delay_days == 0   # late within the day
    raw_tickets = spark.createDataFrame([("t1", "c", "2026-03-01 10:00:00", "", "0001", "1"),
                                         ("t2", "c", "2026-03-01 11:00:00", None, "0001", "2")],
                                        "ticket_id string, customer_id string, created_at string, "
                                        "sentiment_score string, _load_id string, _row_id string")
    f = facts.fact_sentiment_daily(staging.stg_tickets(raw_tickets)).first()
    assert f.avg_sentiment_score is None and f.ticket_count == 2 and f.negative_ticket_count == 0
    assert f.negative_ticket_ratio == 0.0
