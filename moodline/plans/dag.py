"""The model DAG: raw_zone -> staging -> core -> enrichment -> dashboard.

``build_models`` composes all six models lazily (one plan, Catalyst sees
everything). ``run_models`` materialises them layer by layer as new table
versions, writing ``stg_tickets`` once and reading it back for both of its
consumers (M3 and M6) instead of recomputing the dedupe.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from moodline.operators import dashboard, facts, risk, staging
from moodline.session import configure
from moodline.sources import sinks
from moodline.sources.schemas import RAW_ORDERS, RAW_TICKETS

# DAG edges (model -> inputs), as declared by the source models.
DEPENDS = {
    "stg_tickets": ("raw_tickets",),
    "stg_orders": ("raw_orders",),
    "fact_sentiment_daily": ("stg_tickets",),
    "high_risk_customers": ("fact_sentiment_daily", "stg_orders"),
    "high_risk_table": ("high_risk_customers",),
    "sentiment_heatmap": ("stg_tickets",),
}
LAYER = {
    "stg_tickets": "staging", "stg_orders": "staging", "fact_sentiment_daily": "core",
    "high_risk_customers": "enrichment", "high_risk_table": "dashboard",
    "sentiment_heatmap": "dashboard",
}


def build_models(raw_tickets: DataFrame, raw_orders: DataFrame,
                 as_of: dt.datetime | str | None = None) -> dict[str, DataFrame]:
    """All models as lazy DataFrames over the two raw tables."""
    stg_t = staging.stg_tickets(raw_tickets)
    stg_o = staging.stg_orders(raw_orders)
    fact = facts.fact_sentiment_daily(stg_t)
    hr = risk.high_risk_customers(fact, facts.order_daily(stg_o), as_of=as_of)
    return {
        "stg_tickets": stg_t, "stg_orders": stg_o, "fact_sentiment_daily": fact,
        "high_risk_customers": hr, "high_risk_table": dashboard.high_risk_table(hr),
        "sentiment_heatmap": dashboard.sentiment_heatmap(stg_t, ordered=False),
    }


def run_models(spark: SparkSession, store: sinks.TableStore,
               as_of: dt.datetime | str | None = None) -> dict[str, str]:
    """Materialise every model as a new version; returns table -> path.

    ``as_of`` defaults to the run's start, fixed once so every model of
    the run carries the same refresh time.
    """
    configure(spark)
    as_of = as_of or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    raw_t = store.read("raw_zone", "raw_tickets", None)
    raw_o = store.read("raw_zone", "raw_orders", None)
    if raw_t is None:
        raw_t = spark.createDataFrame([], RAW_TICKETS)
    if raw_o is None:
        raw_o = spark.createDataFrame([], RAW_ORDERS)
    out: dict[str, str] = {}

    def write(name: str, df: DataFrame) -> DataFrame:
        out[name] = store.overwrite(df, LAYER[name], name)
        return store.read(LAYER[name], name)

    stg_t = write("stg_tickets", staging.stg_tickets(raw_t))
    stg_o = write("stg_orders", staging.stg_orders(raw_o))
    fact = write("fact_sentiment_daily", facts.fact_sentiment_daily(stg_t))
    hr = write("high_risk_customers", risk.high_risk_customers(fact, facts.order_daily(stg_o), as_of=as_of))
    write("high_risk_table", dashboard.high_risk_table(hr))
    write("sentiment_heatmap", dashboard.sentiment_heatmap(stg_t, ordered=False))
    return out
