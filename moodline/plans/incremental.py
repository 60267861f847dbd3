"""Incremental refresh: a load's changes to the raw tables carried on to the daily aggregates.

``merge_and_refresh_tickets`` / ``_orders`` merge a batch into a raw table and
update the states of its aggregates, each a table partitioned by day. A day's
rows carry the load that changed them last; a load that is repeated after a
failure skips the days it has already changed, so every load counts once.
Loads into one store run one after another and a failed one is repeated
before the next.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.operators import incremental, staging
from moodline.session import checkpoint_dir
from moodline.sources.sinks import TableStore

RAW, CORE = "raw_zone", "core"
# State table -> (keys, day column, state of the changes, result of the states).
STATES: dict[str, tuple[Sequence[str], str, Callable, Callable]] = {
    "_sentiment_state": (incremental.SENTIMENT_KEYS, "sentiment_date", incremental.sentiment_state, incremental.fact_of),
    "_heatmap_state": (incremental.HEATMAP_KEYS, "sentiment_date", incremental.heatmap_state, incremental.heatmap_of),
    "_order_state": (incremental.ORDER_KEYS, "order_date", incremental.order_state, incremental.order_daily_of),
}
LOAD = "_load"


def update_state(store: TableStore, table: str, changes: DataFrame, load_id: str) -> list:
    """Add a load's changes to a state table; returns the days that were rewritten.

    The states of the touched days are all that is read: the days are known
    before the scan, which takes them as a partition filter.
    """
    keys, day, *_ = STATES[table]
    store.finish(CORE, table)
    days = [r[0] for r in changes.select(day).distinct().collect()]  # calendar days, few
    old = store.read(CORE, table)
    if old is not None:
        old = old.where(F.col(day).isin(days))
        done = {r[0] for r in old.where(F.col(LOAD) == load_id).select(day).distinct().collect()}
        days = [d for d in days if d not in done]
        changes = changes.where(F.col(day).isin(days))
        changes = incremental.combined(old.where(F.col(day).isin(days)).drop(LOAD), changes, keys)
    if days:
        columns = [c for c in changes.columns if c != day]
        store.replace_partitions(changes.select(*columns, F.lit(load_id).alias(LOAD), day), CORE, table, day)
    return days


def _refresh(store: TableStore, batch: DataFrame, table: str, key: str, order: Sequence[Column], load_id: str,
             stage: Callable[[DataFrame], DataFrame], states: Sequence[str]) -> dict[str, list]:
    spark = store.spark
    added, replaced = incremental.merge_changes(store.read(RAW, table), batch, key, order)
    # What the merge will replace is written before it does; a repeated load finds the first attempt's rows there.
    path = f"{checkpoint_dir(spark)}/changes/{load_id}-{table}"
    rows = added.withColumn("_new", F.lit(True))
    if replaced is not None:
        rows = rows.unionByName(replaced.withColumn("_new", F.lit(False)), allowMissingColumns=True)
    if not store._exists(f"{path}/_SUCCESS"):
        rows.write.mode("overwrite").parquet(path)
    staged = spark.read.schema(rows.schema).parquet(path)
    plus, minus = (staged.where(F.col("_new") == new).drop("_new") for new in (True, False))
    store.merge(plus, RAW, table, key)
    out = {name: update_state(store, name, STATES[name][2](stage(plus), stage(minus)), load_id) for name in states}
    store.remove(path)
    return out


def merge_and_refresh_tickets(store: TableStore, batch: DataFrame, load_id: str | None = None) -> dict[str, list]:
    """Merge accepted tickets; returns the rewritten days per state table."""
    order = [F.col("created_at").desc(), F.col("_row_id").desc()]
    return _refresh(store, batch, "raw_tickets", "ticket_id", order, load_id or uuid.uuid4().hex, staging.stg_tickets,
                    ("_sentiment_state", "_heatmap_state"))


def merge_and_refresh_orders(store: TableStore, batch: DataFrame, load_id: str | None = None) -> dict[str, list]:
    """Merge accepted orders (newest per order first); returns the rewritten days per state table."""
    order = [F.col("order_purchase_timestamp").desc(), F.col("_row_id").desc()]
    return _refresh(store, batch, "raw_orders", "order_id", order, load_id or uuid.uuid4().hex, staging.stg_orders, ("_order_state",))


def result(store: TableStore, table: str) -> DataFrame | None:
    """The aggregate that a state table stands for."""
    states = store.read(CORE, table)
    return None if states is None else STATES[table][3](states)
