"""Merge on a primary key (S6, J2) as a pure DataFrame operator.

``target`` rows whose key appears in ``batch`` are replaced, other target
rows stay, and the batch is first reduced to one row per key. That is a
``left_anti`` join of the target against the batch keys plus a union:
Spark broadcasts the key side when AQE measures it under the broadcast
threshold (typical for incremental batches) and otherwise shuffles both
sides on the key. Writing the result is the sink's job
(:mod:`moodline.sources.sinks`), always to a new location.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from moodline.operators.staging import keep_latest


def merge_by_key(target: DataFrame | None, batch: DataFrame, key: str | Sequence[str],
                 order: Sequence[Column] | None = None, newest: bool = False) -> DataFrame:
    """One row per key: new rows win, untouched keys stay.

    With ``newest`` the stored row stands for its key too: the first under
    ``order`` of it and the batch's rows stays, whichever came first.

    ``order`` picks the surviving batch row when a key repeats in the batch
    (first under the ordering); without it the batch must already be
    unique on the key. Columns missing on either side become NULL.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if newest:
        if not order:
            raise ValueError("the newest row needs an order")
        every = batch if target is None else target.unionByName(batch, allowMissingColumns=True)
        return keep_latest(every, keys, list(order))
    arriving = batch.select(*keys)  # an anti join needs no unique keys, so the window stays out of it
    if order:
        batch = keep_latest(batch, keys, list(order))
    if target is None:
        return batch
    kept = target.join(arriving, keys, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)
