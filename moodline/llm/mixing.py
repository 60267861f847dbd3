"""Mixing sources to target weights by balanced sampling, the cube method (operator 2).

A source's target, over its size, is the number of times each of its documents
should enter the mix. The whole part enters for certain; the fraction is an
inclusion probability. The cube method's flight phase moves those
probabilities through the null space of the balancing constraints (documents
and words): any three undecided documents have a direction that changes
neither total, and moving along it until one probability reaches 0 or 1
decides a document. Documents fly in blocks of bounded size; what a block
leaves undecided (at most two) flies again with other blocks' remains, until a
source has one block. Its last few documents (at most 14) land: all their 0/1
choices are tried; of those that come within 0.1% of the block's words of the
nearest to what the probabilities promise, the one nearest in documents is
taken. Random choices are hashes of the row, so reruns agree.

Cases: null texts have size 0; documents of size 0 never enter the mix. Null
sources are a source of their own, last in order. Equal rows are told apart by
their number in a block; which of them is taken does not change the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodline.llm import ships_by_value
from moodline.llm.tables import written
from moodline.llm.textbuf import chunks

ships_by_value(__name__)

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2.0
BLOCK_ROWS = 4096
LANDING = 12
TOLERANCE = 0.001
_EPS = 1e-9


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace text by its number of words: runs of anything but space and the controls 9 to 13."""
    blank = np.zeros(256, bool)
    blank[[32, *range(9, 14)]] = True
    for batch in batches:
        sizes = np.zeros(batch.num_rows, np.int64)
        for lo, hi, data, offsets in chunks(batch.column("text")):
            if not len(data):
                continue
            inside = ~blank[data]
            begin = inside.copy()
            begin[1:] &= ~inside[:-1]
            at = offsets[:-1][np.diff(offsets) > 0]
            begin[at] = inside[at]
            total = np.r_[0, np.cumsum(begin)]
            sizes[lo:hi] = total[offsets[1:]] - total[offsets[:-1]]
        names = [f.name for f in batch.schema if f.name != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sizes)], names=[*names, "size"])


def sizes(docs: DataFrame) -> DataFrame:
    """``docs`` with its text replaced by size, its number of words."""
    docs = docs.drop("size")
    rest = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), "size long"])
    return docs.mapInArrow(_sized, schema)


def targets(per_source: list[tuple[str | None, int]], weights: tuple[float, ...] = WEIGHTS,
            share: float = SHARE, most_repeats: float = MOST_REPEATS) -> dict[str | None, float]:
    """Words each source should give: weights repeat over sources in code-point order, null last.

    Targets stop at ``most_repeats`` times a source's size; what is over goes to
    the others by weight, until none is above.
    """
    order = sorted(per_source, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size = dict(order)
    left, open_ = share * sum(size.values()), [s for s, _ in order]
    done: dict[str | None, float] = {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total >= most_repeats * size[s]]
        if not full:
            return done | {s: left * weight[s] / total for s in open_}
        for s in full:
            done[s] = most_repeats * size[s]
        left -= sum(done[s] for s in full)
        open_ = [s for s in open_ if s not in done]
    return done


def fly(prob: np.ndarray, size: np.ndarray, draws: np.ndarray, keep: int = 0) -> np.ndarray:
    """Flight phase: decide all but at most two, keeping the sums of prob and of prob * size.

    The last ``keep`` documents stay as they are.
    """
    prob = prob.copy()
    held: list[int] = []
    for i in range(len(prob) - keep):
        if prob[i] < _EPS or prob[i] > 1 - _EPS:
            prob[i] = round(prob[i])
            continue
        held.append(i)
        while len(held) == 3:
            a, b, c = held
            # A vector orthogonal to (1, 1, 1) and to the sizes.
            u = (size[b] - size[c], size[c] - size[a], size[a] - size[b])
            if u == (0, 0, 0):
                u = (1, -1, 0)
            up = min((1 - prob[k]) / x if x > 0 else prob[k] / -x for k, x in zip(held, u, strict=True) if x)
            down = min(prob[k] / x if x > 0 else (1 - prob[k]) / -x for k, x in zip(held, u, strict=True) if x)
            step = up if draws[i] * (up + down) < down else -down
            for k, x in zip(held, u, strict=True):
                prob[k] += step * x
                if prob[k] < _EPS or prob[k] > 1 - _EPS:
                    prob[k] = round(prob[k])
            held = [k for k in held if 0 < prob[k] < 1]
    return prob


def land(prob: np.ndarray, size: np.ndarray, tolerance: float = 1.0) -> np.ndarray:
    """Landing: the 0/1 choice nearest to the promised words; of those as near, up to ``tolerance`` words, documents."""
    n = len(prob)
    if not n:
        return prob
    choices = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
    words, docs = np.abs(choices @ size - prob @ size), np.abs(choices.sum(1) - prob.sum())
    return choices[np.lexsort((words, np.round(docs, 6), np.floor(words / tolerance)))[0]].astype(float)


def _flight(_: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("draw", kind="stable")
    size = rows["size"].to_numpy(float)
    draws = (rows["draw"].to_numpy(np.int64).view(np.uint64) >> np.uint64(11)) / float(1 << 53)
    last = bool(rows["last"].iloc[0])
    prob = fly(rows["prob"].to_numpy(float), size, draws, min(LANDING, len(rows)) if last else 0)
    if last:
        open_ = np.flatnonzero((prob > 0) & (prob < 1))
        prob[open_] = land(prob[open_], size[open_], max(1.0, TOLERANCE * size.sum()))
    return rows.assign(prob=prob)


def mix(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
        most_repeats: float = MOST_REPEATS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows (doc_id, source, size and any further key columns) -> those, source_size, target, copies, taken.

    The driver holds one number per source. Every row is kept; copies may be 0.
    """
    spark, own = sized.sparkSession, sized.columns
    rows = written(sized.groupBy(*own).agg(F.count("*").alias("n"))
                   .withColumn("ordinal", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).drop("n"))
    totals = [(r["source"], r["total"], r["n"]) for r in
              rows.groupBy("source").agg(F.sum("size").alias("total"), F.count("*").alias("n")).collect()]
    goal = targets([(s, n) for s, n, _ in totals], weights, share, most_repeats)
    plan = spark.createDataFrame(
        [(s, total, float(goal[s]), goal[s] / total if total else 0.0) for s, total, _ in totals],
        "plan_source string, source_size long, target double, rate double")
    drawn = (rows.join(F.broadcast(plan), rows["source"].eqNullSafe(plan["plan_source"]))  # one row per source
             .select(*(rows[c] for c in own), "ordinal", "source_size", "target",
                     F.floor("rate").cast("long").alias("base"),
                     F.when(F.col("size") > 0, F.col("rate") - F.floor("rate")).otherwise(0.0).alias("prob"),
                     F.xxhash64(F.lit(2), *(rows[c] for c in own), "ordinal").alias("draw")))
    fixed = drawn.where(f"prob < {_EPS}").withColumn("prob", F.lit(0.0))
    decided = [fixed]
    open_ = drawn.where(f"prob >= {_EPS}")
    counts = {r["source"]: r["n"] for r in open_.groupBy("source").agg(F.count("*").alias("n")).collect()}
    round_, schema = 0, drawn.schema
    while counts:
        blocks = spark.createDataFrame([(s, max(1, -(-n // block_rows))) for s, n in counts.items()],
                                       "of string, blocks int")
        dealt = (open_.join(F.broadcast(blocks), F.col("source").eqNullSafe(F.col("of")))
                 .withColumn("block", F.pmod(F.xxhash64(F.lit(round_), "draw"), F.col("blocks")))
                 .withColumn("last", F.col("blocks") == 1).drop("of", "blocks"))
        names = [f.name for f in dealt.schema.fields]
        out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields)
        flown = written(dealt.groupBy("source", "block").applyInPandas(
            lambda key, pdf: _flight(key, pdf)[names], out).select(*schema.names))
        decided.append(flown.where("prob = 0 or prob = 1"))
        open_ = flown.where("prob > 0 and prob < 1")
        counts = {r["source"]: r["n"] for r in open_.groupBy("source").agg(F.count("*").alias("n")).collect()}
        round_ += 1
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    copies = F.when(F.col("size") > 0, F.col("base") + F.col("prob").cast("long")).otherwise(F.lit(0))
    return (out.withColumn("copies", copies.cast("int"))
            .select(*own, "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))


def mixed(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` as the mix takes them: a document stands in it as often as it is taken, others go.

    Rows that differ in any column (of a type that has a hash) are documents of their own.
    """
    hashed = [f"`{f.name}`" for f in docs.schema.fields
              if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    version = F.xxhash64(F.lit(2), *hashed, *(F.col(c).isNull() for c in hashed))
    sized = sizes(docs.select("doc_id", "source", version.alias("version"), "text"))
    taken = (mix(sized, **parameters).groupBy("doc_id", "source", "version")
             .agg(F.sum("copies").cast("int").alias("__copies")).where("__copies > 0")
             .select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"),
                     F.col("version").alias("__version"), "__copies"))
    own = docs.withColumn("__own", version)
    same = (F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source"))
            & F.col("__own").eqNullSafe(F.col("__version")))
    return (own.join(taken.hint("merge"), same).dropDuplicates(["__id", "__source", "__version"])
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns))
