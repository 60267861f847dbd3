"""Exact top-k inner products by Fagin's threshold algorithm (operator 6).

Vectors are dealt to blocks of bounded size; in a block every dimension has a
list of vectors sorted by that component. A query walks all lists from the end
its own component's sign prefers, scores each newly met vector in full, and
stops as soon as the k-th score found beats the bound
sum(query component x component at the list's present depth), which no unmet
vector can exceed; equal bounds go on, as an unmet vector with a smaller id
could tie, or when no vector is left unmet. Lists are walked in steps of doubling
depth. Each block gives its k
best per query, and a last ranking over blocks gives the result.

Cases: vectors that are null, empty, or hold null or non-finite components, and
rows without vec_id, take no part. Rows that repeat a vec_id with one vector
are one row; a query never meets rows of its own vec_id. Shorter vectors count
as padded with zeros. Ties go to the smaller vec_id. Components beyond 2^20 in
size are scored with Python's integers; a score that does not fit 64 bits counts, and is given, as the least or
largest that does.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodline.llm import ships_by_value

ships_by_value(__name__)

BLOCK_ROWS = 4096
QUERY_ROWS = 2048
_FIRST_DEPTH = 16


def quantised(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, taken as double; null where a component is unusable."""
    usable = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(usable & (F.size(embedding) > 0),
                  F.transform(embedding, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")))


def sorted_lists(vectors: np.ndarray) -> np.ndarray:
    """Per dimension, vector numbers by ascending component."""
    return np.argsort(vectors, axis=0, kind="stable")


def top_k(vectors: np.ndarray, ids: np.ndarray, lists: np.ndarray, query: np.ndarray, own: int, k: int
          ) -> list[tuple[int, int]]:
    """The k best (score, id) for one query, best first; exact."""
    n, d = vectors.shape
    used = np.flatnonzero(query)
    met = ids == own
    found_ids, found = np.zeros(0, ids.dtype), np.zeros(0, vectors.dtype)
    depth = min(_FIRST_DEPTH, n)
    while True:
        if len(used):
            rising = query[used] < 0
            walked = np.where(rising, lists[:depth, used], lists[::-1][:depth, used])
            new = np.zeros(n, bool)
            new[walked.ravel()] = True
            new &= ~met
            edge = vectors[walked[depth - 1], used]
            bound = (query[used] * edge).sum()
        else:  # all scores are 0: nothing can be told apart but the ids
            new, bound, depth = ~met, 0, n
        at = np.flatnonzero(new)
        met[at] = True
        found_ids, found = np.concatenate([found_ids, ids[at]]), np.concatenate([found, vectors[at] @ query])
        best = np.lexsort((found_ids, -found))[:k]
        found_ids, found = found_ids[best], found[best]
        if met.all() or (len(found) == k and found[-1] > bound):
            return [(int(s), int(i)) for s, i in zip(found, found_ids, strict=True)]
        depth = min(n, depth * 2)


_LEAST, _MOST = -2 ** 63, 2 ** 63 - 1  # a score beyond counts as the bound it passes


def _block(k: int):
    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        if len(vectors) and len(queries):
            width = max(vectors["v"].map(len).max(), queries["v"].map(len).max())
            largest = max(np.abs(np.concatenate([*vectors["v"], *queries["v"]])).max(), 1)
            # Products and sums are whole numbers: exact in doubles while they stay below 2^53.
            kind = float if float(largest) ** 2 * width < 2.0 ** 53 else object

            def matrix(rows: pd.Series) -> np.ndarray:
                m = np.zeros((len(rows), width), kind)
                for i, v in enumerate(rows):
                    m[i, :len(v)] = v
                return m

            x, q = matrix(vectors["v"]), matrix(queries["v"])
            ids, lists = vectors["vec_id"].to_numpy(np.int64), sorted_lists(x)
            for own, vector in zip(queries["vec_id"].to_numpy(np.int64), q, strict=True):
                out += [(int(own), i, min(max(s, _LEAST), _MOST)) for s, i in top_k(x, ids, lists, vector, own, k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")
    return run


def search(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, block_rows: int = BLOCK_ROWS,
           query_rows: int = QUERY_ROWS) -> DataFrame:
    """Rows (vec_id, embedding) -> query_id, rank, vec_id, score: each query's k best, all rows searched."""
    ready = (vectors.where("vec_id is not null").select("vec_id", quantised(F.col("embedding"), scale).alias("v"))
             .where("v is not null").distinct())
    queries = ready.where(is_query)
    n = vectors.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    blocks, groups = max(1, -(-n["n"] // block_rows)), max(1, -(-n["q"] // query_rows))
    dealt = (ready.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
             .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
    asked = (queries.withColumn("group", F.pmod(F.xxhash64(F.lit(6), "vec_id"), F.lit(groups)).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))))
    found = (dealt.groupBy("block", "group").cogroup(asked.groupBy("block", "group"))
             .applyInPandas(_block(k), "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
