import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodline.llm import threshold_topk as tt
from tests.conftest import SF_SMALL


def _brute(rows, k=5):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            usable[i] = [math.floor(256 * float(np.float32(x))) for x in v]
    out = set()
    for q, a in usable.items():
        if q % 50:
            continue
        best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable.items() if i != q)[:k]
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)}
    return out


def _got(df, **more):
    return {tuple(r) for r in tt.search(df, F.col("vec_id") % 50 == 0, **more).collect()}


def test_small_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    assert _got(df, block_rows=90, query_rows=3) == _brute([(r["vec_id"], r["embedding"]) for r in df.collect()])


def test_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 4]) for i in range(150)]
    rows += [(200, None), (250, []), (300, [1.0, None, 0.0, 0.0]), (350, [float("nan")] * 4), (400, [float("inf")] * 4),
             (None, [1.0] * 4), (450, [0.0] * 4), (500, [1e12, 0.0, -1e12, 0.5])]
    df = spark.createDataFrame([(*r, "x") for r in rows + rows[:3]], "vec_id long, embedding array<float>, k string")
    small = df.where("vec_id is null or vec_id <> 500")
    assert _got(small, block_rows=40) == _brute([r for r in rows if r[0] != 500])
    assert {r[3] for r in _got(df) if r[0] == 500} <= {r[3] for r in _brute(rows) if r[0] == 500}
    assert _got(df.where("false")) == set()


def test_scores_beyond_64_bits_are_bounded(spark):
    big = float(2 ** 54)  # 2^62 once scaled
    rows = [(0, [big, big]), (1, [big, 0.0]), (2, [-big, -big]), (3, [0.25, 0.5]), (4, [2 * big, big])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["rank"], r["vec_id"], r["score"]) for r in tt.search(df, tt.F.col("vec_id") == 0).orderBy("rank").collect()]
    assert [v for _, v, _ in got] == [1, 3, 4, 2] and [s for *_, s in got] == [2 ** 63 - 1] * 3 + [-2 ** 63]


@pytest.mark.parametrize("skew", [False, True])
def test_stops_early_only_when_exact(skew):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 3)) * 100
    if skew:
        x[:, 0] *= 50
    x = np.floor(x)
    lists = tt.sorted_lists(x)
    for q in range(20):
        want = sorted(((-float(x[i] @ x[q]), i) for i in range(500) if i != q))[:5]
        got = tt.top_k(x, np.arange(500), lists, x[q], q, 5)
        assert [(-s, i) for s, i in got] == [(int(s), i) for s, i in want]
