import numpy as np
import pytest

from moodline.llm import mixing as mx
from moodline.llm import queries
from tests.conftest import SF_ORACLE


def test_targets_stop_at_twice_the_size_and_share_the_rest():
    got = mx.targets([("b", 100), (None, 1000), ("a", 10)])
    assert got["a"] == 20  # weight 3, stopped
    assert sum(got.values()) == pytest.approx(1.5 * 1110)
    assert got["b"] == 200 and got[None] == pytest.approx(1665 - 220)
    assert mx.targets([]) == {} and mx.targets([("a", 0)]) == {"a": 0.0}


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(1)
    size = rng.integers(1, 500, 1000).astype(float)
    prob = np.full(1000, 0.37)
    out = mx.fly(prob, size, rng.random(1000))
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert out.sum() == pytest.approx(prob.sum(), abs=1e-4) and out @ size == pytest.approx(prob @ size, rel=1e-6)
    equal = mx.fly(np.full(9, 0.5), np.ones(9), rng.random(9))
    assert equal.sum() == pytest.approx(4.5)


def test_landing_takes_the_nearest_choice():
    assert list(mx.land(np.array([0.5, 0.5]), np.array([10.0, 90.0]))) in ([0, 1], [1, 0])
    assert list(mx.land(np.array([0.6, 0.6, 0.6]), np.array([10.0, 90.0, 50.0]))) == [0, 1, 0]
    assert list(mx.land(np.array([0.5] * 4), np.array([30.0, 10.0, 10.0, 10.0]))) in ([1, 0, 0, 0], [0, 1, 1, 1])
    assert mx.land(np.array([0.9]), np.array([5.0])) == [1.0]


def test_query_reaches_targets_and_reruns_agree(spark):
    rows = queries.queries()["op2_mix"](spark, SF_ORACLE).collect()
    again = queries.queries()["op2_mix"](spark, SF_ORACLE).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    largest: dict = {}
    for r in rows:
        s = largest.setdefault(r["source"], [r["target"], 0, 0, r["source_size"], 0])
        s[1] += r["taken"]
        s[2] = max(s[2], r["size"])
        s[4] += r["size"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    for target, taken, most, given, size in largest.values():
        assert abs(taken - target) <= min(most, 0.01 * target) and given == size
    assert sum(x[0] for x in largest.values()) == pytest.approx(1.5 * sum(x[3] for x in largest.values()))


def test_many_blocks_agree_with_the_targets(spark):
    rows = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, null, concat('s', id % 7)) as source",
                                        "1 + id % 97 as size")
    got = mx.mix(rows, block_rows=64).groupBy("source").agg({"target": "max", "taken": "sum"}).collect()
    assert len(got) == 8 and all(abs(r["max(target)"] - r["sum(taken)"]) <= 97 for r in got)


def test_edges(docs_of):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "x y z " * 50_000, "en", None), (4, "a b c", "en", "b"),
            (4, "a b c", "en", "b"), (None, "q r", "en", "b")]
    docs = docs_of(rows)
    sizes = sorted((r["size"] for r in mx.sizes(docs).collect()))
    assert sizes == [0, 0, 2, 2, 2, 150_000]
    out = mx.mixed(docs)
    assert out.columns == docs.columns and all(r["text"] for r in out.collect())
    assert mx.mix(mx.sizes(docs)).count() == 6
    assert mx.mixed(docs.where("false")).count() == 0


def test_mixed_keeps_rows_that_differ_elsewhere(docs_of):
    """Rows equal in doc_id, source and text but not in lang stand for themselves; equal rows are counted."""
    rows = [(1, "a b c", lang, "s") for lang in ("en", "de", "fr", None)] + [(2, "d e", "en", "s")] * 3
    out = mx.mixed(docs_of(rows).select("doc_id", "text", "lang", "source")).collect()
    taken = {(r["doc_id"], r["lang"]) for r in out}
    # 150% of the source's words are taken and none more than twice, so at least three of four versions stand in the mix
    assert len({lang for i, lang in taken if i == 1}) >= 3
