import hashlib
import re

import pytest
from pyspark.sql import functions as F

from moodline.llm import fingerprint as fp
from moodline.llm import queries
from tests.conftest import SF_SMALL


def _pieces(t):
    return {p for p in re.split(r"\n|(?<=[.!?])[ \t\n\x0b\f\r]+", t) if p}


def _likeness(a, b):
    a, b = _pieces(a), _pieces(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def _brute(rows):
    ids = sorted({i for i, _ in rows}, key=lambda i: (i is not None, i or 0), reverse=True)
    least = {i: min(t or "" for j, t in rows if j == i) for i in ids}
    out = []
    for i, t in rows:
        t = t or ""
        beside = least[ids[(ids.index(i) + 1) % len(ids)]]
        half = len(t) // 2
        edited = t[:len(t) - half] + beside[:half]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), _likeness(t, edited), _likeness(t, beside)))
    return sorted(out, key=repr)


def _got(df):
    return sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"])
                   for r in df.collect()), key=repr)


def test_small_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = queries.queries()["op1_fingerprints"](spark, SF_SMALL)
    assert _got(got) == _brute([tuple(r) for r in docs])


def test_edges(docs_of):
    rows = [(9, "Same. Text here.\nMore"), (7, "Same. Text here.\nMore"), (5, None), (4, ""), (3, "é🙂é. x"),
            (None, "last one"), (2, "a"), (2, "b"), (2, "b"), (1, "\n".join(f"line {i}" for i in range(3000)))]
    got = fp.fingerprints(docs_of(rows))
    assert _got(got) == _brute(rows)
    prints = {(r["doc_id"], r["n_chars"]): r["fingerprint"] for r in got.collect()}
    assert prints[9, 21] == prints[7, 21] and prints[5, 0] == prints[4, 0] != prints[9, 21]
    assert fp.fingerprints(docs_of(rows).where("false")).count() == 0
    assert _got(fp.fingerprints(docs_of([(1, "only. one")]))) == _brute([(1, "only. one")])


@pytest.mark.parametrize(("cells", "load", "recovered"), [(24, 6, True), (6, 40, False), (96, 40, True)])
def test_peeling_recovers_or_says_so(spark, cells, load, recovered):
    df = spark.range(20).select(F.transform(F.sequence(F.lit(1), F.lit(load)), lambda i: F.xxhash64(i, "id")).alias("x"))
    entries = "transform(x, d -> named_struct('s', if(d % 2 = 0, 1, -1), 'd', d))"
    rows = df.select("x", F.expr(fp.peel_sql(fp.table_sql(entries, cells), cells)).alias("got")).collect()
    whole = [r["got"] is not None and sorted((e["d"], e["s"]) for e in r["got"])
             == sorted((d, -1 if d % 2 else 1) for d in r["x"]) for r in rows]
    assert (sum(whole) >= 17) if recovered else {r["got"] for r in rows} == {None}


@pytest.mark.parametrize("parameters", [{}, {"retries": 0, "cells": 3}, {"per_table": 500, "cells": 6, "retries": 1}])
def test_difference_is_the_set_difference(spark, parameters):
    """Also where every peeling fails and the last resort compares digest by digest."""
    sides = [(list(range(i, 3 * i)), list(range(2 * i, 2 * i + n))) for i, n in ((0, 0), (1, 4), (5, 9), (40, 1), (300, 310))]
    sides.append((list(range(500)), list(range(1, 503))))
    df = spark.createDataFrame(sides, "a array<long>, b array<long>").select(
        *(F.transform(c, lambda x: F.xxhash64(x)).alias(c) for c in ("a", "b")))
    df = df.select("*", fp.table("a").alias("ta"), fp.table("b").alias("tb"))
    for r in df.select("a", "b", fp.difference("a", "b", "ta", "tb", **parameters).alias("got")).collect():
        a, b = set(r["a"]), set(r["b"])
        assert sorted((e["s"], e["d"]) for e in r["got"]) == sorted([(1, d) for d in a - b] + [(-1, d) for d in b - a])


def test_next_ids(spark):
    ids = [5, 9, -3, 40, 7, 1000, 12, 13]
    got = {tuple(r) for r in fp.next_ids(spark.createDataFrame([(i,) for i in ids + ids], "k long")).collect()}
    order = sorted(ids, reverse=True)
    assert got == set(zip(order, order[1:] + order[:1], strict=True))
