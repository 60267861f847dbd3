import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from moodline.llm import language_id as li
from moodline.llm import queries
from tests.conftest import SF_ORACLE


def _grams(texts: dict[str, list[str]]) -> pd.DataFrame:
    rows = {}
    for lang, own in texts.items():
        for t in own:
            b = b"\n\n\n" + t.encode()
            for i in range(3, len(b)):
                gram = b[i] | b[i - 1] << 8 | b[i - 2] << 16 | b[i - 3] << 24
                rows[lang, gram] = rows.get((lang, gram), 0) + 1
    return pd.DataFrame([(a, g, n) for (a, g), n in rows.items()], columns=["lang", "gram", "n"])


TEXTS = {"aa": ["abab abab cab", "bab"] * 6, "bb": ["xyz zyx xyz", "yx é"] * 6}


def _brute_bits(texts: list[str], text: str) -> float:
    """Method C with renormalised exclusion, straight from counts of every context."""
    counts: dict[bytes, dict[int, int]] = {}
    for t in texts:
        b = b"\n\n\n" + t.encode()
        for i in range(3, len(b)):
            for d in range(4):
                own = counts.setdefault(b[i - d:i] if d else b"", {})
                own[b[i]] = own.get(b[i], 0) + 1
    seen_anywhere = {x for own in TEXTS.values() for t in own for x in t.encode()}

    def prob(ctx: bytes, depth: int) -> list[float]:
        if depth < 0:
            return [1 / 256] * 256
        key = ctx[len(ctx) - depth:]
        shorter = prob(ctx, depth - 1)
        total_all = sum(sum(c.values()) for k, c in every.items() if k == key)
        if depth > 0 and total_all < (1 if depth < 2 else 4):
            return shorter
        own = counts.get(key)
        if not own:
            return shorter
        total, distinct = sum(own.values()), len(own)
        left = sum(p for s, p in enumerate(shorter) if s not in own)
        return [own[s] / (total + distinct) if s in own else p * distinct / (total + distinct) / left
                for s, p in enumerate(shorter)]

    every: dict[bytes, dict[int, int]] = {}
    for own in TEXTS.values():
        for t in own:
            b = b"\n\n\n" + t.encode()
            for i in range(3, len(b)):
                for d in range(4):
                    c = every.setdefault(b[i - d:i] if d else b"", {})
                    c[b[i]] = c.get(b[i], 0) + 1
    # A context with a byte that was never seen is read as its longest seen suffix.
    bits, b = 0.0, b"\n\n\n" + text.encode()
    for i in range(3, len(b)):
        ctx = b[i - 3:i]
        depth = 3
        while depth and (any(x not in seen_anywhere and x != 10 for x in ctx[3 - depth:])):
            depth -= 1
        bits -= math.log2(prob(ctx, depth)[b[i]])
    return bits


@pytest.mark.parametrize("text", ["abab", "zyx xyz", "cab xyz é", "b", "aé"])
def test_code_lengths_match_brute_force(text):
    model = li.freeze(_grams(TEXTS))
    data = np.frombuffer(text.encode(), np.uint8)
    got = li.code_lengths(model, data, np.array([0, len(data)]))[0]
    assert got == pytest.approx([_brute_bits(TEXTS[a], text) for a in model["langs"]], rel=1e-4)


def test_every_context_is_a_distribution():
    model = li.freeze(_grams(TEXTS))
    unseen = 256 - (model["size"] - 1)
    prob = np.exp2(-model["bits"].astype(float)).reshape(-1, model["size"], len(model["langs"]))
    prob[:, -1] *= unseen
    assert prob.sum(axis=1) == pytest.approx(np.ones((len(prob), len(model["langs"]))), rel=1e-4)


def test_held_out_accuracy(spark):
    got = queries.queries()["op8_language"](spark, SF_ORACLE)
    truth = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "lang")
    part = got.where("held_out").join(truth, "doc_id").agg(
        F.count("*").alias("n"), F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right")).first()
    assert part["n"] > 150 and part["right"] >= 0.95
    assert got.where("score < 0 or score > 1").count() == 0


def test_edges(docs_of):
    model = li.freeze(_grams(TEXTS))
    docs = docs_of(["abab", None, "", "123 !?", "xyz " * 300_000, "abab", "abab"]).drop("lang")
    rows = {r["doc_id"]: r for r in li.predict(docs, model).collect()}
    assert [rows[i]["lang_pred"] for i in range(7)] == ["aa", "und", "und", "und", "bb", "aa", "aa"]
    assert rows[1]["score"] == rows[2]["score"] == 0 and rows[0]["score"] == rows[5]["score"]
    assert rows[0]["k"] is None and rows[0]["band"] == "x"
    assert li.predict(docs.where("false"), model).count() == 0


def test_no_labels_at_all(docs_of):
    docs = docs_of([(0, "abab", None)])
    model = li.train(docs.where("lang is not null").select("doc_id", "text", "lang"))
    assert [r["lang_pred"] for r in li.predict(docs.drop("lang"), model).collect()] == ["und"]
