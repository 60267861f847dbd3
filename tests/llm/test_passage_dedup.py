import random
import re

import numpy as np
import pyarrow as pa

from moodline.llm import passage_dedup as pd_
from moodline.llm import textbuf
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def _rows(seed=2):
    rng = random.Random(seed)

    def fresh(n):
        return [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]

    shared = [fresh(n) for n in (51, 55, 60, 74, 120, 300)]
    short = fresh(49)
    rows = []
    for i in range(40):
        parts = fresh(rng.randrange(5, 80))
        for _ in range(rng.randrange(3)):
            parts += rng.choice(shared) + fresh(rng.randrange(1, 60))
        if i % 5 == 0:
            parts += short + fresh(3)
        rows.append((i, " ".join(parts)))
    return rows


def _check(rows, spans, across_only=False):
    """Every repeated 50-word window that is not its first is covered; every span equals its earlier place.

    ``across_only``: windows that stand in one text only need not be covered
    (lines that a text repeats in changing order may hide each other).
    """
    words = {i: _words(t) for i, t in rows if t is not None}
    covered = set()
    for i, at, n, j, there in spans:
        assert n >= 50 and (j, there) < (i, at)
        assert words[i][at:at + n] == words[j][there:there + n]
        assert at == 0 or there == 0 or words[i][at - 1] != words[j][there - 1]
        covered |= {(i, k) for k in range(at, at + n)}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 49):
            window = tuple(words[i][k:k + 50])
            known = first.setdefault(window, (i, k))
            if known != (i, k) and not (across_only and known[0] == i):
                assert all((i, m) in covered for m in range(k, k + 50)), (i, k)


def test_against_all_windows(docs_of):
    rows = _rows()
    got = [tuple(r) for r in pd_.repeats(docs_of(rows)).collect()]
    assert len(got) > 10
    _check(rows, got)


def test_small_table_against_all_windows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    _check(rows, [tuple(r) for r in pd_.repeats(docs).collect()], across_only=True)


def test_small_table_with_repeats_in_one_text(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    _check(rows, [tuple(r) for r in pd_.repeats(docs).collect()])


def test_passage_whose_seeds_all_stand_first_in_fragments(docs_of):
    rng = random.Random(4)

    def fresh(n):
        return [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]

    p = fresh(400)
    pieces = [p[a:a + 48] for a in range(0, 400, 23)]
    rows = [(i, " ".join(fresh(5) + x + fresh(5))) for i, x in enumerate(pieces)]
    rows += [(100, " ".join(fresh(9) + p + fresh(9))), (101, " ".join(fresh(3) + p + fresh(4))),
             (102, " ".join(fresh(3) + p[100:180] + fresh(4)))]
    got = sorted(tuple(r) for r in pd_.repeats(docs_of(rows)).collect())
    _check(rows, got)
    assert got == [(101, 3, 400, 100, 9), (102, 3, 80, 100, 109)]


def test_cutting_keeps_each_window_once(docs_of):
    rows = _rows(3)
    docs = docs_of(rows)
    cut = pd_.without_repeats(docs)
    assert cut.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert len(texts) == len(rows)
    assert {w for _, t in rows for w in _words(t)} == {w for t in texts.values() for w in _words(t)}
    spans = pd_.repeats(docs_of(sorted(texts.items()))).count()
    assert spans == 0


def test_edges(docs_of):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, "short"), (None, passage), (4, passage), (5, "Intro. " + passage.upper() + "!"),
            (5, "Intro. " + passage.upper() + "!"), (6, "z " * 100_000)]
    docs = docs_of(rows)
    got = sorted(tuple(r) for r in pd_.repeats(docs).collect() if r["doc_id"] != 6)
    assert got == [(5, 1, 60, 4, 0)]
    texts = [(r["doc_id"], r["text"]) for r in pd_.without_repeats(docs).collect()]
    assert len(texts) == 8 and (1, None) in texts and (None, passage) in texts and (4, passage) in texts
    assert texts.count((5, "Intro. ")) == 2
    assert len(dict(x for x in texts if x[0])[6]) < 200
    assert pd_.repeats(docs.where("false")).count() == 0


def test_contexts_are_the_words_beside_each_place(monkeypatch):
    """All asked places, also at a text's ends; a batch holds a bounded number of words."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 99, n)) for n in (0, 1, 7, 60, 300)]
    lefts = [None, [0, 1], [3], list(range(61)), [300, 0, 5]]
    rights = [[0], None, [7, 0], list(range(61)), [300, 299, 1]]
    batch = pa.RecordBatch.from_pydict({
        "doc_id": pa.array(range(5), pa.int64()), "version": pa.array(range(10, 15), pa.int64()), "text": pa.array(texts),
        "lefts": pa.array(lefts, pa.list_(pa.int32())), "rights": pa.array(rights, pa.list_(pa.int32()))})
    want = set()
    for i, text in enumerate(texts):
        data, offsets = textbuf.buffers(pa.array([text]))
        own = (textbuf.words(data, offsets).hash >> np.uint64(32)).astype(np.uint32)
        want |= {(i, i + 10, at, True, own[max(0, at - 24):at][::-1].tobytes()) for at in lefts[i] or ()}
        want |= {(i, i + 10, at, False, own[at:at + 24].tobytes()) for at in rights[i] or ()}
    monkeypatch.setattr(pd_, "CONTEXT_WORDS", 480)
    got = list(pd_._contexts(24)(iter([batch])))
    assert {tuple(r.values()) for b in got for r in b.to_pylist()} == want
    assert sum(b.num_rows for b in got) == len(want) and max(b.num_rows for b in got) == 20
