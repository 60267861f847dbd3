import random
import re
from collections import Counter

import numpy as np
import pytest

from moodline.llm import collocations as co


def _brute(rows, least, top):
    f, total = Counter(), Counter()
    for text, lang in rows:
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for k in range(1, 5):
                f.update((lang or "und", *w[i:i + k]) for i in range(len(w) - k + 1))
    frequent = {p: n for p, n in f.items() if len(p) > 2 and n >= least}
    out = []
    for (lang, *w), a in frequent.items():
        k = len(w)
        inside = any(o[0] == lang and len(o) > k + 1 and 100 * n >= 80 * a and any(o[i:i + k] == tuple(w) for i in range(1, len(o) - k + 1))
                     for o, n in frequent.items())
        if not inside:
            cuts = [(2_000_000 * a // (f[lang, *w[:i]] + f[lang, *w[i:]]), i) for i in range(1, k)]
            score, i = min(cuts)
            out.append((lang, " ".join(w), a, f[lang, *w[:i]], f[lang, *w[i:]], total[lang], score))
    ranked = []
    for lang in total:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(lang, k + 1, *r[1:]) for k, r in enumerate(own)]
    return ranked


def _same(docs_of, rows, least=3, top=50, **more):
    docs = docs_of([(k, t, g, "s") for k, (t, g) in enumerate(rows)])
    got = co.collocations(docs, least=least, top=top, **more)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(_brute(rows, least, top))


def _texts(n, seed=5):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(12)] + ["Éa", "X", "#-"]
    return [("".join(rnd.choice(vocabulary) + rnd.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ", "]) for _ in range(rnd.randrange(60))),
             rnd.choice(["en", "fr", None, "und"])) for _ in range(n)]


@pytest.mark.parametrize("most_sent", [co.MOST_SENT, 3])
def test_against_written_out_counts(docs_of, most_sent):
    """Sent dictionaries and joined ones give the same."""
    _same(docs_of, _texts(60), most_sent=most_sent)


def test_ties_and_top(docs_of):
    _same(docs_of, [("a b. c d. e f. g h i j", "en")] * 5 + [("a b c d e f", "fr")] * 4, top=2)


def test_overlaps_and_long_texts(docs_of):
    _same(docs_of, [("x " * 50_000 + "y z " * 9, "en"), ("x x x x", "fr"), ("x x x x", "fr"), ("X x x x", "fr")], least=4)


@pytest.mark.parametrize("rows", [[("", "en")], [(None, None)], [(" . \n", "en")], [("a", "en")] * 40])
def test_nothing_to_find(docs_of, rows):
    _same(docs_of, rows)


def test_empty_table(docs_of):
    assert co.collocations(docs_of([(1, "a")]).where("false")).count() == 0


def test_tiles_count_as_sorting_does():
    rnd = np.random.default_rng(1)
    a, b = (rnd.zipf(1.3, 900_000) % 6000 for _ in range(2))
    pairs = a.astype(np.int64) << 32 | b
    keys, times = co.counted(pairs)
    want = dict(zip(*np.unique(pairs, return_counts=True), strict=True))
    assert len(keys) == len(want) and dict(zip(keys, times, strict=True)) == want
    assert co.counted(pairs[:0])[0].size == 0
