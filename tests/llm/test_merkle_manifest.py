import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodline.llm import merkle_manifest as mm


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _leaf(row, more=0):
    i, text, lang, source = row
    n = len(text) if text else None
    return _h("".join(map(_field, (i, source, lang, None if n is None else n + more, text))))


def _reduced(nodes):
    """Levels of a tree, written out."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_h(*levels[-1][k:k + 2]) for k in range(0, len(levels[-1]), 2)])
    return levels


def _walk(levels, at):
    for level in levels[:-1]:
        pair = level[at // 2 * 2:at // 2 * 2 + 2]
        yield pair, at % 2
        at //= 2


def _brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        trees[g] = _reduced([_leaf(r) for r in groups[g]])
    top = _reduced([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for at, r in enumerate(groups[g]):
            steps = [*_walk(trees[g], at), *_walk(top, k)]
            proof = _h(*(x for pair, own in steps for j, x in enumerate(pair) if j != own))
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = _leaf(r, 1 if hit else 0)
            for pair, own in steps:
                node = _h(*(node if j == own else x for j, x in enumerate(pair)))
            out.append((r[0], g, _leaf(r), trees[g][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


def _same(docs_of, rows):
    docs = docs_of(rows)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    seen = F.when(hit, mm.leaf_digest([F.col(f) + 1 if f == "n_chars" else F.col(f) for f in mm.FIELDS]))
    got = mm.manifest(docs, seen=seen)
    assert sorted(map(repr, (tuple(r) for r in got.drop("proof").collect()))) == sorted(map(repr, _brute(rows)))
    for r in got.limit(20).collect():
        assert mm.folded(r["leaf"], r["proof"]) == r["root"]


@pytest.fixture()
def small_blocks(monkeypatch):
    monkeypatch.setattr(mm, "LEVELS", 2)
    monkeypatch.setattr(mm, "BLOCK", 4)


def test_trees_of_many_sizes(docs_of, small_blocks):
    rows = [(k * 3 - 40, f"t{k}", g, "s") for g, n in {"a": 1, "b": 2, "c": 5, "d": 16, "e": 17, "f": 70, None: 3, "é": 4}.items() for k in range(n)]
    random.Random(3).shuffle(rows)
    _same(docs_of, rows)


def test_ids_of_all_sizes(docs_of):
    ids = [0, 1, -1, 4095, 4096, -4096, 2**31, 2**53 + 1, 2**53, 2**62, -2**62, 2**63 - 1, -2**63, 2**28, 2**44, 2**44 - 1]
    _same(docs_of, [(i, f"text {i}", "en", None) for i in [*ids, None, *range(5000, 6000)]])


def test_shared_ids_and_repeated_rows(docs_of, small_blocks):
    rows = [(7, "same", "en", "s")] * 23 + [(7, f"other {k}", "en", "s") for k in range(11)] + [(None, None, "en", None)] * 6
    rows += [(None, "x", None, None)] * 2 + [(8, "y", "en", "s"), (6, "z", "en", "s")]
    _same(docs_of, rows)


def test_single_and_empty(docs_of):
    _same(docs_of, [(1, "", "en", "s")])
    assert mm.manifest(docs_of([(1, "a")]).where("false")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 255, 256, 3000, 4096])
def test_containers(n):
    own = np.sort(np.random.default_rng(n).permutation(4096)[:n])
    assert (mm.unpacked(mm.packed(own)) == own).all()
    repeated = own[::3]
    container = mm.Container(mm.packed(own), list(repeated), [2] * len(repeated))
    asked = np.arange(4096)
    assert (container.rank(asked) == np.searchsorted(own, asked) + 2 * np.searchsorted(repeated, asked)).all()
