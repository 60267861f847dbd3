import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from moodline.llm import packing as pk
from moodline.llm import queries
from tests.conftest import SF_SMALL


def _check(rows, texts, sequence=2048, limit=0.03):
    """Round trip, gapless offsets, little padding."""
    path, _ = queries.tokenizer_files()
    own = Tokenizer.from_file(path)
    want = sorted((i is None, i or 0, tuple(own.encode(t or "", add_special_tokens=False).ids + [1])) for i, t in texts)
    by_doc: dict = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for missing, i, ids in want:
        own_rows = by_doc[None if missing else i]
        pieces = [r for r in own_rows if r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(
            np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes())]
        assert sum(r["length"] for r in pieces) % len(ids) == 0 and pieces
    assert sum(r["length"] for r in rows) == sum(len(ids) for *_, ids in want)
    by_sequence: dict = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    padded = 0
    for own_rows in by_sequence.values():
        at = 0
        for offset, length in sorted(own_rows):
            assert offset == at
            at += length
        assert 0 < at <= sequence
        padded += 0 if at & (at - 1) == 0 else sequence - at
    assert padded <= limit * sum(r["length"] for r in rows) + sequence


def test_small_table(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    _check(queries.queries()["op10_pack"](spark, SF_SMALL).collect(), texts)


def test_edges(docs_of):
    rows = [(1, None), (2, ""), (3, "word " * 30_000), (4, "a <|endoftext|> b"), (5, "same"), (5, "same"), (None, "no id")]
    docs = docs_of(rows)
    got = pk.pack(docs, *queries.tokenizer_files()).collect()
    _check(got, rows, limit=1)
    assert len([r for r in got if r["doc_id"] == 5]) == 2
    assert pk.pack(docs.where("false"), *queries.tokenizer_files()).count() == 0


def test_ranks_give_the_tokenizers_ids(spark):
    path, ranks = queries.tokenizer_files()
    fast, own = pk.Tokenizer(path, ranks, pk.added_tokens(path)), Tokenizer.from_file(path)
    texts = ["", " a  b\n\n c", "naïve 😀 ½ x²", "don't we'll I'VE", "\x00\x01", "<|endoftext|>", "a" * 3000, "   x"]
    texts += [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert [fast.ids(t) for t in texts] == [own.encode(t, add_special_tokens=False).ids for t in texts]


def test_short_texts_leave_little_padding(docs_of):
    rows = [(i, "word" + " word" * 15) for i in range(600)]
    got = pk.pack(docs_of(rows), *queries.tokenizer_files()).collect()
    _check(got, rows)
    assert len({r["sequence_id"] for r in got}) == -(-sum(r["length"] for r in got) // 2048)


@pytest.mark.parametrize("seed", range(3))
def test_exact_plan_holds_all_pieces(seed):
    rng = np.random.default_rng(seed)
    lengths = np.unique(rng.integers(1, 1000 if seed else 300, 900))
    demand = rng.integers(1, 200, len(lengths))
    plan = pk.exact_plan(lengths, demand, 2048, 16)
    held = dict.fromkeys(lengths.tolist(), 0)
    for times, own in plan:
        assert times > 0 and sum(k * n for k, n in own.items()) <= 2048
        for k, n in own.items():
            held[k] += n * times
    assert list(held.values()) == demand.tolist()
    assert sum(t for t, _ in plan) <= 1.01 * lengths @ demand / 2048 + 1


@pytest.mark.parametrize("space", [" ", "\n", "\u00a0"])
def test_long_runs_of_white_space(space):
    path, ranks = queries.tokenizer_files()
    text = "a" + space * 2_000_000 + "b"
    fast, own = pk.Tokenizer(path, ranks, pk.added_tokens(path)), Tokenizer.from_file(path)
    assert fast.ids(text) == own.encode(text, add_special_tokens=False).ids


def test_linear_program_is_near_the_bound():
    rng = np.random.default_rng(3)
    sizes = np.arange(1, 65)
    demand = rng.integers(0, 500, 64)
    plan = pk.patterns(demand, sizes, 64)
    assert (sum(t * p for t, p in plan) == demand).all() and all(p @ sizes <= 64 for _, p in plan)
    # No two pieces over half a sequence share one, and what is left of theirs takes the others at best.
    bounds = [demand @ sizes / 64] + [
        demand[sizes > 64 - a].sum() + demand[(sizes > 32) & (sizes <= 64 - a)].sum()
        + max(0, (demand * sizes)[(sizes >= a) & (sizes <= 64 - a)].sum() / 64
              - demand[(sizes > 32) & (sizes <= 64 - a)].sum()) for a in range(1, 33)]
    assert sum(t for t, _ in plan) <= np.ceil(max(bounds)) * 1.01 + 2


@pytest.mark.parametrize(("value", "sizes", "room"), [([3, 5, 7], [2, 3, 5], 11), ([1, 1], [4, 9], 3), ([0.0, 2], [1, 3], 7)])
def test_knapsack_matches_brute_force(value, sizes, room):
    from itertools import product
    best = max(sum(a * v for a, v in zip(n, value, strict=True)) for n in product(range(room + 1), repeat=len(sizes))
               if sum(a * s for a, s in zip(n, sizes, strict=True)) <= room)
    got, take = pk.best_pattern(np.array(value, float), np.array(sizes), room)
    assert got == best == pytest.approx(take @ np.array(value)) and take @ np.array(sizes) <= room
