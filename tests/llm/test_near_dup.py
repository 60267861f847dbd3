import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodline.llm import near_dup as nd
from moodline.llm.queries import queries
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute_classes(rows: list[tuple[int, str | None]], most: float = 3.0) -> dict[int, int]:
    n = len(rows)
    bags = {}
    for i, t in rows:
        w = WORD.findall(_lower(t or ""))
        if t is not None and w:
            bags[i] = Counter(tuple(w[j:j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)])
    df = Counter(s for b in bags.values() for s in b)

    def weight(s, tf):
        idf = 1 + math.log(min(most, n / df[s]))
        return math.exp(round(16 * math.log((1 + math.log(tf)) * idf)) / 16)

    weighed = {i: {s: weight(s, c) for s, c in b.items()} for i, b in bags.items()}
    parent = {i: i for i, t in rows if t is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def union(x, y):
        x, y = find(x), find(y)
        parent[max(x, y)] = min(x, y)

    ids = sorted(weighed)
    for a in range(len(ids)):
        for b in range(a):
            x, y = weighed[ids[a]], weighed[ids[b]]
            if not x.keys() & y.keys():
                continue
            low = sum(min(x[s], y[s]) for s in x.keys() & y.keys())
            if low / (sum(x.values()) + sum(y.values()) - low) >= 0.8:
                union(ids[a], ids[b])
    blank = {}
    for i, t in rows:
        if t is not None and i not in weighed:
            union(i, blank.setdefault(t, i))
    return {i: find(i) for i in parent}


def _texts(seed=5):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(800)]
    rows = []
    for family in range(12):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([60, 150, 400]))]
        rows.append(" ".join(words))
        for _ in range(rng.choice([0, 1, 6, 25])):
            copy = list(words)
            for _ in range(rng.randrange(0, max(2, len(copy) // 60))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(" ".join(copy).title())
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_matches_brute_force_on_families(spark, docs_of):
    rows = _texts()
    got = {r["doc_id"]: r["class_id"] for r in nd.classes(docs_of(rows), small_bucket=4).collect()}
    assert got == brute_classes(rows)


def test_matches_brute_force_on_the_small_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: r["class_id"] for r in nd.classes(docs).collect()}
    assert got == brute_classes(rows)


def _drifting(positions, variants, size, seed=1):
    """Windows that drift over one long text, so that only neighbours are alike, in slightly edited variants."""
    rng = random.Random(seed)
    step = size // 16
    words = [f"w{i}" for i in range(size + positions * step)]
    rows = []
    for p in range(positions):
        for v in range(variants):
            own = words[p * step:p * step + size]
            own[rng.randrange(size)] = f"x{p}y{v}"
            rows.append(" ".join(own))
    return list(enumerate(rows))


@pytest.mark.parametrize(("bands", "rows"), [(3, 1), (6, 2)])
def test_drifting_chains_in_large_buckets(docs_of, bands, rows):
    texts = _drifting(14, 8, 400) + [(1000 + i, t.replace("w", "v")) for i, t in _drifting(9, 10, 300, seed=2)]
    got = {r["doc_id"]: r["class_id"] for r in nd.classes(docs_of(texts), bands=bands, rows=rows).collect()}
    assert got == brute_classes(texts) and len(set(got.values())) == 2


def test_edges(docs_of):
    rows = [(1, None), (2, None), (3, ""), (4, ""), (5, "one two"), (6, "One, two!"), (7, "one three"), (8, "?!"),
            (9, "?!"), (None, "one two"), (5, "one two"), (10, "w " * 200_000), (11, "w " * 200_000)]
    docs = docs_of(rows)
    got = {r["doc_id"]: r["class_id"] for r in nd.classes(docs).collect()}
    assert got == {3: 3, 4: 3, 5: 5, 6: 5, 7: 7, 8: 8, 9: 8, 10: 10, 11: 10}
    kept = nd.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 3, 5, 7, 8, 10]
    assert nd.classes(docs.where("false")).count() == 0


def test_texts_that_share_a_doc_id_are_kept_apart(docs_of):
    x, y, z = ("".join(f"{c}{k} " for k in range(40)) for c in "xyz")
    docs = docs_of([(5, x), (5, y), (7, z), (8, y), (9, z), (5, x), (5, None), (6, None), (6, None)])
    got = sorted((r["doc_id"], r["class_id"], r["key"] == r["class_key"]) for r in nd.classes(docs).collect())
    assert got == [(5, 5, True), (5, 5, True), (7, 7, True), (8, 5, True), (9, 7, True)]
    assert nd.classes(docs).select("class_id", "class_key").distinct().count() == 3
    kept = sorted((r["doc_id"], r["text"] or "") for r in nd.one_of_each(docs).collect())
    assert kept == sorted([(5, x), (5, y), (7, z), (5, ""), (6, ""), (6, "")])
    every = nd.every_document(docs, nd.classes(docs))
    assert sorted((r["doc_id"], r["class_id"]) for r in every.where("key is null").collect()) == [(5, 5), (6, 6)]


def test_common_shingles_get_their_exact_idf(docs_of):
    common = "this line stands in very many texts here "
    rows = [common + " ".join(f"w{i}x{j}" for j in range(30)) for i in range(40)] + [
        " ".join(f"v{i}y{j}" for j in range(30)) for i in range(20)]
    idf = nd.common_idf(docs_of(rows))
    assert len(idf["gram"]) == 4 and idf["idf"] == pytest.approx([1 + math.log(60 / 40)] * 4)


def test_rare_shingles_get_their_exact_idf(spark, docs_of, monkeypatch):
    """Every shingle weighs by the documents that hold it, whatever blocks and ranges count it."""
    words = [f"s{j}" for j in range(53)]
    rows = [(i, " ".join(words[:25] + [f"w{i}"] + words[25:])) for i in range(4)]
    rows += [(100 + i, " ".join(f"u{i}x{j}" for j in range(60))) for i in range(200)]
    rows += [(300, None), (None, rows[0][1])]
    docs = docs_of(rows).repartition(7)
    # Four texts that differ in one word: alike by counts, not once that word's shingles weigh by ln(N / 1).
    named = [r for r in rows if r[0] is not None]
    saturated = {r["doc_id"]: r["class_id"] for r in nd.classes(docs).collect()}
    assert len(set(saturated.values())) == 201
    monkeypatch.setattr(nd, "BLOCK_BYTES", 2000)
    exact = {r["doc_id"]: r["class_id"] for r in nd.classes(docs, common_share=0).collect()}
    assert exact == brute_classes(named, math.inf) and len(set(exact.values())) == 204
    weights = nd.Weights(docs, 0)
    assert weights.n == 206 and weights.df.select("block").distinct().count() > 4
    got = {}
    for r in weights.df.collect():
        df = np.frombuffer(r["df"], np.int64).tolist()
        got |= {(r["range"], r["grams"][6 * i:6 * i + 6]): n for i, n in enumerate(df)}
    assert sorted(got.values()) == [2] * 5 + [5] * 45


def test_exact_idf_matches_brute_force(docs_of):
    rows = _texts()
    got = {r["doc_id"]: r["class_id"] for r in nd.classes(docs_of(rows), small_bucket=4, common_share=0).collect()}
    assert got == brute_classes(rows, math.inf)


def test_sampling_collides_as_often_as_the_similarity():
    import numpy as np
    rng = np.random.default_rng(3)
    grams = np.sort(rng.integers(1, 1 << 63, 300).astype(np.uint64))
    level = rng.integers(0, 40, 300)
    a, b = np.arange(0, 220), np.arange(60, 300)
    w = np.exp(level / 16)
    both = w[60:220].sum()
    expect = both / (w[a].sum() + w[b].sum() - both)
    multipliers = nd.mix(np.arange(1, 2001, dtype=np.uint64)) | np.uint64(1)
    keys = [nd.sample_keys(np.zeros(len(x), np.int64), grams[x], level[x], nd.sampling_pool(), multipliers)[1][0]
            for x in (a, b)]
    assert (keys[0] == keys[1]).mean() == pytest.approx(expect, abs=0.04)


def test_large_buckets_of_near_misses_are_not_paired_all_with_all(docs_of, monkeypatch):
    """Texts round one passage, most too different by their own words: pairs verified grow with the texts."""
    passage = [f"p{j}" for j in range(200)]
    rows = [" ".join(passage + [f"o{i}x{j}" for j in range(3 + i % 30)]) for i in range(150)]
    rows += [r + " end" for r in rows[20:30]]
    rows = list(enumerate(rows))
    compared, verified = [], nd._verified

    def counting(pairs, sets):
        found = verified(pairs, sets)
        compared.append(found.count())
        return found

    monkeypatch.setattr(nd, "_verified", counting)
    got = {r["doc_id"]: r["class_id"] for r in nd.classes(docs_of(rows), bands=4, rows=1, common_share=0).collect()}
    want = brute_classes(rows, math.inf)
    assert got == want and 100 < len(set(want.values())) < 150
    assert sum(compared) < 12 * len(rows)


def test_cells_lose_no_similar_pair(spark):
    """Of texts of one bucket, every similar pair is given or meets in a wide cell, whatever counts as few."""
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(1, 1 << 40, 60, dtype=np.uint64)) << np.uint64(8)
    texts = []
    for k in range(70):
        kept = base[rng.random(len(base)) > (k % 35) / 100]
        fresh = rng.integers(1, 1 << 40, k // 9, dtype=np.uint64) << np.uint64(8)
        texts.append(np.unique(np.concatenate([kept, fresh])) | rng.integers(0, 3, 1, dtype=np.uint64))
    sets = spark.createDataFrame([((i, -i), t.tobytes()) for i, t in enumerate(texts)], f"id {nd.ID}, entries binary").cache()
    rest = spark.createDataFrame([(9, (i, -i), 5) for i in range(70)], f"bucket long, rep {nd.ID}, degree long")
    similar = {(i, j) for i in range(70) for j in range(i + 1, 70) if nd.weighted_jaccard(texts[i], texts[j]) >= 0.8}
    for few in (0, 4, 32):
        pairs, wide = nd._cells(rest, sets, 0.8, few)
        met = {tuple(sorted((r["a"]["doc_id"], r["b"]["doc_id"]))) for r in pairs.collect()}
        cells = {}
        for r in wide.collect():
            cells.setdefault(r["bucket"], set()).add(r["rep"]["doc_id"])
        assert similar and all(p in met or any({*p} <= c for c in cells.values()) for p in similar)
    assert met and len(met) < 70 * 69 / 2


def test_room_bounds_no_similar_pair_away(spark):
    """Whatever pair is as similar lies within both texts' bounds; a text with too much of its own has none."""
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(1, 1 << 40, 60, dtype=np.uint64)) << np.uint64(8)
    texts = []
    for k in range(60):
        kept = base[rng.random(len(base)) > k / 150]
        fresh = rng.integers(1, 1 << 40, k // 6, dtype=np.uint64) << np.uint64(8)
        texts.append(np.unique(np.concatenate([kept, fresh])) | rng.integers(0, 3, 1, dtype=np.uint64))
    texts.append(rng.integers(1 << 41, 1 << 42, 50, dtype=np.uint64) << np.uint64(8))
    texts[-1].sort()
    sets = spark.createDataFrame([((i, -i), t.tobytes()) for i, t in enumerate(texts)], f"id {nd.ID}, entries binary")
    room = {r["id"]["doc_id"]: r for r in nd._room(sets.select("id"), sets, 0.8).collect()}
    similar = [(i, j) for i in range(61) for j in range(61) if i != j and nd.weighted_jaccard(texts[i], texts[j]) >= 0.8]
    assert similar and 60 not in room
    for i, j in similar:
        assert room[i]["least"] <= room[j]["total"] <= room[i]["most"]


def _edited(words, edits, rng, name):
    own = list(words)
    for k in rng.sample(range(5, len(words) - 5, 6), edits):
        own[k] = f"{name}e{k}"
    return " ".join(own)


def test_near_copies_in_large_groups_are_found_by_the_query(spark, docs_of, scratch):
    """What a group shares weighs no less because the group is large; a passage of unrelated texts still does."""
    rng = random.Random(8)
    base, other = ([f"{c}{j}" for j in range(200)] for c in "bo")
    near = [_edited(base, 2, rng, f"n{i}x") for i in range(60)]
    copies = [" ".join(other)] * 40 + [_edited(other, 4, rng, f"c{i}x") for i in range(2)]
    passage = " ".join(f"p{j}" for j in range(150))
    clean = [" ".join(f"u{i}x{j}" for j in range(rng.choice([30, 120]))) for i in range(150)]
    clean += [f"{passage} " + " ".join(f"v{i}x{j}" for j in range(90)) for i in range(40)]
    docs_of(near + copies + clean).repartition(5).write.parquet(f"{scratch}/documents.parquet")
    got = {r["doc_id"]: r["class_id"] for r in queries()["op7_neardup"](spark, scratch).collect()}
    first, second = len(near), len(near) + len(copies)
    assert {got[i] for i in range(first)} == {0}
    assert {got[i] for i in range(first, second)} == {first}
    assert all(got[i] == i for i in range(second, second + len(clean)))


def test_groups_count_once_in_document_frequencies(spark, docs_of, monkeypatch):
    passage = " ".join(f"p{j}" for j in range(30))
    rows = [(i, f"{passage} a{i}") for i in range(9)] + [(20, f"{passage} a0"), (1, f"{passage} a1"), (None, f"{passage} a1")]
    rows += [(100 + i, f"some words that only these texts hold {i % 2}") for i in range(4)] + [(200, None), (201, "?")]
    monkeypatch.setattr(nd, "BLOCK_BYTES", 300)
    weights = nd.Weights(docs_of(rows).repartition(4), 0)
    signed = nd.signatures(weights).where("doc_id < 6 or doc_id = 20 or doc_id >= 100 and doc_id < 200")
    held = (signed.groupBy("k1").agg(F.min(F.struct("doc_id", "block")).alias("first"), F.count("*").alias("n"))
            .select("first.*", F.col("k1").alias("key"), "n", F.expr("if(first.doc_id < 100, first.doc_id % 2, -1) as `group`")))
    found = weights.of_copies(held)
    # 0 to 5 and the copies 20 and 1 are two groups, all of 100 to 103 one; 6 to 8 and a text without doc_id stay alone.
    assert weights.n == 18 and found.n == 9
    assert sorted({r["doc_id"] for r in found.texts.collect()}) == [0, 1, 2, 3, 4, 5, 100, 101]
    df = {}
    for r in found.df.collect():
        n = np.frombuffer(r["df"], np.int64).tolist()
        for i, k in enumerate(n):
            assert df.setdefault((r["range"], r["grams"][6 * i:6 * i + 6]), k) == k
    assert sorted(df.values()) == [2] + [6] * 26


def test_copies_count_once_on_families(docs_of):
    """Every link by whole document frequencies stays, and all texts alike by their counts alone join."""
    rows = _texts()
    whole = brute_classes(rows, math.inf)
    counted = brute_classes(rows, 1.0)
    for few in (4, 32):
        got = {r["doc_id"]: r["class_id"] for r in nd.classes(docs_of(rows), small_bucket=few, common_share=0, copies_once=True).collect()}
        assert got == counted and all(got[i] == got[c] for i, c in whole.items())
    assert len(set(whole.values())) > len(set(counted.values()))
