import hashlib

import pytest

from moodline.llm import shard_table as st


def _brute(shards, prime):
    """Preference lists written out, shards taking turns."""
    def h(name, salt):
        return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")

    lists = [[(h(s, "start") + j * (h(s, "step") % (prime - 1) + 1)) % prime for j in range(prime)] for s in shards]
    table, at = {}, [0] * len(shards)
    while len(table) < prime:
        for i, own in enumerate(lists):
            if len(table) == prime:
                break
            while own[at[i]] in table:
                at[i] += 1
            table[own[at[i]]] = i
    return [table[s] for s in range(prime)]


@pytest.mark.parametrize(("n", "prime"), [(1, 7), (3, 13), (7, 101), (13, 13)])
def test_fill_matches_written_out_preferences(n, prime):
    shards = tuple(f"s{i}" for i in range(n))
    assert st.filled(shards, prime) == _brute(shards, prime)


def test_even_and_little_disturbed():
    shards = tuple(f"s{i}" for i in range(20))
    table = st.filled(shards, 4001)
    sizes = [table.count(i) for i in range(20)]
    assert max(sizes) - min(sizes) <= 1
    fewer = st.filled(shards[:-1], 4001)
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != 19)
    assert moved < 0.1 * 4001


@pytest.mark.parametrize("bad", [((), 7), (("a", "a"), 7), (("a", "b"), 8), (("a", "b", "c"), 2)])
def test_bad_parameters(bad):
    with pytest.raises(ValueError):
        st.filled(*bad)


def test_edges(docs_of, scratch, spark):
    docs = docs_of([(1, "a"), (1, "b"), (None, "c"), (None, None), (2, "")])
    got = st.place(docs, "doc_id")
    assert got.count() == 5 and {"slot", "shard", *docs.columns} == set(got.columns)
    places = {(r["doc_id"], r["shard"]) for r in got.collect()}
    assert len(places) == 3
    assert st.place(docs.where("false"), "doc_id").count() == 0
    assert st.place(docs, "doc_id", spread=4).count() == 5
    st.write_shards(docs, f"{scratch}/out", "doc_id", files_per_shard=2)
    assert spark.read.parquet(f"{scratch}/out").count() == 5
