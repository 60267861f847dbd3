"""Near duplicates by improved consistent weighted sampling (operator 7).

Texts become sets of shingles of five words. A shingle's weight is
(1 + ln tf) * idf on a grid of 1/16 in the logarithm, with
idf = 1 + ln(N / df), where df is the exact number of documents that hold the
shingle (``Weights``), whatever it is. By default the idf saturates for shingles
in less than ``common_share`` of the documents; the queries pass 0 for the whole
TF-IDF. Counted so, what a group of copies shares weighs the less the larger the
group is, and its near copies are no longer alike. With ``copies_once``, which
op7_neardup passes, a first sampling by these weights only tells which texts are
copies of each other: df then counts each group of them as one document, and the
texts that share a key are sampled and compared by the weights that follow.

Consistent weighted sampling draws, per sample and shingle, r and c from
Gamma(2, 1) and beta from U(0, 1); with t = floor(ln w / r + beta) and
ln y = r (t - beta) the shingle with the least ln c - ln y - r is kept together
with t. Draws come from a pool of 2^14 triples picked by a hash of the shingle
and the sample, so a draw costs one multiplication and one look-up. ``bands``
groups of ``rows`` samples make bucket keys: two texts of weighted Jaccard
similarity s share one with probability 1 - (1 - s^rows)^bands (0.998 at 0.8,
0.20 at 0.5, 0.006 at 0.3).

Candidates in one bucket are never paired all with all when the bucket is
large: small buckets pair their texts; in larger ones all texts are compared
with a leader (the text with most bucket mates). Texts that it does not match
meet only those that their weights leave room for (``_cells``); where these are
many on both sides, with leaders again, one first and four times as many each
round, until none is left. Texts that a leader nearly matches are then compared
with its followers, as long as no links join them. Every candidate is verified
by exact weighted Jaccard similarity.

Cases: copies of one word sequence are one text. Texts of one to four words
are one shingle; texts without words are duplicates only if equal; null texts
and rows without doc_id are never duplicates. Different texts that share a
doc_id are told apart by their keys. Repeated rows get equal results. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from moodline.llm import ships_by_value
from moodline.llm.components import components
from moodline.llm.tables import bucketed, written
from moodline.llm.textbuf import buffers, chunks, mix, range_hash, window_hash, words

ships_by_value(__name__)

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 28, 7
COMMON_SHARE = 1 / 3
SMALL_BUCKET = 32
LEADERS = 1
SLICES = 16
BLOCK_BYTES = 2 << 20
RANGE_BYTES = 12 << 20
_LOW = np.uint64((1 << 48) - 1)
_GRID = 16
_BIN = 0.05
# A text is named by its least doc_id and its key, as texts may share a doc_id.
ID = "struct<doc_id: bigint, key: bigint>"
_SIGNED = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("one", pa.int64()), ("two", pa.int64()), ("wordless", pa.bool_()),
                     ("same", pa.int64()), ("bands", pa.list_(pa.int64()))])
_SETS = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("entries", pa.binary())])
_LEVELS = 128
_POOL_BITS = 14


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE):
    """(text number, shingle hash) of every shingle, and the words they come from."""
    found = words(data, offsets)
    grams = window_hash(found.hash, size)
    n = len(grams)
    inside = found.doc[:n] == found.doc[size - 1:size - 1 + n] if n else np.zeros(0, bool)
    doc, grams = found.doc[:n][inside], grams[inside]
    counts = found.counts()
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = range_hash(found.hash, found.first)[short]
        doc = np.concatenate([doc, short])
        grams = np.concatenate([grams, whole])
        order = np.argsort(doc, kind="stable")
        doc, grams = doc[order], grams[order]
    return doc, grams, found


def counted(doc: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) in that order with how often each occurs."""
    order = np.lexsort((grams, doc))
    doc, grams = doc[order], grams[order]
    if not len(doc):
        return doc, grams, np.zeros(0, np.int64)
    new = np.empty(len(doc), bool)
    new[0] = True
    new[1:] = (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])
    at = np.flatnonzero(new)
    return doc[at], grams[at], np.diff(np.append(at, len(doc)))


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the number of their block: a run of a task's texts of about ``BLOCK_BYTES``."""
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        for lo, hi, _, _ in chunks(batch.column("text"), BLOCK_BYTES):
            rows = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(hi - lo, block)), *rows.columns],
                                             names=["block", *rows.schema.names])
            block += 1


def _blobs(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """Runs of rows as binary values; run i begins at ``first[i]``, the last entry is the end."""
    values = np.ascontiguousarray(values)
    offsets = first.astype(np.int64) * values[:1].nbytes if len(values) else np.zeros(len(first), np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(first) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)]
                                 ).cast(pa.binary())


def _ranged(grams: np.ndarray, ranges: int) -> np.ndarray:
    """The number of a hash's range in the high 16 bits, the hash's low 48 bits: what is sent and looked up."""
    return grams // np.uint64((1 << 64) // ranges + 1) << np.uint64(48) | grams & _LOW


def _packed(keys: np.ndarray) -> np.ndarray:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]


def _unpacked(column: pa.Array, ranges: pa.Array | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a column of packed ones and where each row's begin; the ranges go into the high bits."""
    data, offsets = buffers_of(column)
    keys = np.zeros((len(data) // 6, 8), np.uint8)
    keys[:, :6] = data.reshape(-1, 6)
    keys, first = keys.view("<u8").ravel().astype(np.uint64), offsets // 6
    if ranges is not None:
        keys |= np.repeat(ranges.to_numpy(zero_copy_only=False).astype(np.uint64) << np.uint64(48), np.diff(first))
    return keys, first


def _dealt(ranges: int):
    """Distinct shingles of each block with the number of its texts that hold them, dealt by ranges of their hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = np.arange(ranges, dtype=np.uint64) << np.uint64(48)
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            ends = np.append(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1, len(blocks))
            for begin, end in zip(np.append(0, ends[:-1]), ends, strict=True):
                for _, _, data, offsets in chunks(batch.column("text").slice(begin, end - begin), BLOCK_BYTES):
                    doc, grams, _ = shingles(data, offsets)
                    key, n = np.unique(_ranged(counted(doc, grams)[1], ranges), return_counts=True)
                    first = np.append(np.searchsorted(key, starts), len(key))
                    own = np.flatnonzero(np.diff(first))
                    kept = np.append(first[own], len(key))
                    yield pa.RecordBatch.from_pydict({
                        "range": pa.array(own.astype(np.int32)), "block": pa.array(np.full(len(own), blocks[begin])),
                        "grams": _blobs(_packed(key), kept), "n": _blobs(n.astype(np.int32), kept)})
    return run


def _document_frequencies(dealt: pa.Table) -> pa.Table:
    """All shingles of one range of hashes -> per block those in two texts or more of the table, with their counts."""
    dealt = dealt.combine_chunks()
    keys, first = _unpacked(dealt.column("grams").chunk(0))
    n = buffers_of(dealt.column("n").chunk(0))[0].view(np.int32)
    order = np.argsort(keys)
    ranked = keys[order]
    at = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    df = np.empty(len(keys), np.int64)
    df[order] = np.repeat(np.add.reduceat(n[order], at, dtype=np.int64), np.diff(np.append(at, len(keys))))
    kept = df > 1
    first = np.append(0, np.cumsum(kept))[first]
    return pa.table({"block": dealt.column("block"), "range": dealt.column("range"),
                     "grams": _blobs(_packed(keys[kept]), first), "df": _blobs(df[kept], first)})


def _dealt_by_group(ranges: int):
    """Distinct (shingle, group) of a block's texts with the number of documents that are copies of these, dealt by ranges."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        starts = np.arange(ranges, dtype=np.uint64) << np.uint64(48)
        names = zip(right.column("doc_id").to_pylist(), right.column("key").to_pylist(), strict=True)
        place = {name: i for i, name in enumerate(names)}
        group, n = (right.column(c).to_numpy().astype(np.int64) for c in ("group", "n"))
        parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        for batch in left.select(["doc_id", "text"]).combine_chunks().to_batches():
            ids = batch.column("doc_id").to_pylist()
            for lo, _, data, offsets in chunks(batch.column("text"), BLOCK_BYTES):
                doc, grams, found = shingles(data, offsets)
                doc, grams, _ = counted(doc, grams)
                key = range_hash(found.hash, found.first).view(np.int64).tolist()
                at = np.array([place.pop((ids[lo + i], k), -1) for i, k in enumerate(key)], np.int64)[doc]  # repeated rows: once
                parts.append((_ranged(grams[at >= 0], ranges), at[at >= 0]))
        key, at = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((group[at], key))
        key, at = key[order], at[order]
        own = group[at]
        new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (own[1:] != own[:-1])]) if len(key) else np.zeros(0, np.int64)
        held = np.add.reduceat(n[at], new) if len(new) else np.zeros(0, np.int64)
        key, own = key[new], own[new]
        first = np.append(np.searchsorted(key, starts), len(key))
        some = np.flatnonzero(np.diff(first))
        kept = np.append(first[some], len(key))
        block = left.column("block")[0].as_py() if len(left) else 0
        return pa.table({"block": pa.array(np.full(len(some), block)), "range": pa.array(some.astype(np.int32)),
                         "grams": _blobs(_packed(key), kept), "group": _blobs(own, kept), "n": _blobs(held, kept)})
    return run


def _less_copies(counts: pa.Table, dealt: pa.Table) -> pa.Table:
    """Counts of one range of hashes less what groups hold more than once -> per block those above 1 of the shingles it dealt."""
    if not dealt.num_rows:
        return pa.table({"block": pa.array([], pa.int64()), "range": pa.array([], pa.int32()), "grams": pa.array([], pa.binary()),
                         "df": pa.array([], pa.binary())})
    keys, first = _unpacked(dealt.column("grams").combine_chunks())
    group, n = (buffers_of(dealt.column(c).combine_chunks())[0].view(np.int64) for c in ("group", "n"))
    order = np.lexsort((group, keys))
    ranked, own = keys[order], group[order]
    pair = np.flatnonzero(np.r_[True, (ranked[1:] != ranked[:-1]) | (own[1:] != own[:-1])])
    more, ranked = np.add.reduceat(n[order], pair) - 1, ranked[pair]
    at = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    single, df = ranked[at], np.ones(len(at), np.int64)
    if counts.num_rows:
        known, row = np.unique(_unpacked(counts.column("grams").combine_chunks())[0], return_index=True)
        place = np.minimum(np.searchsorted(known, single), len(known) - 1)
        hit = known[place] == single
        df[hit] = buffers_of(counts.column("df").combine_chunks())[0].view(np.int64)[row[place[hit]]] - np.add.reduceat(more, at)[hit]
    df = df[np.searchsorted(single, keys)]
    kept = df > 1
    first = np.append(0, np.cumsum(kept))[first]
    return pa.table({"block": dealt.column("block"), "range": dealt.column("range"),
                     "grams": _blobs(_packed(keys[kept]), first), "df": _blobs(df[kept], first)})


def _counts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Keys and document frequencies of rows of ``Weights.df``."""
    return _unpacked(batch.column("grams"), batch.column("range"))[0], buffers_of(batch.column("df"))[0].view(np.int64)


class Weights:
    """Texts in blocks, and the exact document frequency of every shingle, beside the blocks that hold it.

    Blocks deal their distinct shingles by ranges of the hash, each range sums
    them over all documents, and the sums go back to the blocks that asked: two
    shuffles of six bytes a shingle and less, no task holds more than its range or
    block. Shingles without a sum stand in one document only. With
    ``common_share`` the idf saturates for shingles in a smaller share of the
    documents; 0 leaves all as they are.
    """

    def __init__(self, docs: DataFrame, common_share: float):
        spark = docs.sparkSession
        of = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
        self.n, self.most = of.n, 1 - math.log(common_share) if common_share else math.inf
        # A block is one task's, so few files hold a bucket; the blocks' texts are never shuffled.
        self.texts = bucketed(docs.where("text is not null").select("doc_id", "text", F.xxhash64(F.lit(1), "text").alias("same"))
                              .mapInArrow(_placed, "block long, doc_id long, text string, same long"), "block", shuffled=False)
        self.ranges = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil((of.bytes or 0) / RANGE_BYTES)), 1 << 16)
        self.df = written(self.texts.mapInArrow(_dealt(self.ranges), "range int, block long, grams binary, n binary")
                          .groupBy("range").applyInArrow(_document_frequencies, "block long, range int, grams binary, df binary")
                          .where("length(grams) > 0"))

    def of_copies(self, held: DataFrame) -> Weights:
        """Texts of ``held`` only, by document frequencies that count each group of copies once.

        ``held`` has one row per text: the block and doc_id of a row that holds it,
        its key, the group and the number n of documents that are copies of it. Blocks
        deal these texts' shingles by group, each range takes from its counts what
        groups hold more than once. Other documents count as before.
        """
        of = held.agg(F.sum("n").alias("n"), F.count_distinct("group").alias("groups")).first()
        found = copy.copy(self)
        found.n = self.n - (of.n or 0) + of.groups

        # Joined by the block alone, the texts stay where they are; a block's list is that of some hundred texts.
        ids = held.groupBy("block").agg(F.collect_set("doc_id").alias("ids"))
        texts = self.texts.join(ids.hint("merge"), "block").where(F.array_contains("ids", F.col("doc_id"))).drop("ids")
        found.texts = bucketed(texts, "block", shuffled=False)
        dealt = (found.texts.groupBy("block").cogroup(held.groupBy("block"))
                 .applyInArrow(_dealt_by_group(self.ranges), "block long, range int, grams binary, group binary, n binary"))
        found.df = written(self.df.groupBy("range").cogroup(dealt.groupBy("range"))
                           .applyInArrow(_less_copies, "block long, range int, grams binary, df binary").where("length(grams) > 0"))
        return found

    def with_idf(self, work, schema: pa.Schema, asked: DataFrame | None = None) -> DataFrame:
        """``work(idf, batches)`` over the texts of each block, with the idf of the block's shingles.

        ``asked`` (block, doc_id): only these documents, else all with a doc_id.
        """
        n, most, ranges = self.n, self.most, self.ranges
        beside = self.df.withColumn("asked", F.lit(None).cast("long"))
        if asked is not None:
            beside = beside.unionByName(asked.select("block", F.col("doc_id").alias("asked")), allowMissingColumns=True)

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            rows = left.select(["block", "doc_id", "text", "same"])
            wanted = right.column("asked").drop_null()
            if asked_only:
                rows = rows.filter(pc.is_in(rows.column("doc_id"), pa.array(wanted.to_numpy(), pa.int64())))
            parts = [_counts(b) for b in right.filter(pc.is_valid(right.column("grams"))).combine_chunks().to_batches()]
            gram, df = parts[0] if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            order = np.argsort(gram)
            idf = {"gram": gram[order], "idf": np.minimum(1 + np.log(n / df[order]), most), "rest": min(1 + math.log(n), most),
                   "ranges": ranges}
            batches = rows.combine_chunks().to_batches()
            return pa.Table.from_batches([found.cast(schema) for found in work(idf, batches)], schema)

        asked_only = asked is not None
        texts = self.texts.where("doc_id is not null")
        return texts.groupBy("block").cogroup(beside.groupBy("block")).applyInArrow(run, from_arrow_schema(schema))


def common_idf(docs: DataFrame, common_share: float = COMMON_SHARE) -> dict:
    """The idf of every shingle in at least ``common_share`` of the documents, of two at least.

    At most 1 / common_share times the mean number of shingles of a text can be
    that common, so the result is bounded whatever the number of documents.
    """
    weights = Weights(docs, common_share)
    least = max(common_share * weights.n, 2)

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram, df = _counts(batch)
            yield pa.RecordBatch.from_pydict({"gram": pa.array(gram[df >= least].view(np.int64)), "df": pa.array(df[df >= least])})

    found = weights.df.mapInArrow(common, "gram long, df long").distinct().toPandas()
    gram = found["gram"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(gram)
    return {"gram": gram[order], "idf": 1 + np.log(weights.n / found["df"].to_numpy(float)[order]), "rest": weights.most,
            "ranges": weights.ranges}


def weight_levels(grams: np.ndarray, n: np.ndarray, idf: dict) -> np.ndarray:
    """Grid level of each shingle's weight."""
    own = np.full(len(grams), idf["rest"])
    if len(idf["gram"]) and len(grams):
        keys = _ranged(grams, idf["ranges"])
        place = np.minimum(np.searchsorted(idf["gram"], keys), len(idf["gram"]) - 1)
        hit = idf["gram"][place] == keys
        own[hit] = idf["idf"][place[hit]]
    level = np.rint(_GRID * np.log((1 + np.log(n)) * own)).astype(np.int64)
    return np.clip(level, 0, _LEVELS - 1)


def sampling_pool(seed: int = 7) -> np.ndarray:
    """Per weight level and pool entry: ln c - ln y - r as an ordered 32-bit number, in the high half."""
    rng = np.random.default_rng(seed)
    size = 1 << _POOL_BITS
    r, c = rng.gamma(2.0, 1.0, size), rng.gamma(2.0, 1.0, size)
    beta = rng.random(size)
    ln_w = np.arange(_LEVELS)[:, None] / _GRID
    t = np.floor(ln_w / r + beta)
    value = (np.log(c) - r * (t - beta) - r).astype(np.float32)
    raw = value.view(np.uint32)
    ordered = np.where(raw >> 31, ~raw, raw | np.uint32(1 << 31))
    return ordered.astype(np.uint64) << np.uint64(32)


def sample_keys(doc: np.ndarray, grams: np.ndarray, level: np.ndarray, pool: np.ndarray,
                multipliers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and, per text, one 64-bit value per sample (equal: same shingle and t)."""
    at = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, np.int64)
    keys = np.empty((len(at), len(multipliers)), np.uint64)
    if not len(doc):
        return doc, keys
    flat, base = pool.ravel(), level << _POOL_BITS
    low = np.uint64(0xFFFFFFFF)
    for k, m in enumerate(multipliers):
        z = grams * m
        place = (z >> np.uint64(64 - _POOL_BITS)).astype(np.int64)
        place += base
        key = flat[place]
        z &= low
        key |= z
        keys[:, k] = np.minimum.reduceat(key, at)
    return doc[at], keys


def band_keys(keys: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = mix(keys).reshape(len(keys), bands, rows)
    factor = mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
    return mix((parts * factor).sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64))


def _signer(bands: int, rows: int):
    pools: list[np.ndarray] = []  # a task makes it once for all its blocks

    def run(idf: dict, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not pools:
            pools.append(sampling_pool())
        pool = pools[0]
        multipliers = mix(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)
        for batch in batches:
            ids = batch.column("doc_id")
            for lo, hi, data, offsets in chunks(batch.column("text"), 1 << 18):
                doc, grams, found = shingles(data, offsets)
                doc, grams, n = counted(doc, grams)
                level = weight_levels(grams, n, idf)
                has, keys = sample_keys(doc, grams, level, pool, multipliers)
                out = np.zeros((hi - lo, bands), np.uint64)
                out[has] = band_keys(keys, bands, rows)
                empty = found.counts() == 0
                one, two = range_hash(found.hash, found.first), range_hash(mix(found.hash), found.first)
                flat = pa.array(out.ravel().view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1, dtype=np.int32) * bands), flat)
                yield pa.RecordBatch.from_pydict({
                    "block": batch.column("block").slice(lo, hi - lo), "doc_id": ids.slice(lo, hi - lo), "one": pa.array(one.view(np.int64)),
                    "two": pa.array(two.view(np.int64)), "wordless": pa.array(empty),
                    "same": batch.column("same").slice(lo, hi - lo), "bands": lists})
    return run


def signatures(weights: Weights, bands: int = BANDS, rows: int = ROWS, asked: DataFrame | None = None) -> DataFrame:
    """(block, doc_id, text key k1, k2, bands) of rows with a text and a doc_id; wordless texts are keyed by their bytes."""
    signed = weights.with_idf(_signer(bands, rows), _SIGNED, asked)
    return signed.select("block", "doc_id", F.when(F.col("wordless"), F.col("same")).otherwise(F.col("one")).alias("k1"),
                         "two", F.when(~F.col("wordless"), F.col("bands")).alias("bands"))


def _shingle_sets(idf: dict, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for lo, hi, data, offsets in chunks(batch.column("text")):
            doc, grams, found = shingles(data, offsets)
            doc, grams, n = counted(doc, grams)
            key = range_hash(found.hash, found.first)
            entry = (grams & ~np.uint64(_LEVELS - 1)) | weight_levels(grams, n, idf).astype(np.uint64)
            yield pa.RecordBatch.from_pydict({"doc_id": ids.slice(lo, hi - lo), "key": pa.array(key.view(np.int64)),
                                              "entries": _blobs(entry, np.searchsorted(doc, np.arange(hi - lo + 1)))})


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sorted entry arrays (shingle hash in the high bits, weight level in the low ones)."""
    mask = np.uint64(_LEVELS - 1)
    wa, wb = (np.exp((x & mask).astype(float) / _GRID) for x in (a, b))
    ha, hb = a & ~mask, b & ~mask
    place = np.searchsorted(ha, hb)
    place[place == len(ha)] = 0
    hit = ha[place] == hb if len(ha) else np.zeros(len(hb), bool)
    both = np.minimum(wa[place[hit]], wb[hit]).sum()
    total = wa.sum() + wb.sum() - both
    return float(both / total) if total else 1.0


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = []
        for name in ("left", "right"):
            data, offsets = buffers_of(batch.column(name))
            sides.append([data[i:j].view(np.uint64) for i, j in zip(offsets[:-1], offsets[1:], strict=True)])
        sim = [weighted_jaccard(x, y) for x, y in zip(*sides, strict=True)]
        yield pa.RecordBatch.from_pydict({"a": batch.column("a"), "b": batch.column("b"),
                                          "similarity": pa.array(sim, pa.float64())})


def buffers_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column, bytes at offset 0 of their own buffer."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]].copy(), offsets - offsets[0]


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with their exact similarity."""
    left = sets.select(F.col("id").alias("a"), F.col("entries").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("entries").alias("right"))
    return written(pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "left", "right")
                   .mapInArrow(_verify, f"a {ID}, b {ID}, similarity double"))


def _ordered(x: str, y: str) -> tuple[Column, Column]:
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def _weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    mask = np.uint64(_LEVELS - 1)
    for batch in batches:
        data, offsets = buffers_of(batch.column("entries"))
        entries = data.view(np.uint64)
        text = np.repeat(np.arange(batch.num_rows), np.diff(offsets) // 8)
        ids = batch.column("id").take(pa.array(text))
        yield pa.RecordBatch.from_pydict({
            "doc_id": ids.field("doc_id"), "key": ids.field("key"), "gram": pa.array((entries & ~mask).view(np.int64)),
            "weight": pa.array(np.exp((entries & mask).astype(float) / _GRID))})


def _room(ids: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(id, total, least, most): each text's weight, and the least and most weight of one of ``ids`` as similar.

    A shingle that no other of these texts holds cannot be common to two of
    them: with total weights x, y and at most c of x held by others, a
    similarity of s needs s * x <= y <= x / s and s / (1 + s) * (x + y) <= c.
    Texts without such partners are left out.
    """
    grams = (sets.join(ids.hint("merge"), "id", "left_semi")
             .mapInArrow(_weighed, "doc_id long, key long, gram long, weight double"))
    # Partial sums leave a task at most one row per shingle, so frequent ones are not hot.
    own = (grams.groupBy("gram").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"), F.min("key").alias("key"),
                                     F.min("weight").alias("weight"))
           .where("n = 1").groupBy("doc_id", "key").agg(F.sum("weight").alias("alone")))
    totals = grams.groupBy("doc_id", "key").agg(F.sum("weight").alias("total"))
    common = F.col("total") - F.coalesce("alone", F.lit(0.0))
    low, high = 1 - 1e-9, 1 + 1e-9
    return written(totals.join(own.hint("merge"), ["doc_id", "key"], "left")
                   .select(F.struct("doc_id", "key").alias("id"), "total", (F.col("total") * (similarity * low)).alias("least"),
                           (F.least(common * ((1 + similarity) / similarity) - F.col("total"), F.col("total") / similarity)
                            * high).alias("most")).where("least <= most"))


def _bin(weight: Column) -> Column:
    return F.floor(F.log(weight) / math.log(1 + _BIN)).cast("int")


def _cells(rest: DataFrame, sets: DataFrame, similarity: float, small_bucket: int) -> tuple[DataFrame, DataFrame]:
    """(pairs, wide): what is left to compare among the texts of each bucket of ``rest`` (bucket, rep, degree).

    The heavier text of a similar pair finds the lighter one in the bins of
    weight that ``_room`` leaves it, and the lighter one the heavier: both meet
    in the cell of their two bins. Cells with few texts on one side give the
    pairs (a, b) that fit both texts' bounds; ``wide`` has the texts of the
    others, as buckets of their own.
    """
    room = _room(rest.select(F.col("rep").alias("id")).distinct(), sets, similarity)
    placed = written(rest.join(room.withColumnRenamed("id", "rep").hint("merge"), "rep"))
    own, least = _bin(F.col("total")), _bin(F.col("least"))
    heavy = placed.withColumns({"heavy": own, "light": F.explode(F.sequence(least, _bin(F.least("most", "total"))))})
    light = placed.where("most >= total").withColumns({"light": own, "heavy": F.explode(F.sequence(own, _bin(F.col("most"))))})
    cell = ["bucket", "heavy", "light"]
    # Of both sides only texts that may have a partner are dealt, so frequent buckets keep what weights allow.
    met = written(heavy.select(*cell, "rep", "degree", "total", "least", "most", F.lit(True).alias("above"))
                  .union(light.select(*cell, "rep", "degree", "total", "least", "most", F.lit(False).alias("above"))))
    sizes = (met.groupBy(*cell).agg(F.count_if("above").alias("above_n"), F.count_if(~F.col("above")).alias("below_n"))
             .select(*cell, F.least("above_n", "below_n").alias("few")).where("few > 0"))
    met = written(met.join(sizes.hint("merge"), cell))
    narrow = met.where(F.col("few") <= small_bucket)
    x = narrow.where("above").select(*cell, "rep", "total", "least", "most")
    y = narrow.where(~F.col("above")).select(*cell, F.col("rep").alias("other"), F.col("total").alias("weight"),
                                             F.col("least").alias("from"), F.col("most").alias("to"))
    pairs = (x.join(y.hint("merge"), cell)
             .where((F.col("rep") != F.col("other")) & F.col("weight").between(F.col("least"), F.col("most"))
                    & F.col("total").between(F.col("from"), F.col("to")))
             .select(*_ordered("rep", "other")).distinct())
    wide = met.where(F.col("few") > small_bucket).select(F.xxhash64(*cell).alias("bucket"), "rep", "degree").distinct()
    return written(pairs), written(wide)


def _bridged(stars: DataFrame, tried: DataFrame, sets: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame | None]:
    """(tried, label): ``tried`` with the pairs of leaders' followers and other texts (rep) that were compared with the leader.

    1 - similarity is a metric: only texts of similarity 2 * similarity - 1 or
    more with the leader can match a follower, and none that is further from the
    leader than the follower by over 1 - similarity. Of these only texts whose
    weights leave room for the similarity meet (``_room``), by bins of weight: a
    share of the followers first, all others only while no links join them to
    the leader; at once if that share gave no link. label: the components of the
    links (``components``), if they are known on the way.
    """
    slack = 1 - similarity + 1e-9
    seen = written(stars.distinct().join(tried.hint("merge"), ["a", "b"])
                   .where(F.col("similarity") >= similarity - slack).select("leader", "rep", "similarity"))
    if not seen.where(F.col("similarity") < similarity).limit(1).count():
        return tried, None
    room = _room(seen.select(F.col("rep").alias("id")).distinct(), sets, similarity)
    placed = written(seen.join(room.withColumnRenamed("id", "rep").hint("merge"), "rep"))
    followers = placed.where(F.col("similarity") >= similarity).select(
        "leader", F.col("rep").alias("follower"), F.col("similarity").alias("near"), F.col("total").alias("weight"),
        F.col("least").alias("from"), F.col("most").alias("to"), _bin(F.col("total")).alias("bin"),
        F.pmod(F.xxhash64("rep"), F.lit(SLICES)).cast("int").alias("slice"))
    weak = placed.where(F.col("similarity") < similarity)
    label: DataFrame | None = None
    first, last, linked = 0, 1, True
    while first < SLICES and weak.limit(1).count():
        if linked:  # else components are as before
            label = components(tried.where(F.col("similarity") >= similarity))
            own = label.select(F.col("node").alias("rep"), F.col("label").alias("own"))
            other = label.select(F.col("node").alias("leader"), F.col("label").alias("other"))
            weak = written(weak.join(own.hint("merge"), "rep", "left").join(other.hint("merge"), "leader", "left")
                           .where(F.coalesce("own", "rep") != F.coalesce("other", "leader")).drop("own", "other"))
        dealt = (weak.withColumn("slice", F.explode(F.sequence(F.lit(first), F.lit(last - 1))))
                 .withColumn("bin", F.explode(F.sequence(_bin(F.col("least")), _bin(F.col("most"))))))
        pairs = (dealt.join(followers.hint("merge"), ["leader", "slice", "bin"])
                 .where((F.col("near") <= F.col("similarity") + slack) & F.col("weight").between(F.col("least"), F.col("most"))
                        & F.col("total").between(F.col("from"), F.col("to")))
                 .select(*_ordered("rep", "follower")).distinct().join(tried.hint("merge"), ["a", "b"], "left_anti"))
        checked = _verified(pairs, sets)
        tried = tried.union(checked)
        linked = checked.where(F.col("similarity") >= similarity).limit(1).count() > 0
        first, last = last, min(4 * last, SLICES) if linked else SLICES
    return tried, None if linked else label


def _mates(keyed: DataFrame) -> DataFrame:
    """Texts and keys (rep, bucket) that another text has too, with the bucket's number n of texts and its least one."""
    sizes = keyed.groupBy("bucket").agg(F.count("*").alias("n"), F.min("rep").alias("least")).where("n > 1")
    return written(keyed.join(sizes.hint("merge"), "bucket"))


def _groups(mates: DataFrame) -> DataFrame:
    """(node, label): texts point to the least text of their largest bucket, label is where these pointers end.

    Looser than classes and never verified, it only says what document frequencies
    count as one. Pointers go to lesser texts, so they end; each round doubles their reach.
    """
    labels = written(mates.groupBy("rep").agg(F.min(F.struct(-F.col("n"), F.col("least").alias("least"))).alias("to"))
                     .select(F.col("rep").alias("node"), F.col("to.least").alias("label")))
    while True:
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("further"))
        new = written(labels.join(jump.hint("merge"), labels["label"] == jump["via"])
                      .select("node", F.col("label").alias("was"), F.col("further").alias("label")))
        if not new.where("label <> was").limit(1).count():
            return labels
        labels = new.select("node", "label")


def _copies_once(weights: Weights, reps: DataFrame, mates: DataFrame, bands: int, rows: int) -> tuple[Weights, DataFrame]:
    """(weights, keyed): weights that count each group of ``mates`` (``_groups``), with its copies, as one document; (rep, bucket) by them."""
    held = written(reps.join(_groups(mates).withColumnRenamed("node", "rep").hint("merge"), "rep", "left")
                   .where("label is not null or copies > 1")
                   .select("rep", "first.block", "rep.doc_id", "rep.key", F.xxhash64(F.coalesce("label", "rep")).alias("group"),
                           F.col("copies").alias("n"), F.col("label").isNotNull().alias("met")))
    weights = weights.of_copies(held)
    met = held.where("met")
    signed = signatures(weights, bands, rows, met.select("block", "doc_id")).withColumn(
        "rep", F.struct("doc_id", F.col("k1").alias("key")))
    # Repeated rows of a text give the same keys.
    keyed = signed.join(met.select("rep").hint("merge"), "rep", "left_semi").select("rep", F.explode("bands").alias("bucket")).distinct()
    return weights, written(keyed)


def links(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS,
          common_share: float = COMMON_SHARE, small_bucket: int = SMALL_BUCKET, copies_once: bool = False) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(members, pairs, label): (doc_id, key) -> representative of its word sequence, similar representatives a < b, their components if known.

    Pairs of texts that meet in a small bucket are all verified. In a larger
    bucket each text is verified against a leader, those that it does not match
    against each other as far as their weights leave room, in wide cells against
    leaders until one matches, and all against followers of leaders that nearly
    match; a pair is left out there only if other links join its texts or their
    weights exclude it. ``copies_once``: see ``_copies_once``.
    """
    weights = Weights(docs, common_share)
    signed = written(signatures(weights, bands, rows))
    reps = written(signed.groupBy("k1", "two").agg(
        F.min(F.struct("doc_id", F.col("k1").alias("key"))).alias("rep"), F.min_by("bands", "doc_id").alias("bands"),
        F.min(F.struct("doc_id", "block")).alias("first"), F.count("*").alias("copies")))
    members = (signed.select("doc_id", "k1", "two").join(reps.select("k1", "two", "rep"), ["k1", "two"])
               .select("doc_id", F.col("k1").alias("key"), "rep").distinct())
    # The tables below grow with the documents: their joins are sort-merge joins at every size.
    keyed = reps.where("bands is not null").select("rep", F.explode("bands").alias("bucket"))  # a key is one band's
    mates = _mates(keyed)
    if copies_once:
        weights, keyed = _copies_once(weights, reps, mates, bands, rows)
        mates = _mates(keyed)
    wanted = written(mates.groupBy("rep").agg(F.sum("n").alias("degree")))
    asked = reps.join(wanted.hint("merge"), "rep", "left_semi").select("first.block", "rep.doc_id")
    sets = weights.with_idf(_shingle_sets, _SETS, asked).select(F.struct("doc_id", "key").alias("id"), "entries")
    sets = written(sets.join(wanted.select(F.col("rep").alias("id")).hint("merge"), "id", "left_semi").dropDuplicates(["id"]))
    small = mates.where(F.col("n") <= small_bucket).select("bucket", "rep")
    pool = written(mates.where(F.col("n") > small_bucket).join(wanted.hint("merge"), "rep").select("bucket", "rep", "degree"))
    tried: DataFrame | None = None
    stars: DataFrame | None = None
    fitting: DataFrame | None = None
    leaders = LEADERS
    while True:
        pairs = (small.groupBy("bucket").agg(F.collect_set("rep").alias("reps"))
                 .select(F.explode(F.flatten(F.transform("reps", lambda x: F.transform(
                     F.filter("reps", lambda y: y > x), lambda y: F.struct(x.alias("a"), y.alias("b")))))).alias("p"))
                 .select("p.a", "p.b"))
        rank = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("degree"), "rep"))
        lead = pool.withColumn("rank", rank).where(F.col("rank") <= leaders).select("bucket", F.col("rep").alias("leader"))
        star = written(pool.join(lead.hint("merge"), "bucket").select("*", *_ordered("rep", "leader")))
        compared = star.where("rep <> leader").select("leader", "rep", "a", "b")
        stars = compared if stars is None else stars.union(compared)
        pairs = pairs.union(compared.select("a", "b")).distinct()
        if tried is not None:
            pairs = pairs.union(fitting).distinct().join(tried, ["a", "b"], "left_anti")
            fitting = fitting.limit(0)
        checked = _verified(pairs, sets)
        tried = checked if tried is None else tried.union(checked)
        linked = tried.where(F.col("similarity") >= similarity).select("a", "b", F.lit(True).alias("linked"))
        left = (star.join(linked, ["a", "b"], "left").groupBy("bucket", "rep", "degree")
                .agg(F.max((F.col("rep") == F.col("leader")) | F.coalesce("linked", F.lit(False))).alias("done"))
                .where(~F.col("done")).drop("done"))
        again = left.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
        rest = written(left.join(again, "bucket"))
        if not rest.limit(1).count():
            tried, label = _bridged(stars, tried, sets, similarity)
            return members, tried.where(F.col("similarity") >= similarity), label
        if fitting is None:
            # Where a leader matches few, the next ones may as well: weights tell which texts can match at all.
            fitting, pool = _cells(rest.drop("n"), sets, similarity, small_bucket)
            small = pool.limit(0)
            continue
        small, pool = (rest.where(c).drop("n") for c in (F.col("n") <= small_bucket, F.col("n") > small_bucket))
        leaders *= 4


def classes(docs: DataFrame, **parameters) -> DataFrame:
    """One row per distinct (doc_id, text): class_id and class_key (doc_id and key of the class's least text), n_links, key.

    A class is told by class_id alone where doc_ids are unique, else with
    class_key. n_links counts the verified links of the text, a lower bound of
    its near duplicates: large buckets verify what joins classes, not all
    pairs. A document without text is a class of its own without keys.
    """
    members, pairs, label = links(docs, **parameters)
    members, pairs = written(members), written(pairs)
    # A representative is the least of its copies, so a class's least text is that of its representatives.
    if label is None:
        label = components(pairs)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_links"))
    label = label.select(F.col("node").alias("rep"), "label")
    return (members.join(ends, "rep", "left").join(label.hint("merge"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
            .select("doc_id", F.col("label.doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.col("label.key").alias("class_key"), "key"))

def every_document(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``classes`` with rows for documents without text: classes of their own, without keys."""
    none = F.lit(None).cast("long")
    textless = (docs.where("doc_id is not null and text is null").select("doc_id").distinct()
                .select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
                        none.alias("class_key"), none.alias("key")))
    return found.unionByName(textless)


def _text_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, same = [], batch.column("__same").to_numpy()
        for lo, hi, data, offsets in chunks(batch.column("__text")):
            found = words(data, offsets)
            own = range_hash(found.hash, found.first).view(np.int64)
            keys.append(np.where(found.counts() == 0, same[lo:hi], own))
        if keys:
            yield pa.RecordBatch.from_arrays([batch.column("__row"), pa.array(np.concatenate(keys))], names=["__row", "__key"])


def one_of_each(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with one row of each class: its least (doc_id, text). Rows without text or doc_id stay.

    Of repeated rows (doc_id and text) one stays, the least by a hash of all its columns.
    """
    label = (classes(docs, **parameters).where("doc_id <> class_id or key <> class_key")
             .select(F.col("doc_id").alias("__id"), F.col("key").alias("__other")))
    keyless = docs.where("doc_id is null or text is null")
    full = docs.where("doc_id is not null and text is not null").select(
        F.struct(*[f"`{c}`" for c in docs.columns]).alias("__row"), F.col("text").alias("__text"),
        F.xxhash64(F.lit(1), "text").alias("__same"))
    keyed = full.mapInArrow(_text_keys, f"__row {full.schema['__row'].dataType.simpleString()}, __key long").withColumn(
        "__doc", F.col("__row.doc_id"))
    kept = keyed.join(label.hint("merge"), (F.col("__doc") == F.col("__id")) & (F.col("__key") == F.col("__other")), "left_anti")
    first = F.row_number().over(Window.partitionBy("__doc", "__key").orderBy(F.xxhash64("__row.*")))
    return kept.withColumn("__first", first).where("__first = 1").select("__row.*").unionByName(keyless)
