"""Phrase collocations by direct-address tiling.

Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those
into words ``[^\\x20\\x09]+``; phrases never cross pieces. Everything is per language
(null: ``und``). Frequent words (``least`` occurrences) get ids by descending
frequency. A pair of neighbouring ids is a cell of a square table that is split
into tiles of 1024 x 1024 cells: tiles of frequent ids are counted densely
(``bincount``), the rest as sorted coordinates. Frequent pairs are ranked in turn
and take the words' place: two overlapping pairs that follow each other are three
words, two overlapping triples four.

Candidates are phrases of 2 to 4 words with a = f(phrase) >= least. A cut after k
words gives l and r, the occurrences of both parts, and floor(2000000 a / (l + r));
the lowest cut counts (ties: smallest k). Candidates are dropped whose words lie
within a longer candidate with 100 f(longer) >= 80 a. Since f of a phrase between the
two is not lower, it suffices to look at candidates of one more word.

Words are told apart by 63-bit hashes of (language, word); a collision among the
words of a table is detected and another seed is taken, so counts are exact.
Dictionaries of up to ``MOST_SENT`` entries are sent to the tasks; larger ones are
joined, on each text's distinct keys. The results are the same.

Defined cases: null text is empty, an empty table gives an empty result, repeated
rows count as often as they stand, other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodline.llm import ships_by_value
from moodline.llm.tables import written
from moodline.llm.textbuf import _LOWER, byte_ranges, chunks, mix, words

ships_by_value(__name__)

LEAST = 30
LONGEST = 4
TOP = 2000
TILE = 1024
HEAD_TILES = 4  # tiles a side that may be counted densely
FLUSH = 3 << 19  # pairs counted at once
RUN = 1 << 18  # ids worked on at once
MOST_SENT = 1 << 21
SCALE = 2_000_000

_INSIDE = np.ones(256, bool)
_CUT = np.zeros(256, bool)
_CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_INSIDE[_CUT] = _INSIDE[[0x20, 0x09]] = False


def _salts(lang: pa.Array, seed: int) -> tuple[np.ndarray, pa.Array]:
    """A 64-bit value per row by its language, and the languages."""
    names = lang.fill_null("und").dictionary_encode()
    salt = [int.from_bytes(hashlib.sha256(f"{seed}:{n}".encode()).digest()[:8], "big") for n in names.dictionary.to_pylist()]
    return np.array(salt or [0], np.uint64)[names.indices.to_numpy()], names


def _text_keys(batch: pa.RecordBatch, seed: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, object, np.ndarray]]:
    """Per run of texts: (first row, end row, keys of its words, each word's row, words, bytes)."""
    salt, _ = _salts(batch.column("lang"), seed)
    for lo, hi, data, offsets in chunks(batch.column("text")):
        found = words(data, offsets, _INSIDE, _LOWER)
        row = found.doc + lo
        yield lo, hi, (mix(found.hash ^ salt[row]) >> np.uint64(1)).astype(np.int64), row, found, data


def _word_counter(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, langs = _salts(batch.column("lang"), seed)
            keys, times, names, spelt = [], [], [], []
            for _, _, key, row, found, data in _text_keys(batch, seed):
                own, first, n = np.unique(key, return_index=True, return_counts=True)
                keys.append(own)
                times.append(n)
                names.append(row[first])
                spelt.append(byte_ranges(_LOWER[data], found.start[first], found.end[first]))
            if not keys:
                continue
            own, first, where = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
            n = np.zeros(len(own), np.int64)
            np.add.at(n, where, np.concatenate(times))
            at = pa.array(np.concatenate(names)[first])
            yield pa.RecordBatch.from_arrays([langs.cast(pa.string()).take(at), pa.array(own), pa.concat_arrays(spelt).take(pa.array(first)), pa.array(n)],
                                             names=["_g", "_key", "_word", "_n"])
    return run


def _broken(key: np.ndarray, row: np.ndarray, found, data: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a run with -1 between pieces and after each text, and the number of entries per text."""
    cuts = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_CUT[data], out=cuts[1:])
    gap = np.flatnonzero((row[1:] == row[:-1]) & (cuts[found.start[1:]] > cuts[found.end[:-1]])) + 1
    ends = np.searchsorted(row, np.arange(lo, hi) + 1)
    marks = np.concatenate([gap, ends])
    values = np.insert(key, marks, -1)
    return values, np.bincount(row - lo, minlength=hi - lo) + np.bincount(row[gap] - lo, minlength=hi - lo) + 1


def _entries(batch: pa.RecordBatch, seed: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, entries per row) of runs of texts, or of ids as pairs of neighbours."""
    if "ids" not in batch.schema.names:
        for lo, hi, key, row, found, data in _text_keys(batch, seed):
            yield _broken(key, row, found, data, lo, hi)
        return
    column = batch.column("ids")
    offsets = column.offsets.to_numpy()
    lo = 0
    while lo < batch.num_rows:
        hi = min(max(int(np.searchsorted(offsets, offsets[lo] + RUN, side="right")) - 1, lo + 1), batch.num_rows)
        ids = column.values.to_numpy()[offsets[lo]:offsets[hi]].astype(np.int64)
        both = np.full(len(ids), -1, np.int64)
        if len(ids):
            both[:-1] = np.where((ids[:-1] >= 0) & (ids[1:] >= 0), ids[:-1] << 32 | ids[1:] & 0xFFFFFFFF, -1)
        yield both, np.diff(offsets[lo:hi + 1])
        lo = hi


def counted(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pair, times) of pairs a << 32 | b: head tiles that hold enough pairs by bincount, others sorted."""
    head = (pairs < TILE * HEAD_TILES << 32) & (pairs & 0xFFFFFFFF < TILE * HEAD_TILES)
    in_head, rest = pairs[head], pairs[~head]
    tile = ((in_head >> 32) // TILE * HEAD_TILES + (in_head & 0xFFFFFFFF) // TILE).astype(np.int16)
    full = np.bincount(tile, minlength=HEAD_TILES ** 2)
    dense = np.zeros(HEAD_TILES ** 2, bool)
    dense[full >= TILE * TILE // 8] = True
    keys, times = [], []
    for k in np.flatnonzero(dense):
        own = in_head[tile == k]
        cells = np.bincount((own >> 32) % TILE * TILE + (own & 0xFFFFFFFF) % TILE, minlength=TILE * TILE)
        cell = np.flatnonzero(cells)
        keys.append((cell // TILE + k // HEAD_TILES * TILE) << 32 | cell % TILE + k % HEAD_TILES * TILE)
        times.append(cells[cell])
    rest = np.concatenate([rest, in_head[~dense[tile]]])
    del in_head, tile
    own, n = np.unique(rest, return_counts=True)
    return np.concatenate([*keys, own]), np.concatenate([*times, n])


def _pair_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def told():
        keys, times = counted(np.concatenate(held))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(times.astype(np.int64))], names=["_key", "_n"])

    for batch in batches:
        for pairs, _ in _entries(batch, 0):
            held.append(pairs[pairs >= 0])
            size += len(held[-1])
            if size >= FLUSH:
                yield told()
                size = 0
    if size:
        yield told()


def _lists(values: np.ndarray, sizes: np.ndarray, name: str) -> pa.RecordBatch:
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=[name])


def _sent_encoder(keys: np.ndarray, ids: np.ndarray, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, sizes in _entries(batch, seed):
                at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                yield _lists(np.where(keys[at] == own, ids[at], np.int32(-1)), sizes, "ids")
    return run


def _key_lister(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, sizes in _entries(batch, seed):
                yield _lists(own, sizes, "_keys")
    return run


def _joined_encoder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for keys, pairs in zip(batch.column("_keys"), batch.column("_found"), strict=True):
            own = np.asarray(keys.values, np.int64)
            ids = np.full(len(own), -1, np.int64)
            if pairs.is_valid and len(pairs):
                known, of = (pairs.values.field(c).to_numpy() for c in ("_key", "_id"))
                order = np.argsort(known)
                at = np.minimum(np.searchsorted(known, own, sorter=order), len(known) - 1)
                ids = np.where(known[order[at]] == own, of[order[at]], -1)
            out.append(ids.astype(np.int32))
        if out:
            yield _lists(np.concatenate(out), np.array([len(o) for o in out]), "ids")


def _encoded(entries: DataFrame, table: DataFrame, size: int, seed: int, most_sent: int) -> DataFrame:
    """Each text's keys (of words or of neighbouring ids) as the ids of ``table``, -1 where it has none."""
    if size <= most_sent:
        sent = table.select("_key", "_id").toArrow()
        keys, ids = sent.column("_key").to_numpy(), sent.column("_id").to_numpy()
        order = np.argsort(keys)
        return written(entries.mapInArrow(_sent_encoder(keys[order], ids[order].astype(np.int32), seed), "ids array<int>"))
    listed = written(entries.mapInArrow(_key_lister(seed), "_keys array<long>").withColumn("_row", F.monotonically_increasing_id()))
    asked = listed.select("_row", F.explode(F.array_distinct("_keys")).alias("_key")).where("_key >= 0")
    found = (asked.join(table.select("_key", "_id"), "_key").groupBy("_row")
             .agg(F.collect_list(F.struct("_key", "_id")).alias("_found")))
    return written(listed.join(found, "_row", "left").select("_keys", "_found").mapInArrow(_joined_encoder, "ids array<int>"))


def _ranked(table: DataFrame) -> DataFrame:
    """``table`` with _id: 0, 1, ... by descending _n; ranges are numbered by the rows of the ranges before them."""
    order = [F.col("_n").desc(), F.col("_key")]
    ranges = written(table.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = (ranges.groupBy("_part").agg(F.count("*").alias("_rows"))
               .select(F.col("_part").alias("_of"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return written(ranges.withColumn("_own", own).join(offsets, F.col("_part") == F.col("_of"))
                   .withColumn("_id", F.col("_offset") + F.col("_own")).drop("_part", "_of", "_own", "_offset"))


def _words(docs: DataFrame, most_seeds: int = 4) -> tuple[DataFrame, int]:
    """(_g, _key, _word, _n) of all words, and the seed under which their keys differ."""
    for seed in range(most_seeds):
        found = written(docs.mapInArrow(_word_counter(seed), "_g string, _key long, _word string, _n long").groupBy("_key")
                        .agg(F.min("_word").alias("_word"), F.max("_word").alias("_other"), F.min("_g").alias("_g"),
                             F.max("_g").alias("_other_g"), F.sum("_n").alias("_n")))
        if not found.where("_word <> _other or _g <> _other_g").limit(1).count():
            return found.drop("_other", "_other_g"), seed
    raise RuntimeError("word keys collide under every seed")


def _phrases(pairs: DataFrame, below: DataFrame) -> DataFrame:
    """Pairs of ids with language, phrase, last word and the counts of their first and of their last words."""
    def side(name: str) -> DataFrame:
        return below.select(F.col("_id").alias(f"_{name}"), *(F.col(c).alias(f"{c}_{name}") for c in ("_g", "_phrase", "_last", "_pre", "_suf")))

    full = (pairs.withColumns({"_a": F.shiftright("_key", 32), "_b": F.col("_key").bitwiseAND(0xFFFFFFFF)})
            .join(side("a").drop("_last_a", "_suf_a"), "_a").join(side("b").drop("_g_b", "_phrase_b", "_pre_b"), "_b"))
    return full.select("_key", "_id", "_a", "_b", "_n", F.col("_g_a").alias("_g"), F.concat_ws(" ", "_phrase_a", "_last_b").alias("_phrase"),
                       F.col("_last_b").alias("_last"), F.concat("_pre_a", F.array("_n")).alias("_pre"),
                       F.concat("_suf_b", F.array("_n")).alias("_suf"))


def _scored(found: DataFrame, longer: DataFrame | None, length: int) -> DataFrame:
    """Candidates of one length that no longer one stands for, with their lowest cut."""
    if longer is not None:
        over = (longer.select(F.col("_a").alias("_in"), "_n").union(longer.select("_b", "_n")).groupBy("_in")
                .agg(F.max("_n").cast("decimal(20,0)").alias("_over")))
        own = F.col("_n").cast("decimal(20,0)")
        found = (found.join(over, F.col("_id") == F.col("_in"), "left")
                 .where(F.col("_over").isNull() | (100 * F.col("_over") < 80 * own)))
    cuts = F.expr(f"""array_min(transform(sequence(1, {length - 1}), k -> named_struct(
        's', (cast({SCALE} as decimal(7,0)) * cast(_n as decimal(20,0)))
             div (cast(_pre[k - 1] as decimal(20,0)) + cast(_suf[{length - 1} - k] as decimal(20,0))),
        'k', k, 'l', _pre[k - 1], 'r', _suf[{length - 1} - k])))""")
    return found.withColumn("_cut", cuts).select(
        F.col("_g").alias("lang"), F.col("_phrase").alias("phrase"), F.col("_n").alias("a"), F.col("_cut.l").alias("l"),
        F.col("_cut.r").alias("r"), F.col("_cut.s").alias("score"))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, most_sent: int = MOST_SENT) -> DataFrame:
    """``lang`` and ``text`` -> each language's first ``top`` candidates: lang, rank, phrase, a, l, r, n, score.

    Ordered by score descending, a descending, phrase (UTF-8 bytes) ascending.
    """
    docs = docs.select("lang", "text")
    vocabulary, seed = _words(docs)
    totals = vocabulary.groupBy("_g").agg(F.sum("_n").alias("n")).withColumnRenamed("_g", "lang")
    one = F.array("_n")
    level = _ranked(vocabulary.where(F.col("_n") >= least)).select(
        "_key", "_id", "_g", "_n", F.col("_word").alias("_phrase"), F.col("_word").alias("_last"), one.alias("_pre"), one.alias("_suf"))
    found: list[DataFrame] = []
    entries = docs
    for _ in range(2, longest + 1):
        size = level.count()
        if not size:
            break
        if size >= 1 << 31:
            raise ValueError("more than 2^31 frequent phrases of one length")
        entries = _encoded(entries, level, size, seed, most_sent)
        pairs = (entries.mapInArrow(_pair_counter, "_key long, _n long").groupBy("_key").agg(F.sum("_n").alias("_n"))
                 .where(F.col("_n") >= least))
        level = written(_phrases(_ranked(pairs), level))
        found.append(level)
    schema = "lang string, phrase string, a long, l long, r long, score long"
    candidates = docs.sparkSession.createDataFrame([], schema)
    for k, own in enumerate(found):
        candidates = candidates.union(_scored(own, found[k + 1] if k + 1 < len(found) else None, k + 2))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    first = candidates.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
