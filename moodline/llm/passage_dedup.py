"""Removal of repeated passages with sparse suffix arrays (operator 4).

A suffix starts at a word. Kept are only suffixes at minimiser positions: the
least hash of ``select_words`` words in a window of ``window`` consecutive
starts, so that two copies of a passage keep the same places. With
``prefix = min_words - window + 1`` words, each passage of ``min_words`` words
holds a kept suffix whose first ``prefix`` words lie inside it. Kept suffixes
are sorted by the hash of those words (the shuffle's sort), equal neighbours
form one interval of the suffix array, and each is compared with the interval's
first suffix in the order of (doc_id, position). Neighbouring kept suffixes of
a text that match the same place are joined to one match, which is then
extended left and right until the words differ (to the right: or until another
repeat goes on). Passages whose first place of all seeds goes on differently are
left by that: every window of ``min_words`` words that holds a repeated seed and
lies in no match yet is sorted by the hash of all its words and compared with
the first of its equals, and these matches are extended likewise. So every
window of ``min_words`` words that stands earlier is found. Matches of at least
``min_words`` words are repeats of an earlier passage; cutting them leaves each
passage's first occurrence in place, as every cut points to a strictly smaller
(doc_id, position).

Cases: null, empty and short texts have no repeats. Repeats within one text
count. Rows without doc_id take no part. Rows that share a doc_id are told
apart by their text's hash, and equal rows are one text: they get equal cuts.
Extra columns pass through ``without_repeats``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodline.llm import ships_by_value
from moodline.llm.tables import bucketed, written
from moodline.llm.textbuf import chunks, window_hash, words

ships_by_value(__name__)

MIN_WORDS = 50
WINDOW = 25
SELECT_WORDS = 8
CONTEXT_WORDS = 1 << 20


def _sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each run of ``size`` values, by doubling."""
    out, width = values, 1
    while width * 2 <= size:
        out = pick(out[:-width], out[width:])
        width *= 2
    rest = size - width
    return pick(out[:-rest], out[rest:]) if rest else out


def kept_positions(hashes: np.ndarray, first: np.ndarray, doc: np.ndarray, window: int = WINDOW,
                   select_words: int = SELECT_WORDS) -> np.ndarray:
    """Word numbers (over all texts) that are the least of some window inside one text."""
    grams = window_hash(hashes, select_words)
    n = len(grams)
    if n < window:
        return np.zeros(0, np.int64)
    least = _sliding(grams, window, np.minimum)
    inside = doc[:len(least)] == doc[window + select_words - 2:window + select_words - 2 + len(least)]
    # A start is kept if the least value of some window that covers it, and lies in one text, is its own.
    lows = np.zeros(n + window - 1, np.uint64)
    lows[window - 1:window - 1 + len(least)] = np.where(inside, least, np.uint64(0))
    reach = _sliding(lows, window, np.maximum)
    return np.flatnonzero((reach == grams) & (grams > 0))


def _anchors(window: int, select_words: int, prefix: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions = batch.column("doc_id"), batch.column("version")
            for lo, hi, data, offsets in chunks(batch.column("text")):
                found = words(data, offsets)
                place = kept_positions(found.hash, found.first, found.doc, window, select_words)
                seeds = window_hash(found.hash, prefix)
                place = place[place < len(seeds)]
                place = place[found.doc[place] == found.doc[place + prefix - 1]]
                doc = found.doc[place]
                rows = pa.array(doc + lo)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids.take(rows), "version": versions.take(rows),
                    "pos": pa.array((place - found.first[doc]).astype(np.int32)),
                    "seed": pa.array(seeds[place].view(np.int64))})
    return run


def _short(hashes: np.ndarray) -> np.ndarray:
    """32 bits of each word hash, enough to compare words of two known places."""
    return (hashes >> np.uint64(32)).astype(np.uint32)


def _context(short: np.ndarray, begin: np.ndarray, end: np.ndarray, at: np.ndarray, reach: int, left: bool) -> pa.Array:
    """Up to ``reach`` words next to each place ``at`` of the text [begin, end); those to the left from the place backwards."""
    start = begin + (np.maximum(at - reach, 0) if left else at)
    stop = begin + (at if left else at + reach)
    start, stop = np.minimum(start, end), np.minimum(stop, end)
    size = np.maximum(stop - start, 0)
    offsets = np.zeros(len(at) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    step = np.arange(offsets[-1]) - np.repeat(offsets[:-1], size)
    words_at = np.repeat(stop - 1, size) - step if left else np.repeat(start, size) + step
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer((4 * offsets).astype(np.int32)), pa.py_buffer(short[words_at])])


def _contexts(reach: int):
    """Word hashes next to asked places of a text: to the left of ``lefts``, to the right of ``rights``."""
    most = max(1, CONTEXT_WORDS // reach)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions = batch.column("doc_id"), batch.column("version")
            for lo, hi, data, offsets in chunks(batch.column("text")):
                found = words(data, offsets)
                short = _short(found.hash)
                for left, name in ((True, "lefts"), (False, "rights")):
                    asked = batch.column(name).slice(lo, hi - lo)
                    rows = np.repeat(np.arange(hi - lo), pc.fill_null(pc.list_value_length(asked), 0).to_numpy(zero_copy_only=False))
                    places = pc.list_flatten(asked).to_numpy(zero_copy_only=False).astype(np.int64)
                    for k in range(0, len(rows), most):
                        row, at = rows[k:k + most], places[k:k + most]
                        take = pa.array(row + lo)
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": ids.take(take), "version": versions.take(take), "at": pa.array(at.astype(np.int32)),
                            "left": pa.array(np.full(len(at), left)),
                            "context": _context(short, found.first[row], found.first[row + 1], at, reach, left)})
    return run


def _common(short: np.ndarray, start: np.ndarray, step: int, room: np.ndarray, contexts: pa.Array, reach: int) -> np.ndarray:
    """How many words of each context the words from ``start`` on (``step`` 1 or -1), ``room`` at most, are equal to."""
    contexts = pc.fill_null(contexts, b"").cast(pa.large_binary())
    ends = np.frombuffer(contexts.buffers()[1], np.int64)[contexts.offset:contexts.offset + len(contexts) + 1] // 4
    data = contexts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    values = data[:len(data) // 4 * 4].view(np.uint32)
    size = np.maximum(np.minimum(np.minimum(room, reach), np.diff(ends)), 0)
    out, most = size.copy(), max(1, CONTEXT_WORDS // reach)
    for k in range(0, len(size), most):
        n = size[k:k + most]
        first = np.cumsum(n) - n
        along = np.arange(n.sum()) - np.repeat(first, n)
        differ = np.flatnonzero(short[np.repeat(start[k:k + most], n) + step * along] != values[np.repeat(ends[k:k + len(n)], n) + along])
        if len(differ):
            at = np.append(differ, np.iinfo(np.int64).max)[np.searchsorted(differ, first)]
            out[k:k + most] = np.where(at < first + n, at - first, n)
    return out


def _lengthened_by(lists: pa.Array, found, reach: int):
    """Matches of a run of texts as one array, their text numbers, and the words they gain to the left and right."""
    held = pc.list_flatten(lists)
    row = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    lo, hi = (_ints(held, c) for c in ("lo", "hi"))
    short, begin, end = _short(found.hash), found.first[row], found.first[row + 1]
    return (held, row, lo, hi, _common(short, begin + lo - 1, -1, lo, pc.struct_field(held, "left"), reach),
            _common(short, begin + hi, 1, end - begin - hi, pc.struct_field(held, "right"), reach))


def _ints(held: pa.Array, name: str) -> np.ndarray:
    return pc.struct_field(held, name).to_numpy(zero_copy_only=False).astype(np.int64)


def _extended(reach: int, min_words: int, cut: bool):
    """Extend each text's matches by its own words and cut it (``cut``) or list its repeats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [f.name for f in batch.schema]
            texts: list[str | None] = []
            for lo, hi, data, offsets in chunks(batch.column("text")):
                lists = batch.column("__matches").slice(lo, hi - lo)
                if not pc.sum(pc.list_value_length(lists)).as_py():
                    texts += batch.column("text").slice(lo, hi - lo).to_pylist() if cut else []
                    continue
                found = words(data, offsets)
                held, row, begin, end, more_left, more_right = _lengthened_by(lists, found, reach)
                begin, end = begin - more_left, end + more_right
                long = np.flatnonzero(end - begin >= min_words)
                row, begin, end = row[long], begin[long], end[long]
                if not cut:
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": batch.column("doc_id").take(pa.array(row + lo)), "start_word": pa.array(begin.astype(np.int32)),
                        "n_words": pa.array((end - begin).astype(np.int32)),
                        "first_doc_id": pc.struct_field(held, "first_doc").take(pa.array(long)),
                        "first_start_word": pa.array((begin - _ints(held, "shift")[long]).astype(np.int32))})
                    continue
                order = np.lexsort((end, begin, row))
                row, begin, end = row[order], begin[order], end[order]
                of = np.searchsorted(row, np.arange(hi - lo + 1))
                for k in range(hi - lo):
                    if not lists[k].is_valid or not len(lists[k]):
                        texts.append(batch.column("text")[lo + k].as_py())
                        continue
                    w0, w1 = int(found.first[k]), int(found.first[k + 1])
                    kept, done = [], int(offsets[k])
                    for a, b in zip(begin[of[k]:of[k + 1]], end[of[k]:of[k + 1]], strict=True):
                        start = int(found.start[w0 + a])
                        stop = int(found.start[w0 + b]) if w0 + b < w1 else int(offsets[k + 1])
                        if start > done:
                            kept.append(data[done:start].tobytes())
                        done = max(done, stop)
                    kept.append(data[done:offsets[k + 1]].tobytes())
                    texts.append(b"".join(kept).decode("utf-8"))
            if cut:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names if n != "__matches"],
                    names=[n for n in names if n != "__matches"])
    return run


def _lengthened(reach: int, min_words: int):
    """Matches extended by up to ``reach`` words a side; open ones may go on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions = batch.column("doc_id"), batch.column("version")
            for lo, hi, data, offsets in chunks(batch.column("text")):
                found = words(data, offsets)
                held, row, begin, end, more_left, more_right = _lengthened_by(batch.column("__matches").slice(lo, hi - lo), found, reach)
                begin, end = begin - more_left, end + more_right
                # Places of all texts in one row, each with two more than its words.
                place, long = found.first[row] + 2 * row, end - begin >= min_words
                ends = np.zeros(int(found.first[-1]) + 2 * (hi - lo) + 1, np.int64)
                np.add.at(ends, (place + begin)[long], 1)
                np.add.at(ends, (place + end)[long], -1)
                covered = np.cumsum(ends) > 0
                take = pa.array(row + lo)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids.take(take), "version": versions.take(take),
                    **{n: pc.struct_field(held, n) for n in ("first_doc", "first_version", "shift")},
                    "lo": pa.array(begin.astype(np.int32)), "hi": pa.array(end.astype(np.int32)),
                    **{n: pc.struct_field(held, n) for n in ("begin", "end")},
                    "open": pa.array((more_left == reach) | (more_right == reach) & ~covered[place + end])})
    return run


def _open_windows(min_words: int, prefix: int):
    """Hashes of the windows that hold a repeated seed and lie in no match of ``min_words`` words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions = batch.column("doc_id"), batch.column("version")
            lists = batch.column("__matches")
            for lo, hi, data, offsets in chunks(batch.column("text")):
                found = words(data, offsets)
                rows, starts, hashes = [], [], []
                for row in range(lo, hi):
                    own = found.hash[found.first[row - lo]:found.first[row - lo + 1]]
                    if len(own) < min_words:
                        continue
                    asked = np.zeros(len(own) - min_words + 1, bool)
                    held = lists[row].as_py()
                    for m in held:
                        asked[max(0, m["begin"] + prefix - min_words):m["end"] - prefix + 1] = True
                    for m in held:
                        if m["hi"] - m["lo"] >= min_words:
                            asked[m["lo"]:m["hi"] - min_words + 1] = False
                    at = np.flatnonzero(asked)
                    if len(at):
                        rows.append(np.full(len(at), row))
                        starts.append(at)
                        hashes.append(window_hash(own, min_words)[at])
                if rows:
                    take = pa.array(np.concatenate(rows))
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": ids.take(take), "version": versions.take(take),
                        "pos": pa.array(np.concatenate(starts).astype(np.int32)),
                        "seed": pa.array(np.concatenate(hashes).view(np.int64))})
    return run


_PLACE = ["doc_id", "version", "first_doc", "first_version", "shift"]
_ANCHORS = "doc_id long, version long, pos int, seed long"


def _runs(anchors: DataFrame, size: int) -> DataFrame:
    """Word ranges [lo, hi) whose anchors (each ``size`` words) match the first place of their seed, at one shift."""
    # Written, so that the join with it can split a seed that many places share.
    firsts = written(anchors.groupBy("seed")
              .agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "version", "pos")).alias("first"))
              .where("n > 1")
              .select("seed", F.col("first.doc_id").alias("first_doc"), F.col("first.version").alias("first_version"),
                      F.col("first.pos").alias("first_pos")))
    # These tables grow with the documents: their joins are sort-merge joins at every size.
    later = (anchors.join(firsts.hint("merge"), "seed")
             .where("doc_id <> first_doc or version <> first_version or pos <> first_pos")
             .select("doc_id", "version", "pos", "first_doc", "first_version",
                     (F.col("pos") - F.col("first_pos")).alias("shift")))
    # Anchors that match the same place and overlap make one match.
    along = Window.partitionBy(*_PLACE).orderBy("pos")
    begins = F.coalesce(F.col("pos") - F.lag("pos").over(along) > size, F.lit(True)).cast("int")
    return written(later.distinct().withColumn("run", F.sum(begins).over(along))
                   .groupBy(*_PLACE, "run")
                   .agg(F.min("pos").alias("lo"), (F.max("pos") + F.lit(size)).alias("hi")).drop("run")
                   .withColumn("begin", F.col("lo")).withColumn("end", F.col("hi")))


def _grown(texts: DataFrame, runs: DataFrame, reach: int, min_words: int) -> DataFrame:
    """Matches extended word by word; those still open after ``reach`` words go on with eight times as many."""
    done: DataFrame | None = None
    while True:
        asked = (runs.select(F.col("first_doc").alias("doc_id"), F.col("first_version").alias("version"),
                             F.expr("lo - shift").alias("left_at"), F.expr("hi - shift").alias("right_at"))
                 .groupBy("doc_id", "version")
                 .agg(F.collect_set("left_at").alias("lefts"), F.collect_set("right_at").alias("rights")))
        near = written(texts.join(asked.hint("merge"), ["doc_id", "version"])
                       .mapInArrow(_contexts(reach), "doc_id long, version long, at int, left boolean, context binary")
                       .distinct())

        def beside(side: str, at: str, near: DataFrame = near) -> DataFrame:
            return near.where(F.col("left") == (side == "left")).select(
                F.col("doc_id").alias("first_doc"), F.col("version").alias("first_version"),
                F.col("at").alias(at), F.col("context").alias(side)).hint("merge")

        placed = runs.withColumn("left_at", F.expr("lo - shift")).withColumn("right_at", F.expr("hi - shift"))
        placed = placed.join(beside("left", "left_at"), ["first_doc", "first_version", "left_at"], "left")
        placed = placed.join(beside("right", "right_at"), ["first_doc", "first_version", "right_at"], "left")
        held = placed.groupBy("doc_id", "version").agg(F.collect_list(F.struct(
            "lo", "hi", "shift", "first_doc", "first_version", "begin", "end", "left", "right")).alias("__matches"))
        grown = written(texts.join(held.hint("merge"), ["doc_id", "version"])
                        .mapInArrow(_lengthened(reach, min_words),
                                    "doc_id long, version long, first_doc long, first_version long, shift int, lo int, "
                                    "hi int, begin int, end int, open boolean").distinct())
        closed = grown.where("not open").drop("open")
        done = closed if done is None else done.union(closed)
        runs = grown.where("open").drop("open")
        if not runs.limit(1).count():
            return done
        reach *= 8


def matches(texts: DataFrame, min_words: int = MIN_WORDS, window: int = WINDOW,
            select_words: int = SELECT_WORDS) -> DataFrame:
    """Per (doc_id, version) of ``keyed_texts``: list of matches with an earlier place, extended.

    A match holds word range [lo, hi), shift to the earlier place and first_doc.
    """
    prefix = min_words - window + 1
    if prefix < select_words or window + select_words - 1 > min_words:
        raise ValueError("min_words must leave room for the window and the selecting words")
    anchors = written(texts.mapInArrow(_anchors(window, select_words, prefix), _ANCHORS))
    found = _grown(texts, _runs(anchors, prefix), window - 1, min_words)
    held = found.groupBy("doc_id", "version").agg(
        F.collect_list(F.struct("lo", "hi", "begin", "end")).alias("__matches"))
    windows = written(texts.join(held.hint("merge"), ["doc_id", "version"])
                      .mapInArrow(_open_windows(min_words, prefix), _ANCHORS).distinct())
    more = _runs(windows, min_words)
    if more.limit(1).count():
        found = found.union(_grown(texts, more, window - 1, min_words))
    # Overlapping matches with one place at one shift are one.
    along = Window.partitionBy(*_PLACE).orderBy("lo", "hi")
    before = F.max("hi").over(along.rowsBetween(Window.unboundedPreceding, -1))
    whole = (found.where(F.col("hi") - F.col("lo") >= min_words).select(*_PLACE, "lo", "hi").distinct()
             .withColumn("begins", F.coalesce(F.col("lo") > before, F.lit(True)).cast("int"))
             .withColumn("run", F.sum("begins").over(along)).groupBy(*_PLACE, "run")
             .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    nothing = F.lit(None).cast("binary")
    return written(whole.groupBy("doc_id", "version")
                   .agg(F.collect_list(F.struct("lo", "hi", "shift", "first_doc", nothing.alias("left"),
                                                nothing.alias("right"))).alias("__matches")))


def keyed_texts(docs: DataFrame) -> DataFrame:
    """Texts in buckets of (doc_id, version), by which they are joined again and again; the version is the text's hash."""
    keyed = (docs.where("doc_id is not null and text is not null")
             .select("doc_id", F.xxhash64(F.lit(4), "text").alias("version"), "text"))
    return bucketed(keyed, "doc_id", "version")


def repeats(docs: DataFrame, min_words: int = MIN_WORDS, window: int = WINDOW,
            select_words: int = SELECT_WORDS) -> DataFrame:
    """One row per repeated passage: doc_id, start_word, n_words, first_doc_id, first_start_word."""
    texts = keyed_texts(docs)
    found = matches(texts, min_words, window, select_words)
    return (texts.join(found.hint("merge"), ["doc_id", "version"])
            .mapInArrow(_extended(window - 1, min_words, False),
                        "doc_id long, start_word int, n_words int, first_doc_id long, first_start_word int")
            .distinct())


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS, window: int = WINDOW,
                    select_words: int = SELECT_WORDS) -> DataFrame:
    """``docs`` with every repeat of an earlier passage cut from its text; all rows and columns stay."""
    found = (matches(keyed_texts(docs), min_words, window, select_words)
             .select(F.col("doc_id").alias("__id"), F.col("version").alias("__version"), "__matches"))
    keyed = docs.withColumn("__own", F.xxhash64(F.lit(4), "text"))
    joined = keyed.join(found.hint("merge"), (F.col("doc_id") == F.col("__id")) & (F.col("__own") == F.col("__version")), "left")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return joined.select(*docs.columns, "__matches").mapInArrow(
        _extended(window - 1, min_words, True), schema)
