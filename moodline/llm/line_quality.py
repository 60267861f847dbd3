"""Quality rules by cross-document line frequency.

A line's *normal form* is the sequence of its words (``textbuf``: letters and
digits, A-Z lower-cased) with every digit read as 0; lines without such a word
have none and are never removed. For each host, the distinct documents (texts)
that hold a normal form are counted. A line above its host's limit (at least
``LEAST_DOCUMENTS`` documents and more than ``SHARE`` of the host's distinct
documents) is removed; a document that keeps less than ``LEAST_LEFT`` of its
words is depleted and rejected, as is one that fails the base rules.

Base rules, over words ``[^\\x20\\x09-\\x0D]+``: fewer than 20 words, or more than
30% of the words in 8-word windows found twice or more in the text.

Defined cases: a null text counts as empty (it fails the base rules); null
hosts form one host; rows with equal host and text are one document for the
counts and share one verdict; an empty table gives an empty result; columns of
the input named like results are replaced by them, helper columns never clash.

What is counted are 64-bit hashes of (host, normal form). Rows per (host, line)
are partial sums before they are shuffled, so a line that stands in a third of
all documents costs no task more than the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodline.llm import ships_by_value
from moodline.llm.tables import written
from moodline.llm.textbuf import _IS_WORD, _LOWER, byte_ranges, chunks, mix, powers, range_hash, window_hash, words

ships_by_value(__name__)

LEAST_DOCUMENTS = 10
SHARE = 0.005
LEAST_LEFT = 0.3
LEAST_WORDS = 20
WINDOW = 8
MOST_REPEATED = 0.3
SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_SAME = np.arange(256, dtype=np.uint8)
_LINE_FOLD = _LOWER.copy()
_LINE_FOLD[48:58] = 48
_LINE_BASE = 0xA0761D6478BD642F


def _per_text(marked: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(marked) + 1, np.int64)
    np.cumsum(marked, out=sums[1:])
    return np.diff(sums[offsets])


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line bounds, text of each line); a line's bounds hold its line feed."""
    cuts = np.union1d(offsets, np.flatnonzero(data == 10) + 1)
    line_text = np.searchsorted(offsets, cuts[:-1], side="right") - 1
    return cuts, line_text


def normal_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(line bounds, text, normal-form hash, words of the normal form) of each line of a run of texts."""
    cuts, line_text = _lines(data, offsets)
    found = words(data, cuts, _IS_WORD, _LINE_FOLD)
    return cuts, line_text, range_hash(found.hash, found.first), found.counts()


def _repeated_words(hashes: np.ndarray, doc: np.ndarray, n_texts: int) -> np.ndarray:
    """Words per text that lie in a window found twice or more in that text."""
    found = window_hash(hashes, WINDOW)
    if not len(found):
        return np.zeros(n_texts, np.int64)
    at = np.flatnonzero(doc[:len(found)] == doc[WINDOW - 1:])
    key = mix(found[at] + mix(doc[at].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    step = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(step, at[twice], 1)
    np.add.at(step, at[twice] + WINDOW, -1)
    return np.bincount(doc[np.cumsum(step[:-1]) > 0], minlength=n_texts)


def _measured(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Base measures per text, then (text, normal form, words) of each text's distinct lines."""
    n = len(offsets) - 1
    found = words(data, offsets, ~_SPACE, _SAME)
    word_chars = _per_text(~_SPACE[data] & ((data & 0xC0) != 0x80), offsets)
    n_symbols = _per_text(_SYMBOL[data], offsets)
    cuts, line_text, form, form_words = normal_lines(data, offsets)
    line_words = np.diff(np.searchsorted(found.start, cuts))
    # whole lines, without their line feed, compared by hash and length
    ends = cuts[1:] - (data[cuts[1:] - 1] == 10) if len(data) else cuts[1:]
    up, down = powers(_LINE_BASE, len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    whole = mix((sums[ends] - sums[cuts[:-1]]) * down[cuts[:-1]])
    worded = line_words > 0
    n_lines = np.bincount(line_text[worded], minlength=n)
    distinct = np.unique(np.stack([line_text[worded].astype(np.uint64), whole[worded]], axis=1), axis=0)
    n_dup_lines = n_lines - np.bincount(distinct[:, 0].astype(np.int64), minlength=n)
    base = [found.counts(), word_chars, n_symbols, n_dup_lines, _repeated_words(found.hash, found.doc, n)]

    at = np.flatnonzero(form_words > 0)
    order = at[np.lexsort((form[at], line_text[at]))]
    text, form, amount = line_text[order], form[order], line_words[order]
    new = np.ones(len(order), bool)
    new[1:] = (text[1:] != text[:-1]) | (form[1:] != form[:-1])
    first = np.flatnonzero(new)
    return base, text[first], form[first], np.add.reduceat(amount, first) if len(first) else amount


def _measurer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column("_text")
        rest = [f.name for f in batch.schema if f.name != "_text"]
        base: list[list[np.ndarray]] = [[] for _ in MEASURES]
        forms, amounts, sizes = [], [], []
        for _, _, data, offsets in chunks(text):
            own, line_text, form, amount = _measured(data, offsets)
            for have, more in zip(base, own, strict=True):
                have.append(more)
            forms.append(form)
            amounts.append(amount)
            sizes.append(np.bincount(line_text, minlength=len(offsets) - 1))
        if not sizes:
            continue
        ends = np.zeros(batch.num_rows + 1, np.int32)
        np.cumsum(np.concatenate(sizes), out=ends[1:])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in rest), *(pa.array(np.concatenate(b).astype(np.int64)) for b in base),
             pa.ListArray.from_arrays(ends, pa.array(np.concatenate(forms).view(np.int64))),
             pa.ListArray.from_arrays(ends, pa.array(np.concatenate(amounts).astype(np.int64)))],
            names=[*rest, *MEASURES, "_forms", "_amounts"])


def _keyed(docs: DataFrame, host: str) -> DataFrame:
    """``docs`` as struct ``_row`` beside its host hash, two text hashes and the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.struct(*(f"`{c}`" for c in docs.columns if c != "text")).alias("_row"),
                       F.xxhash64(F.col(host).isNull(), F.col(host)).alias("_host"),
                       F.xxhash64(text).alias("_k1"), F.xxhash64(F.lit(1), text).alias("_k2"), text.alias("_text"))


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """Rows with the base measures and, as arrays, each text's distinct normal forms with their words; written."""
    keyed = _keyed(docs, host)
    schema = ", ".join([f"_row {keyed.schema['_row'].dataType.simpleString()}, _host long, _k1 long, _k2 long",
                        *(f"{m} long" for m in MEASURES), "_forms array<long>, _amounts array<long>"])
    return written(keyed.mapInArrow(_measurer, schema))


def _removed(table: DataFrame, least: int, share: float) -> DataFrame:
    """(_host, _k1, _k2, _form, _amount) of every line above its host's limit, once per distinct document."""
    lines = (table.select("_host", "_k1", "_k2", F.explode(F.arrays_zip("_forms", "_amounts")).alias("_line"))
             .select("_host", "_k1", "_k2", F.col("_line._forms").alias("_form"), F.col("_line._amounts").alias("_amount"))
             .distinct())
    held = lines.groupBy("_host", "_form").agg(F.count("*").alias("_held")).where(F.col("_held") >= least)
    hosts = (table.select("_host", "_k1", "_k2").distinct().groupBy("_host").agg(F.count("*").alias("_documents")))
    over = held.join(hosts, "_host").where(F.col("_held") > F.lit(share) * F.col("_documents")).select("_host", "_form")
    return lines.join(over, ["_host", "_form"])


def verdicts(docs: DataFrame, host: str = "source", least: int = LEAST_DOCUMENTS, share: float = SHARE,
             left: float = LEAST_LEFT) -> DataFrame:
    """``docs`` without text, with the base measures, base_failed, n_removed_lines, n_removed_words and kept."""
    table = measured(docs, host)
    cut = (_removed(table, least, share).groupBy("_host", "_k1", "_k2")
           .agg(F.count("*").alias("_lines"), F.sum("_amount").alias("_words")))
    full = table.drop("_forms", "_amounts").join(cut, ["_host", "_k1", "_k2"], "left")
    removed = F.coalesce("_words", F.lit(0))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > round(100 * MOST_REPEATED) * F.col("n_words"))
    depleted = F.col("n_words") - removed < F.lit(left) * F.col("n_words")
    results = {"base_failed": failed, "n_removed_lines": F.coalesce("_lines", F.lit(0)), "n_removed_words": removed,
               "kept": ~(failed | depleted)}
    own = [c for c in docs.columns if c != "text" and c not in results and c not in MEASURES]
    return full.select(*(F.col(f"_row.`{c}`") for c in own), *MEASURES, *(v.alias(k) for k, v in results.items()))


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rest = [f.name for f in batch.schema if f.name not in ("_text", "_cut")]
        column, gone = batch.column("_text"), batch.column("_cut")
        out: list[pa.Array] = []
        for lo, hi, data, offsets in chunks(column):
            cuts, line_text, form, amount = normal_lines(data, offsets)
            drop = np.zeros(len(line_text), bool)
            for k in range(lo, hi):
                forms = gone[k].as_py()
                if forms:
                    a, b = np.searchsorted(line_text, [k - lo, k - lo + 1])
                    drop[a:b] = (amount[a:b] > 0) & np.isin(form[a:b], np.array(forms, np.int64).view(np.uint64))
            keep = np.repeat(~drop, np.diff(cuts))
            ends = np.zeros(len(data) + 1, np.int64)
            np.cumsum(keep, out=ends[1:])
            left = data[keep]
            at = ends[offsets]
            out.append(byte_ranges(left, at[:-1], at[1:]))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.concat_arrays(out) if out else pa.array([], pa.string())],
                                         names=[*rest, "text"])


def cleaned(docs: DataFrame, host: str = "source", least: int = LEAST_DOCUMENTS, share: float = SHARE,
            left: float = LEAST_LEFT) -> DataFrame:
    """The kept documents, in the columns of ``docs``, without the lines above their host's limit.

    A removed line goes with its line feed. Null texts are not kept.
    """
    table = measured(docs, host)
    cut = (_removed(table, least, share).groupBy("_host", "_k1", "_k2")
           .agg(F.collect_list("_form").alias("_cut"), F.sum("_amount").alias("_words")))
    # equal rows of host and text share one verdict, so they are told once
    measures = table.select("_host", "_k1", "_k2", "n_words", "n_repeat_words").distinct()
    told = measures.join(cut, ["_host", "_k1", "_k2"], "left").where(
        (F.col("n_words") >= LEAST_WORDS) & (100 * F.col("n_repeat_words") <= round(100 * MOST_REPEATED) * F.col("n_words"))
        & (F.col("n_words") - F.coalesce("_words", F.lit(0)) >= F.lit(left) * F.col("n_words")))
    keyed = _keyed(docs, host)
    kept = keyed.join(told.select("_host", "_k1", "_k2", "_cut"), ["_host", "_k1", "_k2"]).select("_row", "_text", "_cut")
    cleared = kept.mapInArrow(_cutter, f"_row {keyed.schema['_row'].dataType.simpleString()}, text string")
    return cleared.select(*(F.col("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns))
