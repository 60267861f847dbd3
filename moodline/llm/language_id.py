"""Language identification by prediction by partial matching (operator 8).

Per language, a context tree over bytes of order 0 to 3 is counted from
labelled texts. Escape method C blends the orders: a symbol seen n times after
a context with N symbols, D of them distinct, has probability n / (N + D), and
the escape weight D / (N + D) is spread over the symbols not seen there in
proportion to the next shorter context. Each context's distribution sums to
one, so code lengths are exact. After training, statistics are frozen: the
trees are flattened to a table (longest kept context, byte) -> code length per
language, and a text costs one table look-up per byte and language.

Training uses a bounded, documented sample of labelled rows (whole texts,
``docs_per_language`` per language in the order of a hash) and at most
``max_contexts`` contexts; prediction reads every text whole.

Cases: a null text, or one without a letter, is ``und`` with score 0; without
any labelled text everything is ``und``. Repeated rows give repeated results.
The score is the winner's share of 2^(-code length), the lengths scaled to
``evidence_bytes`` bytes where the text is longer; ties go to the language that
is first in code-point order. Input columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.llm import ships_by_value
from moodline.llm.textbuf import chunks

ships_by_value(__name__)

UNDETERMINED = "und"
RESULTS = ("lang_pred", "score", "bits_per_byte")
ORDER = 3
_PAD = 10  # texts are read as if line feeds stood before them
DOCS_PER_LANGUAGE = 400
MAX_CONTEXTS = 16_384
MAX_GRAMS = 600_000
EVIDENCE_BYTES = 64


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (language, order-3 context and byte as a 32-bit number)."""
    for batch in batches:
        texts, langs = batch.column("text"), batch.column("lang").to_numpy(zero_copy_only=False)
        for lo, hi, data, offsets in chunks(texts):
            wide = data.astype(np.uint32)
            code = _context_code(wide, offsets[:-1])
            doc = np.repeat(np.arange(hi - lo), np.diff(offsets))
            for lang in set(langs[lo:hi]):
                pick = (langs[lo:hi] == lang)[doc]
                gram, n = np.unique(code[pick], return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(gram), pa.string()),
                                                  "gram": pa.array(gram.astype(np.int64)),
                                                  "n": pa.array(n.astype(np.int64))})


def _shifted(symbols: np.ndarray, starts: np.ndarray, by: int, pad: int) -> np.ndarray:
    """The symbol ``by`` places before, ``pad`` before a text's start."""
    out = np.empty_like(symbols)
    out[:by] = pad
    out[by:] = symbols[:-by] if by < len(symbols) else symbols[:0]
    for k in range(by):
        at = starts + k
        out[at[at < len(out)]] = pad
    return out


def _context_code(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    code = symbols.copy()
    for by in range(1, ORDER + 1):
        code |= _shifted(symbols, starts, by, _PAD) << np.uint32(8 * by)
    return code


def sample(labelled: DataFrame, docs_per_language: int) -> DataFrame:
    """About ``docs_per_language`` labelled texts of each language, at most twice as many, by a hash of the id.

    Whole texts; every language keeps all its texts where it has fewer.
    """
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.lit(8), "doc_id", F.length("text")), F.lit(1 << 30))
    keep: Column = F.lit(False)
    for lang, n in sizes.items():
        share = min(1.0, docs_per_language / n)
        keep = keep | ((F.col("lang") == lang) & (draw < int(share * (1 << 30))))
    return labelled.where(keep)


def train(labelled: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE,
          max_contexts: int = MAX_CONTEXTS, max_grams: int = MAX_GRAMS) -> dict:
    """Frozen model from rows (doc_id, text, lang); lang and text not null.

    The counts brought to the driver are bounded by ``max_grams`` rows.
    """
    grams = (sample(labelled, docs_per_language).select("text", "lang")
             .mapInArrow(_grams, "lang string, gram long, n long")
             .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
             .orderBy(F.desc("n"), "lang", "gram").limit(max_grams).toPandas())
    return freeze(grams, max_contexts)


def freeze(grams: pd.DataFrame, max_contexts: int = MAX_CONTEXTS) -> dict:
    """Flatten counted grams into the code-length table."""
    langs = sorted(grams["lang"].unique())
    gram = grams["gram"].to_numpy(np.int64)
    seen = np.union1d(gram & 255, [_PAD])
    size = len(seen) + 1  # the last symbol stands for every byte that was never seen
    symbol = np.full(256, size - 1, np.int32)
    symbol[seen] = np.arange(len(seen))
    unseen = 256 - len(seen)
    parts = []
    for depth in range(ORDER + 1):
        table = pd.DataFrame({"lang": grams["lang"], "ctx": (gram >> 8) & ((1 << (8 * depth)) - 1),
                              "sym": symbol[gram & 255], "n": grams["n"]})
        parts.append(table.groupby(["lang", "ctx", "sym"], as_index=False)["n"].sum())
    # Contexts kept: those with most symbols over all languages, shorter ones first.
    kept: list[dict[int, int]] = []
    total = 0
    for depth, table in enumerate(parts):
        sums = table.groupby("ctx")["n"].sum()
        sums = sums[sums >= (1 if depth < 2 else 4)]
        order = sums.reset_index().sort_values(["n", "ctx"], ascending=[False, True])["ctx"]
        kept.append({int(c): total + i for i, c in enumerate(order.iloc[:max(0, max_contexts - total)])})
        total += len(kept[-1])
    bits = np.empty((total, size, len(langs)), np.float32)
    uniform = np.full(size, 1 / 256)
    uniform[-1] = unseen / 256 if unseen else 1e-9
    uniform /= uniform.sum()
    for j, lang in enumerate(langs):
        prob = np.empty((total, size))
        for depth, table in enumerate(parts):
            own = table[table["lang"] == lang]
            counts = {c: (s.to_numpy(), n.to_numpy(float)) for c, s, n in
                      ((c, g["sym"], g["n"]) for c, g in own[own["ctx"].isin(kept[depth])].groupby("ctx"))}
            for ctx, row in kept[depth].items():
                shorter = uniform if depth == 0 else prob[_row(kept, ctx, depth - 1)]
                prob[row] = _blend(shorter, *counts[ctx]) if ctx in counts else shorter
        bits[:, :, j] = -np.log2(prob)
    bits[:, -1, :] += np.log2(max(unseen, 1))  # which of the unseen bytes it was
    longest = np.zeros((size,) * ORDER, np.int32)
    for depth in range(ORDER + 1):
        for ctx, row in kept[depth].items():
            place = [symbol[(ctx >> (8 * k)) & 255] for k in range(depth)]
            if size - 1 in place:
                continue
            longest[(slice(None),) * (ORDER - depth) + tuple(reversed(place))] = row
    return {"langs": langs, "symbol": symbol, "bits": bits.reshape(-1, len(langs)) if langs else bits,
            "longest": longest.ravel(), "size": size}


def _row(kept: list[dict[int, int]], ctx: int, depth: int) -> int:
    while depth > 0:
        row = kept[depth].get(ctx & ((1 << (8 * depth)) - 1))
        if row is not None:
            return row
        depth -= 1
    return kept[0][0]


def _blend(shorter: np.ndarray, syms: np.ndarray, n: np.ndarray) -> np.ndarray:
    total, distinct = n.sum(), len(n)
    rest = shorter.copy()
    rest[syms] = 0.0
    left = rest.sum()
    if left <= 0:
        out = np.zeros_like(shorter)
        out[syms] = n / total
        return out
    out = rest * (distinct / (total + distinct) / left)
    out[syms] = n / (total + distinct)
    return out


def code_lengths(model: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of every text under every language."""
    n_lang, size = len(model["langs"]), model["size"]
    out = np.zeros((len(offsets) - 1, n_lang))
    if len(data) == 0:
        return out
    symbols = model["symbol"][data]
    pad = int(model["symbol"][_PAD])
    starts = offsets[:-1]
    place = _shifted(symbols, starts, 3, pad)
    place *= size
    place += _shifted(symbols, starts, 2, pad)
    place *= size
    place += _shifted(symbols, starts, 1, pad)
    cell = model["longest"][place]
    cell *= size
    cell += symbols
    cost = model["bits"][cell]
    filled = np.diff(offsets) > 0
    out[filled] = np.add.reduceat(cost, starts[filled], axis=0, dtype=np.float64)
    return out


def _predictor(shared, evidence_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        langs = np.array([*model["langs"], UNDETERMINED], object)
        for batch in batches:
            n = batch.num_rows
            best, score, per_byte = np.full(n, len(langs) - 1), np.zeros(n), np.zeros(n)
            letters = batch.column("__letter").to_numpy(zero_copy_only=False)
            if len(langs) > 1:
                for lo, hi, data, offsets in chunks(batch.column("text")):
                    bits = code_lengths(model, data, offsets)
                    size = np.maximum(np.diff(offsets), 1)
                    won = bits.argmin(axis=1)
                    least = bits[np.arange(hi - lo), won]
                    scale = np.minimum(1.0, evidence_bytes / size)
                    odds = np.exp2(np.maximum((least[:, None] - bits) * scale[:, None], -1000.0))
                    ok = letters[lo:hi].astype(bool)
                    best[lo:hi][ok] = won[ok]
                    score[lo:hi][ok] = (1.0 / odds.sum(axis=1))[ok]
                    per_byte[lo:hi][ok] = (least / size)[ok]
            keep = [batch.column(i) for i, f in enumerate(batch.schema) if f.name not in ("text", "__letter")]
            names = [f.name for f in batch.schema if f.name not in ("text", "__letter")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(langs[best], pa.string()), pa.array(score), pa.array(per_byte)],
                names=[*names, "lang_pred", "score", "bits_per_byte"])
    return run


def predict(docs: DataFrame, model: dict, evidence_bytes: int = EVIDENCE_BYTES) -> DataFrame:
    """``docs`` (text and any other columns) -> the other columns, lang_pred, score, bits_per_byte."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded by max_contexts rows of at most 257 bytes
    docs = docs.drop(*RESULTS)
    rest = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest),
                        "lang_pred string", "score double", "bits_per_byte double"])
    ready = docs.withColumn("__letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return ready.mapInArrow(_predictor(shared, evidence_bytes), schema)
