"""Packing token pieces into sequences by cutting-stock column generation (operator 10).

Documents are tokenised whole, closed by an end id, and cut into pieces of the
sequence length and one remainder. The remainders' histogram over length
classes (lengths rounded up to multiples of ``granule``) is a cutting-stock
problem: fill sequences with classes so that few sequences meet the demand. Its
linear program starts from one pattern per class; a knapsack dynamic program
over the duals finds the pattern that lowers the objective most, until none
does. The solution is rounded down, the rest is packed best-fit-decreasing on
the histogram. The patterns are then filled with exact lengths, and a share of
the emptiest sequences is dealt to the room that is really free in the others,
or anew; of several shares the one with the fewest sequences is taken. Pieces are then ranked within their class, without gathering a
class in one task, and rank r of a class takes the r-th place that the patterns
hold for it. The driver sees only the histogram, however many documents there are.

Cases: a null or empty text is its end id alone. Equal rows are separate
documents. Special tokens written out in a text get their own ids, as the
tokenizer gives them.
"""

from __future__ import annotations

import base64
import bisect
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodline.llm import ships_by_value
from moodline.llm.tables import written

ships_by_value(__name__)

SEQUENCE = 2048
END_ID = 1
GRANULE = 16
PIECES = ("doc_id long, text_key long, start long, length long, ids_crc32 long, doc_tokens long")
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The rank file's reader recurses over white space and dies with its process on runs of about a million.
LONG_SPACE = 50_000
_SPACE = re.compile(r"\s+")


class Tokenizer:
    """Ids of the ``tokenizers`` file at ``path``, read with its byte-level merges as ranks where that is the same.

    ``ranks`` is the same vocabulary as a rank file; texts that spell out an
    added token or hold a very long run of white space go to the tokenizer itself.
    """

    def __init__(self, path: str, ranks: str | None, added: tuple[str, ...]):
        self.path, self.added, self.own, self.fast = path, added, None, None
        if ranks:
            import tiktoken
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> list[int]:
        long_space = len(text) >= LONG_SPACE and any(m.end() - m.start() >= LONG_SPACE for m in _SPACE.finditer(text))
        if self.fast is None or long_space or any(t in text for t in self.added):
            if self.own is None:
                from tokenizers import Tokenizer as Own
                self.own = Own.from_file(self.path)
            return self.own.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def added_tokens(path: str) -> tuple[str, ...]:
    from tokenizers import Tokenizer as Own
    return tuple(t.content for t in Own.from_file(path).get_added_tokens_decoder().values())


def _cutter(path: str, ranks: str | None, added: tuple[str, ...], sequence: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = None
        for batch in batches:
            tokenizer = tokenizer or Tokenizer(path, ranks, added)
            row, start, length, crc, total = [], [], [], [], []
            texts = batch.column("text")
            for i in range(batch.num_rows):
                ids = array("I", tokenizer.ids(texts[i].as_py() or ""))
                ids.append(end_id)
                n = len(ids)
                data = memoryview(ids).cast("B")
                for at in range(0, n, sequence):
                    end = min(n, at + sequence)
                    row.append(i)
                    start.append(at)
                    length.append(end - at)
                    crc.append(zlib.crc32(data[4 * at:4 * end]))
                    total.append(n)
            row = pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(row), batch.column("text_key").take(row),
                 *(pa.array(x, pa.int64()) for x in (start, length, crc, total))],
                names=["doc_id", "text_key", "start", "length", "ids_crc32", "doc_tokens"])
    return run


def pieces(docs: DataFrame, tokenizer: str, ranks: str | None = None, sequence: int = SEQUENCE,
           end_id: int = END_ID) -> DataFrame:
    """Every document's pieces: full sequences, then its remainder. ``tokenizer`` is a path on every executor."""
    return (docs.select("doc_id", F.xxhash64(F.lit(10), "text").alias("text_key"), "text")
            .mapInArrow(_cutter(tokenizer, ranks, added_tokens(tokenizer), sequence, end_id), PIECES))


def best_pattern(value: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the multiset of ``sizes`` within ``room`` of most value."""
    best, last = np.zeros(room + 1), np.full(room + 1, -1)
    for c in range(1, room + 1):
        fits = int(np.searchsorted(sizes, c, side="right"))
        best[c], last[c] = best[c - 1], -1
        if fits:
            got = best[c - sizes[:fits]] + value[:fits]
            j = int(got.argmax())
            if got[j] > best[c] + 1e-12:
                best[c], last[c] = got[j], j
    take, c = np.zeros(len(sizes), np.int64), room
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            take[last[c]] += 1
            c -= sizes[last[c]]
    return float(best[room]), take


def column_generation(demand: np.ndarray, sizes: np.ndarray, room: int, gap: float = 1e-3
                      ) -> tuple[np.ndarray, np.ndarray]:
    """Basic patterns (one per column) and how often the linear program uses each.

    Ends when no pattern is worth more than 1 + ``gap``: the objective is then
    within that share of the optimum (the duals over that worth are feasible).
    """
    # Slightly unequal demands keep equal ratios, and so cycles, away.
    demand = demand * (1 + 1e-7 * np.arange(1, len(sizes) + 1))
    basis = np.diag(room // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(basis))
    use = inverse @ demand
    step = 0
    while True:
        step += 1
        duals = inverse.sum(axis=0)
        value, take = best_pattern(duals, sizes, room)
        if value <= 1 + gap:
            break
        direction = inverse @ take
        ratio = np.where(direction > 1e-9, use / np.where(direction > 1e-9, direction, 1), np.inf)
        out = int(ratio.argmin())
        step_ = ratio[out]
        use = use - step_ * direction
        use[out] = step_
        np.maximum(use, 0, out=use)
        basis[:, out] = take
        pivot = inverse[out] / direction[out]
        inverse -= np.outer(direction, pivot)
        inverse[out] = pivot
        if step % 200 == 0:
            # One Newton step takes back what rounding has added to the inverse.
            inverse = 2 * inverse - np.einsum("ij,jk->ik", inverse, np.einsum("ij,jk->ik", basis, inverse))
            use = np.maximum(inverse @ demand, 0)
    return basis.round().astype(np.int64), use


def patterns(demand: np.ndarray, sizes: np.ndarray, room: int) -> list[tuple[int, np.ndarray]]:
    """(times, pattern) that cover ``demand`` exactly; ``sizes`` ascending."""
    plan: list[tuple[int, np.ndarray]] = []
    left = demand.astype(np.int64).copy()
    if not left.any():
        return plan
    columns, use = column_generation(demand.astype(float), sizes, room)
    for j in np.argsort(-use, kind="stable"):
        take = columns[:, j]
        held = take > 0
        if not held.any():
            continue
        times = min(int(np.floor(use[j] + 1e-6)), int((left[held] // take[held]).min()))
        if times > 0:
            plan.append((times, take))
            left -= times * take
    while left.any():  # what rounding left: the largest classes first, each sequence filled as well as it goes
        space, take = room, np.zeros(len(sizes), np.int64)
        for c in range(len(sizes) - 1, -1, -1):
            take[c] = min(left[c], space // sizes[c])
            space -= take[c] * sizes[c]
        held = take > 0
        times = int((left[held] // take[held]).min())
        plan.append((times, take))
        left -= times * take
    return plan


def realised(plan: list[tuple[int, np.ndarray]], members: list[list[list[int]]]) -> list[tuple[int, dict[int, int]]]:
    """``plan`` with exact lengths; ``members``: per class [length, number of pieces], which are used up."""
    out: list[tuple[int, dict[int, int]]] = []
    for times, take in plan:
        held = np.flatnonzero(take)
        while times:
            run = max(1, min(times, *(members[c][-1][1] // int(take[c]) for c in held)))
            own: dict[int, int] = {}
            for c in held:
                need = int(take[c])
                while need:
                    length, n = members[c][-1]
                    used = min(need, n // run)
                    own[length] = own.get(length, 0) + used
                    members[c][-1][1] -= used * run
                    need -= used
                    if not members[c][-1][1]:
                        members[c].pop()
            out.append((run, own))
            times -= run
    return out


def refilled(plan: list[tuple[int, dict[int, int]]], keep: int, room: int) -> list[tuple[int, dict[int, int]]]:
    """``plan`` with its ``keep`` fullest sequences; pieces of the others go to free room, then to new sequences."""
    def used(own: dict[int, int]) -> int:
        return sum(length * n for length, n in own.items())

    kept, left = [], {}
    for times, own in sorted(plan, key=lambda x: -used(x[1])):
        stay = min(times, keep)
        keep -= stay
        if stay:
            kept.append((stay, own))
        for length, n in own.items():
            if times > stay:
                left[length] = left.get(length, 0) + n * (times - stay)
    sizes = sorted(left)
    out, at = [], len(kept) - 1
    while sizes or at >= 0:
        # The emptiest sequences first, each with the longest pieces that fit; without any, a new one.
        times, own = kept[at] if at >= 0 else (sum(left.values()), {})
        space, more = room - used(own), {}
        place = bisect.bisect_right(sizes, space) - 1
        while place >= 0:
            n = min(left[sizes[place]], space // sizes[place])
            more[sizes[place]] = n
            space -= n * sizes[place]
            place = min(place, bisect.bisect_right(sizes, space)) - 1
        run = min(times, *(left[length] // n for length, n in more.items())) if more else times
        out.append((run, {length: own.get(length, 0) + more.get(length, 0) for length in own.keys() | more.keys()}))
        for length, n in more.items():
            left[length] -= n * run
            if not left[length]:
                sizes.remove(length)
        if at >= 0:
            kept[at] = (times - run, own)
            at -= times == run
    return out


def exact_plan(lengths: np.ndarray, demand: np.ndarray, room: int, granule: int) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: pieces}) that hold ``demand`` pieces of each of ``lengths`` (ascending, under ``room``)."""
    if not len(lengths):
        return []
    kinds, of = np.unique(-(-lengths // granule), return_inverse=True)
    members: list[list[list[int]]] = [[] for _ in kinds]
    for c, length, n in zip(of, lengths, demand, strict=True):
        members[c].append([int(length), int(n)])
    whole = max(1, room // granule)
    plan = realised(patterns(np.bincount(of, demand).astype(np.int64), np.minimum(kinds, whole), whole), members)
    total = sum(times for times, _ in plan)
    return min((refilled(plan, total * share // 16, room) for share in range(16, -1, -1)),
               key=lambda x: sum(times for times, _ in x))


def places(plan: Iterable[tuple[int, np.ndarray]], n_classes: int, first_sequence: int) -> dict:
    """Per class: ends of the rank ranges that each pattern's places take, and what they lead to."""
    out: dict[int, list] = {c: [] for c in range(n_classes)}
    ends = np.zeros(n_classes, np.int64)
    sequence = first_sequence
    for times, take in plan:
        slot = 0
        for c in np.flatnonzero(take):
            ends[c] += times * take[c]
            out[int(c)].append((int(ends[c]), int(ends[c] - times * take[c]), sequence, int(take[c]), slot))
            slot += int(take[c])
        sequence += times
    return {c: np.array(v, np.int64).reshape(-1, 5).T for c, v in out.items()}


def _placer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            kind = batch.column("class").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, slot = np.zeros(len(kind), np.int64), np.zeros(len(kind), np.int64)
            for c in np.unique(kind):
                own = kind == c
                ends, begin, first, each, place = table[int(c)]
                at = np.searchsorted(ends, rank[own], side="right")
                inside = rank[own] - begin[at]
                sequence[own] = first[at] + inside // each[at]
                slot[own] = place[at] + inside % each[at]
            names = [f.name for f in batch.schema]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sequence), pa.array(slot)],
                                             names=[*names, "sequence_id", "slot"])
    return run


def ranked(rows: DataFrame, key: str, order: list[str], block_rows: int = 2_000) -> DataFrame:
    """``rows`` with rank: 0, 1, ... within each value of ``key`` (few values), no key gathered in one task.

    Rows are dealt to blocks by a hash of ``order``; ranks run within a block
    and key, and start after the earlier blocks' counts.
    """
    n = rows.count()
    blocks = max(1, -(-n // block_rows))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    within = Window.partitionBy("block", key).orderBy(*order)
    counts = dealt.groupBy("block", key).agg(F.count("*").alias("n"))
    before = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return (dealt.withColumn("own", F.row_number().over(within) - 1).join(begins, ["block", key])
            .withColumn("rank", F.col("own") + F.col("before")).drop("block", "own", "before"))


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, sequence: int = SEQUENCE,
         end_id: int = END_ID, granule: int = GRANULE) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    cut = written(pieces(docs, tokenizer, ranks, sequence, end_id)
                  .withColumn("class", F.col("length").cast("int")))
    histogram = {r["class"]: r["n"] for r in cut.groupBy("class").agg(F.count("*").alias("n")).collect()}
    full = sequence
    kinds = np.array(sorted(c for c in histogram if c != full), np.int64)
    demand = np.array([histogram[int(c)] for c in kinds], np.int64)
    # A full class makes sequences of its own: ids 0 to n - 1.
    plan = ((times, np.array([own.get(int(k), 0) for k in kinds], np.int64))
            for times, own in exact_plan(kinds, demand, sequence, granule))
    table = places(plan, len(kinds), histogram.get(full, 0))
    by_class = {int(k): table[i] for i, k in enumerate(kinds)}
    by_class[full] = np.array([[histogram.get(full, 0)], [0], [0], [1], [0]], np.int64)
    shared = spark.sparkContext.broadcast(by_class)  # bounded by classes and patterns, not by rows
    order = ["doc_id", "text_key", "start"]
    numbered = ranked(cut, "class", order)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema.fields)
    placed = numbered.mapInArrow(_placer(shared), f"{fields}, sequence_id long, slot long")
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))
