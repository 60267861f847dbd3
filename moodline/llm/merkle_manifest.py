"""Merkle manifest of a dataset, leaves placed by bitmap rank.

Every row is a leaf: H (lowercase hex SHA-256) over its fields, each ``-`` if
null, else UTF-8 byte count, ``:`` and value. Within a group (null: a group of its
own, first) leaves ascend by id; every two consecutive nodes become H of their
digests (a last one alone: of its own) until one, the group's root, remains. The
groups' roots, ordered by group, are reduced likewise to the dataset's root.

No row is sorted to learn its place. The ids of a group are merged into
compressed bitmaps, one *container* per 4096 consecutive ids (few ids as 16-bit
values, more as bits). A directory of counts per container, summed up along the
id's digits so that no step holds more than 2^20 entries, and the popcount within
the container give an id's rank: its leaf's coordinate (``ranked``). Coordinates
address slots: ``BLOCK`` slots of a group are one array that is reduced in one go,
and its top is a slot of the next round (``_round``). Proofs are read downwards.

Defined cases: a null id comes before all others; rows with equal group and id
ascend by leaf digest, equal leaves are interchangeable; an empty table gives an
empty result; the tree of a single leaf is the leaf; only key, group and fields
are read, so other columns can't clash. Rows that share an id, up to all rows, are
placed by counts per digest prefix and never meet in one task. The step that
orders the groups' roots has one row per group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodline.llm import ships_by_value
from moodline.llm.tables import written

ships_by_value(__name__)

LEVELS = 10  # of one block
BLOCK = 1 << LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
CONTAINER_BITS = 12
# the directory's further digits: 16 bits, 16 bits, the rest (20)
SECOND, THIRD = CONTAINER_BITS + 16, CONTAINER_BITS + 32
_SIZE = 1 << CONTAINER_BITS
_LISTED = _SIZE // 16 - 1  # ids up to which values take less room than bits
PROOF = "array<string>"


def field(value: Column) -> Column:
    """``-`` for null, else byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*(field(v) for v in values)), 256)


def _h(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


# ---- bitmap rank index ------------------------------------------------------------------------------------------------

def packed(values: np.ndarray) -> bytes:
    """Ascending distinct values below 4096, as values or as bits."""
    if len(values) <= _LISTED:
        return b"v" + values.astype("<u2").tobytes()
    bits = np.zeros(_SIZE, np.uint8)
    bits[values] = 1
    return b"b" + np.packbits(bits, bitorder="little").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if data[:1] == b"v":
        return np.frombuffer(data, "<u2", offset=1).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=1), bitorder="little"))


class Container:
    """Rank queries within one container; repeated ids count as often as they stand."""

    def __init__(self, data: bytes, repeated: list[int], more: list[int]):
        if data[:1] == b"v":
            self.values, self.words = unpacked(data), None
        else:
            self.words = np.frombuffer(data, "<u8", offset=1)
            self.before = np.zeros(len(self.words), np.int64)
            np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])
        self.repeated = np.array(repeated, np.int64)
        self.more = np.concatenate([[0], np.cumsum(np.array(more, np.int64))])

    def rank(self, low: np.ndarray) -> np.ndarray:
        """Rows with smaller ids in the container."""
        if self.words is None:
            found = np.searchsorted(self.values, low)
        else:
            word = low >> 6
            below = (np.uint64(1) << (low & 63).astype(np.uint64)) - np.uint64(1)
            found = self.before[word] + np.bitwise_count(self.words[word] & below)
        return found + self.more[np.searchsorted(self.repeated, low)]


def _partial_containers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_g, _id, _m) -> one packed container per (group, container) of a batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column("_g").dictionary_encode()
        ids = batch.column("_id").to_numpy()
        order = np.lexsort((ids, group.indices.to_numpy()))
        code, ids, times = group.indices.to_numpy()[order], ids[order], batch.column("_m").to_numpy()[order]
        own = ids >> CONTAINER_BITS
        starts = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (own[1:] != own[:-1])])
        names = group.dictionary.to_pylist()
        out: list[list] = [[] for _ in range(5)]
        for a, b in zip(starts, np.r_[starts[1:], len(ids)], strict=True):
            low, again = ids[a:b] & (_SIZE - 1), np.flatnonzero(times[a:b] > 1)
            for column, value in zip(out, (names[code[a]], own[a], packed(low), low[again], times[a:b][again] - 1), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()),
             pa.array(out[3], pa.list_(pa.int64())), pa.array(out[4], pa.list_(pa.int64()))],
            names=["_g", "_c", "_data", "_low", "_more"])


def _merged_containers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial containers in order of (group, container) -> whole ones with their row counts."""
    def told(key, parts):
        values = np.sort(np.concatenate([unpacked(p["_data"]) for p in parts]))
        again = sorted((low, more) for p in parts for low, more in zip(p["_low"], p["_more"], strict=True))
        low, more = [a for a, _ in again], [b for _, b in again]
        return {"_g": key[0], "_c": key[1], "_data": packed(values), "_low": low, "_more": more, "_n": len(values) + sum(more)}

    schema = pa.schema([("_g", pa.string()), ("_c", pa.int64()), ("_data", pa.binary()), ("_low", pa.list_(pa.int64())),
                        ("_more", pa.list_(pa.int64())), ("_n", pa.int64())])
    key, parts = None, []
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if (row["_g"], row["_c"]) != key:
                if parts:
                    out.append(told(key, parts))
                key, parts = (row["_g"], row["_c"]), []
            parts.append(row)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    if parts:
        yield pa.RecordBatch.from_pylist([told(key, parts)], schema)


def _before(counts: DataFrame, within: list[str], order: str, name: str) -> DataFrame:
    """Adds the sum of _n over smaller ``order`` within the same ``within``."""
    window = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(name, F.coalesce(F.sum("_n").over(window), F.lit(0)))


def rank_index(ids: DataFrame) -> DataFrame:
    """(_g, _id, _m) of distinct ids with their numbers of rows -> containers with _base and the group's total _all.

    Null ids stand before all containers.
    """
    known = ids.where("_id is not null").select("_g", "_id", "_m")
    partial = known.mapInArrow(_partial_containers, "_g string, _c long, _data binary, _low array<long>, _more array<long>")
    whole = written(partial.repartition("_g", "_c").sortWithinPartitions("_g", "_c").mapInArrow(
        _merged_containers, "_g string, _c long, _data binary, _low array<long>, _more array<long>, _n long"))
    second, third = F.shiftright("_c", SECOND - CONTAINER_BITS).alias("_c2"), F.shiftright("_c", THIRD - CONTAINER_BITS).alias("_c3")
    digits = whole.select("_g", "_c", second, third, "_n")
    low = _before(digits, ["_g", "_c2"], "_c", "_b1").select("_g", "_c", "_c2", "_b1")
    middle = _before(digits.groupBy("_g", "_c2", "_c3").agg(F.sum("_n").alias("_n")), ["_g", "_c3"], "_c2", "_b2")
    high = _before(digits.groupBy("_g", "_c3").agg(F.sum("_n").alias("_n")), ["_g"], "_c3", "_b3")
    nulls = F.coalesce(F.sum(F.when(F.col("_id").isNull(), F.col("_m"))), F.lit(0))
    totals = ids.groupBy("_g").agg(nulls.alias("_nulls"), F.sum("_m").alias("_all"))
    base = (middle.select("_g", "_c2", "_c3", "_b2").join(high.select("_g", "_c3", "_b3"), ["_g", "_c3"]).join(totals, "_g")
            .select("_g", "_c2", (F.col("_b2") + F.col("_b3") + F.col("_nulls")).alias("_upper"), "_all"))
    directory = low.join(base, ["_g", "_c2"]).select("_g", "_c", (F.col("_b1") + F.col("_upper")).alias("_base"), "_all")
    return whole.join(directory, ["_g", "_c"])


def _rank_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Container rows, each before the ids of its container -> ids with _at, their first coordinate, and _all."""
    container, base, total = None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        is_id = batch.column("_is_id").to_numpy(zero_copy_only=False)
        ids = batch.column("_id").fill_null(0).to_numpy()
        at, every = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        cuts = np.r_[np.flatnonzero(~is_id), len(ids)]
        if container is not None and cuts[0] > 0:
            at[:cuts[0]] = base + container.rank(ids[:cuts[0]] & (_SIZE - 1))
            every[:cuts[0]] = total
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            container = Container(batch.column("_data")[a].as_py(), batch.column("_low")[a].as_py(), batch.column("_more")[a].as_py())
            base, total = batch.column("_base")[a].as_py(), batch.column("_all")[a].as_py()
            at[a + 1:b] = base + container.rank(ids[a + 1:b] & (_SIZE - 1))
            every[a + 1:b] = total
        rows = pa.array(np.flatnonzero(is_id))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(rows) for c in ("_g", "_id", "_m", "_leaf", "_seen")), pa.array(at).take(rows), pa.array(every).take(rows)],
            names=["_g", "_id", "_m", "_leaf", "_seen", "_at", "_all"])


def ranked(ids: DataFrame) -> DataFrame:
    """Distinct ids (_g, _id, _m, _leaf, _seen) with _at, the coordinate of their first row, and _all, the group's rows."""
    blank = {"_data": "binary", "_low": "array<long>", "_more": "array<long>", "_base": "long", "_all": "long"}
    asked = ids.where("_id is not null").select("_g", F.shiftright("_id", CONTAINER_BITS).alias("_c"), F.lit(True).alias("_is_id"),
                                                "_id", "_m", "_leaf", "_seen", *(F.lit(None).cast(t).alias(c) for c, t in blank.items()))
    index = rank_index(ids).select("_g", "_c", F.lit(False).alias("_is_id"), F.lit(None).cast("long").alias("_id"),
                                   F.lit(0).cast("long").alias("_m"), *(F.lit(None).cast("string").alias(c) for c in ("_leaf", "_seen")), *blank)
    known = (index.unionByName(asked).repartition("_g", "_c").sortWithinPartitions("_g", "_c", "_is_id")
             .mapInArrow(_rank_rows, "_g string, _id long, _m long, _leaf string, _seen string, _at long, _all long"))
    totals = ids.groupBy("_g").agg(F.sum("_m").alias("_all"))
    nulls = (ids.where("_id is null").join(totals, "_g")
             .select("_g", "_id", "_m", "_leaf", "_seen", F.lit(0).cast("long").alias("_at"), "_all"))
    return known.unionByName(nulls)


def _placed(leaves: DataFrame) -> DataFrame:
    """Leaves (_g, _id, _leaf, _seen) -> runs of equal leaves (.., _at, _run, _all)."""
    ids = written(leaves.groupBy("_g", "_id").agg(F.count("*").alias("_m"), F.min("_leaf").alias("_leaf"), F.min("_seen").alias("_seen")))
    places = written(ranked(ids))
    alone = places.where("_m = 1").select("_g", "_id", "_leaf", "_seen", "_at", F.col("_m").alias("_run"), "_all")
    shared = places.where("_m > 1").select(F.col("_g").alias("_g2"), F.col("_id").alias("_id2"), "_at", "_all")
    if shared.limit(1).count() == 0:
        return alone
    runs = written(leaves.join(shared, (F.col("_g") == F.col("_g2")) & F.col("_id").eqNullSafe(F.col("_id2")))
                   .groupBy("_g", "_id", "_at", "_all", "_leaf").agg(F.count("*").alias("_run"), F.min("_seen").alias("_seen"))
                   .withColumn("_p", F.substring("_leaf", 1, 4)))
    key = ["_g", "_at"]  # one id of one group
    parts = runs.groupBy(*key, "_p").agg(F.sum("_run").alias("_n"))
    upper = _before(parts, key, "_p", "_b1").select(*key, "_p", "_b1")
    inner = Window.partitionBy(*key, "_p").orderBy("_leaf").rowsBetween(Window.unboundedPreceding, -1)
    lower = runs.withColumn("_b2", F.coalesce(F.sum("_run").over(inner), F.lit(0)))
    tied = lower.join(upper, [*key, "_p"]).withColumn("_at", F.col("_at") + F.col("_b1") + F.col("_b2"))
    return alone.unionByName(tied.select(*alone.columns))


# ---- tree -------------------------------------------------------------------------------------------------------------

def _levels(slots: list[str], whole: bool) -> list[list[str]]:
    """The levels above an array of digests, up to its top or, where it is the whole tree, to one node."""
    levels = [slots]
    while len(levels[-1]) > 1 or not whole and len(levels) <= LEVELS:
        below = levels[-1]
        levels.append([_h(*below[k:k + 2]) for k in range(0, len(below), 2)])
    return levels


def _path(levels: list[list[str]], slot: int) -> list[str]:
    """Siblings from a slot upwards: side and digest, empty where a node is alone."""
    path = []
    for level in levels[:-1]:
        other = slot ^ 1
        path.append(("R" if other > slot else "L") + level[other] if other < len(level) else "")
        slot >>= 1
    return path


def _array(rows: pd.DataFrame) -> list[str]:
    """Slot array of a block from its runs."""
    slots: list[str] = [""] * int((rows["_slot"] + rows["_run"]).max())
    for slot, run, leaf in zip(rows["_slot"], rows["_run"], rows["_leaf"], strict=True):
        slots[slot:slot + run] = [leaf] * run
    return slots


def _tops(rows: pd.DataFrame) -> pd.DataFrame:
    first = rows.iloc[0]
    top = _levels(_array(rows), bool(first["_all"] <= BLOCK))[-1][0]
    return pd.DataFrame({"_g": [first["_g"]], "_at": [first["_block"]], "_leaf": [top], "_run": [1],
                         "_all": [-(-int(first["_all"]) // BLOCK)]})


def _blocked(nodes: DataFrame) -> DataFrame:
    """Nodes or runs of equal ones, cut at block borders: _block, _slot, _run."""
    first, last = F.expr(f"_at div {BLOCK}"), F.expr(f"(_at + _run - 1) div {BLOCK}")
    cut = nodes.withColumn("_block", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.col("_at"), F.col("_block") * BLOCK)
    hi = F.least(F.col("_at") + F.col("_run"), (F.col("_block") + 1) * BLOCK)
    return cut.withColumns({"_slot": lo - F.col("_block") * BLOCK, "_run": hi - lo}).drop("_at")


def _tree(nodes: DataFrame) -> list[DataFrame]:
    """Blocked nodes of each round, bottom up; last the tops of all groups (one node each)."""
    rounds = [written(_blocked(nodes))]
    while True:
        tops = written(rounds[-1].groupBy("_g", "_block").applyInPandas(_tops, "_g string, _at long, _leaf string, _run long, _all long"))
        if tops.where("_all > 1").limit(1).count() == 0:
            return [*rounds, tops]
        rounds.append(written(_blocked(tops)))


def _downward(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """Paths of a round's nodes, their block's path appended."""
    levels, upper = _levels(_array(rows), bool(rows["_all"].iloc[0] <= BLOCK)), list(above["_path"].iloc[0])
    at = rows["_block"] * BLOCK + rows["_slot"]
    return pd.DataFrame({"_g": rows["_g"], "_block": at, "_path": [_path(levels, s) + upper for s in rows["_slot"]],
                         "_top": above["_top"].iloc[0], "_root": above["_root"].iloc[0]})


def folded(leaf: str, path: list[str]) -> str:
    """The root that a leaf and its siblings give."""
    for step in path:
        leaf = _h(step[1:], leaf) if step[:1] == "L" else _h(leaf, step[1:]) if step else _h(leaf)
    return leaf


def _proven(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """One row per leaf: digests, the hash of its proof, and the root recomputed from the leaf seen."""
    levels, upper = _levels(_array(rows), bool(rows["_all"].iloc[0] <= BLOCK)), list(above["_path"].iloc[0])
    top, root = above["_top"].iloc[0], above["_root"].iloc[0]
    out = []
    for g, i, slot, run, leaf, seen in zip(*(rows[c] for c in ("_g", "_id", "_slot", "_run", "_leaf", "_seen")), strict=True):
        for s in range(slot, slot + run):
            path = _path(levels, s) + upper
            again = folded(seen if isinstance(seen, str) else leaf, path)
            out.append((g, i, leaf, top, root, _h(*(p[1:] for p in path)), again, again == root, path))
    return pd.DataFrame(out, columns=["_g", "_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "proof"])


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "lang",
             seen: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: key, group, leaf, subroot, root, proof_sha256, folded_root, verified, proof.

    ``seen`` is the leaf digest to verify with the original siblings (null: the
    row's own). ``proof`` lists the siblings from leaf to root, each with its side
    (L or R); an empty entry is a node without sibling.
    """
    own = F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit(""))  # null first, then by UTF-8 bytes
    leaves = written(docs.select(own.alias("_g"), F.col(key).cast("long").alias("_id"), leaf_digest([F.col(f) for f in fields]).alias("_leaf"),
                                 (F.lit(None).cast("string") if seen is None else seen).alias("_seen")))
    # ids travel as text: pandas would read integers beside nulls as doubles
    *rounds, tops = _tree(_placed(leaves).withColumn("_id", F.col("_id").cast("string")))
    order = Window.orderBy("_g")
    roots = written(tops.select(F.col("_g").alias("_own"), F.col("_leaf").alias("_top"), (F.row_number().over(order) - 1).cast("long").alias("_at")))
    one, groups = F.lit(1).cast("long"), F.lit(roots.count()).cast("long")
    *high, summit = _tree(roots.select(F.lit("").alias("_g"), "_at", F.col("_top").alias("_leaf"), one.alias("_run"), groups.alias("_all")))
    path_type = f"_g string, _block long, _path {PROOF}, _top string, _root string"
    above = summit.select("_g", F.col("_at").alias("_block"), F.array().cast(PROOF).alias("_path"), F.lit("").alias("_top"), F.col("_leaf").alias("_root"))
    for nodes in reversed(high):
        above = written(nodes.groupBy("_g", "_block").cogroup(above.groupBy("_g", "_block")).applyInPandas(_downward, path_type))
    above = written(roots.join(above.select("_block", "_path", "_root"), roots["_at"] == above["_block"])
                    .select(F.col("_own").alias("_g"), F.lit(0).cast("long").alias("_block"), "_path", "_top", "_root"))
    for nodes in reversed(rounds[1:]):
        above = written(nodes.groupBy("_g", "_block").cogroup(above.groupBy("_g", "_block")).applyInPandas(_downward, path_type))
    proven = rounds[0].groupBy("_g", "_block").cogroup(above.groupBy("_g", "_block")).applyInPandas(
        _proven, "_g string, _id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
                 f"verified boolean, proof {PROOF}")
    kind = docs.schema[key].dataType
    return proven.select(F.col("_id").cast(kind).alias(key), F.when(F.col("_g") != "", F.substr("_g", F.lit(2))).alias(group), *proven.columns[2:])
