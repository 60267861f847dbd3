"""Document fingerprints as invertible Bloom lookup tables (operator 1).

A document is the set of 64-bit digests of its paragraph pieces: lines, cut on
after sentence ends. A table of cells holds, per cell, a count, the XOR of the
digests and the XOR of their check digests; every digest enters one cell of
each third of the table. Tables of two versions subtract cell by cell, so that
common pieces vanish; cells with count 1 or -1 and a fitting check give a
digest, which is taken out of its other cells, and so on (peeling). What is
recovered are the digests that differ.

The fingerprint is the table of ``base_cells`` cells. Two texts are compared by
subtracting their fingerprints. Where peeling leaves something, larger tables
are made: digests are dealt to sub-tables of about ``per_table`` entries by
their own bits, so the work is linear in the text; a sub-table whose peeling
leaves something is made again with four times the cells, up to ``retries``
times, and is then compared digest by digest.

The likeness of two texts is common / all pieces, from the recovered
differences and the two set sizes; 1 for equal sets, two empty ones included.
All of it is DataFrame and SQL functions.

Cases: a null text is empty. Equal texts have equal fingerprints. Rows that
share a doc_id are one place in the order; their next document is the one with
the next smaller doc_id, and the least text where that has several. Null ids
come last. A single document is its own next one. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.llm.tables import written

BASE_CELLS = 12
PER_TABLE = 4
TABLE_CELLS = 12
RETRIES = 2
_ROUNDS = 10
_NOTHING = "cast(array() as array<struct<s:int,d:bigint>>)"
_LAST = -(1 << 63)  # stands for a null doc_id


def pieces(text: Column) -> Column:
    """Distinct digests of a text's paragraph pieces."""
    parts = F.filter(F.split(text, r"\n|(?<=[.!?])\s+"), lambda p: p != "")
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def _entry(sign: str, digest: str, cells: int) -> str:
    """SQL: an entry with its check digest and its cell in each third (each third uses other bits)."""
    third = cells // 3
    places = ", ".join(f"'c{i}', cast(pmod(shiftright({digest}, {20 * i}), {third}L) as int) + {i * third}" for i in range(3))
    return f"named_struct('s', {sign}, 'd', {digest}, 'h', xxhash64({digest}, 11), {places})"


def _added(entries: str, cell: str, start: str, sign: str) -> str:
    """SQL: a cell's content with those of the entries that belong in it put in (or taken out)."""
    return f"""aggregate(filter({entries}, e -> e.c0 = {cell} or e.c1 = {cell} or e.c2 = {cell}), {start},
        (s, e) -> named_struct('n', s.n {sign} e.s, 'k', s.k ^ e.d, 'h', s.h ^ e.h))"""


def table_sql(entries: str, cells: int) -> str:
    """SQL: the cells (n, key, check) of an array of entries (sign s, digest d)."""
    full = f"transform({entries}, x -> {_entry('x.s', 'x.d', cells)})"
    empty = "named_struct('n', 0, 'k', 0L, 'h', 0L)"
    return f"""transform(array({full}), f -> transform(sequence(0, {cells - 1}), c -> {_added('f', 'c', empty, '+')}))[0]"""


def peel_sql(table: str, cells: int) -> str:
    """SQL: the (sign s, digest d) entries that peeling recovers from a table; null if something is left."""
    pure = f"""array_distinct(transform(filter(st.cells, x -> abs(x.n) = 1 and x.h = xxhash64(x.k, 11)),
        x -> {_entry('x.n', 'x.k', cells)}))"""
    taken = f"transform(st.cells, (x, c) -> {_added('p', 'c', 'x', '-')})"
    step = f"""if(not st.go, st, transform(array({pure}), p -> if(size(p) = 0,
        named_struct('cells', st.cells, 'got', st.got, 'go', false),
        named_struct('cells', {taken}, 'got', concat(st.got, transform(p, x -> named_struct('s', x.s, 'd', x.d))),
            'go', true)))[0])"""
    state = f"""aggregate(sequence(1, {_ROUNDS}), named_struct('cells', {table}, 'got', {_NOTHING}, 'go', true), (st, r) -> {step})"""
    return f"""transform(array({state}), e -> if(exists(e.cells, x -> x.n <> 0 or x.k <> 0L or x.h <> 0L), null, e.got))[0]"""


def subtract_sql(left: str, right: str) -> str:
    """SQL: the cells of one table without those of another of the same size."""
    return f"""zip_with({left}, {right},
        (x, y) -> named_struct('n', x.n - y.n, 'k', x.k ^ y.k, 'h', x.h ^ y.h))"""


def _signed(left: str, right: str) -> str:
    """SQL: entries of two digest arrays, the left one's with sign 1, the right one's with -1."""
    return f"""concat(transform({left}, x -> named_struct('s', 1, 'd', x)),
        transform({right}, x -> named_struct('s', -1, 'd', x)))"""


def retried_sql(left: str, right: str, per_table: int = PER_TABLE, cells: int = TABLE_CELLS,
                retries: int = RETRIES) -> str:
    """SQL: the signed digests in one of two distinct digest arrays only, by peeling sub-tables of both.

    Sub-tables are found in two steps (upper, then lower bits), so the work
    grows with n^1.5 at most, and in proportion for texts of usual length. A
    sub-table that fails in every size is compared digest by digest.
    """
    # 2^b sub-tables in groups of 2^(b div 2).
    bits = f"greatest(0, cast(ceil(log2(greatest(1, size({left}) + size({right})) / {float(per_table)})) as int))"
    side = "transform(filter(t, e -> e.s = {}), e -> e.d)"
    attempt = f"""transform(array(named_struct('l', {side.format(1)}, 'r', {side.format(-1)})),
        v -> {_signed('array_except(v.l, v.r)', 'array_except(v.r, v.l)')})[0]"""
    for k in range(retries, -1, -1):
        n = cells * 4 ** k
        attempt = f"transform(array({peel_sql(table_sql('t', n), n)}), r{k} -> if(r{k} is not null, r{k}, {attempt}))[0]"
    one = f"if(size(t) = 0, {_NOTHING}, {attempt})"
    inner = f"""flatten(transform(sequence(0, w.lo - 1), j -> transform(array(
        filter(g, e -> shiftright(e.d, 44) & (w.lo - 1) = j)), t -> {one})[0]))"""
    outer = f"""flatten(transform(sequence(0, w.hi - 1), i -> transform(array(
        filter(w.e, e -> shiftright(e.d, 52) & (w.hi - 1) = i)), g -> {inner})[0]))"""
    return f"""transform(array(named_struct('e', {_signed(left, right)},
        'lo', cast(shiftleft(1, {bits} div 2) as int), 'hi', cast(shiftleft(1, {bits} - {bits} div 2) as int))),
        w -> {outer})[0]"""


def difference(left: str, right: str, left_table: str, right_table: str, base_cells: int = BASE_CELLS, **parameters) -> Column:
    """The signed digests in one of two texts only: 1 for the left one's, -1 for the right one's.

    ``left`` and ``right`` are columns of distinct digests, the tables their
    fingerprints. These are subtracted and peeled; if that leaves something,
    larger ones are made.
    """
    first = peel_sql(subtract_sql(left_table, right_table), base_cells)
    # tables whose sizes differ by more than their cells can't be peeled
    near = f"abs(size({left}) - size({right})) <= {base_cells}"
    return F.expr(f"""transform(array(if({near}, {first}, null)),
        q -> if(q is not null, q, {retried_sql(left, right, **parameters)}))[0]""")


def likeness(left: str, right: str, differing: str) -> Column:
    """Common / all pieces of two columns of distinct digests and their differing ones."""
    both = f"(size({left}) + size({right}))"
    return F.expr(f"""transform(array(size({differing})),
        d -> if({both} = 0, 1.0D, ({both} - d) / cast({both} + d as double)))[0]""")


def table(digests: str, cells: int = BASE_CELLS) -> Column:
    """The cells of a column of distinct digests."""
    return F.expr(table_sql(f"transform({digests}, x -> named_struct('s', 1, 'd', x))", cells))


def as_text(cells: str) -> Column:
    """A table as text: count:key:check of every cell, hexadecimal."""
    return F.expr(f"""array_join(transform({cells},
        x -> concat(x.n, ':', lower(hex(x.k)), ':', lower(hex(x.h)))), '.')""")


def next_ids(ids: DataFrame, key: str = "k") -> DataFrame:
    """(k, next_k): the next smaller key of every distinct key; the least one's is the greatest.

    Keys are range-partitioned and numbered within partitions; only each
    partition's first and last key meet in one place.
    """
    parts = max(1, int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = written(ids.select(key).distinct().repartitionByRange(parts, F.desc(key))
                      .sortWithinPartitions(F.desc(key)).withColumn("place", F.monotonically_increasing_id()))
    later = ordered.select(F.col(key).alias("next_k"), (F.col("place") - 1).alias("place"))
    inside = ordered.join(later, "place", "left")
    firsts = (ordered.groupBy(F.shiftright("place", 33).alias("part")).agg(F.max(key).alias("first"), F.min(key).alias("end"))
              .agg(F.array_sort(F.collect_list(F.struct("first", "end")), lambda a, b: F.when(
                  a["first"] > b["first"], -1).when(a["first"] < b["first"], 1).otherwise(0)).alias("parts")))
    bounds = firsts.select(F.posexplode("parts").alias("i", "p"), "parts").select(
        F.col("p.end").alias("end"),
        F.expr("parts[(i + 1) % size(parts)].first").alias("wrapped"))
    return (inside.join(F.broadcast(bounds), inside[key] == bounds["end"], "left")  # one row per partition
            .select(key, F.coalesce("wrapped", "next_k").alias("next_k")))


def versions(docs: DataFrame) -> DataFrame:
    """k (doc_id, null: least), text, n, edited and the next document's digests ``beside``.

    The edited text replaces the last n div 2 code points by the first as many
    of the next document.
    """
    base = docs.select(F.coalesce("doc_id", F.lit(_LAST)).alias("k"), F.coalesce("text", F.lit("")).alias("text"))
    ids = base.select("k", (F.char_length("text") / 2).cast("long").alias("need")).distinct()
    order = written(next_ids(ids))
    asked = written(ids.join(order, "k").select(F.col("next_k").alias("k"), F.col("k").alias("asker"), "need"))
    served = (base.join(asked, "k")
              .select("asker", "need", F.expr("substring(text, 1, cast(need as int))").alias("head"),
                      F.xxhash64("text").alias("version"), pieces(F.col("text")).alias("beside"))
              .groupBy("asker", "need").agg(F.min(F.struct("head", "version", "beside")).alias("next")))
    joined = base.join(served, (base["k"] == served["asker"])
                       & (served["need"] - (F.char_length("text") / 2).cast("long") == 0))
    n = F.char_length("text")
    return joined.select("k", "text", n.cast("long").alias("n"), F.col("next.beside").alias("beside"),
                         F.concat(F.expr("substring(text, 1, char_length(text) - cast(need as int))"),
                                  F.col("next.head")).alias("edited"))


def fingerprints(docs: DataFrame, base_cells: int = BASE_CELLS, **parameters) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    ``edited_diff`` and ``next_diff`` are the recovered digests: s is 1 for a
    piece the text alone has, -1 for one that only the other text has.
    """
    made = versions(docs).select(
        F.nullif("k", F.lit(_LAST)).alias("doc_id"), F.col("n").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        pieces(F.col("text")).alias("own"), pieces(F.col("edited")).alias("changed"), "beside")
    tables = made.select("*", *(table(c, base_cells).alias(f"{c}_table") for c in ("own", "changed", "beside")))
    compared = tables.select(
        "*", difference("own", "changed", "own_table", "changed_table", base_cells, **parameters).alias("edited_diff"),
        difference("own", "beside", "own_table", "beside_table", base_cells, **parameters).alias("next_diff"))
    return compared.select("doc_id", "n_chars", "edited_sha256", as_text("own_table").alias("fingerprint"),
                           as_text("changed_table").alias("edited_fingerprint"),
                           likeness("own", "changed", "edited_diff").alias("near_edited"),
                           likeness("own", "beside", "next_diff").alias("near_next"), "edited_diff", "next_diff")
