"""Landed inputs: ticket payload files (S1, S3) and orders CSV.

The ticket feed is read as landed payload files, one JSON document per file
(one API page each), never through a network client. Each file is one row
(``wholetext``), parsed to VARIANT on the executors; the envelope is
unwrapped and the record list exploded there too, so the driver only plans.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from moodline.functions.records import is_object

# Envelope keys tried in this order after a root list.
ENVELOPE_KEYS = ("data", "tickets", "results", "items")
MALFORMED_MESSAGE = "Malformed JSON payload"
BAD_SHAPE_MESSAGE = "Unsupported ticket API response shape"


def read_ticket_payloads(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per landed payload file: ``value`` text, ``_source`` path."""
    paths = [path] if isinstance(path, str) else list(path)
    return (spark.read.text(paths, wholetext=True)
            .select("value", F.col("_metadata.file_path").alias("_source")))


def landed_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The files under the landing paths: ``path, modified, length`` (no content is read)."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.format("binaryFile").load(paths).select(
        "path", F.col("modificationTime").alias("modified"), "length")


def _column_names(header: str) -> list[str]:
    names = next(csv.reader([header]))
    if len(set(names)) != len(names) or not all(names):
        raise ValueError(f"header has blank or repeated column names: {header!r}")
    return names


# One field with its comma, and a quoted field that the line does not close, as the source's CSV reader splits them:
# quotes count at a field's start only, "" is a quote, text after the closing quote belongs to the field.
_IN_QUOTES = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = r'(?:"' + _IN_QUOTES + r'"[^,]*+|[^",][^,]*+)?+,'
OPENS_QUOTE = r"^(?:" + _FIELD + r')*+"' + _IN_QUOTES + r"\z"
CHUNK_LINES = 1 << 14  # a divisor of 2^33, so no chunk holds lines of two tasks
STAYS_QUOTED = r"^" + _IN_QUOTES + r'(?:"[^,]*+,(?:' + _FIELD + r')*+"' + _IN_QUOTES + r")?+\z"


def _place() -> Column:
    return F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
                    F.monotonically_increasing_id().alias("i"))


def _whole_place() -> Column:
    """The place (:func:`_place`) of rows that hold their file's path once."""
    return F.struct(F.col("_source").alias("f"), F.col("_ordinal.b").alias("b"), F.col("_ordinal.i").alias("i"))


def _csv_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines as they stand (a carriage return stays), and what each does to the state outside / inside quotes.

    ``_block`` and ``_chunk`` name the piece of the file a line lies in: at most ``CHUNK_LINES`` lines of one split.
    """
    quoted = F.contains("value", F.lit('"'))
    return spark.read.text(paths, lineSep="\n").select("value", _place().alias("p")).select(
        "value", F.struct("p.b", "p.i").alias("_ordinal"), F.col("p.f").alias("_source"), F.col("p.b").alias("_block"),
        F.floor(F.col("p.i") / CHUNK_LINES).cast("long").alias("_chunk"),
        (quoted & F.col("value").rlike(OPENS_QUOTE)).alias("_opens"),
        (~quoted | F.col("value").rlike(STAYS_QUOTED)).alias("_stays"))


def read_orders_csv(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Orders CSV files with a header row each, every column read as text.

    Columns go by each file's own header: files whose headers differ in order
    or in extra columns are read per header and united by name; only a file's
    first line is its header. All files are split between tasks. One scan
    finds the headers and the files in which a quoted field goes on over a line
    end; these are put together by :func:`_whole_records`, the others are read
    line by line. Text after a closing quote keeps the field's quotes, as
    Spark's parser has it. ``multi_line`` reads each file in one task instead, by
    Spark's own reader. A file whose last quote is never closed fails the read.
    ``_source`` and ``_ordinal`` record where each row came from, so "first
    seen" ties break by file order.
    """
    paths = [path] if isinstance(path, str) else list(path)
    lines = _csv_lines(spark, paths)
    named = (F.col("_block") == 0) & (F.trim("value", F.lit(" \r\t")) != "")
    files = (lines.groupBy("_source")
             .agg(F.min_by(F.when(named, F.rtrim("value", F.lit("\r"))), F.when(named, F.col("_ordinal.i"))).alias("header"),
                  F.bool_or("_opens").alias("spans")).where("header is not null")
             .groupBy("header", "spans").agg(F.collect_list("_source").alias("files")))
    out: DataFrame | None = None
    for header, spans, group in sorted((r.header, r.spans, sorted(r.files)) for r in files.collect()):  # two rows per header
        names = _column_names(header)
        schema = StructType([StructField(n, StringType()) for n in names])
        if spans and not multi_line:
            rows = _whole_records(_csv_lines(spark, group)).select(
                F.from_csv("_record", schema.toDDL(), {"escape": '"'}).alias("r"), "_source", _whole_place().alias("_ordinal")).select(
                "r.*", "_source", "_ordinal")
        else:
            rows = (spark.read.schema(schema).csv(group, header=True, multiLine=multi_line, escape='"')
                    .select(*[F.col(f"`{n}`") for n in names], F.col("_metadata.file_path").alias("_source"),
                            _place().alias("_ordinal")))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        return lines.select("_source", _whole_place().alias("_ordinal")).where("false")
    return out


def _composed(rows: DataFrame, within: list[str], order: list[str], fixed: Column, flips: Column) -> DataFrame:
    """Running composition of two-state steps: adds _fixed (the state after the last step that sets one) and
    _flips (the flips since), up to and with each row, and _fixed0, _flips0 before it. All windows share one sort."""
    w = Window.partitionBy(*within).orderBy(*order)
    told = (rows.withColumns({"_set": fixed, "_flip": flips}).withColumns({
        "_fixed": F.last("_set", ignorenulls=True).over(w), "_all": F.coalesce(F.sum("_flip").over(w), F.lit(0))}))
    # Flips up to the row that set the state do not count, its own neither.
    told = told.withColumn("_until", F.last(F.when(F.col("_set").isNotNull(), F.col("_all")), ignorenulls=True).over(w))
    told = told.withColumn("_flips", (F.col("_all") - F.coalesce("_until", F.lit(0))) % 2)
    before = {f"{c}0": F.lag(c).over(w) for c in ("_fixed", "_flips")}
    return told.withColumns(before).withColumn("_flips0", F.coalesce("_flips0", F.lit(0))).drop("_set", "_flip", "_all", "_until")


def _whole_records(lines: DataFrame) -> DataFrame:
    """Lines of split files -> CSV records after each file's header: _record, _source, _ordinal.

    Whether a line begins inside quotes depends on all lines before it. Every
    line is a step between two states; steps are composed within a chunk of a
    split, and the chunks' compositions along the file (one row per chunk). So
    each chunk learns the state it begins in, and only lines of records that
    span lines are gathered, by the place of the record's first line.
    """
    along = ["_block", "_chunk"]
    split = ["_source", *along]
    state = F.when(F.col("_opens") == F.col("_stays"), F.col("_opens").cast("int"))
    steps = _composed(lines, split, ["_ordinal"], state, (F.col("_opens") & ~F.col("_stays")).cast("int"))
    text = F.trim("value", F.lit(" \r\t")) != ""
    ends = steps.groupBy(*split).agg(F.max_by(F.struct("_fixed", "_flips"), "_ordinal").alias("_end"),
                                     F.min(F.when(text, F.col("_ordinal"))).alias("_first"))
    ends = ends.select(*split, "_first", F.col("_end._fixed").alias("_k"), F.col("_end._flips").alias("_s"))
    file = ["_source"]
    chain = _composed(ends, file, along, F.when(F.col("_k").isNotNull(), (F.col("_k") + F.col("_s")) % 2), F.col("_s"))
    whole = Window.partitionBy(*file)
    end = (F.coalesce("_fixed", F.lit(0)) + F.col("_flips")) % 2
    open_end = F.max_by(end, F.struct(*along)).over(whole)
    start = F.when(open_end == 1, F.raise_error(F.concat(F.lit("unpaired quotes: the last quoted field is never closed in "), "_source"))
                   ).otherwise((F.coalesce("_fixed0", F.lit(0)) + F.col("_flips0")) % 2)
    begun = chain.select(*split, start.alias("_start"), F.min("_first").over(whole).alias("_header"))

    def inside(fixed: str, flips: str) -> Column:
        return (F.coalesce(fixed, "_start") + F.col(flips)) % 2

    told = steps.join(begun, split).withColumns({"_in": inside("_fixed0", "_flips0"), "_out": inside("_fixed", "_flips")})
    w = Window.partitionBy(*split).orderBy("_ordinal")
    told = told.withColumn("_own", F.last(F.when(F.col("_in") == 0, F.col("_ordinal")), ignorenulls=True).over(w))
    before = Window.partitionBy(*file).orderBy(*along).rowsBetween(Window.unboundedPreceding, -1)
    carried = (told.groupBy(*split).agg(F.max(F.when(F.col("_in") == 0, F.col("_ordinal"))).alias("_last"))
               .select(*split, F.last("_last", ignorenulls=True).over(before).alias("_carried")))
    kept = told.select(*split, "value", "_ordinal", "_in", "_out", "_own", "_header")
    single = kept.where("_in = 0 and _out = 0 and _ordinal <> _header").select(
        F.col("value").alias("_record"), "_source", "_ordinal")
    spanning = (kept.where("_in = 1 or _out = 1").join(carried, split)
                .groupBy("_source", F.coalesce("_own", "_carried").alias("_ordinal"), "_header")
                .agg(F.array_sort(F.collect_list(F.struct(F.col("_ordinal").alias("o"), "value"))).alias("_lines"))
                .where("_ordinal <> _header")
                .select(F.array_join("_lines.value", "\n").alias("_record"), "_source", "_ordinal"))
    records = single.unionByName(spanning).withColumn("_record", F.rtrim("_record", F.lit("\r")))
    return records.where(F.trim("_record", F.lit(" \t")) != "")


def envelope_records(payload: Column) -> Column:
    """S3: the record list of a parsed payload, or NULL for a bad shape.

    A root list is used as is; otherwise the first of ``data``,
    ``tickets``, ``results``, ``items`` that *is a list* (an empty list
    wins over later keys). Scalars and objects without such a list give
    NULL.
    """
    return F.coalesce(
        F.try_variant_get(payload, "$", "array<variant>"),
        *[F.try_variant_get(payload, f"$['{k}']", "array<variant>") for k in ENVELOPE_KEYS],
    )


def unwrap_payloads(payloads: DataFrame, text_col: str = "value") -> DataFrame:
    """S3 + F5: payload rows -> record rows and bad payload rows in one frame, from one scan.

    Record rows carry ``record`` (VARIANT), ``_source`` and ``_ordinal``
    (source, position) for first-seen ordering; non-object list items are
    dropped. A bad payload (unparseable JSON or no record list) is one row
    without a record, with ``_bad_text`` and ``_bad_error``.
    """
    source = F.col("_source") if "_source" in payloads.columns else F.lit(None).cast("string")
    parsed = payloads.select(F.col(text_col).alias("_text"), source.alias("_source"),
                             F.try_parse_json(F.col(text_col)).alias("_payload"))
    parsed = parsed.withColumn("_items", envelope_records(F.col("_payload")))
    bad = F.col("_items").isNull()
    error = F.when(F.col("_payload").isNull(), F.lit(MALFORMED_MESSAGE)).otherwise(F.lit(BAD_SHAPE_MESSAGE))
    rows = parsed.select("_source", F.when(bad, F.col("_text")).alias("_bad_text"), F.when(bad, error).alias("_bad_error"),
                         F.posexplode_outer("_items").alias("_pos", "record"))
    return (rows.filter(F.col("_bad_error").isNotNull() | F.coalesce(is_object(F.col("record")), F.lit(False)))
            .select("record", "_source", F.struct(F.col("_source").alias("f"), F.col("_pos").alias("p")).alias("_ordinal"),
                    "_bad_text", "_bad_error"))


def unwrap_envelope(payloads: DataFrame, text_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """S3 + F5 as two frames: (record rows, bad payload rows with ``raw_record`` and ``error_message``)."""
    rows = unwrap_payloads(payloads, text_col)
    records = rows.filter(F.col("_bad_error").isNull()).select("record", "_source", "_ordinal")
    bad = (rows.filter(F.col("_bad_error").isNotNull())
           .select(F.col("_bad_text").alias("raw_record"), "_source", F.col("_bad_error").alias("error_message")))
    return records, bad
