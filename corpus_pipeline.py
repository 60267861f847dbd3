"""Corpus pipeline: documents to packed training sequences.

``STAGES`` runs language identification, near-duplicate removal, removal of
repeated passages, source mixing and packing, in that order. Every stage works
on all its predecessor kept; its result is written and read again for the next.
All but the last return the columns of ``documents``. Tables that a stage wrote
on its way are removed when the next one starts, unless its input reads them.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodline.llm import language_id, mixing, near_dup, packing, passage_dedup, tables
from moodline.llm.queries import language_model, tokenizer_files
from moodline.session import configure

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Text of a learned language costs 2 to 5 bits a byte, short texts that are mostly numbers 5 to 10; a script
# that was never learned costs 15 and more.
MOST_BITS_PER_BYTE = 12.0


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a learned language; a missing lang becomes the predicted one."""
    found = language_id.predict(docs.select(F.struct(*docs.columns).alias("row"), "text"), language_model(docs))
    kept = found.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("bits_per_byte") <= MOST_BITS_PER_BYTE))
    lang = F.coalesce("row.lang", "lang_pred").alias("lang")
    return kept.select(*(lang if c == "lang" else F.col(f"row.`{c}`") for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near duplicates."""
    return near_dup.one_of_each(docs, common_share=0)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that an earlier document holds; documents that are nothing else go."""
    cut = passage_dedup.without_repeats(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut.where(F.col("text").isNull() | F.col("text").rlike(r"\S")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents as often as the mix of sources asks for."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all documents into token sequences."""
    return packing.pack(docs, *tokenizer_files())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("passage_dedup", cut_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Trained models, sampling and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


_left: list[str] = []


def _tidy(stage: Stage) -> Stage:
    """``stage``, which first removes what the stages before it left in the checkpoint folder."""
    @functools.wraps(stage)
    def tidied(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles()
        gone = [path for path in _left if not any(f"/{path.rpartition('/')[2]}/" in f for f in read)]
        tables.remove(spark, *gone)
        _left[:] = [path for path in _left if path not in gone]
        with tables.scope() as paths:
            found = stage(spark, docs, sf_dir)
        _left.extend(paths)
        return found
    return tidied


STAGES = [(name, _tidy(stage)) for name, stage in STAGES]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = tables.written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
