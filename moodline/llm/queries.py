"""Registered queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodline.llm import (
    collocations,
    fingerprint,
    html_blocks,
    language_id,
    license_scan,
    line_quality,
    merkle_manifest,
    mixing,
    near_dup,
    packing,
    passage_dedup,
    shard_table,
    threshold_topk,
)
from moodline.llm.tables import read_table
from moodline.session import configure

Query = Callable[[SparkSession, str], DataFrame]


def language_model(docs: DataFrame) -> dict:
    """Trained on labelled documents outside the held-out quarter (CRC-32 of the id modulo 4 is 2)."""
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return language_id.train(docs.where((part != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
                             .select("doc_id", "text", "lang"))


def tokenizer_files() -> tuple[str, str]:
    """The public byte-level vocabulary as tokenizer file and as ranks."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(read_table(spark, sf_dir, "documents", "doc_id", "text")).drop("edited_diff", "next_diff")


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return mixing.mix(mixing.sizes(docs)).select("doc_id", "size", "source_size", "target", "taken", "source")


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_table.place(read_table(spark, sf_dir, "documents", "doc_id"), "doc_id").select("doc_id", "slot", "shard")


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_dedup.repeats(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_topk.search(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return near_dup.every_document(docs, near_dup.classes(docs, common_share=0, copies_once=True))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return (language_id.predict(docs.select("doc_id", "text"), language_model(docs))
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_byte"))


def op9_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer, ranks = tokenizer_files()
    return packing.pack(read_table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer, ranks)


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return line_quality.verdicts(docs).drop("source")


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    one_more = F.col("n_chars").cast("decimal(20,0)") + 1
    tampered = merkle_manifest.leaf_digest([one_more if f == "n_chars" else F.col(f) for f in merkle_manifest.FIELDS])
    return merkle_manifest.manifest(docs, seen=F.when(hit, tampered)).drop("proof")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents", "lang", "text"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    def ready(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)
        return run

    return {fn.__name__: ready(fn) for fn in (
        op1_fingerprints, op2_mix, op3_shards, op4_repeats, op5_licenses, op6_topk, op7_neardup, op8_language,
        op9_extract, op10_pack, op11_quality,
        op12_manifest, op13_collocations, pipeline)}
