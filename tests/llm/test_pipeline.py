import math

import corpus_pipeline as cp
from tests.conftest import SF_SMALL
from tests.llm.test_near_dup import brute_classes


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, n = docs.columns, docs.count()
    names = [name for name, _ in cp.STAGES]
    assert names == ["language_id", "near_dedup", "passage_dedup", "mixing", "packing"]
    kept = cp.identify_language(spark, docs, SF_SMALL)
    assert kept.columns == columns and kept.count() == n
    single = cp.drop_near_duplicates(spark, kept, SF_SMALL)
    want = brute_classes([(r["doc_id"], r["text"]) for r in kept.collect()], math.inf)  # idf of exact counts
    assert single.columns == columns and {r["doc_id"] for r in single.collect()} == set(want.values())
    cut = cp.cut_repeated_passages(spark, single, SF_SMALL)
    assert cut.columns == columns and all(r["n_chars"] == len(r["text"]) for r in cut.collect())
    mixed = cp.mix_sources(spark, cut, SF_SMALL)
    assert mixed.columns == columns and mixed.count() > 0
    packed = cp.pack_sequences(spark, mixed, SF_SMALL)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in mixed.collect()}


def test_rejects_and_empties(spark, docs_of):
    real = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(3).collect()]
    numbers = "Of on the erou 24.16.87.17 is. 4935048725946546"
    docs = docs_of([(1, None), (2, "1234 !!"), (3, "Съешь же ещё этих мягких булок, да выпей чаю", None, "a"), (9, numbers),
                    *((10 + i, t) for i, t in enumerate(real))]).withColumnRenamed("rank", "r")
    kept = cp.identify_language(spark, docs, SF_SMALL)
    assert sorted(r["doc_id"] for r in kept.collect()) == [9, 10, 11, 12]
    for _, stage in cp.STAGES[1:]:
        assert stage(spark, docs.where("false"), SF_SMALL).count() == 0


def test_run(spark):
    rows = cp.run(spark, SF_SMALL)
    assert rows.count() > 0 and "sequence_id" in rows.columns


def test_near_duplicates_weigh_rare_words_fully(spark, docs_of):
    """Texts that differ in a word of their own stay, though their shingles are alike by counts."""
    words = [f"s{j}" for j in range(53)]
    docs = docs_of([" ".join(words[:25] + [f"w{i}"] + words[25:]) for i in range(4)]
                   + [" ".join(f"u{i}x{j}" for j in range(60)) for i in range(200)])
    kept = {r["doc_id"] for r in cp.drop_near_duplicates(spark, docs, SF_SMALL).collect()}
    assert kept == set(range(204))
