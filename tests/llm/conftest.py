import pytest

# Columns named like those the operators use or return.
CLASHING = "band string, k string, rank int, score double, size long, version long, matches string, slot long, shard string, labels string"
DOC_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING


@pytest.fixture()
def docs_of(spark):
    """DataFrame of documents from texts or (id, text[, lang, source]) tuples, with clashing extra columns."""
    def make(rows):
        full = []
        for i, r in enumerate(rows):
            r = r if isinstance(r, tuple) else (i, r)
            r = (*r, *("en", "src0")[len(r) - 2:]) if len(r) < 4 else r
            full.append((*r[:4], len(r[1]) if r[1] else None, "x", None, i, 0.5, 7, 1, "m", None, "s", "l"))
        return spark.createDataFrame(full, DOC_COLUMNS)
    return make
