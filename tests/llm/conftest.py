from __future__ import annotations

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that clash with names the operators use inside.
CLASHES = ["hash", "node", "key", "size", "row", "copies", "fingerprint", "component", "words", "removed", "spans", "n_words", "kept", "q", "place", "dropped", "turn", "bucket"]


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table of (doc_id, text) or (doc_id, text, lang,
    source) rows, with clashing further columns if asked for."""

    def build(rows, clashes=False):
        full = [(*r, "en", "s")[:4] if len(r) == 2 else r for r in rows]
        full = [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in full]
        df = spark.createDataFrame(full, DOCUMENTS)
        for name in CLASHES if clashes else []:
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit("x"))
        return df

    return build
