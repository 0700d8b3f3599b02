import hashlib

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) pairs; other columns are filled in."""
    def make(rows, extra: dict | None = None):
        df = spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], DOCS)
        for name, value in (extra or {}).items():
            df = df.selectExpr("*", f"'{value}' AS `{name}`")
        return df
    return make


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()
