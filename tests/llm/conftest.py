import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(*rows, extra=""):
        """(doc_id, text[, lang]) tuples; ``extra`` names string columns that clash with results or helpers."""
        names = extra.split()
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or ""), *["x"] * len(names)) for r in rows]
        return spark.createDataFrame(full, DOCS + "".join(f", `{n}` string" for n in names))

    return make


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
