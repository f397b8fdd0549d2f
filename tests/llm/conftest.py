import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

ODD_TEXTS = [None, "", " \t\n", "a", "The the THE", "x" * 50_000, "päß 𝒳 ünï x   y",
             "same text here for all of us to see twice", "same text here for all of us to see twice"]


def make_docs(spark, texts, source="s", start=0):
    """documents with ids from ``start`` in the order of ``texts``."""
    rows = [(start + i, t, "en", source, len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture()
def docs_of(spark):
    return lambda texts, **kw: make_docs(spark, texts, **kw)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def small_docs(spark):
    """sf0.001 documents plus odd rows: nulls everywhere, repeated rows, a
    clashing extra column."""
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame(
        [(10_000 + i, t, None if i % 2 else "en", None if i % 3 == 0 else "odd", None) for i, t in enumerate(ODD_TEXTS)]
        + [(10_100, "repeated row text", "en", "odd", 17)] * 2 + [(None, "no id", None, None, None)],
        DOC_SCHEMA)
    return base.unionByName(odd)
