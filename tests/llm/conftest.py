import pytest
from pyspark.sql import types as T

from tests.llm.cases import EDGE_ROWS


@pytest.fixture(scope="session")
def small(spark):
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty, blank, very long and repeated texts, ties, and extra columns named like the operators' own."""
    fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType())]
    clash = ["node", "sig", "hash", "bare", "points", "text_sha256", "n_words", "bits", "keep_id", "domain", "cluster", "rate", "shingles", "kept"]
    schema = T.StructType([T.StructField(n, t) for n, t in fields] + [T.StructField(n, T.StringType()) for n in clash])
    rows = [(i, t, lang, None, None, *["x"] * len(clash)) for i, t, lang in EDGE_ROWS]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def edge_labels(spark):
    rows = [(1, 1, 0), (2, 1, 0), (3, 0, 1), (4, 0, 0), (5, 1, None), (None, 1, 1), (6, None, None), (7, 1, 1), (999, 1, 0), (1, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def no_labels(edge_labels):
    return edge_labels.limit(0)
