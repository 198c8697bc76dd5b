import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang), with columns whose names clash with
    results or helpers of the operators."""
    def make(rows):
        rows = [(r[0], r[1], r[2] if len(r) > 2 else None, None, len(r[1]) if r[1] else None) for r in rows]
        df = spark.createDataFrame(rows, DOCS)
        return df.selectExpr("*", "n_chars as score", "source as component_id", "lang as gid", "doc_id as host", "text as n")
    return make


@pytest.fixture
def vectors(spark):
    def make(rows):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
        return df.selectExpr("*", "vec_id as qid", "label as shard", "vec_id as v", "label as kind")
    return make


@pytest.fixture
def pages(spark):
    def make(rows):
        df = spark.createDataFrame(rows, "page_id long, url string, html string")
        return df.selectExpr("*", "url as host", "html as digest", "page_id as first", "url as wrapper")
    return make
