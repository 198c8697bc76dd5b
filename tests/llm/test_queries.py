"""The registered queries on the driver's smallest tables, and the pipeline stage by stage."""

import hashlib
import os
import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from loopcount.llm import common, jaccard, language, quality, queries
from tests import oracle_compare
from tests.llm.test_jaccard import brute

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver test data not present")


def test_all_are_registered():
    names = entry.queries()
    assert {re.match(r"op(\d+)_", n)[1] for n in names if n.startswith("op")} == {str(i) for i in range(1, 14)}
    assert "pipeline" in names and set(queries.ORACLE_SQL) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    r = oracle_compare.compare(spark, oracle_compare.duck(SF_DIR), name, queries.QUERIES[name], queries.ORACLE_SQL[name], SF_DIR)
    assert r["columns_match"] and r["spark_rows"] == r["oracle_rows"] and r["values_match"], r


def test_neighbours_recall(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    got = {}
    for r in queries.op1_neighbours(spark, SF_DIR).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        score = x @ x[i]
        score[i] = -np.inf
        hits += len(got[ids[i]] & set(ids[np.argsort(-score)[:20]].tolist()))
        total += 20
    assert hits >= 0.9 * total


def test_tokens_of_whole_documents(spark):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in queries.op7_bpe(spark, SF_DIR).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_columns_of_the_other_queries(spark):
    want = {"op3_quality": "doc_id held_out score predicted", "op5_licenses": "doc_id n_words n_base first_word last_word base_labels labels score",
            "op8_html": "page_id url text n_chars", "op9_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
            "op10_language": "doc_id held_out lang_pred score", "op11_hyperminhash": "doc_id n_shingles component_id kept"}
    for name, columns in want.items():
        df = queries.QUERIES[name](spark, SF_DIR)
        assert df.columns[:len(columns.split())] == columns.split()
        assert df.count() >= (50 if name == "op8_html" else 200)


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    columns, before = docs.columns, docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, SF_DIR).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        ids = {r["doc_id"] for r in after.select("doc_id").collect()}
        if name == "quality":
            assert ids == {r["doc_id"] for r in quality.quality_of(before, labels).collect() if r["predicted"]}
        elif name == "language":
            assert ids == {r["doc_id"] for r in language.languages_of(before).collect() if r["accepted"]}
        elif name == "near_copies":
            groups = brute([(r["doc_id"], r["text"]) for r in before.collect()], 5, 80)
            assert ids == {c for _, c in groups.values()}
        else:
            assert ids == {r["doc_id"] for r in before.collect()}
            assert {r["doc_tokens"] for r in after.collect()} and after.groupBy().sum("length").first()[0] == sum(
                r[1] for r in after.select("doc_id", "doc_tokens").distinct().collect())
        if i < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == columns
        before = after
    whole = {(r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert sum(n for _, _, n, _ in whole) == before.groupBy().sum("length").first()[0]


def test_no_stage_drops_clean_rows_without_reason(spark, docs):
    clean = [(i, "the house is near the water and the road %d" % i, "en") for i in range(40)]
    assert language.keep_known(docs(clean)).count() == 40
    assert jaccard.keep_one_of_each(docs([(i, " ".join("w%d_%d" % (i, j) for j in range(30))) for i in range(20)])).count() == 20


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None), (2, "", "en", "a", 0), (None, None, None, None, None)]])
def test_pipeline_on_empty_and_null_documents(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in (1, 2)][:len(rows)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns[:2] == ["doc_id", "start"]
    labels = spark.read.parquet(str(tmp_path / "labels.parquet"))
    assert quality.keep_good(docs.limit(0), labels).count() == 0 and jaccard.keep_one_of_each(docs.limit(0)).count() == 0


def test_intermediate_folders_are_removed(spark):
    folder = common.shared_folder(spark, "probe")
    base = os.path.dirname(folder).removeprefix("file:")
    common.remove_stored(spark)
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    found = queries.op2_jaccard(spark, SF_DIR)
    assert found.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert len(set(os.listdir(base)) - before) > 5
    assert common.remove_stored(spark) > 5 and set(os.listdir(base)) == before
    assert common.remove_stored(spark) == 0
