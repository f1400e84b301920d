"""The pipeline stage by stage, and the registered queries against their SQL."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import differences, duck
from tillflow.llm.common import n_words
from tillflow.llm.queries import ORACLE, QUERIES
from tillflow.llm.secrets import scan_documents

SF = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="tables not here")


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), duck(SF), ORACLE[name]) is None


@needs_tables
def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, kept = docs, {}
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, SF)
        if at < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns, name
        after.write.parquet(str(tmp_path / str(at)))
        kept[name] = before, spark.read.parquet(str(tmp_path / str(at)))
        before = kept[name][1]
    toxic = spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1")
    given, left = kept["toxicity"]
    # Recall per language on rows not trained on is asserted in test_arrow.py, on the larger table.
    assert left.join(toxic, "doc_id").count() <= 0.25 * toxic.count() and left.count() > 0.85 * given.count()
    given, left = kept["minhash near-dedup"]
    assert left.count() == left.select("doc_id").distinct().count() == left.select("text").distinct().count() < given.count()
    given, left = kept["secret scans"]
    assert left.count() == given.count()
    assert scan_documents(left).where("spans <> ''").count() == 0 < scan_documents(given).where("spans <> ''").count()
    given, left = kept["mixing sources"]
    size = F.sum(n_words(F.col("text"))).alias("size")
    sizes = {r.source: r.size for r in given.groupBy("source").agg(size).collect()}
    mixed = {r.source: r.size for r in left.groupBy("source").agg(size).collect()}
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}
    level = sum(sizes.values()) / sum(weights.values())
    assert all(level * weights[s] < 3 * sizes[s] for s in sizes)
    assert all(abs(mixed[s] - level * weights[s]) <= 2 * corpus_pipeline.BLOCK_WORDS for s in sizes)
    given, left = kept["sentencepiece"]
    assert left.count() == given.count() == left.where("round_trip").count()


@needs_tables
def test_pipeline_runs_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


@needs_tables
def test_pipeline_carries_odd_rows_and_columns_of_any_name(spark):
    columns = "ids array<int>, doc_id long, shard int, text string, source string, bucket string, kept boolean, n_chars long, row string, lang string, n_tokens int, size double"
    texts = [None, "", "  ", "a b", "password=abcdef123 " * 3, "word " * 30_000, "x" * 100_000, "same text here now ok", "same text here now ok"]
    rows = [([1], i, 2, text, None if i == 3 else "s", "b", True, 1, "r", None, 5, 0.5) for i, text in enumerate(texts)]
    rows += [rows[4], ([1], None, 2, "no id at all", "s", "b", None, None, "r", None, 5, 0.5)]
    docs = spark.createDataFrame(rows, columns)
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
        if at < 4:
            assert docs.columns == [c.split()[0] for c in columns.split(", ")], name
        if name == "minhash near-dedup":
            # The repeated row and the copy are gone; texts without words and the row without an id stay.
            assert sorted((r.doc_id is None, r.doc_id or 0) for r in docs.collect()) == [(False, i) for i in range(8)] + [(True, 0)]
        if name == "secret scans":
            assert docs.where("doc_id = 4").first().text == "[secret] " * 3
    assert docs.where("NOT round_trip").count() == 0 and {"ids", "document_ids", "n_tokens", "document_n_tokens"} < set(docs.columns)
