"""The corpus pipeline, and the registration of this package's queries."""

import __spark_entry__ as contract
import corpus_pipeline
from orderloom.llm import queries

SF = "/root/testdata/sf0.001"
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered():
    names = set(contract.queries())
    assert set(queries.queries()) | {"pipeline"} <= names
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{i}" for i in range(1, 14)]
    assert set(queries.oracle_sql()) <= names


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        counts.append(docs.count())
        if number < 4:
            assert docs.columns == DOCUMENT
            assert docs.where("n_chars != length(text)").count() == 0
    after_quality, after_dedup, after_secrets = counts[1:4]
    assert counts[0] > after_quality > after_dedup == after_secrets > 0
    assert docs.where("offset < 0 OR offset + length > 1024").count() == 0


def test_stages_on_an_empty_table_and_on_nulls(spark, documents):
    empty = documents().selectExpr(*DOCUMENT)
    odd = documents((None, None, None), (1, "", "s"), (2, "token=abcdef12 and some words to go with it", None)).selectExpr(*DOCUMENT)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
        stage(spark, odd, SF).collect()


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(rows.columns)
