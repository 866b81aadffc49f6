"""The pipeline's stages on small documents, and every registered query against its SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import langid
from sluice.llm.queries import ORACLES, QUERIES
from sluice.plans.tables import table
from sluice.session import materialize

SF_SMALL = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "mixing",
                                                      "token_output"]
    docs = table(spark, SF_SMALL, "documents")
    columns = docs.columns
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in docs.collect()}
        docs = materialize(stage(spark, docs, SF_SMALL))
        after = docs.collect()
        assert {r.doc_id for r in after} <= before
        assert name == "token_output" or docs.columns == columns
        sizes.append(len(after))
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] == sizes[-2] > 0


def rows_of(spark):
    words = " ".join(f"word{i}" for i in range(120))
    rows = [(1, "the quick brown fox and the dog were in that house", "en", "a", 1), (2, None, "en", "a", 1), (3, "", None, None, 1),
            (4, "123 456", "en", "a", 1), (5, words, "en", "b", 1), (6, words, "en", "b", 1), (6, words, "en", "b", 1),
            (7, words.replace("word7 ", "other "), "en", "b", 1), (None, "the fox and that house of the dog", "en", None, 1),
            (8, "der hund und die katze waren in dem haus", "de", "a", 1)]
    return spark.createDataFrame([(*r, "x") for r in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint, text_hash string")


def test_decisions_on_edge_rows(spark):
    docs = rows_of(spark)
    kept = corpus_pipeline.language_id(spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "5", "6", "6", "7", "8", "None"]
    single = corpus_pipeline.near_duplicates(spark, docs, SF_SMALL)
    assert single.columns == docs.columns
    assert sorted(str(r.doc_id) for r in single.collect()) == ["1", "2", "3", "4", "5", "8", "None"]
    lone = corpus_pipeline.near_duplicates(spark, docs.where("doc_id = 6"), SF_SMALL)
    assert [r.doc_id for r in lone.collect()] == [6]
    assert corpus_pipeline.decontamination(spark, docs, SF_SMALL).count() == docs.count()


def test_empty_table(spark):
    docs = rows_of(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF_SMALL))
        assert docs.count() == 0


def test_language_stage_rejects_only_the_undetermined(spark):
    docs = table(spark, SF_SMALL, "documents")
    kept = corpus_pipeline.language_id(spark, docs, SF_SMALL).count()
    assert kept >= 0.99 * docs.where(F.col("text").rlike(r"\p{L}")).count()
    assert langid.UNKNOWN == "und"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.sql(ORACLES[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = lambda d: sorted(map(str, d[columns].astype(object).where(d[columns].notna(), None)
                                .itertuples(index=False, name=None)))
    assert rows(got) == rows(want)
