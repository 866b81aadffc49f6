"""The corpus pipeline: documents in, token ids out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next stage's ``docs``. All stages but the
last return the columns of documents, for the rows they keep:

1. language_id: documents whose language is undetermined, or in which no
   language prevails (the best one holds less than 0.35 of the words), go.
   Code-switched documents and short ones with a long key or a foreign
   notice in them stay.
2. near_duplicates: one document of each class of near duplicates stays, the
   one with the smallest doc_id (of equal rows, one).
3. decontamination: documents contaminated by benchmark text go.
4. mixing: documents are sampled by their calibrated probabilities.
5. token_output: texts are encoded, written as shards and read back.

Defined cases are those of the operators; an empty table passes through every
stage as an empty table. Nulls, and columns beyond those of documents, are
kept as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm import decontam, jaccard, langid, mixing, tokenout
from sluice.llm.common import fresh_name
from sluice.llm.queries import END_ID, MIX_TARGETS, TOKENIZER
from sluice.plans.tables import table
from sluice.session import materialize

MIN_LANGUAGE_SHARE = 0.35


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.learn(docs.where(~langid.is_held_out(F.col("doc_id"))))
    found, name = langid.identify(docs, model)
    sure = (F.col(f"{name}.lang_pred") != langid.UNKNOWN) & (F.col(f"{name}.score") >= MIN_LANGUAGE_SHARE)
    return found.where(sure).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard.near_duplicates(docs)
    stays = materialize(
        found.where(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("th") == F.col("class_th")))
        .select(F.col("doc_id").alias("s_id"), F.col("th").alias("s_th")).distinct(), "pipeline-stays")
    th = fresh_name(docs.columns, "text_hash")
    own = docs.withColumn(th, F.xxhash64("text"))
    kept = own.join(stays.hint("merge"), own.doc_id.eqNullSafe(stays.s_id) & (own[th] == stays.s_th), "left_semi")
    # Rows that repeat both id and text are one document; texts without a word are in no class and all stay.
    rank = fresh_name([*docs.columns, th], "copy")
    worded = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
    ranked = kept.withColumn(rank, F.row_number().over(Window.partitionBy("doc_id", th).orderBy("doc_id")))
    return ranked.where((F.col(rank) == 1) | ~worded).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found, name = decontam.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~decontam.is_contaminated(name)).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed, name = mixing.mix(docs, MIX_TARGETS, tokenizer=public_tokenizers.path(TOKENIZER))
    return mixed.where(F.col(f"{name}.selected")).select(*docs.columns)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokenout.token_output(docs, public_tokenizers.path(TOKENIZER), END_ID)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing_stage),
    ("token_output", token_output),
]

# The stages learn a model, rake weights and run a tokenizer, which SQL cannot express; tests/llm compares them with
# brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
    return docs
