"""Scraped items as a stream: clean each spec sheet, skip URLs already stored,
append the rest.

Raw sheets arrive as JSON lines in a directory. Every micro-batch is cleaned
in-row (``clean_spec_sheet``), de-duplicated on its URL (of several sheets of
one URL the smallest text stays, so a replay keeps the same one), compared with
the URLs stored by earlier batches through a ledger that reads only the
batch's own hash buckets (``operators.ledger``), and written to ``batch_id=<n>/``
under the output. Sheets without a URL cannot be compared and are all stored.
Text that is no JSON object goes to ``_rejects/batch_id=<n>/``, the other sheets
of a batch's URL to ``_duplicates/batch_id=<n>/``. A batch
replayed after a failure overwrites only its own folders and compares only
against earlier batches, so the output holds every URL exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.documents import clean_spec_sheet, is_spec_sheet
from sluice.operators.ledger import store_urls, unseen
from sluice.session import materialize
from sluice.streaming.logs import file_stream

URL_FIELD = "url"
STORED_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
    T.StructField("specs", T.MapType(T.StringType(), T.MapType(T.StringType(), T.ArrayType(T.StringType())))),
    T.StructField("batch_id", T.LongType()),
])


LEDGER = "_urls"  # hidden folders: readers of the JSON output skip them
REJECTS = "_rejects"
DUPLICATES = "_duplicates"


def store_new_sheets(batch: DataFrame, batch_id: int, output_dir: str, raw_col: str = "value") -> None:
    """One micro-batch: clean, drop URLs seen before, write this batch's folders and its URLs to the ledger.

    The batch is read and parsed once, into a written copy that all outputs
    are taken from.
    """
    readable = F.when(is_spec_sheet(raw_col), F.col(raw_col))
    clean = clean_spec_sheet(batch.select(raw_col, readable.alias("__sheet")), raw_col="__sheet", keep=[raw_col, "__sheet"],
                             on_malformed="null")
    rows = materialize(clean.withColumn("url", F.col("fields")[URL_FIELD]), "sheet-batch")
    sheets = rows.where(F.col("__sheet").isNotNull())
    first = sheets.where(F.col("url").isNotNull()).groupBy("url").agg(F.min(raw_col).alias("__first"))
    unkeyed = sheets.where(F.col("url").isNull()).select("url", "fields", "specs")
    # Equal texts are one sheet; of different ones of a URL the smallest text is stored and the others are set aside.
    chosen = materialize(sheets.join(first, "url").withColumn("__chosen", F.col(raw_col) == F.col("__first")), "sheet-chosen")
    for folder, lost in ((REJECTS, rows.where(F.col("__sheet").isNull())), (DUPLICATES, chosen.where(~F.col("__chosen")))):
        lost.select(raw_col).write.mode("overwrite").text(f"{output_dir}/{folder}/batch_id={batch_id}")
    keyed = chosen.where("__chosen").groupBy("url").agg(F.first(F.struct("fields", "specs")).alias("s")).select("url", "s.*")
    fresh = materialize(unseen(keyed, f"{output_dir}/{LEDGER}", before_batch=batch_id), "sheet-fresh")
    fresh.unionByName(unkeyed).write.mode("overwrite").json(f"{output_dir}/batch_id={batch_id}")
    store_urls(fresh, f"{output_dir}/{LEDGER}", batch_id)


def run_spec_sheet_stream(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_dir: str,
                          max_files_per_trigger: int | None = None, timeout_s: float | None = None):
    """Drain the raw sheets under ``input_dir`` (``availableNow``) into ``output_dir``."""
    query = (file_stream(spark, input_dir, max_files_per_trigger).writeStream
             .foreachBatch(lambda df, batch_id: store_new_sheets(df, batch_id, output_dir))
             .option("checkpointLocation", checkpoint_dir)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination(timeout_s)
    return query


def read_rejects(spark: SparkSession, output_dir: str) -> DataFrame:
    """Every rejected text (``value``) with the batch it came in; count it to see what was lost."""
    return spark.read.schema("value string, batch_id long").text(f"{output_dir}/{REJECTS}")


def read_duplicates(spark: SparkSession, output_dir: str) -> DataFrame:
    """Sheets (``value``) that lost to another sheet of their URL in the same batch."""
    return spark.read.schema("value string, batch_id long").text(f"{output_dir}/{DUPLICATES}")


def read_stored_sheets(spark: SparkSession, output_dir: str) -> DataFrame:
    """Every stored sheet with the batch that stored it (the ledger folder is skipped)."""
    return spark.read.schema(STORED_SCHEMA).json(output_dir)
