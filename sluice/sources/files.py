"""File sources: typed CSV, JSON documents, forecast JSON, Parquet.

Schemas are always declared (no inference pass over the data), so the
readers split files across tasks and Catalyst prunes unread columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.incremental import batch_after
from sluice.operators.selection import nth_key
from sluice.operators.weather import WEATHER_DOCUMENT
from sluice.session import scratch_path

# The sales record layout (header names, and the month/day/year
# date layout, which must accept one-digit months and days).
SALES_DATE_FORMAT = "M/d/yyyy"
SALES_HEADER = ["Region", "Country", "Item Type", "Sales Channel", "Order Priority", "Order Date",
                "Order ID", "Ship Date", "Units Sold", "Unit Price", "Unit Cost", "Total Revenue",
                "Total Cost", "Total Profit"]
MONEY = T.DecimalType(18, 2)
CSV_KEEP_SPACES = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
SALES_CSV_SCHEMA = T.StructType([
    T.StructField("Region", T.StringType()),
    T.StructField("Country", T.StringType()),
    T.StructField("Item Type", T.StringType()),
    T.StructField("Sales Channel", T.StringType()),
    T.StructField("Order Priority", T.StringType()),
    T.StructField("Order Date", T.StringType()),
    T.StructField("Order ID", T.LongType()),
    T.StructField("Ship Date", T.StringType()),
    T.StructField("Units Sold", T.IntegerType()),
    T.StructField("Unit Price", MONEY),
    T.StructField("Unit Cost", MONEY),
    T.StructField("Total Revenue", MONEY),
    T.StructField("Total Cost", MONEY),
    T.StructField("Total Profit", MONEY),
])
SALES_DATE_COLUMNS = ("Order Date", "Ship Date")
MONEY_COLUMNS = ("Unit Price", "Unit Cost", "Total Revenue", "Total Cost", "Total Profit")


def _declared_in_file_order(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> T.StructType:
    """The header of the (first) file with the declared types; columns that are not declared are text."""
    header = spark.read.option("header", True).options(**CSV_KEEP_SPACES).csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise ValueError(f"CSV header lacks {', '.join(missing)}")
    types = {f.name: f.dataType for f in schema.fields}
    return T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])


def read_sales_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType = SALES_CSV_SCHEMA,
                   date_columns: Sequence[str] = SALES_DATE_COLUMNS, date_format: str = SALES_DATE_FORMAT,
                   mode: str = "FAILFAST") -> DataFrame:
    """Header CSV with declared columns found by name; the date columns parsed with ``M/d/yyyy``.

    The header's order is the file's own: it is read from the first file, the
    declared types are put in that order and the declared columns selected by
    name. A missing column raises; further columns are left out. Files whose
    header differs from the first one's fail the read (``enforceSchema`` is
    off, so every file's header is compared). Quoted fields may contain
    commas. ``mode='FAILFAST'`` makes a malformed row fail the job instead of
    silently becoming NULLs.
    """
    as_stored = _declared_in_file_order(spark, path, schema)
    raw = (spark.read.schema(as_stored).option("header", True).option("mode", mode).option("enforceSchema", False)
           .options(**CSV_KEEP_SPACES).csv(path))
    return raw.select(*[
        (F.to_date(F.col(f"`{c}`"), date_format).alias(c) if c in date_columns else F.col(f"`{c}`"))
        for c in schema.fieldNames()])


CORRUPT = "_corrupt_record"


def split_sales_csv(spark: SparkSession, path: str | Sequence[str], good_path: str, reject_path: str,
                    schema: T.StructType = SALES_CSV_SCHEMA, date_columns: Sequence[str] = SALES_DATE_COLUMNS,
                    date_format: str = SALES_DATE_FORMAT, required: Sequence[str] = ()) -> dict[str, int]:
    """Read a sales CSV once and write its good rows (Parquet) and its bad lines, each line to exactly one of the two.

    A line is bad when it has too few or too many fields, an unbalanced quote,
    a field that is not of its column's type, or no value in a ``required``
    column. ``reject_path`` gets the line as it stands in the file (column
    ``line``) and why (``reason``). Returns ``rows``, ``good`` and ``bad``,
    counted while the lines are written.
    """
    spark_schema = _declared_in_file_order(spark, path, schema)
    dated = T.StructType([T.StructField(f.name, T.DateType() if f.name in date_columns else f.dataType) for f in spark_schema]
                         + [T.StructField(CORRUPT, T.StringType())])
    raw = (spark.read.schema(dated).option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
           .option("columnNameOfCorruptRecord", CORRUPT).option("dateFormat", date_format).options(**CSV_KEEP_SPACES).csv(path))
    # A line that lacks a required value was read in full, so it is written as its fields.
    lacks = F.lit(False)
    for c in required:
        lacks = lacks | F.col(f"`{c}`").isNull()
    fields = F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in dated if f.name != CORRUPT]))
    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed").when(lacks, "missing value")
    seen = Observation("csv")
    judged = raw.select("*", reason.alias("__reason")).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("__reason").isNull()).alias("good"),
        F.count_if(F.col("__reason").isNotNull()).alias("bad"))
    staged = scratch_path(spark, "csv-split")
    # One pass over the file: both kinds are written by the same job, to two folders.
    (judged.select(*[F.col(f"`{c}`") for c in schema.fieldNames()], "__reason",
                   F.when(F.col("__reason").isNotNull(), F.coalesce(F.col(CORRUPT), fields)).alias("__line"),
                   F.col("__reason").isNotNull().alias("__bad"))
     .write.partitionBy("__bad").parquet(staged))
    counts = dict(seen.get)
    stored = T.StructType([*[f for f in dated if f.name != CORRUPT], T.StructField("__reason", T.StringType()),
                           T.StructField("__line", T.StringType()), T.StructField("__bad", T.BooleanType())])
    both = spark.read.schema(stored).parquet(staged)
    (both.where("not __bad").select(*[F.col(f"`{c}`") for c in schema.fieldNames()])
     .write.mode("overwrite").parquet(good_path))
    (both.where("__bad").select(F.col("__line").alias("line"), F.col("__reason").alias("reason"))
     .write.mode("overwrite").parquet(reject_path))
    return counts


def as_int(df: DataFrame, columns: Sequence[str] = MONEY_COLUMNS) -> DataFrame:
    """Money as whole numbers, halves rounded to even, for loads into integer columns."""
    return df.select(*[(F.bround(F.col(f"`{c}`"), 0).cast("bigint").alias(c) if c in columns else F.col(f"`{c}`"))
                       for c in df.columns])


def write_sales_csv(df: DataFrame, path: str, date_columns: Sequence[str] = SALES_DATE_COLUMNS,
                    date_format: str = SALES_DATE_FORMAT) -> None:
    """Write sales rows as header CSV with ``M/d/yyyy`` dates (one file per task)."""
    out = df.select(*[
        (F.date_format(F.col(f"`{c}`"), date_format).alias(c) if c in date_columns else F.col(f"`{c}`"))
        for c in df.columns])
    out.write.mode("overwrite").option("header", True).options(**CSV_KEEP_SPACES).csv(path)


def read_csv_batches(df: DataFrame, key: str, batch: int, skip: int = 0, last_key=None) -> DataFrame:
    """The batch of ``batch`` rows in key order after ``last_key``, or after ``skip`` earlier batches.

    A caller that remembers where it stopped passes ``last_key``; ``skip``
    finds the last skipped key by counting, in a few scans however many
    batches are skipped. No task ever holds the rows that were skipped; a
    file line number would not be stable under parallel reads. Keys are
    unique.
    """
    rows = batch_after(df, key, last_key)
    if skip:
        last_key = nth_key(rows, key, skip * batch)
        if last_key is None:
            return df.limit(0)
    return batch_after(df, key, last_key, batch)


def read_json_documents(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
                        multiline: bool = True) -> DataFrame:
    """A JSON array of documents (or one document per line with ``multiline=False``)."""
    return (spark.read.schema(schema).option("multiLine", multiline)
            .option("allowUnquotedControlChars", True).json(path))


def oid_to_text(df: DataFrame, id_col: str = "_id") -> DataFrame:
    """Extended-JSON ``{"$oid": ...}`` ids to plain text (24 hex chars sort in id order)."""
    dtype = df.schema[id_col].dataType
    if isinstance(dtype, T.StructType) and "$oid" in dtype.fieldNames():
        return df.withColumn(id_col, F.col(f"`{id_col}`.`$oid`"))
    return df.withColumn(id_col, F.col(f"`{id_col}`").cast("string"))


def read_weather_json(spark: SparkSession, path: str | Sequence[str], multiline: bool = True) -> DataFrame:
    """Forecast documents (``init`` plus nested ``dataseries``): one document per
    file as an API returns it, or JSON lines with ``multiline=False``."""
    return read_json_documents(spark, path, WEATHER_DOCUMENT, multiline=multiline)


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One or several Parquet paths as one DataFrame."""
    return spark.read.parquet(*([path] if isinstance(path, str) else list(path)))
