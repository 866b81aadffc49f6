"""Incremental extraction: high-water marks, id ranges, batches after a key.

The reference walks cursors and pulls whole result sets to the driver.
Here every step is a DataFrame: marks are one-row aggregates (of a stored
Parquet table from its footers, see ``stored_mark``), ranges are pushed-down
filters, the next n rows are a filter too, and a backfill of many batches is one job that tags each pending
row with its batch number instead of one driver round trip per batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.selection import first_rows

STATUS_UP_TO_DATE = "up to date"
STATUS_LOAD = "load"
STATUS_TARGET_AHEAD = "target ahead"


def high_water_mark(target: DataFrame | None, key: str) -> DataFrame:
    """One row, one column ``high_water_mark``: ``max(key)``, NULL when empty or missing."""
    if target is None:
        raise ValueError("use mark_value(None, key) for a missing target")
    return target.agg(F.max(key).alias("high_water_mark"))


def mark_value(target: DataFrame | None, key: str):
    """The high-water mark as a Python scalar (None for a missing or empty target)."""
    if target is None:
        return None
    return target.agg(F.max(key).alias("m")).first()["m"]


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application in which Parquet answers ``min``, ``max`` and ``count`` from its footers."""
    session = spark.newSession()
    for key, value in (("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text"),  # Parquet by the v2 reader
                       ("spark.sql.parquet.aggregatePushdown", "true")):
        session.conf.set(key, value)
    return session


def footer_mark(spark: SparkSession, path: str | list[str], key: str) -> DataFrame:
    """One row, one column ``high_water_mark``: ``max(key)`` of a stored Parquet table, from row-group statistics.

    No column is read: the plan's scan has a pushed-down aggregate. Spark does
    so for whole numbers, floats, booleans and dates; other types are scanned.
    Files without statistics make it fail, see ``stored_mark``.
    """
    table = footer_session(spark).read.parquet(*([path] if isinstance(path, str) else path))
    return table.agg(F.max(F.col(f"`{key}`")).alias("high_water_mark"))


def stored_mark(spark: SparkSession, path: str | list[str], key: str):
    """The high-water mark of a stored Parquet table as a Python scalar: from its footers, by a scan where a file has no
    statistics; None for a missing or empty table."""
    try:
        return footer_mark(spark, path, key).first()["high_water_mark"]
    except Exception as e:  # noqa: BLE001 - a Java exception
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        if "FAILED_READ_FILE" not in str(e):
            raise
        # A file that cannot be read at all fails here again.
        return mark_value(spark.read.parquet(*([path] if isinstance(path, str) else path)), key)


def recover(spark: SparkSession, path: str) -> None:
    """Put back a table that a replacing load had set aside when its driver died before the switch (``path__old``).

    Where ``path`` exists the switch was finished, and nothing is done.
    """
    base = path.rstrip("/")
    jvm = spark.sparkContext._jvm
    at, old = jvm.org.apache.hadoop.fs.Path(base), jvm.org.apache.hadoop.fs.Path(f"{base}__old")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at) and fs.exists(old) and not fs.rename(old, at):
        raise OSError(f"cannot put {base}__old back")


def read_target(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The stored target table, or None when it does not exist yet.

    A table that was set aside when a replacing load died is found and put back.
    """
    recover(spark, path)
    try:
        return spark.read.format(fmt).load(path)
    except Exception as e:  # noqa: BLE001 - AnalysisException for a missing path
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def reconcile(source: DataFrame, target: DataFrame | None) -> DataFrame:
    """One status row: source and target counts and what to do.

    Equal counts: ``up to date``; fewer in the target (or no target):
    ``load``; more in the target: ``target ahead``.
    """
    # One aggregate over both inputs tagged by side: a single job, no join.
    side = source.select(F.lit(True).alias("__src"))
    if target is not None:
        side = side.unionByName(target.select(F.lit(False).alias("__src")))
    both = side.agg(F.count_if(F.col("__src")).alias("source_rows"),
                    F.count_if(~F.col("__src")).alias("target_rows"))
    status = (F.when(F.col("target_rows") == F.col("source_rows"), STATUS_UP_TO_DATE)
              .when(F.col("target_rows") < F.col("source_rows"), STATUS_LOAD)
              .otherwise(STATUS_TARGET_AHEAD))
    return both.select("source_rows", "target_rows", status.alias("status"),
                       F.greatest(F.col("source_rows") - F.col("target_rows"), F.lit(0)).alias("pending_rows"))


def next_id_range(source: DataFrame, key: str, mark, batch: int) -> DataFrame:
    """Rows of the ``batch`` ids that start at the first existing id above ``mark`` (at the first id when it is None).

    Id-range semantics: gaps inside the range give a short batch, as a
    ``where id between a and b`` extraction does. A gap right after the mark
    is skipped, however long it is, so repeated runs always come to the end;
    the start is one pushed-down ``min``.
    """
    above = source if mark is None else source.where(F.col(key) > F.lit(mark))
    lo = above.agg(F.min(key).alias("m")).first()["m"]
    if lo is None:
        return source.limit(0)
    return source.where(F.col(key).between(F.lit(lo), F.lit(lo + batch - 1)))


def id_range_batches(source: DataFrame, key: str, mark, batch: int, batch_col: str = "batch_id") -> DataFrame:
    """Every pending row (``key > mark``) tagged with its id-range batch number.

    Batch ``b`` holds ids ``mark + 1 + b*batch .. mark + (b+1)*batch``,
    produced in one pass; a range inside a gap has no rows.
    """
    if mark is None:
        lo = source.agg(F.min(key).alias("m")).first()["m"]
        if lo is None:
            return source.limit(0).withColumn(batch_col, F.lit(None).cast("long"))
        mark = lo - 1
    pending = source.where(F.col(key) > F.lit(mark))
    return pending.withColumn(batch_col, F.floor((F.col(key) - F.lit(mark) - 1) / F.lit(batch)).cast("long"))


def batch_after(source: DataFrame, key: str, last_key=None, n: int | None = None) -> DataFrame:
    """Documents after ``last_key`` in key order, ``n`` of them.

    (no n, no key): everything; (n, no key): the first n; (n, key): the next
    n after the key; (no n, key): everything after the key. The n-th key is
    found by counting (``operators.selection``), so the result is a plain
    filter whatever n is. Rows that share the n-th key all belong to the batch.
    """
    column = F.col(f"`{key}`")
    rows = source if last_key is None else source.where(column > F.lit(last_key).cast(source.schema[key].dataType))
    return rows if n is None else first_rows(rows, key, n)


def latest(source: DataFrame, key: str) -> DataFrame:
    """The row with the largest key, as one row (``max_by`` over a struct, no sort)."""
    cols = source.columns
    best = source.agg(F.max_by(F.struct(*cols), F.col(key)).alias("__r"))
    return best.select("__r.*")


def resume_key(staged: DataFrame, key: str, date_col: str, run_date: str) -> DataFrame:
    """``max(key)`` of the previous day's partition: where the next batch starts."""
    prev = F.date_sub(F.to_date(F.lit(run_date)), 1)
    return staged.where(F.to_date(F.col(date_col)) == prev).agg(F.max(key).alias("resume_key"))
