"""Sinks: Parquet, table loads with write dispositions, typed (DDL-checked)
tables, date-staged layouts, document output and star-schema loading.

Tables are path-based Parquet datasets, so every write is a distributed
Spark job committed by the file output committer: a failed job leaves no
partial files visible to readers. A load that replaces a table writes and
checks a new folder beside it and switches the two at the end, so a failed
load leaves the old table as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.incremental import STATUS_LOAD, next_id_range, read_target, reconcile, recover, stored_mark
from sluice.operators.reshape import conform

WRITE_APPEND = "WRITE_APPEND"
WRITE_TRUNCATE = "WRITE_TRUNCATE"
WRITE_EMPTY = "WRITE_EMPTY"


def write_parquet(df: DataFrame, path: str, compression: str | None = None, mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> None:
    """Parquet output with an optional codec (``gzip``, ``zstd``, ...) and partition columns."""
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace_table(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Replace the table at ``path`` by ``df``, which may read that table.

    The new table is written in full to a folder of its own first; a failing
    write ends here and the old table stays. The switch is two renames on the
    table's file system; should the driver die between them, the old table lies
    beside ``path`` with the suffix ``__old``, and the next load or
    ``read_target`` puts it back. ``sinks.versioned`` has tables that are not
    missing for a moment either.
    """
    spark = df.sparkSession
    base = path.rstrip("/")
    recover(spark, base)
    new, old = f"{base}__new-{uuid.uuid4().hex[:12]}", f"{base}__old"
    write_parquet(df, new, compression=compression, mode="errorifexists")
    jvm = spark.sparkContext._jvm
    at = {p: jvm.org.apache.hadoop.fs.Path(p) for p in (base, new, old)}
    fs = at[base].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(at[base]):
        fs.delete(at[old], True)
        if not fs.rename(at[base], at[old]):
            raise OSError(f"cannot set {base} aside")
    if not fs.rename(at[new], at[base]):
        fs.rename(at[old], at[base])
        raise OSError(f"cannot switch {base} to {new}")
    fs.delete(at[old], True)
    spark.catalog.refreshByPath(base)


def is_empty(df: DataFrame | None) -> bool:
    """A missing table or one without rows (reads at most one row)."""
    return df is None or df.limit(1).count() == 0


def load(df: DataFrame, path: str, disposition: str = WRITE_APPEND, compression: str | None = None) -> str:
    """Load ``df`` into the table at ``path``; returns ``'loaded'`` or ``'skipped'``.

    ``WRITE_APPEND`` adds rows; ``WRITE_TRUNCATE`` replaces the whole table;
    ``WRITE_EMPTY`` loads only when the table is missing or holds no rows
    (an emptiness check, not the existence check of ``mode('ignore')``).
    """
    spark = df.sparkSession
    if disposition == WRITE_EMPTY:
        if not is_empty(read_target(spark, path)):
            return "skipped"
        mode = "append"
    elif disposition == WRITE_TRUNCATE:
        replace_table(df, path, compression)
        return "loaded"
    elif disposition == WRITE_APPEND:
        mode = "append"
    else:
        raise ValueError(f"unknown disposition {disposition}")
    recover(spark, path)
    write_parquet(df, path, compression=compression, mode=mode)
    return "loaded"


def load_with_metrics(df: DataFrame, path: str, disposition: str = WRITE_APPEND,
                      metrics: dict | None = None) -> dict:
    """Load and return metrics gathered during the same write (no second pass).

    By default ``rows_loaded``; ``metrics`` adds named aggregate columns.
    """
    obs = Observation("load")
    exprs = [F.count(F.lit(1)).alias("rows_loaded")] + [c.alias(n) for n, c in (metrics or {}).items()]
    observed = df.observe(obs, *exprs)
    status = load(observed, path, disposition)
    if status != "loaded":
        return {"status": status, "rows_loaded": 0}
    return {"status": status, **obs.get}


def enforce_schema(df: DataFrame, schema: T.StructType, not_null: Sequence[str] = ()) -> DataFrame:
    """Cast to the declared types (ANSI: a bad value fails the job) and fail on
    NULL in a NOT NULL column, checked row by row inside the write itself."""
    typed = conform(df, schema)
    checked = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in not_null or not f.nullable:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"NULL in NOT NULL column {f.name}"))).otherwise(c)
        checked.append(c.alias(f.name))
    return typed.select(*checked)


def write_typed_table(df: DataFrame, path: str, schema: T.StructType, not_null: Sequence[str] = (),
                      compression: str | None = None) -> None:
    """Drop and re-create a typed table: the declared schema, enforced on write.

    A row that breaks it fails the load and the old table stays.
    """
    replace_table(enforce_schema(df, schema, not_null), path, compression)


def staged_write(df: DataFrame, root: str, load_date, date_col: str = "load_date") -> None:
    """Write under ``root/load_date=YYYY-MM-DD/``; re-running a day replaces only that day.

    ``load_date`` is a run date (text) or a Column deriving the date per row.
    """
    col = F.lit(load_date).cast("date") if isinstance(load_date, str) else load_date.cast("date")
    # Rebalance on the partition column: each date's rows are written by a few
    # tasks (few files per date), and AQE splits a date that holds a large
    # share of the rows instead of leaving it to one task.
    staged = df.withColumn(date_col, col).hint("rebalance", date_col)
    (staged.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(root))


def write_documents(df: DataFrame, path: str, mode: str = "append") -> None:
    """Cleaned documents as JSON lines (nested maps and lists kept)."""
    df.write.mode(mode).json(path)


def table_path(root: str, name: str) -> str:
    """Location of table ``name`` below a warehouse root."""
    return f"{root.rstrip('/')}/{name}"


def load_star(spark: SparkSession, root: str, fact_name: str, fact: DataFrame,
              dims: dict[str, DataFrame]) -> dict[str, str]:
    """Append the fact; load each dimension only when it is missing or empty.

    Every dimension is checked by name (needed EXCEPT existing), so one
    missing dimension is repaired even when the others exist.
    """
    actions = {fact_name: load(fact, table_path(root, fact_name), WRITE_APPEND)}
    for name in (n for n in dims if n != fact_name):
        actions[name] = load(dims[name], table_path(root, name), WRITE_EMPTY)
    return actions


def incremental_extract(source: DataFrame, target_path: str, key: str, batch: int,
                        disposition: str = WRITE_APPEND) -> dict:
    """One run of an incremental load into the table at ``target_path``.

    Reconcile counts; when the target is behind (or missing), read ``batch``
    ids from the first one above the target's high-water mark and append
    them. Returns the reconcile status plus what was loaded.
    """
    spark = source.sparkSession
    target = read_target(spark, target_path)
    status = reconcile(source, target).first()
    if status["status"] != STATUS_LOAD:
        return {"status": status["status"], "rows_loaded": 0, "mark": None if target is None else stored_mark(spark, target_path, key)}
    mark = None if target is None else stored_mark(spark, target_path, key)
    m = load_with_metrics(next_id_range(source, key, mark, batch), target_path, disposition)
    return {"status": status["status"], "rows_loaded": m["rows_loaded"], "mark": mark}


def write_bucketed_table(df: DataFrame, name: str, path: str, key: str | Sequence[str], buckets: int,
                         mode: str = "overwrite") -> DataFrame:
    """Store ``df`` as a catalog table bucketed and sorted on ``key``.

    Two tables bucketed on their join key with the same bucket count join
    without a shuffle (the planner reads bucket ``i`` of both sides in one
    task); at scale this is how a large fact is co-located with a dimension
    too large to broadcast. Data lives at ``path``; the catalog keeps the
    bucket spec.
    """
    keys = [key] if isinstance(key, str) else list(key)
    (df.write.mode(mode).format("parquet").option("path", path)
       .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    return df.sparkSession.table(name)
