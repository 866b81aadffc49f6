"""Projection and reshaping operators (pure ``DataFrame -> DataFrame``)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import materialize


def conform(df: DataFrame, columns: T.StructType | Sequence[tuple[str, str | T.DataType]],
            lenient: bool = False) -> DataFrame:
    """Select ``columns`` in order; absent ones become typed NULLs (pandas ``reindex``).

    Present columns are cast to the declared type. A value that does not fit
    fails the job (ANSI); with ``lenient`` it becomes NULL, and
    ``cast_rejects`` counts how many did.
    """
    fields = [(f.name, f.dataType) for f in columns.fields] if isinstance(columns, T.StructType) else list(columns)
    have = set(df.columns)
    out = []
    for name, dtype in fields:
        if name in have:
            c = F.col(f"`{name}`")
            out.append((c.try_cast(dtype) if lenient else c.cast(dtype)).alias(name))
        else:
            out.append(F.lit(None).cast(dtype).alias(name))
    return df.select(*out)


def cast_rejects(df: DataFrame, columns: T.StructType | Sequence[tuple[str, str | T.DataType]]) -> DataFrame:
    """One row: per present column, how many values a lenient ``conform`` turns into NULL."""
    fields = [(f.name, f.dataType) for f in columns.fields] if isinstance(columns, T.StructType) else list(columns)
    return df.agg(*[F.count_if(F.col(f"`{n}`").isNotNull() & F.col(f"`{n}`").try_cast(t).isNull()).alias(n)
                    for n, t in fields if n in df.columns])


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Assign new names by position (``df.columns = [...]``)."""
    return df.toDF(*names)


def dots_to_underscores(df: DataFrame) -> DataFrame:
    """``wind10m.speed`` -> ``wind10m_speed`` for every column name."""
    return df.toDF(*[c.replace(".", "_") for c in df.columns])


def normalise_names(df: DataFrame) -> DataFrame:
    """Lower-case column names and turn spaces into underscores."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def flatten_structs(df: DataFrame, sep: str = ".") -> DataFrame:
    """Promote nested struct fields to top-level ``parent<sep>child`` columns."""

    def walk(dtype: T.DataType, path: list[str]) -> list[Column]:
        if isinstance(dtype, T.StructType):
            cols = []
            for f in dtype.fields:
                cols.extend(walk(f.dataType, path + [f.name]))
            return cols
        ref = F.col(".".join(f"`{p}`" for p in path))
        return [ref.alias(sep.join(path))]

    cols: list[Column] = []
    for f in df.schema.fields:
        cols.extend(walk(f.dataType, [f.name]))
    return df.select(*cols)


def explode_records(df: DataFrame, array_col: str, keep: Sequence[str | Column] = (),
                    outer: bool = False) -> DataFrame:
    """One row per element of an array of structs, carrying parent columns.

    pandas ``json_normalize(record_path=..., meta=...)`` emits nothing for an
    empty list, hence plain ``explode`` unless ``outer``.
    """
    gen = F.explode_outer if outer else F.explode
    keep_cols = [F.col(k) if isinstance(k, str) else k for k in keep]
    exploded = df.select(*keep_cols, gen(array_col).alias("__rec"))
    kept = [c for c in exploded.columns if c != "__rec"]
    return exploded.select(*[F.col(f"`{c}`") for c in kept], "__rec.*")


def array_to_columns(df: DataFrame, array_col: str, names: Sequence[str], drop: bool = True) -> DataFrame:
    """``[lon, lat]`` style arrays to one column per position (NULL when short)."""
    extra = [F.get(F.col(array_col), i).alias(n) for i, n in enumerate(names)]
    base = [F.col(f"`{c}`") for c in df.columns if not (drop and c == array_col)]
    return df.select(*base, *extra)


def string_columns(df: DataFrame) -> list[str]:
    """Names of the top-level string columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def remove_text(df: DataFrame, text: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Delete a literal substring (a unit such as ``mb``) from string columns."""
    targets = set(columns) if columns is not None else set(string_columns(df))
    return df.select(*[
        (F.replace(F.col(f"`{c}`"), F.lit(text), F.lit("")).alias(c) if c in targets else F.col(f"`{c}`"))
        for c in df.columns])


def empty_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """``''`` to NULL in string columns (all of them by default)."""
    targets = set(columns) if columns is not None else set(string_columns(df))
    return df.select(*[
        (F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) if c in targets else F.col(f"`{c}`"))
        for c in df.columns])


def fill_constants(df: DataFrame, values: dict) -> DataFrame:
    """Replace NULLs column by column with constants (``fillna``)."""
    return df.select(*[
        (F.coalesce(F.col(f"`{c}`"), F.lit(values[c])).alias(c) if c in values else F.col(f"`{c}`"))
        for c in df.columns])


def _range_partitions(df: DataFrame) -> int:
    """Range partitions for a full re-sort: the session's shuffle partitions, which
    the cluster profile sizes for the data (AQE does not resize an explicit
    range partitioning). Nothing is run to find out."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def dense_index(df: DataFrame, order_by: Sequence[str], name: str = "index", start: int = 0,
                num_partitions: int | None = None) -> DataFrame:
    """Consecutive ``start, start+1, ...`` over a total order, computed in parallel.

    Rows are range-partitioned and sorted on ``order_by`` (one shuffle),
    tagged with their partition and in-partition position, and written once
    to the shared checkpoint folder (``materialize``) so both uses below see
    identical tags even if executors are lost. Per-partition counts (one row per partition,
    bounded by the partition count) are turned into offsets and broadcast
    back. ``order_by`` should be unique for a deterministic numbering.
    """
    spark = df.sparkSession
    n = num_partitions or _range_partitions(df)
    keys = [F.col(f"`{c}`") for c in order_by]
    tagged = materialize(df.repartitionByRange(n, *keys)
                         .sortWithinPartitions(*keys)
                         .withColumn("__pid", F.spark_partition_id())
                         .withColumn("__mid", F.monotonically_increasing_id()), "dense_index")
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__first"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    idx = (F.col("__off") + F.col("__mid") - F.col("__first") + F.lit(start)).cast("long")
    return (tagged.join(F.broadcast(offsets), "__pid")
            .select(*[F.col(f"`{c}`") for c in df.columns], idx.alias(name)))
