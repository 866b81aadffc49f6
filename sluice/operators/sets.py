"""Set operators over DataFrames of keys or names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _sides(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of both inputs with the sides they occur on (1: a, 2: b, 3: both).

    One tagged union and one aggregate: each input is read once and only
    partial aggregates of distinct rows are shuffled. NULLs equal each other.
    """
    tagged = a.withColumn("__side", F.lit(1)).unionAll(b.toDF(*a.columns).withColumn("__side", F.lit(2)))
    return tagged.groupBy(*[F.col(f"`{c}`") for c in a.columns]).agg(F.bit_or("__side").alias("__side"))


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows in exactly one of ``a`` and ``b`` (``a EXCEPT b UNION ALL b EXCEPT a``)."""
    return _sides(a, b).where("__side <> 3").drop("__side")


def missing_from(needed: DataFrame, existing: DataFrame) -> DataFrame:
    """Distinct rows of ``needed`` that ``existing`` lacks (``needed EXCEPT existing``)."""
    return _sides(needed, existing).where("__side = 1").drop("__side")


def append_rows(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Union all by column name: a new batch appended to stored rows."""
    return stored.unionByName(batch)
