"""Relational source and sink through Spark's JDBC data source.

Reads split an id range over ``num_partitions`` parallel queries and the
range filter is pushed into each query's WHERE clause; writes insert in
batches per task. The driver jar of the database must be on the classpath;
nothing here is database specific.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_id_range(spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int,
                  num_partitions: int = 8, properties: dict | None = None) -> DataFrame:
    """Rows with ``lower <= key <= upper`` read by ``num_partitions`` parallel range queries."""
    df = spark.read.jdbc(url, table, column=key, lowerBound=lower, upperBound=upper + 1,
                         numPartitions=num_partitions, properties=properties or {})
    return df.where(F.col(key).between(lower, upper))


def read_table(spark: SparkSession, url: str, table: str, properties: dict | None = None) -> DataFrame:
    """A whole table in one query (small tables; use ``read_id_range`` for large ones)."""
    return spark.read.jdbc(url, table, properties=properties or {})


def write_table(df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int = 10000,
                properties: dict | None = None) -> None:
    """Batched inserts (``batchsize`` rows per round trip) from every task."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batchsize))
    df.write.jdbc(url, table, mode=mode, properties=props)
