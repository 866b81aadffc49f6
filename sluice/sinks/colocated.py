"""A fact stored beside the dimension it always meets, so that the two join without a shuffle.

Both are stored bucketed on the join key, in as many buckets; the planner then
reads bucket i of both in one task. What would make one bucket larger than the
others is stored apart: rows of the fact whose key holds more than a quarter
of a bucket's share (fewer than ``4 * buckets`` keys, whatever the rows), and
rows without a key, which match nothing. Those stay spread over files as they
come and meet the few dimension rows of their keys by a broadcast whose size
is measured.

Layout below ``path``: ``v=<n>/{fact,dim,hot,hot_keys}`` and ``_commits``. A
store writes a new folder and ends with one renamed file, so readers see the
old pair or the new one; the folders of older versions stay readable. The
bucketing is told to the session's catalog when the pair is opened, so another
session, or one without a lasting catalog, opens it by its path alone.

Defined cases: repeated keys of the dimension give a row each; an empty fact or
dimension is stored as such; key types must be equal, other column names
different, and columns of the fact come first.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, checked_broadcast
from sluice.session import materialize
from sluice.sinks.versioned import commit_numbers, publish, read_commit
from sluice.sinks.writers import write_parquet

HOT_SHARE = 4  # a key is hot above 1 / HOT_SHARE of an even bucket


@dataclass
class Colocated:
    """An opened pair: the bucketed rows of both sides, and the fact's rows of hot and null keys with the list of hot keys."""
    key: str
    fact: DataFrame
    dim: DataFrame
    hot: DataFrame
    hot_keys: DataFrame


def _check(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> None:
    if fact.schema[fact_key].dataType != dim.schema[dim_key].dataType:
        raise ValueError(f"keys of different types are not stored in the same buckets: {fact_key}, {dim_key}")
    own = {c.lower() for c in fact.columns}
    if both := [c for c in dim.columns if c != dim_key and c.lower() in own]:
        raise ValueError(f"columns of both sides: {', '.join(both)}")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _table(spark: SparkSession, folder: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """The bucketed files in ``folder`` as a table of this session's catalog."""
    name = f"sluice_colocated_{hashlib.sha256(folder.encode()).hexdigest()[:24]}"
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    place = folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({_quoted(key)}) "
              f"SORTED BY ({_quoted(key)}) INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(name)


def _write_bucketed(df: DataFrame, folder: str, key: str, buckets: int) -> None:
    """One sorted file a bucket: rows are shuffled by the hash that also names the bucket."""
    spark = df.sparkSession
    name = f"sluice_storing_{uuid.uuid4().hex}"
    (df.repartition(buckets, F.col(_quoted(key))).write.format("parquet").option("path", folder)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")  # the files stay


def store_colocated(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, path: str, buckets: int) -> Colocated:
    """Store ``fact`` and ``dim`` for joins on ``fact_key = dim_key`` as the next version at ``path``, and open it.

    ``buckets`` is best chosen so that a bucket of both sides is sorted in one task's memory.
    """
    _check(fact, dim, fact_key, dim_key)
    spark, path = fact.sparkSession, path.rstrip("/")
    k = F.col(_quoted(fact_key))
    counts = materialize(fact.where(k.isNotNull()).groupBy(k.alias("key")).agg(F.count(F.lit(1)).alias("n")), "colocated-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    folder = f"{path}/v={uuid.uuid4().hex[:12]}"
    write_parquet(counts.where((F.col("n") > 1) & (F.col("n") * (HOT_SHARE * buckets) > total)).select("key"),
                  f"{folder}/hot_keys")
    hot_keys = spark.read.schema(T.StructType([T.StructField("key", fact.schema[fact_key].dataType)])).parquet(f"{folder}/hot_keys")
    few = F.broadcast(hot_keys)  # fewer than HOT_SHARE * buckets
    write_parquet(fact.join(few, k.eqNullSafe(few["key"]), "left_semi").unionByName(fact.where(k.isNull())), f"{folder}/hot")
    _write_bucketed(fact.where(k.isNotNull()).join(few, k == few["key"], "left_anti"), f"{folder}/fact", fact_key, buckets)
    named = dim.where(F.col(_quoted(dim_key)).isNotNull()).withColumnRenamed(dim_key, fact_key)
    _write_bucketed(named, f"{folder}/dim", fact_key, buckets)
    content = {"folder": folder, "key": fact_key, "buckets": buckets, "fact": fact.schema.json(), "dim": named.schema.json()}
    # Another writer may take the number first; the folder is this store's own either way.
    while not publish(spark, f"{path}/_commits", max(commit_numbers(spark, f"{path}/_commits"), default=0) + 1, content):
        pass
    return _open(spark, content)


def _open(spark: SparkSession, said: dict) -> Colocated:
    folder, key, buckets = said["folder"], said["key"], said["buckets"]
    fact, dim = (T.StructType.fromJson(json.loads(said[side])) for side in ("fact", "dim"))
    keys = T.StructType([T.StructField("key", fact[key].dataType)])
    return Colocated(key, _table(spark, f"{folder}/fact", fact, key, buckets), _table(spark, f"{folder}/dim", dim, key, buckets),
                     spark.read.schema(fact).parquet(f"{folder}/hot"), spark.read.schema(keys).parquet(f"{folder}/hot_keys"))


def open_colocated(spark: SparkSession, path: str, version: int | None = None) -> Colocated | None:
    """The newest pair stored at ``path``, or that of a version; None when nothing was ever stored."""
    commits = f"{path.rstrip('/')}/_commits"
    numbers = commit_numbers(spark, commits)
    return _open(spark, read_commit(spark, commits, version or numbers[-1])) if numbers else None


def colocated_join(stored: Colocated, how: str = "left", max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """The fact's rows with the dimension's columns (``left`` keeps rows without a match, ``inner`` drops them).

    The bucketed rows are not shuffled. A dimension that repeats a hot key so often that its rows exceed the bound is
    joined by a shuffle whose skewed partitions AQE splits.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"a colocated join is left or inner, not {how}")
    few = F.broadcast(stored.hot_keys.withColumnRenamed("key", stored.key))
    # Written, so that its size is measured and sent from the same few rows.
    met = materialize(stored.dim.join(few, stored.key, "left_semi"), "colocated-hot-dim")
    cold = stored.fact.join(stored.dim.hint("merge"), stored.key, how)
    hot = stored.hot.join(checked_broadcast(met, max_broadcast_bytes), stored.key, how)
    columns = stored.fact.columns
    columns = [_quoted(c) for c in columns + [c for c in stored.dim.columns if c not in columns]]
    return cold.select(*columns).unionByName(hot.select(*columns))
