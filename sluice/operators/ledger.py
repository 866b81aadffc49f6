"""A ledger of stored URLs that is asked without being read.

URLs are stored by the hash bucket they fall into and by the batch that stored
them, beside one Bloom filter a bucket and batch. A question about some URLs
reads the filters of their own buckets, and of the URLs only those buckets and
batches in which a filter says "perhaps"; these are compared exactly, so the
answer has no false positives. What lies in other buckets costs nothing,
however large the ledger has grown.

Layout below the ledger's path (hidden from readers of the folder around it
when the path starts with ``_``)::

    urls/bucket=<b>/batch=<n>/      url
    filters/bucket=<b>/batch=<n>/   words (64 bits each, BITS a URL)
    _settings/                      the number of buckets, fixed by the first batch

A batch that is written again replaces its own folders, so a retried
micro-batch stores nothing twice. Null URLs are not stored and are in no
ledger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.joins import checked_broadcast
from sluice.session import materialize
from sluice.sinks.versioned import commit_numbers, publish, read_commit

BUCKETS = 256
BITS = 10  # a URL: about 1 % of the URLs a filter has not seen pass it
HASHES = 7


def bucket_count(spark: SparkSession, path: str) -> int | None:
    """The ledger's number of buckets; None when nothing was ever stored."""
    numbers = commit_numbers(spark, f"{path}/_settings")
    return read_commit(spark, f"{path}/_settings", numbers[0])["buckets"] if numbers else None


def _bucket(url: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(url, F.lit("bucket")), F.lit(buckets)).cast("int")


def _bits(url: Column, words: Column) -> Column:
    """Places of a URL's bits in a filter of so many words: ``HASHES`` steps of one hash from another."""
    size = words * 64
    first, step = F.pmod(F.xxhash64(url), size), F.pmod(F.xxhash64(url, F.lit("step")), size)
    return F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)), lambda i: F.pmod(first + i * step, size))


def _filters(urls: DataFrame) -> DataFrame:
    """(bucket, words) from distinct (bucket, url)."""
    sizes = urls.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) * BITS / 64).cast("long").alias("size"))
    # As many rows as buckets, measured.
    sized = urls.join(checked_broadcast(sizes), "bucket")
    ones = sized.select("bucket", F.explode(_bits(F.col("url"), F.col("size"))).alias("at")).select(
        "bucket", F.floor(F.col("at") / 64).alias("word"), F.expr("shiftleft(1L, cast(at % 64 as int))").alias("bits"))
    # Words without a bit are there too, so that a word's place is its number.
    none = sizes.select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1)).alias("word"),
                        F.lit(0).cast("long").alias("bits"))
    words = ones.unionByName(none).groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
    return words.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).getField("bits").alias("words"))


def store_urls(urls: DataFrame, path: str, batch: int, buckets: int = BUCKETS) -> None:
    """Store the column ``url`` of ``urls`` as batch ``batch`` of the ledger at ``path``."""
    spark = urls.sparkSession
    if bucket_count(spark, path) is None:
        publish(spark, f"{path}/_settings", 1, {"buckets": buckets})
    buckets = bucket_count(spark, path)
    own = materialize(urls.select(_bucket(F.col("url"), buckets).alias("bucket"), "url").where("url is not null").distinct(),
                      "ledger-batch")
    for name, rows in (("urls", own), ("filters", _filters(own))):
        # One task a bucket; a bucket that holds a large share of a batch is split.
        (rows.withColumn("batch", F.lit(batch).cast("long")).hint("rebalance", "bucket").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(f"{path}/{name}"))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(f"{schema}, bucket int, batch long").parquet(path)
    except Exception as e:  # noqa: BLE001 - nothing stored yet
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return None
        raise


def stored(urls: DataFrame, path: str, before_batch: int | None = None) -> DataFrame:
    """(url): those of the column ``url`` of ``urls`` that are in the ledger, or that batches before ``before_batch``
    stored, each once."""
    spark = urls.sparkSession
    asked = urls.select("url").where("url is not null").distinct()
    buckets = bucket_count(spark, path)
    filters = None if buckets is None else _read(spark, f"{path}/filters", "words array<bigint>")
    if filters is None:
        return asked.limit(0)
    asked = materialize(asked.withColumn("bucket", _bucket(F.col("url"), buckets)), "ledger-asked")
    # At most as many numbers as there are buckets; they prune the folders that are listed and read.
    touched = [r[0] for r in asked.select("bucket").distinct().collect()]
    known = filters.where(F.col("bucket").isin(touched))
    if before_batch is not None:
        known = known.where(F.col("batch") < F.lit(before_batch))
    places = _bits(F.col("url"), F.size("words").cast("long"))
    passes = F.forall(places, lambda at: F.get("words", F.floor(at / 64).cast("int")).bitwiseAND(
        F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))) != 0)
    perhaps = materialize(asked.join(known, "bucket").where(passes).select("url", "bucket", "batch"), "ledger-perhaps")
    folders = perhaps.select("bucket", "batch").distinct()
    some = folders.agg(F.collect_set("bucket").alias("b"), F.collect_set("batch").alias("n")).first()
    if not some["b"]:
        return asked.select("url").limit(0)
    held = (_read(spark, f"{path}/urls", "url string")
            .where(F.col("bucket").isin(some["b"]) & F.col("batch").isin(some["n"])))
    return perhaps.join(held, ["bucket", "batch", "url"], "left_semi").select("url").distinct()


def unseen(rows: DataFrame, path: str, url_col: str = "url", before_batch: int | None = None) -> DataFrame:
    """The rows of ``rows`` whose URL the ledger does not hold; rows without a URL stay."""
    seen = stored(rows.select(F.col(f"`{url_col}`").alias("url")), path, before_batch)
    keyed = rows.join(seen.withColumnRenamed("url", "__seen"), F.col(f"`{url_col}`") == F.col("__seen"), "left_anti")
    return keyed
