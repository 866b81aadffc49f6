"""The bucketed ledger: exact answers, untouched buckets unread, repeated batches."""

import os

from pyspark.sql import functions as F

from sluice.operators.ledger import bucket_count, store_urls, stored, unseen
from sluice.streaming.documents import read_duplicates, read_rejects, read_stored_sheets, store_new_sheets


def urls(spark, names):
    return spark.createDataFrame([(n,) for n in names], "url string")


def test_answers_are_exact(spark, tmp_dir):
    p = tmp_dir + "/l"
    assert stored(urls(spark, ["a"]), p).count() == 0 and unseen(urls(spark, ["a", None]), p).count() == 2
    store_urls(urls(spark, [f"u{i}" for i in range(0, 900)] + ["u1", None]), p, 0, buckets=8)
    store_urls(urls(spark, [f"u{i}" for i in range(850, 1200)]), p, 3, buckets=99)
    assert bucket_count(spark, p) == 8  # the first batch fixed it
    asked = [f"u{i}" for i in range(700, 2000)] + ["u900", "é", "", None]
    got = {r.url for r in stored(urls(spark, asked), p).collect()}
    assert got == {f"u{i}" for i in range(700, 1200)}
    assert {r.url for r in stored(urls(spark, asked), p, before_batch=3).collect()} == {f"u{i}" for i in range(700, 900)}
    rest = sorted("-" if r.url is None else r.url for r in unseen(urls(spark, asked), p).collect())
    assert rest == sorted([f"u{i}" for i in range(1200, 2000)] + ["é", "", "-"])


def test_a_repeated_batch_is_stored_once(spark, tmp_dir):
    p = tmp_dir + "/l"
    for _ in range(2):
        store_urls(urls(spark, [f"u{i}" for i in range(50)]), p, 4, buckets=4)
    assert spark.read.parquet(p + "/urls").count() == 50


def test_other_buckets_are_not_read(spark, tmp_dir):
    p = tmp_dir + "/l"
    store_urls(urls(spark, [f"u{i}" for i in range(4000)]), p, 0, buckets=64)
    one = urls(spark, ["u7"])
    bucket = one.select(F.pmod(F.xxhash64("url", F.lit("bucket")), F.lit(64))).first()[0]
    # Everything outside the asked URL's bucket is made unreadable: the answer stays.
    for kind in ("urls", "filters"):
        for folder in os.listdir(f"{p}/{kind}"):
            if folder.startswith("bucket=") and folder != f"bucket={bucket}":
                for batch in os.listdir(f"{p}/{kind}/{folder}"):
                    for name in os.listdir(f"{p}/{kind}/{folder}/{batch}"):
                        if name.endswith(".parquet"):
                            os.remove(f"{p}/{kind}/{folder}/{batch}/.{name}.crc")
                            open(f"{p}/{kind}/{folder}/{batch}/{name}", "w").close()
    assert [r.url for r in stored(one, p).collect()] == ["u7"]


def test_filters_let_few_strangers_pass(spark, tmp_dir):
    from sluice.operators import ledger

    p = tmp_dir + "/l"
    store_urls(urls(spark, [f"u{i}" for i in range(5000)]), p, 0, buckets=2)
    filters = spark.read.parquet(p + "/filters").collect()
    assert all(len(r.words) < 5000 * ledger.BITS / 64 for r in filters)
    bits = {r.bucket: r.words for r in filters}
    asked = urls(spark, [f"x{i}" for i in range(3000)]).withColumn("bucket", F.pmod(F.xxhash64("url", F.lit("bucket")), F.lit(2)))
    size = F.when(F.col("bucket") == 0, F.lit(len(bits[0]))).otherwise(F.lit(len(bits[1]))).cast("long")
    passed = sum(all(bits[r.bucket][a // 64] >> (a % 64) & 1 for a in r.at)
                 for r in asked.withColumn("at", ledger._bits(F.col("url"), size)).collect())
    assert passed < 0.03 * 3000


def test_stream_batches_store_each_url_once_and_reject_the_losers(spark, tmp_dir):
    sheet = '{"url": ["%s"], "General": {"Brand": ["%s"]}}'
    out = tmp_dir + "/out"
    first = [sheet % ("a", "x"), sheet % ("a", "x"), sheet % ("a", "w"), sheet % ("b", "y"), '{"General": {"Brand": ["z"]}}', "no json", None]
    second = [sheet % ("a", "v"), sheet % ("c", "y"), "[1]"]
    lines = lambda rows: spark.createDataFrame([(r,) for r in rows], "value string")
    for batch_id, rows in ((0, first), (1, second), (1, second), (0, first)):  # both replayed
        store_new_sheets(lines(rows), batch_id, out)
    got = sorted((r.url or "-", r.specs["General"]["Brand"][0], r.batch_id) for r in read_stored_sheets(spark, out).collect())
    assert got == [("-", "z", 0), ("a", "w", 0), ("b", "y", 0), ("c", "y", 1)]
    assert sorted((r.batch_id, r.value or "-") for r in read_rejects(spark, out).collect()) == [(0, "-"), (0, "no json"), (1, "[1]")]
    assert [(r.batch_id, r.value) for r in read_duplicates(spark, out).collect()] == [(0, sheet % ("a", "x"))] * 2
