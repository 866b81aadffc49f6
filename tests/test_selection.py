"""The n-th key by counting, batches as filters, marks from footers."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sluice.operators.incremental import batch_after, footer_mark, mark_value, stored_mark
from sluice.operators.selection import first_rows, nth_key
from sluice.sources.files import read_csv_batches


def frame(spark, values, kind):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"k {kind}, i long").repartition(3)


def cases():
    dice = random.Random(1)
    yield "long", [dice.randrange(-2 ** 62, 2 ** 62) for _ in range(3000)]
    yield "long", [dice.choice([5, 5, 5, 7, 2 ** 40 + dice.randrange(50)]) for _ in range(2000)]
    yield "int", list(range(700))
    yield "string", [dice.choice(["a", "ab", "é", "👍", "", "Z"]) + str(dice.randrange(400)) for _ in range(1500)]
    yield "date", [dt.date(2020, 1, 1) + dt.timedelta(days=dice.randrange(300)) for _ in range(500)]
    yield "decimal(20,3)", [__import__("decimal").Decimal(dice.randrange(10 ** 6)) / 1000 for _ in range(400)]
    yield "double", [dice.choice([0.5, -1.25, float("inf"), float("-inf"), 1e-300 * dice.randrange(90)]) for _ in range(300)]
    yield "long", [3] * 50


@pytest.mark.parametrize("kind, values", list(cases()))
def test_nth_key_is_the_nth_of_the_sorted_keys(spark, kind, values):
    rows = frame(spark, values, kind).cache()
    ordered = sorted(values, key=lambda v: v.encode() if isinstance(v, str) else v)
    for n in {1, 2, len(values) // 3, len(values) // 2, len(values) - 1, len(values)}:
        assert nth_key(rows, "k", n, pivots=16) == ordered[n - 1]
    assert nth_key(rows, "k", len(values) + 1) is None
    rows.unpersist()


def test_null_keys_come_first_and_ties_together(spark):
    rows = frame(spark, [None, 4, 4, 1, None, 9, 4], "long")
    pick = lambda n, last=None: sorted((r.k for r in batch_after(rows, "k", last, n).collect()), key=str)
    assert pick(1) == [None, None] and pick(3) == [1, None, None] and pick(4) == [1, 4, 4, 4, None, None]
    assert pick(2, 1) == [4, 4, 4] and pick(9, 4) == [9] and pick(0) == [] and pick(5, 9) == []
    assert len(pick(None)) == 7 and first_rows(rows.limit(0), "k", 3).count() == 0
    with pytest.raises(ValueError):
        nth_key(rows, "k", 0)


def test_batches_of_any_size_give_every_row_once(spark):
    keys = random.Random(2).sample(range(10 ** 9), 500)
    rows = frame(spark, keys, "long")
    last, seen = None, []
    while True:
        got = [r.k for r in batch_after(rows, "k", last, 180).collect()]
        if not got:
            break
        seen, last = seen + sorted(got), max(got)
    assert seen == sorted(keys)
    for skip in range(4):
        want = sorted(keys)[skip * 180:(skip + 1) * 180]
        assert sorted(r.k for r in read_csv_batches(rows, "k", 180, skip).collect()) == want
    assert sorted(r.k for r in read_csv_batches(rows, "k", 10, last_key=sorted(keys)[99]).collect()) == sorted(keys)[100:110]


def test_a_batch_is_a_pushed_down_filter(spark, tmp_dir):
    frame(spark, range(1000), "long").write.parquet(tmp_dir + "/t")
    batch = batch_after(spark.read.parquet(tmp_dir + "/t"), "k", 100, 450)
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Exchange" not in plan and "Limit" not in plan
    assert "PushedFilters: [IsNotNull(k), GreaterThan(k,100), LessThanOrEqual(k,550)]" in plan
    assert batch.count() == 450


def test_marks_come_from_footers(spark, tmp_dir):
    p = tmp_dir + "/t"
    rows = frame(spark, [5, 9, -3, None], "long").withColumn("s", F.lit("x")).withColumn("d", F.lit(dt.date(2024, 1, 2)))
    rows.write.parquet(p)
    plan = footer_mark(spark, p, "k")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(k)]" in plan and "ReadSchema: struct<max(k):bigint>" in plan
    assert stored_mark(spark, p, "k") == 9 and stored_mark(spark, p, "d") == dt.date(2024, 1, 2)
    assert stored_mark(spark, p, "s") == "x"  # not answered by footers: scanned
    assert stored_mark(spark, tmp_dir + "/none", "k") is None
    rows.limit(0).write.parquet(tmp_dir + "/empty")
    assert stored_mark(spark, tmp_dir + "/empty", "k") is None
    rows.where("k is null").write.parquet(tmp_dir + "/nulls")
    assert stored_mark(spark, tmp_dir + "/nulls", "k") is None
    rows.write.option("parquet.column.statistics.enabled", "false").parquet(tmp_dir + "/plain")
    assert stored_mark(spark, tmp_dir + "/plain", "k") == 9 == mark_value(spark.read.parquet(tmp_dir + "/plain"), "k")
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is left alone
