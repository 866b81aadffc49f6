from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.operators.incremental import (
    batch_after,
    id_range_batches,
    latest,
    mark_value,
    next_id_range,
    read_target,
    reconcile,
    resume_key,
)


def _src(spark, ids):
    return spark.createDataFrame([(i, f"r{i}") for i in ids], "id long, v string")


def test_batch_after_four_cases(spark):
    src = _src(spark, range(1, 21))
    assert batch_after(src, "id").count() == 20
    assert [r.id for r in batch_after(src, "id", None, 5).collect()] == [1, 2, 3, 4, 5]
    assert [r.id for r in batch_after(src, "id", 5, 3).collect()] == [6, 7, 8]
    assert batch_after(src, "id", 5).count() == 15


def test_batches_until_empty_equal_full_read(spark):
    src = _src(spark, [1, 2, 3, 5, 8, 13, 21, 34])
    seen, last = [], None
    while True:
        b = [r.id for r in batch_after(src, "id", last, 3).collect()]
        if not b:
            break
        seen += b
        last = b[-1]
    assert seen == [1, 2, 3, 5, 8, 13, 21, 34]


def test_id_range_has_short_batches_on_gaps(spark):
    src = _src(spark, [1, 2, 3, 7, 8, 20])
    assert [r.id for r in next_id_range(src, "id", 3, 5).collect()] == [7, 8]
    tagged = {r.id: r.batch_id for r in id_range_batches(src, "id", 3, 5).collect()}
    assert tagged == {7: 0, 8: 0, 20: 3}


@settings(max_examples=8, deadline=None)
@given(st.sets(st.integers(min_value=0, max_value=200), min_size=1, max_size=40), st.integers(1, 17))
def test_backfill_tags_match_repeated_range_runs(spark, ids, batch):
    src = _src(spark, sorted(ids))
    mark = min(ids) - 1
    tagged = {r.id: r.batch_id for r in id_range_batches(src, "id", mark, batch).collect()}
    for b in set(tagged.values()):
        lo = mark + b * batch
        expect = {i for i in ids if lo < i <= lo + batch}
        assert {i for i, t in tagged.items() if t == b} == expect
    assert set(tagged) == set(ids)


def test_missing_target(spark, tmp_dir):
    assert read_target(spark, tmp_dir + "/nope") is None
    assert mark_value(None, "id") is None
    src = _src(spark, [4, 5, 6])
    assert [r.id for r in next_id_range(src, "id", None, 2).collect()] == [4, 5]
    r = reconcile(src, None).collect()[0]
    assert (r.source_rows, r.target_rows, r.status) == (3, 0, "load")


def test_reconcile_statuses(spark):
    a, b = _src(spark, [1, 2, 3]), _src(spark, [1, 2])
    assert reconcile(a, a).collect()[0].status == "up to date"
    assert reconcile(a, b).collect()[0].pending_rows == 1
    assert reconcile(b, a).collect()[0].status == "target ahead"


def test_latest_and_resume_key(spark):
    src = spark.createDataFrame([(1, "2024-01-14 10:00:00"), (2, "2024-01-15 09:00:00"), (3, "2024-01-15 23:00:00"),
                                 (4, "2024-01-16 01:00:00")], "id long, ts string").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz"))
    assert latest(src, "id").collect()[0].id == 4
    assert resume_key(src, "id", "ts", "2024-01-16").collect()[0].resume_key == 3


def test_resume_key_absent_from_source(spark):
    # The last stored id was deleted upstream: extraction continues after it.
    src = _src(spark, [1, 2, 4, 6, 7])
    assert [r.id for r in batch_after(src, "id", 3, 2).collect()] == [4, 6]
    assert [r.id for r in next_id_range(src, "id", 3, 3).collect()] == [4, 6]
