"""A fact stored beside its dimension: no shuffle, hot and null keys apart, versions by one rename."""

import pytest
from pyspark.sql import functions as F

from sluice.sinks import colocated
from sluice.sinks.colocated import colocated_join, open_colocated, store_colocated

SF_SMALL = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture()
def sides(spark):
    # A third of the rows on key 7, some without a key, some whose key the dimension lacks.
    fact = spark.range(3000).select(
        F.col("id").alias("f"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.col("id") % 400).cast("long").alias("k"))
    dim = spark.range(390).select(F.col("id").alias("d"), (F.col("id") * 2).alias("v"))
    return fact, dim.unionAll(spark.createDataFrame([(11, -1), (None, -2), (7, -3)], "d long, v long"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_rows_equal_a_plain_join(spark, sides, tmp_dir, how):
    fact, dim = sides
    stored = store_colocated(fact, dim, "k", "d", tmp_dir, 8)
    assert [r.key for r in stored.hot_keys.collect()] == [7]
    assert stored.hot.count() == fact.where("k = 7 or k is null").count()
    want = fact.join(dim, F.col("k") == F.col("d"), how).select("f", "k", "v")
    got = colocated_join(stored, how)
    assert got.columns == ["f", "k", "v"] and _rows(got) == _rows(want)
    # Above the bound the hot rows are joined by a shuffle, with the same rows.
    assert _rows(colocated_join(stored, how, max_broadcast_bytes=0)) == _rows(want)


def test_no_shuffle_and_even_buckets(spark, sides, tmp_dir):
    fact, dim = sides
    stored = store_colocated(fact, dim, "k", "d", tmp_dir, 8)
    plan = _plan(colocated_join(stored))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan and "Exchange SinglePartition" not in plan
    sizes = [r["count"] for r in stored.fact.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) <= 8 and max(sizes) < fact.count() / 3


def test_opened_again_and_versions(spark, sides, tmp_dir):
    fact, dim = sides
    assert open_colocated(spark, tmp_dir) is None
    first = _rows(colocated_join(store_colocated(fact, dim, "k", "d", tmp_dir, 8)))
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("sluice_")]:
        spark.sql(f"DROP TABLE {name}")  # as in a session with a new catalog
    again = open_colocated(spark, tmp_dir)
    assert _rows(colocated_join(again)) == first and "Exchange hashpartitioning" not in _plan(colocated_join(again))
    second = _rows(colocated_join(store_colocated(fact.where("f < 10"), dim, "k", "d", tmp_dir, 4)))
    assert _rows(colocated_join(open_colocated(spark, tmp_dir))) == second != first
    assert _rows(colocated_join(open_colocated(spark, tmp_dir, 1))) == first


def test_a_store_that_stops_leaves_the_old_pair(spark, sides, tmp_dir, monkeypatch):
    fact, dim = sides
    first = _rows(colocated_join(store_colocated(fact, dim, "k", "d", tmp_dir, 8)))
    steps = {"write_parquet": 2, "_write_bucketed": 2, "publish": 1}
    for name, times in steps.items():
        for stop in range(times):
            real, calls = getattr(colocated, name), []

            def failing(*args, **kwargs):
                calls.append(1)
                if len(calls) > stop:
                    raise RuntimeError("stopped")
                return real(*args, **kwargs)

            monkeypatch.setattr(colocated, name, failing)
            with pytest.raises(RuntimeError, match="stopped"):
                store_colocated(fact.where("f < 10"), dim, "k", "d", tmp_dir, 8)
            monkeypatch.setattr(colocated, name, real)
            assert _rows(colocated_join(open_colocated(spark, tmp_dir))) == first


def test_edges(spark, sides, tmp_dir):
    fact, dim = sides
    for n, (f, d) in enumerate([(fact.limit(0), dim), (fact, dim.limit(0)), (fact.where("k is null"), dim)]):
        stored = store_colocated(f, d, "k", "d", f"{tmp_dir}/{n}", 4)
        assert _rows(colocated_join(stored)) == _rows(f.join(d, F.col("k") == F.col("d"), "left").select("f", "k", "v"))
    odd = fact.withColumnRenamed("k", "a key, odd")
    assert colocated_join(store_colocated(odd, dim, "a key, odd", "d", f"{tmp_dir}/odd", 4)).count() >= 3000
    with pytest.raises(ValueError, match="types"):
        store_colocated(fact, dim.withColumn("d", F.col("d").cast("string")), "k", "d", tmp_dir, 4)
    with pytest.raises(ValueError, match="both sides: F"):
        store_colocated(fact, dim.withColumnRenamed("v", "F"), "k", "d", tmp_dir, 4)
    with pytest.raises(ValueError, match="left or inner"):
        colocated_join(stored, "full")


def test_the_registered_star(spark):
    from sluice.plans.catalog import queries
    both = [queries()[n](spark, SF_SMALL) for n in ("star_colocated", "star_enrich")]
    assert both[0].columns == both[1].columns and _rows(both[0]) == _rows(both[1])
