import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.crawl import by_page_number, new_urls, newest_first, page_links, read_ledger
from sluice.operators.joins import lookup_join, role
from sluice.operators.reshape import (
    array_to_columns,
    conform,
    dense_index,
    explode_records,
    fill_constants,
    flatten_structs,
    normalise_names,
    remove_text,
)
from sluice.operators.sets import missing_from, symmetric_difference

LEDGER = "\nhttps://x.net/list?m=device&filter=1218\nhttps://x.net/list?m=device&filter=1189\n"


def test_ledger_and_new_urls(spark, tmp_dir):
    path = os.path.join(tmp_dir, "pages.txt")
    with open(path, "w") as f:
        f.write(LEDGER)
    ledger = read_ledger(spark, path)
    assert ledger.count() == 2
    cand = spark.createDataFrame([("https://x.net/list?m=device&filter=1160",),
                                  ("https://x.net/list?m=device&filter=1218",),
                                  ("https://x.net/list?m=device&filter=1160",)], "url string")
    out = by_page_number(new_urls(cand, ledger)).collect()
    assert [(r.url.split("=")[-1], r.page_number) for r in out] == [("1160", 1160)]


def test_page_links_resolve(spark):
    pages = spark.createDataFrame([("https://a.example.com/en/1?x=1", '<a href="/b">b</a><a href="http://c.org/d">'
                                   '</a><a href="rel">r</a><a href="//cdn/x">x</a>')], "url string, html string")
    assert sorted(r.url for r in page_links(pages).collect()) == [
        "http://c.org/d", "https://a.example.com/b", "https://a.example.com/en/rel", "https://cdn/x"]


def test_every_kind_of_link(spark):
    page = "https://a.example.com/en/list.php?m=1#top"
    html = """<A class="x" HREF='b.html'>b</a> <a href=c.html>c</a> <a href="?filter=3&amp;m=2"><b>q</b></a>
      <a data-x="a>b" href = "//cdn.org/x?y">h</a> <a href="../up/./d#frag">d</a> <a href="#top">t</a>
      <a href="mailto:x@y.z">m</a> <a name="none">n</a> <abbr href="no">z</abbr> <a href="/a/../r/..">r</a>"""
    pages = spark.createDataFrame([(page, html), ("not a page", '<a href="/x">x</a><a href="https://k.org/">k</a>'),
                                   (None, "<a href='z'>z</a>"), ("http://bare.org", "<a href='z'>z</a>"), ("http://n.org", None)],
                                  "url string, html string")
    assert sorted(r.url for r in page_links(pages).collect()) == sorted([
        "https://a.example.com/en/b.html", "https://a.example.com/en/c.html",
        "https://a.example.com/en/list.php?filter=3&m=2", "https://cdn.org/x?y", "https://a.example.com/up/d",
        "https://a.example.com/en/list.php?m=1", "https://a.example.com/", "https://k.org/", "http://bare.org/z"])


def test_newest_first(spark):
    urls = spark.createDataFrame([("u?filter=2",), ("u?filter=10",), ("u",)], "url string")
    assert [r.page_number for r in newest_first(urls).collect()] == [10, 2, None]


def test_reshape_helpers(spark):
    df = spark.createDataFrame([(1, ("a", ("b", 2)), [1.5, 2.5], "950mb", None)],
                               "id int, s struct<x:string, y:struct<z:string, w:int>>, loc array<double>, "
                               "layer string, f int")
    flat = flatten_structs(df)
    assert flat.columns == ["id", "s.x", "s.y.z", "s.y.w", "loc", "layer", "f"]
    c = conform(df, [("id", "long"), ("missing", "string")])
    assert c.columns == ["id", "missing"] and c.schema["id"].dataType == T.LongType()
    assert array_to_columns(df, "loc", ["lon", "lat", "alt"]).select("lon", "alt").first() == (1.5, None)
    assert remove_text(df, "mb", ["layer"]).first().layer == "950"
    assert fill_constants(df, {"f": 11}).first().f == 11
    assert normalise_names(df.select(F.col("id").alias("Start Station Id"))).columns == ["start_station_id"]


def test_explode_records_drops_empty_lists(spark):
    df = spark.createDataFrame([(1, [(10, "a"), (20, "b")]), (2, [])],
                               "k int, recs array<struct<v:int, t:string>>")
    out = explode_records(df, "recs", keep=["k"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, 10, "a"), (1, 20, "b")]
    assert explode_records(df, "recs", keep=["k"], outer=True).count() == 3


def test_dense_index_matches_row_number_under_skew(spark):
    # A third of the rows share one sort prefix; ties broken by id.
    rows = [(i, 0 if i % 3 == 0 else i) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, grp long")
    idx = {r.id: r.ix for r in dense_index(df, ["grp", "id"], name="ix", num_partitions=7).collect()}
    expect = {i: n for n, (i, _) in enumerate(sorted(rows, key=lambda t: (t[1], t[0])))}
    assert idx == expect


def test_lookup_join_checked_broadcast(spark):
    fact = spark.range(100).withColumnRenamed("id", "k")
    dim = spark.range(10).select(F.col("id").alias("dk"), (F.col("id") * 2).alias("v"))
    small = lookup_join(fact, dim, "k", "dk")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in small
    big = lookup_join(fact, dim, "k", "dk", max_broadcast_bytes=50)
    assert "BroadcastExchange" not in big._jdf.queryExecution().sparkPlan().toString()
    assert big.where(F.col("v").isNull()).count() == 90  # left join keeps every fact row


def test_broadcast_bound_is_measured_in_bytes(spark):
    from sluice.operators.joins import fits_broadcast

    wide = spark.createDataFrame([(1, "x" * 5000), (2, None)], "k int, v string")
    assert not fits_broadcast(wide, 5000) and fits_broadcast(wide, 6000) and fits_broadcast(wide.select("k"), 100)


@pytest.mark.parametrize("how", ["full", "right", "cross"])
def test_lookup_refuses_joins_that_keep_unmatched_dimension_rows(spark, how):
    from sluice.operators.joins import salted_join

    fact, dim = spark.range(3).withColumnRenamed("id", "k"), spark.range(3).withColumnRenamed("id", "dk")
    with pytest.raises(ValueError):
        lookup_join(fact, dim, "k", "dk", how=how)
    with pytest.raises(ValueError):
        salted_join(fact, dim, "k", "dk", [1], how=how)


def test_equal_rows_of_a_hot_key_get_many_salts(spark):
    from sluice.operators.joins import hot_keys, salted_join

    fact = spark.range(1000).select(F.lit(7).alias("k"))
    dim = spark.createDataFrame([(7, "v"), (8, "w")], "dk int, v string")
    joined = salted_join(fact, dim, "k", "dk", hot_keys(fact, "k", 100), buckets=8)
    assert joined.count() == 1000 and {r.v for r in joined.distinct().collect()} == {"v"}
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "salted_fact" in plan or "__salt" in plan
    assert hot_keys(spark.range(30).select((F.col("id") % 3).alias("k")), "k", 1, max_keys=2) == [0, 1]


def test_role_playing_and_symmetric_difference(spark):
    nation = spark.createDataFrame([(0, "A"), (1, "B")], "n_nationkey int, n_name string")
    r = role(nation, {"n_nationkey": "cn", "n_name": "cust_nation"})
    assert r.columns == ["cn", "cust_nation"]
    a = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    assert sorted(x.k for x in symmetric_difference(a, b).collect()) == [1, 3]
    n = spark.createDataFrame([(None,), (2,)], "k int")
    assert [x.k for x in symmetric_difference(n, b).orderBy("k").collect()] == [None, 3]
    assert symmetric_difference(n, n).count() == 0 and [x.k for x in missing_from(a, n).collect()] == [1]


def _skewed(spark):
    # One key holds a third of the fact rows.
    fact = spark.range(3000).select(F.col("id").alias("fid"),
                                    F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("k"))
    dim = spark.range(500).select(F.col("id").alias("dk"), (F.col("id") * 10).alias("v"))
    return fact, dim


def test_salted_join_equals_plain_join_and_splits_hot_key(spark):
    from sluice.operators.joins import hot_keys, salted_join

    fact, dim = _skewed(spark)
    hot = hot_keys(fact, "k", 500)
    assert hot == [7]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        salted = salted_join(fact, dim, "k", "dk", hot, buckets=8)
        plain = lookup_join(fact, dim, "k", "dk", small=False)
        assert sorted(salted.collect()) == sorted(plain.collect())
        sizes = [r.n for r in salted.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert max(sizes) < 1000   # the hot key no longer lands in one task
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_aqe_splits_skewed_partition_of_left_join(spark):
    fact, dim = _skewed(spark)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        j = lookup_join(fact, dim, "k", "dk", small=False)
        assert j.count() == 3000
        j.collect()
        assert "SortMergeJoin(skew=true)" in j._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_dense_index_random(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=6, deadline=None)
    @given(st.lists(st.integers(0, 5), min_size=1, max_size=120), st.integers(1, 9))
    def check(groups, parts):
        rows = [(i, g) for i, g in enumerate(groups)]
        df = spark.createDataFrame(rows, "id long, g long")
        got = {r.id: r.ix for r in dense_index(df, ["g", "id"], name="ix", start=1, num_partitions=parts).collect()}
        want = {i: n + 1 for n, (i, _) in enumerate(sorted(rows, key=lambda t: (t[1], t[0])))}
        assert got == want

    check()
