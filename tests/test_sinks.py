import datetime as dt
import decimal
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.sales import SALES_TABLE_COLUMNS, load_sales
from sluice.sinks.writers import (
    WRITE_APPEND,
    WRITE_EMPTY,
    WRITE_TRUNCATE,
    load,
    load_star,
    load_with_metrics,
    staged_write,
    write_parquet,
    write_typed_table,
)
from sluice.sources.files import SALES_HEADER, read_sales_csv


def _df(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id long")


def test_dispositions(spark, tmp_dir):
    p = tmp_dir + "/t"
    assert load(_df(spark, [1, 2]), p, WRITE_APPEND) == "loaded"
    assert load(_df(spark, [3]), p, WRITE_APPEND) == "loaded"
    assert sorted(r.id for r in spark.read.parquet(p).collect()) == [1, 2, 3]
    load(_df(spark, [9]), p, WRITE_TRUNCATE)
    assert [r.id for r in spark.read.parquet(p).collect()] == [9]
    assert load(_df(spark, [7]), p, WRITE_EMPTY) == "skipped"
    q = tmp_dir + "/e"
    assert load(_df(spark, [5]), q, WRITE_EMPTY) == "loaded"   # missing target
    e = tmp_dir + "/empty"
    load(_df(spark, []), e, WRITE_APPEND)
    assert load(_df(spark, [6]), e, WRITE_EMPTY) == "loaded"   # existing but empty


def test_metrics_observed_during_write(spark, tmp_dir):
    m = load_with_metrics(_df(spark, [1, 2, 3]), tmp_dir + "/m", metrics={"top": F.max("id")})
    assert m["rows_loaded"] == 3 and m["top"] == 3


def test_gzip_parquet_round_trip(spark, tmp_dir):
    write_parquet(_df(spark, range(10)), tmp_dir + "/g", compression="gzip")
    assert any(f.endswith(".gz.parquet") for f in os.listdir(tmp_dir + "/g"))
    assert spark.read.parquet(tmp_dir + "/g").count() == 10


def test_staged_rerun_is_idempotent(spark, tmp_dir):
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id long, d string")
    staged_write(rows, tmp_dir + "/s", F.col("d"))
    staged_write(rows.where("d = '2024-01-02'"), tmp_dir + "/s", F.col("d"))
    out = spark.read.parquet(tmp_dir + "/s")
    assert sorted((r.id, str(r.load_date)) for r in out.collect()) == [(1, "2024-01-01"), (2, "2024-01-02")]


def test_typed_table_rejects_null(spark, tmp_dir):
    schema = T.StructType([T.StructField("id", T.LongType(), False)])
    with pytest.raises(Exception, match="NOT NULL"):
        write_typed_table(spark.createDataFrame([(None,)], "id long"), tmp_dir + "/n", schema)


def test_load_star_repairs_one_missing_dim(spark, tmp_dir):
    fact, dim = _df(spark, [1, 2]), _df(spark, [7])
    a = load_star(spark, tmp_dir, "FACT", fact, {"DIM_a": dim, "DIM_b": dim})
    assert a == {"FACT": "loaded", "DIM_a": "loaded", "DIM_b": "loaded"}
    b = load_star(spark, tmp_dir, "FACT", fact, {"DIM_a": dim, "DIM_b": dim, "DIM_c": dim})
    assert b == {"FACT": "loaded", "DIM_a": "skipped", "DIM_b": "skipped", "DIM_c": "loaded"}
    assert spark.read.parquet(tmp_dir + "/FACT").count() == 4


def _csv(tmp_dir, lines):
    path = os.path.join(tmp_dir, "sales.csv")
    with open(path, "w") as f:
        f.write(",".join(SALES_HEADER) + "\n" + "".join(x + "\n" for x in lines))
    return path


def test_sales_csv_one_digit_dates_and_quoted_comma(spark, tmp_dir):
    path = _csv(tmp_dir, [
        'Asia,"Korea, South",Snacks,Online,L,7/27/2012,443368995,7/28/2012,1593,152.58,97.44,243060.94,155221.92,87839.02',
        "Europe,Iceland,Baby Food,Offline,H,10/13/2013,812344619,11/1/2013,4611,255.28,159.42,1177096.08,735084.62,"
        "442011.46",
    ])
    rows = {r["Order ID"]: r for r in read_sales_csv(spark, path).collect()}
    r = rows[443368995]
    assert r["Country"] == "Korea, South"
    assert r["Order Date"] == dt.date(2012, 7, 27) and r["Ship Date"] == dt.date(2012, 7, 28)
    assert r["Unit Price"] == decimal.Decimal("152.58")
    table = load_sales(spark, path, tmp_dir + "/sales")
    assert table.columns == ["id"] + SALES_TABLE_COLUMNS
    assert {r.order_id: r.id for r in table.collect()} == {443368995: 1, 812344619: 2}


def test_sales_csv_header_only(spark, tmp_dir):
    assert read_sales_csv(spark, _csv(tmp_dir, [])).count() == 0


def test_incremental_extract_until_up_to_date(spark, tmp_dir):
    from sluice.sinks.writers import incremental_extract

    src = spark.createDataFrame([(i, f"v{i}") for i in [1, 2, 3, 5, 8, 9, 10]], "id long, v string")
    p = tmp_dir + "/inc"
    runs = []
    while True:
        r = incremental_extract(src, p, "id", 4)
        runs.append((r["status"], r["rows_loaded"]))
        if r["status"] != "load":
            break
    # Each run reads four ids from the first one above the stored maximum:
    # 1..4 -> 1,2,3; 5..8 -> 5,8; 9..12 -> 9,10; then up to date.
    assert runs == [("load", 3), ("load", 2), ("load", 2), ("up to date", 0)]
    assert sorted(x.id for x in spark.read.parquet(p).collect()) == [1, 2, 3, 5, 8, 9, 10]


def test_bucketed_tables_join_without_shuffle(spark, tmp_dir):
    from sluice.operators.joins import lookup_join
    from sluice.sinks.writers import write_bucketed_table

    fact = spark.range(2000).select(F.col("id").alias("fid"), (F.col("id") % 300).alias("k"))
    dim = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    f = write_bucketed_table(fact, "t_fact_b", tmp_dir + "/fb", "k", 8)
    d = write_bucketed_table(dim, "t_dim_b", tmp_dir + "/db", "k", 8)
    # Emulate a dimension too large to broadcast.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(f, d, "k", "k", small=False)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 2000 and joined.where(F.col("v").isNull()).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
