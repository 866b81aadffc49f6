"""No row is lost in silence: malformed sheets, bad values, CSV headers, id gaps, failing loads."""

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluice.functions.time import parse_init
from sluice.operators.documents import clean_spec_sheet, is_spec_sheet, malformed_sheets, spec_entries, typed_trips
from sluice.operators.reshape import cast_rejects, conform
from sluice.operators.weather import layer_number
from sluice.plans.derive import event_weather_documents
from sluice.sinks.writers import WRITE_TRUNCATE, incremental_extract, load, write_typed_table
from sluice.sources.files import as_int, read_sales_csv
from sluice.streaming.documents import read_rejects, read_stored_sheets, run_spec_sheet_stream

GOOD = json.dumps({"url": ["u1"], "General": {"Brand": ["b"]}})
OTHER = json.dumps({"url": ["u1"], "General": {"Brand": ["a"]}})
NO_URL = json.dumps({"General": {"Brand": ["c"]}})


def test_malformed_sheets_fail_or_are_set_aside(spark):
    raw = spark.createDataFrame([(1, GOOD), (2, "{broken"), (3, ""), (4, None), (5, "[1]")], "id int, raw string")
    assert sorted(r.id for r in malformed_sheets(raw).collect()) == [2, 3, 4, 5]
    with pytest.raises(PySparkException, match="malformed spec sheet"):
        spec_entries(clean_spec_sheet(raw, keep=["id"]), keep=["id"]).collect()
    assert clean_spec_sheet(raw.where(is_spec_sheet()), keep=["id"]).count() == 1
    kept = clean_spec_sheet(raw, keep=["id"], on_malformed="null")
    assert kept.where("fields is null").count() == 4


def test_stream_stores_sheets_without_url_and_rejects_the_malformed(spark, tmp_dir):
    spark.createDataFrame([(x,) for x in (GOOD, OTHER, NO_URL, NO_URL, "{broken", "7")], "value string").write.text(tmp_dir + "/in")
    for _ in range(2):
        run_spec_sheet_stream(spark, tmp_dir + "/in", tmp_dir + "/out", tmp_dir + "/ckpt")
    stored = read_stored_sheets(spark, tmp_dir + "/out").collect()
    assert sorted((r.url or "-", r.specs["General"]["Brand"][0]) for r in stored) == [("-", "c"), ("-", "c"), ("u1", "a")]
    assert sorted(r.value for r in read_rejects(spark, tmp_dir + "/out").collect()) == ["7", "{broken"]


def test_bad_values_fail_unless_asked_and_are_counted(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "a string")
    with pytest.raises(PySparkException):
        conform(df, [("a", "int")]).collect()
    assert [r.a for r in conform(df, [("a", "int")], lenient=True).collect()] == [1, None, None]
    assert cast_rejects(df, [("a", "int"), ("absent", "int")]).first().a == 1
    layers = spark.createDataFrame([("950mb",), ("high",)], "l string")
    with pytest.raises(PySparkException):
        layers.select(layer_number("l")).collect()
    assert [r[0] for r in layers.select(layer_number("l", lenient=True)).collect()] == [950, None]
    trips = spark.createDataFrame([("2020-01-01 00:00:00.1230",), ("soon",)], "starttime string")
    with pytest.raises(PySparkException):
        typed_trips(trips).collect()
    assert [r.starttime for r in typed_trips(trips, lenient=True).collect()] == [dt.datetime(2020, 1, 1, 0, 0, 0, 123000), None]


def test_stamps_ignore_the_session_time_zone(spark):
    stamps = spark.createDataFrame([("2024031002",), ("2024110301",)], "init string")
    trips = spark.createDataFrame([("2024-03-10 02:30:00.5000",)], "starttime string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:00 did not exist there on that day
        assert [r[0] for r in stamps.select(parse_init("init")).collect()] == [dt.datetime(2024, 3, 10, 2), dt.datetime(2024, 11, 3, 1)]
        assert typed_trips(trips).first().starttime == dt.datetime(2024, 3, 10, 2, 30, 0, 500000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    bad = spark.createDataFrame([("20240310",)], "init string")
    with pytest.raises(PySparkException):
        bad.select(parse_init("init")).collect()
    assert bad.select(parse_init("init", lenient=True)).first()[0] is None


HEADER = ("Region,Country,Item Type,Sales Channel,Order Priority,Order Date,Order ID,Ship Date,Units Sold,Unit Price,Unit Cost,"
          "Total Revenue,Total Cost,Total Profit")
VALUES = "Africa,Kenya,Snacks,Online,H,1/5/2020,7,2/6/2020,3,10.50,4.25,31.50,12.75,18.75"


def _csv(path, header, values):
    with open(path, "w") as f:
        f.write(header + "\n" + values + "\n")


def test_csv_columns_are_found_by_name(spark, tmp_path):
    names, values = HEADER.split(","), VALUES.split(",")
    straight, turned = str(tmp_path / "a.csv"), str(tmp_path / "b.csv")
    _csv(straight, HEADER, VALUES)
    _csv(turned, ",".join(reversed([*names, "Extra"])), ",".join(reversed([*values, "e"])))
    assert read_sales_csv(spark, straight).collect() == read_sales_csv(spark, turned).collect()
    row = read_sales_csv(spark, turned).first()
    assert (row["Region"], row["Country"], row["Order ID"], row["Order Date"]) == ("Africa", "Kenya", 7, dt.date(2020, 1, 5))
    _csv(str(tmp_path / "c.csv"), ",".join(names[1:]), ",".join(values[1:]))
    with pytest.raises(ValueError, match="Region"):
        read_sales_csv(spark, str(tmp_path / "c.csv"))
    with pytest.raises(Exception, match="header"):  # two files in different orders: one fails, it is not misread
        read_sales_csv(spark, [straight, turned]).collect()
    whole = as_int(read_sales_csv(spark, straight)).first()
    assert (whole["Unit Price"], whole["Unit Cost"], whole["Total Revenue"]) == (10, 4, 32)


def test_an_id_gap_does_not_stop_the_extraction(spark, tmp_dir):
    source = spark.createDataFrame([(i,) for i in (1, 2, 3, 100, 101)], "id bigint")
    runs = [incremental_extract(source, tmp_dir + "/t", "id", 10) for _ in range(3)]
    assert [(r["status"], r["rows_loaded"]) for r in runs] == [("load", 3), ("load", 2), ("up to date", 0)]
    assert sorted(r.id for r in spark.read.parquet(tmp_dir + "/t").collect()) == [1, 2, 3, 100, 101]


def test_a_failing_load_leaves_the_old_table(spark, tmp_dir):
    from pyspark.sql import types as T

    path = tmp_dir + "/t"
    load(spark.range(10), path, WRITE_TRUNCATE)
    bad = spark.range(10).select(F.when(F.col("id") == 9, F.raise_error(F.lit("bad row")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(PySparkException):
        load(bad, path, WRITE_TRUNCATE)
    assert spark.read.parquet(path).count() == 10
    with pytest.raises(PySparkException):
        write_typed_table(spark.createDataFrame([(1,), (None,)], "id bigint"), path,
                          T.StructType([T.StructField("id", T.LongType(), False)]))
    assert spark.read.parquet(path).count() == 10
    load(spark.read.parquet(path).where("id < 3"), path, WRITE_TRUNCATE)  # a table may be replaced by part of itself
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2]


def test_hourly_sums_beyond_32_bits(spark):
    rows = [(i, dt.datetime(2024, 1, 1, 5, i % 60), i, "view", 3e8, "{}") for i in range(20)]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    point = event_weather_documents(events).first().dataseries[0]
    assert point.prec_amount == 20 * 300_000_000 > 2 ** 31 and point.msl_pressure == 20
    assert sorted((w.layer, w.direction) for w in point.wind_profile) == [("800mb", 5), ("900mb", 15)]
