import datetime as dt
import json
import os

from pyspark.sql import functions as F

from sluice.operators.weather import (
    FACT_COLUMNS,
    profile_product,
    rh_profile_rows,
    series_rows,
    weather_fact,
    wind_profile_rows,
)
from sluice.sources.files import read_weather_json


def _point(tp, rh, wind, direction="5"):
    return {
        "timepoint": tp, "cloudcover": 2, "highcloud": 3, "midcloud": 4, "lowcloud": 5,
        "rh_profile": [{"layer": layer, "rh": v} for layer, v in rh],
        "wind_profile": [{"layer": layer, "direction": d, "speed": s} for layer, d, s in wind],
        "temp2m": 21, "lifted_index": 2, "rh2m": 60, "msl_pressure": 1013, "prec_type": "none",
        "prec_amount": 0, "snow_depth": 0, "wind10m": {"direction": direction, "speed": 3},
    }


DOC_A = {"product": "civil", "init": "2024011500", "dataseries": [
    _point(3, [("950mb", 10), ("900mb", 20)], [("950mb", 180, 4), ("900mb", 190, 5), ("850mb", 200, 6)]),
    _point(6, [], [("950mb", 170, 2)]),  # empty profile: no fact rows for this timepoint
]}
DOC_B = {"product": "civil", "init": "2024011503", "dataseries": [
    _point(0, [("950mb", 1)], [("950mb", 1, 1)]),  # same time as DOC_A timepoint 3
]}


def _docs(spark, tmp_dir):
    for name, doc in (("a.json", DOC_A), ("b.json", DOC_B)):
        with open(os.path.join(tmp_dir, name), "w") as f:
            json.dump(doc, f, indent=2)
    return read_weather_json(spark, tmp_dir).withColumn("station", F.input_file_name())


def test_fact_rows_are_layer_products(spark, tmp_dir):
    docs = _docs(spark, tmp_dir)
    fact = weather_fact(docs.where(F.col("init") == "2024011500"))
    rows = fact.collect()
    assert len(rows) == 2 * 3
    assert fact.columns == ["time_interval"] + FACT_COLUMNS
    r = rows[0]
    assert r.time_interval == dt.datetime(2024, 1, 15, 3)
    assert {x.rh_layer for x in rows} == {950, 900}
    assert {x.wind_layer for x in rows} == {950, 900, 850}
    assert r.wind10m_direction == 5


def test_documents_with_shared_time_stay_apart_by_key(spark, tmp_dir):
    docs = _docs(spark, tmp_dir)
    fact = weather_fact(docs, keys=["station"])
    at3 = fact.where(F.col("time_interval") == F.lit("2024-01-15 03:00:00").cast("timestamp_ntz"))
    assert at3.count() == 6 + 1
    per = {r.station.split("/")[-1]: r.n for r in at3.groupBy("station").agg(F.count("*").alias("n")).collect()}
    assert per == {"a.json": 6, "b.json": 1}


def test_join_form_equals_explode_form(spark, tmp_dir):
    docs = _docs(spark, tmp_dir).where(F.col("init") == "2024011500")
    joined = profile_product(series_rows(docs), rh_profile_rows(docs), wind_profile_rows(docs))
    assert sorted(joined.collect()) == sorted(weather_fact(docs).collect())


def test_fact_plan_has_no_shuffle(spark, tmp_dir):
    plan = weather_fact(_docs(spark, tmp_dir))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "Generate" in plan


def test_one_document_gives_the_logged_16384_rows(spark, tmp_dir):
    # 64 timepoints x 16 humidity layers x 16 wind layers, as in the logged runs.
    layers = [f"{1000 - 50 * i}mb" for i in range(16)]
    doc = {"product": "civil", "init": "2024011500", "dataseries": [
        _point(3 * t, [(x, 50) for x in layers], [(x, 180, 5) for x in layers]) for t in range(64)]}
    path = os.path.join(tmp_dir, "full.json")
    with open(path, "w") as f:
        json.dump(doc, f)
    fact = weather_fact(read_weather_json(spark, path))
    assert fact.count() == 16384
    assert fact.select("time_interval").distinct().count() == 64
