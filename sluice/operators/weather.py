"""Forecast documents to a star-schema fact table.

A document is ``init`` (``yyyyMMddHH`` text) plus ``dataseries``: an array
of timepoints, each with scalar readings and two profiles (humidity per
pressure layer, wind per pressure layer). The fact has one row per
timepoint x humidity layer x wind layer.

``weather_fact`` builds that product with two ``explode``s on the same
row, so no shuffle is needed; the per-row product is bounded by the two
profile lengths stored in that row. ``profile_product`` is the join form
of the same result for profiles held in separate tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.time import hours_after, parse_init

LAYER_UNIT = "mb"

RH_LAYER = T.StructType([T.StructField("layer", T.StringType()), T.StructField("rh", T.LongType())])
WIND_LAYER = T.StructType([T.StructField("layer", T.StringType()),
                           T.StructField("direction", T.LongType()),
                           T.StructField("speed", T.LongType())])
TIMEPOINT = T.StructType([
    T.StructField("timepoint", T.IntegerType()),
    T.StructField("cloudcover", T.LongType()),
    T.StructField("highcloud", T.LongType()),
    T.StructField("midcloud", T.LongType()),
    T.StructField("lowcloud", T.LongType()),
    T.StructField("rh_profile", T.ArrayType(RH_LAYER)),
    T.StructField("wind_profile", T.ArrayType(WIND_LAYER)),
    T.StructField("temp2m", T.LongType()),
    T.StructField("lifted_index", T.LongType()),
    T.StructField("rh2m", T.LongType()),
    T.StructField("msl_pressure", T.LongType()),
    T.StructField("prec_type", T.StringType()),
    T.StructField("prec_amount", T.LongType()),
    T.StructField("snow_depth", T.LongType()),
    T.StructField("wind10m", T.StructType([T.StructField("direction", T.StringType()),
                                           T.StructField("speed", T.LongType())])),
])
WEATHER_DOCUMENT = T.StructType([
    T.StructField("product", T.StringType()),
    T.StructField("init", T.StringType()),
    T.StructField("dataseries", T.ArrayType(TIMEPOINT)),
])

# Fact column order of the weather star schema.
FACT_COLUMNS = ["cloudcover", "highcloud", "midcloud", "lowcloud", "temp2m",
                "lifted_index", "rh2m", "rh_layer", "rh", "msl_pressure", "prec_type", "prec_amount",
                "wind10m_direction", "wind10m_speed",
                "wind_layer", "wind_direction", "wind_speed",
                "snow_depth"]
SERIES_COLUMNS = ["cloudcover", "highcloud", "midcloud", "lowcloud", "temp2m", "lifted_index",
                  "rh2m", "msl_pressure", "prec_type", "prec_amount", "wind10m_direction",
                  "wind10m_speed", "snow_depth"]


def layer_number(c, lenient: bool = False) -> F.Column:
    """``'950mb'`` -> 950; what is no number without its unit fails the job, or is NULL with ``lenient``."""
    c = F.col(c) if isinstance(c, str) else c
    bare = F.replace(c, F.lit(LAYER_UNIT), F.lit(""))
    return bare.try_cast("int") if lenient else bare.cast("int")


def _timepoints(docs: DataFrame, keys: Sequence[str]) -> DataFrame:
    pts = docs.select(*keys, parse_init("init").alias("__init"), F.explode("dataseries").alias("__d"))
    return pts.select(*keys, hours_after("__init", F.col("__d.timepoint")).alias("time_interval"), "__d")


def _series_map(d: str = "__d") -> dict[str, F.Column]:
    cols = [
        F.col(f"{d}.cloudcover").cast("bigint").alias("cloudcover"),
        F.col(f"{d}.highcloud").cast("bigint").alias("highcloud"),
        F.col(f"{d}.midcloud").cast("bigint").alias("midcloud"),
        F.col(f"{d}.lowcloud").cast("bigint").alias("lowcloud"),
        F.col(f"{d}.temp2m").cast("bigint").alias("temp2m"),
        F.col(f"{d}.lifted_index").cast("bigint").alias("lifted_index"),
        F.col(f"{d}.rh2m").cast("bigint").alias("rh2m"),
        F.col(f"{d}.msl_pressure").cast("bigint").alias("msl_pressure"),
        F.col(f"{d}.prec_type").alias("prec_type"),
        F.col(f"{d}.prec_amount").cast("bigint").alias("prec_amount"),
        F.col(f"{d}.wind10m.direction").cast("bigint").alias("wind10m_direction"),
        F.col(f"{d}.wind10m.speed").cast("bigint").alias("wind10m_speed"),
        F.col(f"{d}.snow_depth").cast("bigint").alias("snow_depth"),
    ]
    return dict(zip(SERIES_COLUMNS, cols))


def _series_cols(d: str = "__d") -> list[F.Column]:
    return list(_series_map(d).values())


def weather_fact(docs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Documents to fact rows: ``time_interval`` plus the 18 fact columns.

    ``keys`` are document columns carried through (for example a station
    id) so that timepoints of different documents never mix.
    """
    keys = list(keys)
    pts = _timepoints(docs, keys)
    rows = (pts.select(*keys, "time_interval", "__d", F.explode("__d.rh_profile").alias("__rh"))
            .select(*keys, "time_interval", "__d", "__rh", F.explode("__d.wind_profile").alias("__w")))
    fact = {
        **_series_map(),
        "rh_layer": layer_number(F.col("__rh.layer")).alias("rh_layer"),
        "rh": F.col("__rh.rh").cast("bigint").alias("rh"),
        "wind_layer": layer_number(F.col("__w.layer")).alias("wind_layer"),
        "wind_direction": F.col("__w.direction").cast("bigint").alias("wind_direction"),
        "wind_speed": F.col("__w.speed").cast("bigint").alias("wind_speed"),
    }
    return rows.select(*keys, "time_interval", *[fact[c] for c in FACT_COLUMNS])


def series_rows(docs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per timepoint with its scalar readings (profiles dropped)."""
    keys = list(keys)
    return _timepoints(docs, keys).select(*keys, "time_interval", *_series_cols())


def rh_profile_rows(docs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Humidity profile: one row per timepoint x layer (layer unit removed)."""
    keys = list(keys)
    pts = _timepoints(docs, keys).select(*keys, "time_interval", F.explode("__d.rh_profile").alias("__rh"))
    return pts.select(*keys, "time_interval", layer_number(F.col("__rh.layer")).alias("rh_layer"),
                      F.col("__rh.rh").cast("bigint").alias("rh"))


def wind_profile_rows(docs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Wind profile: one row per timepoint x layer (layer unit removed)."""
    keys = list(keys)
    pts = _timepoints(docs, keys).select(*keys, "time_interval", F.explode("__d.wind_profile").alias("__w"))
    return pts.select(*keys, "time_interval", layer_number(F.col("__w.layer")).alias("wind_layer"),
                      F.col("__w.direction").cast("bigint").alias("wind_direction"),
                      F.col("__w.speed").cast("bigint").alias("wind_speed"))


def profile_join(series: DataFrame, profile: DataFrame, on: Sequence[str] = ("time_interval",)) -> DataFrame:
    """Inner equi-join of a series to one profile table (one-to-many)."""
    return series.join(profile, list(on), "inner")


def profile_product(series: DataFrame, rh: DataFrame, wind: DataFrame,
                    on: Sequence[str] = ("time_interval",)) -> DataFrame:
    """Series joined to both profiles on the same key: per-key product of layers.

    Both profile tables hold at most one row per key and layer, so a key
    yields (humidity layers x wind layers) rows, the same bound as the
    document form.
    """
    joined = profile_join(profile_join(series, rh, on), wind, on)
    return joined.select(*on, *FACT_COLUMNS)
