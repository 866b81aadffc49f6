"""Weather star-schema queries over forecast-shaped data derived from ``events``."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sluice.functions.time import hours_after, parse_init, stamp_date
from sluice.operators.bands import WEATHER_BANDS, BandSpec, band_dimension, weather_band_dimensions
from sluice.operators.weather import (
    FACT_COLUMNS,
    layer_number,
    profile_join,
    profile_product,
    rh_profile_rows,
    weather_fact,
)
from sluice.plans.catalog import register
from sluice.plans.derive import (
    event_hours,
    event_rh_layers,
    event_weather_documents,
    event_wind_layers,
    weather_rollups,
)
from sluice.plans.tables import Tables
from sluice.sources.html import html_table

HOURS_SQL = """
h AS (
  SELECT date_trunc('hour', ts) AS time_interval,
         CAST(count(*) AS BIGINT) AS cloudcover,
         CAST(count(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS highcloud,
         CAST(count(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS midcloud,
         CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS lowcloud,
         CAST(floor(max(value)) AS BIGINT) AS temp2m,
         CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS lifted_index,
         CAST(count(*) FILTER (WHERE event_type = 'signup') AS BIGINT) AS rh2m,
         CAST(count(DISTINCT user_id) AS BIGINT) AS msl_pressure,
         max(event_type) AS prec_type,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) // 100 AS BIGINT) AS prec_amount,
         CAST(min(user_id) AS BIGINT) AS snow_depth,
         CAST(max(user_id) AS BIGINT) AS wind10m_direction,
         CAST(floor(min(value)) AS BIGINT) AS wind10m_speed
  FROM events GROUP BY 1)"""

_RH_SQL = """
rh AS (
  SELECT date_trunc('hour', ts) AS time_interval,
         CASE event_type WHEN 'view' THEN 1000 WHEN 'click' THEN 850 WHEN 'purchase' THEN 700
                         WHEN 'signup' THEN 500 WHEN 'error' THEN 300 END AS rh_layer,
         CAST(count(*) AS BIGINT) AS rh
  FROM events GROUP BY date_trunc('hour', ts), event_type)"""

_WIND_SQL = """
w AS (
  SELECT date_trunc('hour', ts) AS time_interval,
         CAST(900 - 100 * (minute(ts) // 15) AS INTEGER) AS wind_layer,
         CAST(count(DISTINCT user_id) AS BIGINT) AS wind_direction,
         CAST(floor(max(value)) AS BIGINT) AS wind_speed
  FROM events GROUP BY 1, 2)"""

_FACT_SELECT = ", ".join(["time_interval"] + FACT_COLUMNS)

FACT_SQL = f"""
WITH {HOURS_SQL}, {_RH_SQL}, {_WIND_SQL}
SELECT {_FACT_SELECT}
FROM h JOIN rh USING (time_interval) JOIN w USING (time_interval)
"""


@register("weather_fact", FACT_SQL)
def q_weather_fact(spark: SparkSession, sf_dir: str):
    """Daily forecast documents from events, flattened to the fact with two explodes."""
    return weather_fact(event_weather_documents(Tables(spark, sf_dir).events))


@register("profile_explode", f"WITH {_RH_SQL} SELECT time_interval, CAST(rh_layer AS INTEGER) AS rh_layer, rh FROM rh")
def q_profile_explode(spark: SparkSession, sf_dir: str):
    """Humidity profile arrays exploded with their parent time, ``mb`` removed, cast."""
    return rh_profile_rows(event_weather_documents(Tables(spark, sf_dir).events))


def _flat_profiles(events):
    grain = weather_rollups(events)
    series = event_hours(grain).withColumn("wind10m_direction", F.col("wind10m_direction").cast("bigint"))
    rh = event_rh_layers(grain).select("time_interval", layer_number("layer").alias("rh_layer"), "rh")
    wind = event_wind_layers(grain).select(
        "time_interval", layer_number("layer").alias("wind_layer"),
        F.col("direction").alias("wind_direction"), F.col("speed").alias("wind_speed"))
    return series, rh, wind


_J1_COLS = ["time_interval", "cloudcover", "highcloud", "midcloud", "lowcloud", "temp2m", "lifted_index",
            "rh2m", "msl_pressure", "prec_type", "prec_amount", "wind10m_direction", "wind10m_speed",
            "snow_depth", "rh_layer", "rh"]


@register("profile_join_1", f"""
WITH {HOURS_SQL}, {_RH_SQL}
SELECT {", ".join(_J1_COLS)} FROM h JOIN rh USING (time_interval)
""")
def q_profile_join_1(spark: SparkSession, sf_dir: str):
    """Hourly series joined one-to-many to the humidity profile on time."""
    series, rh, _ = _flat_profiles(Tables(spark, sf_dir).events)
    return profile_join(series, rh).select(*_J1_COLS)


@register("profile_product", FACT_SQL)
def q_profile_product(spark: SparkSession, sf_dir: str):
    """Series joined to both profiles on the same key: the per-hour layer product."""
    series, rh, wind = _flat_profiles(Tables(spark, sf_dir).events)
    return profile_product(series, rh, wind)


@register("event_offset", """
SELECT event_id, strftime(ts, '%Y%m%d') || '00' AS init, CAST(hour(ts) AS INTEGER) AS timepoint,
       date_trunc('hour', ts) AS time_interval
FROM events
""")
def q_event_offset(spark: SparkSession, sf_dir: str):
    """Run stamp (``yyyyMMddHH``) plus an hour offset back to a timestamp."""
    ev = Tables(spark, sf_dir).events.select(
        "event_id", F.concat(stamp_date("ts"), F.lit("00")).alias("init"),
        F.hour("ts").alias("timepoint"))
    return ev.select("event_id", "init", "timepoint",
                     hours_after(parse_init("init"), F.col("timepoint")).alias("time_interval"))


# Fixed values of this project: labels of the ten value bands rendered below.
VALUE_BAND_LABELS = ["calm", "light", "moderate", "fresh", "strong", "gale", "storm", "violent",
                     "hurricane", "extreme"]
VALUE_BAND_WIDTH = 50.0
VALUE_BAND_SPEC = BandSpec("value_band", "Event Value", split="-", unit="m/s", dtype="double",
                           with_description=True, first=(0, None), last=(None, "min"))


def value_band_table(events):
    """Band reference rows (Variable, Value, Meaning) for the bands present in ``events``.

    Band ``k`` covers ``[(k-1)*50, k*50)``; band 1 is written ``Below 50.0m/s``
    and band 10 (everything from 450 up) ``Over 450.0m/s``.
    """
    n = len(VALUE_BAND_LABELS)
    code = F.least(F.floor(F.col("value") / VALUE_BAND_WIDTH).cast("int") + 1, F.lit(n))
    codes = events.select(code.alias("code")).distinct()
    lo = ((F.col("code") - 1) * VALUE_BAND_WIDTH).cast("string")
    hi = (F.col("code") * VALUE_BAND_WIDTH).cast("string")
    label = F.concat(F.lit("("), F.element_at(F.array(*[F.lit(x) for x in VALUE_BAND_LABELS]), F.col("code")),
                     F.lit(")"))
    text = (F.when(F.col("code") == 1, F.concat(F.lit("Below "), hi, F.lit("m/s ")))
            .when(F.col("code") == n, F.concat(F.lit("Over "), lo, F.lit("m/s ")))
            .otherwise(F.concat(lo, F.lit("-"), hi, F.lit("m/s "))))
    return codes.select(F.lit("Event Value").alias("Variable"), F.col("code").cast("string").alias("Value"),
                        F.concat(text, label).alias("Meaning"))


_LABELS_SQL = "[" + ", ".join(f"'{x}'" for x in VALUE_BAND_LABELS) + "]"


@register("band_dims", f"""
WITH b AS (SELECT DISTINCT least(CAST(floor(value / 50.0) AS INTEGER) + 1, 10) AS code FROM events),
e AS (SELECT min(code) AS lo, max(code) AS hi FROM b),
p AS (
  SELECT code,
         CASE WHEN code = 1 THEN NULL ELSE (code - 1) * 50.0 END AS lo_parsed,
         CASE WHEN code = 10 THEN NULL ELSE code * 50.0 END AS hi_parsed,
         CASE WHEN code = 1 THEN code * 50.0 END AS below_num,
         CASE WHEN code = 10 THEN (code - 1) * 50.0 END AS over_num,
         e.lo, e.hi
  FROM b, e),
q AS (
  SELECT code, lo, hi,
         coalesce(lo_parsed, over_num) AS mn, coalesce(hi_parsed, below_num) AS mx FROM p),
r AS (SELECT code, hi, CASE WHEN code = lo THEN 0.0 ELSE mn END AS mn1, mx FROM q)
SELECT code AS value_band, list_extract({_LABELS_SQL}, code) AS description,
       CAST(mn1 AS DOUBLE) AS "min",
       CAST(CASE WHEN code = hi THEN mn1 ELSE mx END AS DOUBLE) AS "max"
FROM r
""")
def q_band_dims(spark: SparkSession, sf_dir: str):
    """Band dimension parsed from band text rendered for the value bands in events."""
    return band_dimension(value_band_table(Tables(spark, sf_dir).events), VALUE_BAND_SPEC)


def _weather_band_text(code, spec_name: str):
    """The Meaning text of a band code, open at code 1 and code 10."""
    text = lambda lo, hi, unit, tail="": F.concat(lo.cast("string"), F.lit("-"), hi.cast("string"), F.lit(unit + tail))
    one = lambda first, last, middle: F.when(code == 1, F.lit(first)).when(code == 10, F.lit(last)).otherwise(middle)
    percent = F.concat((10 * (code - 1)).cast("string"), F.lit("%-"), (10 * code - 1).cast("string"), F.lit("%"))
    return {
        "DIM_cloud": percent,
        "DIM_lifted_index": one("Below -7", "Over 11", F.concat((2 * code - 10).cast("string"), F.lit(" to "),
                                                                (2 * code - 8).cast("string"))),
        "DIM_rh": F.when(code == 10, F.lit("Over 99%")).otherwise(percent),
        "DIM_wind_speed": one("Below 0.3m/s (calm)", "Over 32.6m/s (hurricane)",
                              text((code - 1) * 3.5, code * 3.5, "m/s", " (windy)")),
        "DIM_prec_amount": one("None", "Over 75mm/hr", text(code * 2.5, (code + 1) * 2.5, "mm/hr")),
        "DIM_snow_depth": one("None", "Over 250cm", text(code * 20.5, (code + 1) * 20.5, "cm")),
    }[spec_name]


def _band_row(name: str, cell):
    """One table row of a code; ``cell`` names the variable in the first row."""
    def row(code, i):
        return F.concat(F.lit("<tr>"), F.when(i == 0, cell).otherwise(""), F.lit("<td>"), code.cast("string"),
                        F.lit("</td><td>"), _weather_band_text(code, name), F.lit("</td></tr>"))
    return row


def weather_band_page(events):
    """A stored documentation page with the reference table of the six variables, for the codes present in ``events``.

    One row a code and variable, at most sixty; a variable's name is one cell that spans its rows.
    """
    codes = events.select(F.least(F.floor(F.col("value") / VALUE_BAND_WIDTH).cast("int") + 1, F.lit(10)).alias("code")).distinct()
    rows = codes.groupBy().agg(F.sort_array(F.collect_list("code")).alias("codes"))
    parts = []
    for name, spec in WEATHER_BANDS.items():
        cell = F.concat(F.lit('<td rowspan="'), F.size("codes").cast("string"), F.lit(f'">{spec.variable}</td>'))
        parts.append(F.array_join(F.transform("codes", _band_row(name, cell)), ""))
    table = F.concat(F.lit("<table><tr><th>Variable</th><th>Value</th><th>Meaning</th></tr>"), *parts, F.lit("</table>"))
    # The table stands in a cell of another one, as on the documentation page: it is the second table, or the last.
    return rows.select(F.lit(1).alias("page_id"), F.concat(F.lit("<table><tr><td>Values: "), table,
                                                            F.lit("</td></tr></table>")).alias("html"))


@register("weather_band_dims", """
WITH b AS (SELECT DISTINCT least(CAST(floor(value / 50.0) AS INTEGER) + 1, 10) AS c FROM events),
e AS (SELECT min(c) AS lo, max(c) AS hi FROM b),
p AS (
  SELECT 'DIM_cloud' AS dim, c, NULL AS description, 10.0 * (c - 1) AS mn, 10.0 * c - 1 AS mx FROM b
  UNION ALL SELECT 'DIM_lifted_index', c, NULL, CASE WHEN c IN (1, 10) THEN 11.0 ELSE 2 * c - 10 END,
                   CASE c WHEN 1 THEN -7.0 WHEN 10 THEN 11 ELSE 2 * c - 8 END FROM b
  UNION ALL SELECT 'DIM_rh', c, NULL, CASE c WHEN 10 THEN 99.0 ELSE 10 * (c - 1) END,
                   CASE c WHEN 10 THEN 100.0 ELSE 10 * c - 1 END FROM b
  UNION ALL SELECT 'DIM_wind_speed', c, CASE c WHEN 1 THEN 'calm' WHEN 10 THEN 'hurricane' ELSE 'windy' END,
                   CASE c WHEN 1 THEN 0.3 WHEN 10 THEN 32.6 ELSE (c - 1) * 3.5 END,
                   CASE WHEN c IN (1, 10) THEN 0.3 ELSE c * 3.5 END FROM b
  UNION ALL SELECT 'DIM_prec_amount', c, NULL, CASE c WHEN 1 THEN 0.0 WHEN 10 THEN 75 ELSE c * 2.5 END,
                   CASE WHEN c IN (1, 10) THEN 0.0 ELSE (c + 1) * 2.5 END FROM b
  UNION ALL SELECT 'DIM_snow_depth', c, NULL, CASE c WHEN 1 THEN 0.0 WHEN 10 THEN 250 ELSE c * 20.5 END,
                   CASE WHEN c IN (1, 10) THEN 0.0 ELSE (c + 1) * 20.5 END FROM b),
f AS (
  SELECT dim, c, description, lo, hi,
         CASE WHEN c = lo AND dim = 'DIM_lifted_index' THEN NULL
              WHEN c = lo AND dim IN ('DIM_wind_speed', 'DIM_prec_amount', 'DIM_snow_depth') THEN 0.0 ELSE mn END AS mn,
         CASE WHEN c = lo AND dim = 'DIM_lifted_index' THEN -7.0 ELSE mx END AS mx
  FROM p, e)
SELECT dim, c AS code, description,
       CAST(CASE WHEN c < hi THEN mn ELSE CASE dim WHEN 'DIM_lifted_index' THEN 11.0 WHEN 'DIM_rh' THEN 99 WHEN 'DIM_wind_speed'
            THEN 55.9 WHEN 'DIM_prec_amount' THEN 75 WHEN 'DIM_snow_depth' THEN 250 ELSE mn END END AS DOUBLE) AS "min",
       CAST(CASE WHEN c < hi THEN mx ELSE CASE dim WHEN 'DIM_wind_speed' THEN 55.9 WHEN 'DIM_prec_amount' THEN 75
            WHEN 'DIM_snow_depth' THEN 250 ELSE mx END END AS DOUBLE) AS "max"
FROM f
""")
def q_weather_band_dims(spark: SparkSession, sf_dir: str):
    """All six band dimensions from the reference table of a stored page: spanning cells, nested table, fill values."""
    table = html_table(weather_band_page(Tables(spark, sf_dir).events), -1, header=["Variable", "Value", "Meaning"])
    out = None
    for name, dim in weather_band_dimensions(table).items():
        described = F.col("description") if "description" in dim.columns else F.lit(None).cast("string")
        now = dim.select(F.lit(name).alias("dim"), F.col(WEATHER_BANDS[name].name).alias("code"), described.alias("description"),
                         F.col("min").cast("double").alias("min"), F.col("max").cast("double").alias("max"))
        out = now if out is None else out.unionByName(now)
    return out
