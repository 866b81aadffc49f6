"""Reshaping and document queries: conform, rename, split, index, type, clean."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sluice.operators.documents import (
    clean_spec_sheet,
    normalise_inspections,
    spec_entries,
    typed_trips,
    variant_entries,
    variant_sheets,
    zips_table,
)
from sluice.operators.joins import lookup_join
from sluice.operators.reshape import (
    array_to_columns,
    conform,
    dense_index,
    dots_to_underscores,
    explode_records,
    flatten_structs,
    normalise_names,
)
from sluice.plans.catalog import register
from sluice.plans.derive import (
    customer_inspection_docs,
    customer_zip_docs,
    event_trip_docs,
    event_weather_documents,
    part_spec_sheets,
)
from sluice.plans.q_weather import HOURS_SQL
from sluice.plans.tables import Tables
from sluice.session import materialize, scratch_path, spread
from sluice.streaming.documents import read_stored_sheets, run_spec_sheet_stream


@register("conform_columns", """
SELECT event_id, event_type, value, CAST(NULL AS VARCHAR) AS session_id, user_id FROM events
""")
def q_conform_columns(spark: SparkSession, sf_dir: str):
    """Fixed column order with an absent column as typed NULLs, dots renamed."""
    declared = [("event_id", "bigint"), ("event_type", "string"), ("value", "double"),
                ("session.id", "string"), ("user_id", "bigint")]
    return dots_to_underscores(conform(Tables(spark, sf_dir).events, declared))


@register("normalise_names", """
SELECT c_custkey AS customer_key, c_name AS customer_name, c_mktsegment AS market_segment,
       c_acctbal AS account_balance
FROM customer
""")
def q_normalise_names(spark: SparkSession, sf_dir: str):
    """Exported names with spaces and capitals to ``lower_snake`` names."""
    c = Tables(spark, sf_dir).customer.select(
        F.col("c_custkey").alias("Customer Key"), F.col("c_name").alias("Customer Name"),
        F.col("c_mktsegment").alias("Market Segment"), F.col("c_acctbal").alias("Account Balance"))
    return normalise_names(c)


@register("zips_geo", """
SELECT CAST(vec_id AS VARCHAR) AS zip, embedding[1] AS lon, embedding[2] AS lat, label FROM embeddings
""")
def q_zips_geo(spark: SparkSession, sf_dir: str):
    """Key renamed ``_id`` -> ``zip`` as text; ``[lon, lat, ...]`` array to columns."""
    docs = Tables(spark, sf_dir).embeddings.select(
        F.col("vec_id").alias("_id"), F.col("embedding").alias("loc"), "label")
    renamed = docs.withColumnRenamed("_id", "zip").withColumn("zip", F.col("zip").cast("string"))
    return array_to_columns(renamed, "loc", ["lon", "lat"]).select("zip", "lon", "lat", "label")


_DOCS_SQL = """
d AS (SELECT c_custkey AS k, c_name, c_nationkey, c_acctbal, c_mktsegment,
             lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS _id FROM customer)"""


@register("address_split", f"""
WITH {_DOCS_SQL}
SELECT CAST(row_number() OVER (ORDER BY _id) - 1 AS BIGINT) AS address_id,
       NULLIF(CASE WHEN c_nationkey = 0 THEN '' ELSE 'City ' || CAST(c_nationkey AS VARCHAR) END, '') AS city,
       NULLIF(CASE WHEN c_acctbal < 0 THEN ''
                   ELSE lpad(CAST(c_nationkey * 1000 + k % 1000 AS VARCHAR), 5, '0') END, '') AS zip,
       NULLIF(c_mktsegment || ' Street', '') AS street,
       NULLIF(CASE WHEN k % 7 = 0 THEN '' ELSE CAST(k % 100 AS VARCHAR) END, '') AS number
FROM d
""")
def q_address_split(spark: SparkSession, sf_dir: str):
    """Child table of nested addresses, linked by a dense ``address_id``."""
    _, address = normalise_inspections(customer_inspection_docs(Tables(spark, sf_dir).customer))
    return address


@register("inspection_split", f"""
WITH {_DOCS_SQL}
SELECT CAST(k AS VARCHAR) AS certificate_number, c_name AS business_name, c_mktsegment AS sector,
       CAST(row_number() OVER (ORDER BY _id) - 1 AS BIGINT) AS address_id
FROM d
""")
def q_inspection_split(spark: SparkSession, sf_dir: str):
    """Parent table: documents without ``_id`` and ``address``, plus ``address_id``."""
    inspection, _ = normalise_inspections(customer_inspection_docs(Tables(spark, sf_dir).customer))
    return inspection


@register("inspection_zips", f"""
WITH {_DOCS_SQL},
a AS (SELECT _id, NULLIF(CASE WHEN c_acctbal < 0 THEN '' ELSE lpad(CAST(c_nationkey * 1000 + k % 1000 AS VARCHAR), 5, '0') END, '') AS zip
      FROM d),
z AS (SELECT lpad(CAST(c_nationkey * 1000 + k % 1000 AS VARCHAR), 5, '0') AS zip, 'City ' || CAST(c_nationkey AS VARCHAR) AS city,
             'State ' || CAST(c_nationkey % 5 AS VARCHAR) AS state, count(*) AS pop, c_nationkey + 0.5 AS lat, k % 1000 + 0.25 AS lon
      FROM d GROUP BY 1, 2, 3, 5, 6)
SELECT CAST(row_number() OVER (ORDER BY a._id) - 1 AS BIGINT) AS address_id, a.zip, z.city AS zip_city, z.state, z.pop,
       CAST(z.lat AS DOUBLE) AS lat, CAST(z.lon AS DOUBLE) AS lon
FROM a LEFT JOIN z ON a.zip = z.zip
""")
def q_inspection_zips(spark: SparkSession, sf_dir: str):
    """The three tables of the inspection load: parent, address and zips, the last two joined on the zip."""
    customer = Tables(spark, sf_dir).customer
    _, address = normalise_inspections(customer_inspection_docs(customer))
    zips = zips_table(customer_zip_docs(customer)).withColumnRenamed("city", "zip_city").withColumnRenamed("zip", "z_zip")
    return (lookup_join(address.select("address_id", "zip"), zips, "zip", "z_zip")
            .select("address_id", "zip", "zip_city", "state", "pop", "lat", "lon"))


@register("weather_flatten", f"""
WITH {HOURS_SQL}
SELECT strftime(time_interval, '%Y%m%d') || '00' AS init, CAST(hour(time_interval) AS INTEGER) AS timepoint,
       cloudcover, temp2m, prec_type, prec_amount, CAST(wind10m_direction AS VARCHAR) AS wind10m_direction, wind10m_speed
FROM h
""")
def q_weather_flatten(spark: SparkSession, sf_dir: str):
    """Timepoints as records with their parent's stamp, nested structs flattened to ``parent.child`` columns."""
    docs = event_weather_documents(Tables(spark, sf_dir).events)
    points = explode_records(docs, "dataseries", keep=["init"])
    flat = dots_to_underscores(flatten_structs(points.drop("rh_profile", "wind_profile")))
    return flat.select("init", "timepoint", "cloudcover", "temp2m", "prec_type", "prec_amount", "wind10m_direction",
                       "wind10m_speed")


@register("surrogate_key", """
SELECT o_orderkey, o_orderdate, CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS BIGINT) AS sk
FROM orders
""")
def q_surrogate_key(spark: SparkSession, sf_dir: str):
    """Row position 0..n-1 over a total order, computed without a single-task window."""
    orders = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderdate")
    return dense_index(orders, ["o_orderdate", "o_orderkey"], name="sk")


@register("typed_trips", """
SELECT CAST(event_id AS VARCHAR) AS _id, CAST(floor(value * 10) AS INTEGER) AS tripduration,
       make_timestamp(epoch_us(ts) - epoch_us(ts) % 100) AS starttime,
       make_timestamp(epoch_us(ts) - epoch_us(ts) % 100 + CAST(floor(value * 10) AS BIGINT) * 1000000) AS stoptime,
       CAST(user_id AS VARCHAR) AS start_station_id, 'Station ' || CAST(user_id AS VARCHAR) AS start_station_name,
       CAST(user_id + 1 AS VARCHAR) AS end_station_id, CAST(event_id AS VARCHAR) AS bikeid,
       event_type AS usertype, CAST(1950 + user_id % 50 AS INTEGER) AS birth_year,
       CAST(user_id % 3 AS INTEGER) AS gender
FROM events
""")
def q_typed_trips(spark: SparkSession, sf_dir: str):
    """Trip documents: names normalised, times parsed, ids as text."""
    return typed_trips(event_trip_docs(spread(Tables(spark, sf_dir).events)))


def _spec_rows(category, attribute, index, value, n):
    cat = "CAST(NULL AS VARCHAR)" if category is None else f"'{category}'"
    return (f"SELECT p_partkey AS doc_id, {cat} AS category, '{attribute}' AS attribute, "
            f"CAST({index} AS INTEGER) AS value_index, {value} AS value, CAST({n} AS INTEGER) AS n_values FROM part")


_PRICE = "CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS VARCHAR)"
_SPEC_SQL = "\nUNION ALL\n".join([
    _spec_rows(None, "url", 0, "'https://parts.example.com/p/' || CAST(p_partkey AS VARCHAR)", 1),
    _spec_rows("General", "Brand", 0, "p_brand", 1),
    _spec_rows("General", "Model", 0, "p_name", 1),
    _spec_rows("General", "Secondary Type", 0, "p_type", 1),
    _spec_rows("Size", "Minimum Size", 0, "CAST(p_size AS VARCHAR)", 1),
    _spec_rows("Size", "Equivalent Price", 0, _PRICE, 2),
    _spec_rows("Size", "Equivalent Price", 1, "'USD'", 2),
    _spec_rows("Size", "Pix. Density", 0, "'400 ppi'", 1),
    _spec_rows("Camera", "Auxilary Camera", 0, "p_type", 2),
    _spec_rows("Camera", "Auxilary Camera", 1, "p_brand", 2),
    _spec_rows("Camera", "Camera Res.", 0, "CAST(p_size AS VARCHAR) || ' MP'", 1),
])


@register("spec_clean", _SPEC_SQL)
def q_spec_clean(spark: SparkSession, sf_dir: str):
    """Scraped spec sheets cleaned in-row, listed as (category, attribute, value) rows."""
    raw = part_spec_sheets(spread(Tables(spark, sf_dir).part))
    return spec_entries(clean_spec_sheet(raw, keep=["doc_id"]), keep=["doc_id"])


@register("spec_variant", f"""
SELECT doc_id, category, attribute, CASE WHEN any_value(n_values) = 1 THEN 'STRING' ELSE 'ARRAY<STRING>' END AS kind,
       CASE WHEN any_value(n_values) = 1 THEN CAST(to_json(any_value(value)) AS VARCHAR)
            ELSE CAST(to_json(list(value ORDER BY value_index)) AS VARCHAR) END AS value
FROM ({_SPEC_SQL}) GROUP BY doc_id, category, attribute
""")
def q_spec_variant(spark: SparkSession, sf_dir: str):
    """Cleaned sheets stored as VARIANT documents: attributes of one value are strings, of several lists."""
    raw = part_spec_sheets(spread(Tables(spark, sf_dir).part))
    sheets = materialize(variant_sheets(clean_spec_sheet(raw, keep=["doc_id"]), keep=["doc_id"]), "spec-variant")
    return variant_entries(sheets, keep=["doc_id"])


@register("spec_clean_legacy", f"""
SELECT * FROM ({_SPEC_SQL}) WHERE attribute NOT IN ('Pix. Density', 'Camera Res.')
""")
def q_spec_clean_legacy(spark: SparkSession, sf_dir: str):
    """The same sheets with abbreviated keys that have no expansion deleted."""
    raw = part_spec_sheets(spread(Tables(spark, sf_dir).part))
    return spec_entries(clean_spec_sheet(raw, keep=["doc_id"], legacy=True), keep=["doc_id"])


@register("spec_stream", f"""
SELECT 'https://parts.example.com/p/' || CAST(doc_id AS VARCHAR) AS url, category, attribute, value_index, value,
       n_values
FROM ({_SPEC_SQL})
""")
def q_spec_stream(spark: SparkSession, sf_dir: str):
    """Scraped items as a stream: every sheet arrives twice (a re-crawl), is
    cleaned per micro-batch, and stored once per URL."""
    raw = part_spec_sheets(spread(Tables(spark, sf_dir).part)).select("raw")
    base = scratch_path(spark, "spec_stream")
    in_dir = f"{base}/in"
    for _ in range(2):
        raw.write.mode("append").text(in_dir)
        run_spec_sheet_stream(spark, in_dir, f"{base}/out", f"{base}/checkpoint")
    return spec_entries(read_stored_sheets(spark, f"{base}/out"), keep=["url"])
