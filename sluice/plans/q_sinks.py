"""Source and sink round trips: every query writes to the shared scratch
folder (below ``spark.checkpoint.dir``) and returns what a reader sees."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.bands import band_dimension
from sluice.operators.documents import normalise_inspections
from sluice.operators.incremental import mark_value
from sluice.operators.sales import append_sales, load_sales
from sluice.operators.weather import weather_fact
from sluice.plans.catalog import register
from sluice.plans.derive import (
    customer_inspection_docs,
    event_weather_documents,
    faulty_sales_lines,
    order_sales_rows,
)
from sluice.plans.q_incremental import BATCH, KEY, RUN_DATE, loaded_target
from sluice.plans.q_weather import FACT_SQL, VALUE_BAND_SPEC, value_band_table
from sluice.plans.tables import Tables
from sluice.session import scratch_path, spread
from sluice.sinks.versioned import commit_load, load_star_run, read_star, read_table
from sluice.sinks.writers import (
    WRITE_APPEND,
    WRITE_EMPTY,
    WRITE_TRUNCATE,
    load,
    load_star,
    incremental_extract,
    load_with_metrics,
    staged_write,
    table_path,
    write_documents,
    write_parquet,
    write_typed_table,
)
from sluice.sources.files import (
    read_csv_batches,
    read_json_documents,
    read_sales_csv,
    read_weather_json,
    write_sales_csv,
    as_int,
    oid_to_text,
    split_sales_csv,
)

EVENT_COLS = "event_id, ts, user_id, event_type, value, props"
_RUN_TS = f"TIMESTAMP '{RUN_DATE} 00:00:00'"

_SALES_SQL = """
s AS (
  SELECT r.r_name AS region, n.n_name AS country, c.c_mktsegment AS item_type,
         CASE WHEN o.o_orderstatus = 'O' THEN 'Online' ELSE 'Offline' END AS sales_channel,
         substr(o.o_orderpriority, 3, 1) AS "Order Priority",
         CAST(o.o_orderdate AS DATE) AS order_date, o.o_orderkey AS order_id,
         CAST(o.o_orderdate AS DATE) + 14 AS ship_date,
         CAST(1 + o.o_custkey % 9 AS INTEGER) AS units_sold,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS unit_price,
         CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) * CAST(0.6 AS DECIMAL(1,1)) AS DECIMAL(18,2)) AS unit_cost
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
t AS (
  SELECT *, CAST(unit_price * units_sold AS DECIMAL(18,2)) AS total_revenue,
         CAST(unit_cost * units_sold AS DECIMAL(18,2)) AS total_cost FROM s)"""


def _sales_csv(spark: SparkSession, sf_dir: str) -> str:
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "sales_csv")
    write_sales_csv(order_sales_rows(spread(t.orders), t.customer, t.nation, t.region), path)
    return path


@register("csv_typed_scan", f"""
WITH {_SALES_SQL}
SELECT CAST(row_number() OVER (ORDER BY order_id) AS BIGINT) AS id, region, country, item_type, sales_channel,
       "Order Priority", order_date, order_id, ship_date, units_sold, unit_price, unit_cost, total_revenue,
       total_cost, CAST(total_revenue - total_cost AS DECIMAL(18,2)) AS total_profit
FROM t
""")
def q_csv_typed_scan(spark: SparkSession, sf_dir: str):
    """Sales CSV (``M/d/yyyy`` dates, header) scanned with a declared schema into a
    typed table with NOT NULL checks and auto-increment ids."""
    csv = _sales_csv(spark, sf_dir)
    return load_sales(spark, csv, scratch_path(spark, "sales_table"))


@register("csv_offset_batch", f"""
WITH {_SALES_SQL}
SELECT region AS "Region", country AS "Country", item_type AS "Item Type", sales_channel AS "Sales Channel",
       "Order Priority", order_date AS "Order Date", order_id AS "Order ID", ship_date AS "Ship Date",
       units_sold AS "Units Sold", unit_price AS "Unit Price", unit_cost AS "Unit Cost",
       total_revenue AS "Total Revenue", total_cost AS "Total Cost",
       CAST(total_revenue - total_cost AS DECIMAL(18,2)) AS "Total Profit"
FROM t ORDER BY order_id LIMIT 1000 OFFSET 1000
""")
def q_csv_offset_batch(spark: SparkSession, sf_dir: str):
    """Second batch of 1000 CSV records in key order: what follows the first batch's last key."""
    return read_csv_batches(read_sales_csv(spark, _sales_csv(spark, sf_dir)), "Order ID", 1000, skip=1)


_SALES_ROWS = """
SELECT region AS "Region", country AS "Country", item_type AS "Item Type", sales_channel AS "Sales Channel",
       "Order Priority", order_date AS "Order Date", order_id AS "Order ID", ship_date AS "Ship Date",
       units_sold AS "Units Sold", unit_price AS "Unit Price", unit_cost AS "Unit Cost",
       total_revenue AS "Total Revenue", total_cost AS "Total Cost",
       CAST(total_revenue - total_cost AS DECIMAL(18,2)) AS "Total Profit"
FROM t"""


@register("csv_header_order", f"WITH {_SALES_SQL} {_SALES_ROWS}")
def q_csv_header_order(spark: SparkSession, sf_dir: str):
    """A sales CSV whose columns are in another order, with one more column: columns are found by header name."""
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "sales_csv")
    rows = order_sales_rows(spread(t.orders), t.customer, t.nation, t.region)
    write_sales_csv(rows.select(F.lit("x").alias("Remark"), *reversed(rows.columns)), path)
    return read_sales_csv(spark, path)


@register("csv_money_int", f"""
WITH {_SALES_SQL}
SELECT order_id AS "Order ID", CAST(round_even(unit_price, 0) AS BIGINT) AS "Unit Price",
       CAST(round_even(total_revenue, 0) AS BIGINT) AS "Total Revenue"
FROM t
""")
def q_csv_money_int(spark: SparkSession, sf_dir: str):
    """The scanned sales with money as whole numbers."""
    sales = as_int(read_sales_csv(spark, _sales_csv(spark, sf_dir)))
    return sales.select("Order ID", "Unit Price", "Total Revenue")


@register("csv_rejects", """
SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 10 < 4 THEN 'malformed' END AS reason FROM orders
""")
def q_csv_rejects(spark: SparkSession, sf_dir: str):
    """A sales CSV with four kinds of bad lines: good rows and bad lines written apart, every line once."""
    t = Tables(spark, sf_dir)
    base = scratch_path(spark, "csv_rejects")
    lines = faulty_sales_lines(order_sales_rows(spread(t.orders), t.customer, t.nation, t.region))
    # One column whose name is the header line; no character of the data quotes or separates.
    lines.write.option("header", True).option("quote", "").option("sep", "\u0001").csv(f"{base}/in")
    split_sales_csv(spark, f"{base}/in", f"{base}/good", f"{base}/bad")
    good = spark.read.parquet(f"{base}/good").select(F.col("Order ID").alias("order_id"), F.lit(None).cast("string").alias("reason"))
    bad = spark.read.parquet(f"{base}/bad").select(F.get(F.split("line", ","), 6).cast("long").alias("order_id"), "reason")
    return good.unionByName(bad)


@register("continued_ids", f"""
WITH {_SALES_SQL}
SELECT CAST(row_number() OVER (ORDER BY order_id % 2, order_id) AS BIGINT) AS id, order_id, region, order_date, total_revenue
FROM t
""")
def q_continued_ids(spark: SparkSession, sf_dir: str):
    """Two sales loads with auto-increment ids, the second one going on from the first, both of them repeated."""
    t = Tables(spark, sf_dir)
    base = scratch_path(spark, "continued_ids")
    rows = order_sales_rows(spread(t.orders), t.customer, t.nation, t.region)
    for i in range(2):
        write_sales_csv(rows.where(F.col("Order ID") % 2 == i), f"{base}/csv{i}")
    for i in (0, 1, 1, 0):
        append_sales(spark, f"{base}/csv{i}", f"{base}/sales", f"load{i}")
    return read_table(spark, f"{base}/sales").select("id", "order_id", "region", "order_date", "total_revenue")


def _split(events):
    before = loaded_target(events)
    after = events.where(F.col("ts") >= F.lit(RUN_DATE).cast("timestamp_ntz"))
    return before, after


@register("load_append", f"SELECT {EVENT_COLS} FROM events")
def q_load_append(spark: SparkSession, sf_dir: str):
    """Two batches appended to one table: the table holds their union all."""
    ev = Tables(spark, sf_dir).events
    before, after = _split(ev)
    path = scratch_path(spark, "load_append") + "/events"
    load(before, path, WRITE_APPEND)
    load(after, path, WRITE_APPEND)
    return spark.read.parquet(path)


@register("load_truncate", f"SELECT {EVENT_COLS} FROM events WHERE ts >= {_RUN_TS}")
def q_load_truncate(spark: SparkSession, sf_dir: str):
    """A full load replaced by a truncating load: only the second batch remains."""
    ev = Tables(spark, sf_dir).events
    _, after = _split(ev)
    path = scratch_path(spark, "load_truncate") + "/events"
    load(ev, path, WRITE_TRUNCATE)
    load(after, path, WRITE_TRUNCATE)
    return spark.read.parquet(path)


@register("load_if_empty", f"SELECT {EVENT_COLS} FROM events WHERE ts < {_RUN_TS}")
def q_load_if_empty(spark: SparkSession, sf_dir: str):
    """Load-if-empty twice: the first batch loads, the second is skipped."""
    ev = Tables(spark, sf_dir).events
    before, after = _split(ev)
    path = scratch_path(spark, "load_if_empty") + "/events"
    load(before, path, WRITE_EMPTY)
    load(after, path, WRITE_EMPTY)
    return spark.read.parquet(path)


ORDERS_DDL = T.StructType([
    T.StructField("o_orderkey", T.LongType(), False),
    T.StructField("o_custkey", T.LongType(), False),
    T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_totalprice", T.DecimalType(18, 2), False),
    T.StructField("o_orderdate", T.DateType(), False),
    T.StructField("o_orderpriority", T.StringType()),
])


@register("ddl_enforced_load", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders
""")
def q_ddl_enforced_load(spark: SparkSession, sf_dir: str):
    """Drop + create a typed table: declared types and NOT NULL enforced while writing."""
    path = scratch_path(spark, "ddl") + "/orders"
    write_typed_table(Tables(spark, sf_dir).orders, path, ORDERS_DDL)
    return spark.read.parquet(path)


@register("staged_write", f"SELECT {EVENT_COLS}, CAST(ts AS DATE) AS load_date FROM events")
def q_staged_write(spark: SparkSession, sf_dir: str):
    """Date-partitioned staging; re-running one day replaces that day only."""
    ev = Tables(spark, sf_dir).events
    root = scratch_path(spark, "staged") + "/events"
    staged_write(ev, root, F.to_date("ts"))
    day = F.date_sub(F.lit(RUN_DATE).cast("date"), 1)
    staged_write(ev.where(F.to_date("ts") == day), root, F.to_date("ts"))
    return spark.read.parquet(root)


@register("load_metrics", "SELECT count(*) AS rows_loaded, max(event_id) AS max_event_id FROM events")
def q_load_metrics(spark: SparkSession, sf_dir: str):
    """Rows loaded (and the last id), observed during the write itself."""
    path = scratch_path(spark, "metrics") + "/events"
    m = load_with_metrics(Tables(spark, sf_dir).events, path, WRITE_APPEND,
                          {"max_event_id": F.max("event_id")})
    schema = T.StructType([T.StructField("rows_loaded", T.LongType()), T.StructField("max_event_id", T.LongType())])
    return spark.createDataFrame([(m["rows_loaded"], m["max_event_id"])], schema)


@register("load_star", f"""
WITH f AS ({FACT_SQL}),
b AS (SELECT DISTINCT least(CAST(floor(value / 50.0) AS INTEGER) + 1, 10) AS code FROM events)
SELECT 'FACT_weather' AS table_name, 2 * count(*) AS row_count FROM f
UNION ALL SELECT 'DIM_value_band' AS table_name, count(*) AS row_count FROM b
""")
def q_load_star(spark: SparkSession, sf_dir: str):
    """Two runs of the star load: the fact is appended twice, the dimension loaded once."""
    ev = Tables(spark, sf_dir).events
    root = scratch_path(spark, "star")
    for _ in range(2):
        load_star(spark, root, "FACT_weather", weather_fact(event_weather_documents(ev)),
                  {"DIM_value_band": band_dimension(value_band_table(ev), VALUE_BAND_SPEC)})
    counts = [spark.read.parquet(table_path(root, n)).agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(n).alias("table_name"), "row_count") for n in ("FACT_weather", "DIM_value_band")]
    return counts[0].unionByName(counts[1])


@register("versioned_truncate", f"SELECT {EVENT_COLS} FROM events WHERE ts >= {_RUN_TS}")
def q_versioned_truncate(spark: SparkSession, sf_dir: str):
    """A versioned table replaced by a truncating load that reads the version it replaces."""
    path = scratch_path(spark, "versioned_truncate") + "/events"
    commit_load(Tables(spark, sf_dir).events, path, WRITE_TRUNCATE, "full")
    _, after = _split(read_table(spark, path))
    commit_load(after, path, WRITE_TRUNCATE, "cut")
    return read_table(spark, path)


@register("repeated_append", f"SELECT {EVENT_COLS} FROM events")
def q_repeated_append(spark: SparkSession, sf_dir: str):
    """Two runs appended to a versioned table, the second one twice and the first once more: every row once."""
    before, after = _split(Tables(spark, sf_dir).events)
    path = scratch_path(spark, "repeated_append") + "/events"
    for rows, run in ((before, "day1"), (after, "day2"), (after, "day2"), (before, "day1")):
        commit_load(rows, path, WRITE_APPEND, run)
    return read_table(spark, path)


@register("repeated_star", f"""
WITH f AS ({FACT_SQL}),
b AS (SELECT DISTINCT least(CAST(floor(value / 50.0) AS INTEGER) + 1, 10) AS code FROM events)
SELECT 'FACT_weather' AS table_name, 2 * count(*) AS row_count FROM f
UNION ALL SELECT 'DIM_value_band' AS table_name, count(*) AS row_count FROM b
""")
def q_repeated_star(spark: SparkSession, sf_dir: str):
    """Two runs of a versioned star load, the second one repeated after its fact was loaded but not shown."""
    ev = Tables(spark, sf_dir).events
    root = scratch_path(spark, "repeated_star")
    fact = weather_fact(event_weather_documents(ev))
    dims = {"DIM_value_band": band_dimension(value_band_table(ev), VALUE_BAND_SPEC)}
    load_star_run(spark, root, "FACT_weather", fact, dims, "day1")
    commit_load(fact, table_path(root, "FACT_weather"), WRITE_APPEND, "day2")  # the run dies here
    load_star_run(spark, root, "FACT_weather", fact, dims, "day2")
    counts = [t.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
              for n, t in sorted(read_star(spark, root).items())]
    return counts[0].unionByName(counts[1])


@register("weather_json_scan", FACT_SQL)
def q_weather_json_scan(spark: SparkSession, sf_dir: str):
    """Forecast documents written as JSON and scanned back with the declared schema."""
    path = scratch_path(spark, "weather_json")
    write_documents(event_weather_documents(Tables(spark, sf_dir).events), path, mode="overwrite")
    return weather_fact(read_weather_json(spark, path, multiline=False))


INSPECTION_JSON_SCHEMA = (
    "_id struct<`$oid`: string>, certificate_number bigint, business_name string, sector string, "
    "address struct<city: string, zip: string, street: string, number: string>")


@register("inspection_json_scan", """
SELECT CAST(c_custkey AS VARCHAR) AS certificate_number, c_name AS business_name, c_mktsegment AS sector,
       CAST(row_number() OVER (ORDER BY c_custkey) - 1 AS BIGINT) AS address_id
FROM customer
""")
def q_inspection_json_scan(spark: SparkSession, sf_dir: str):
    """Exported documents (extended-JSON ``$oid`` ids) scanned and normalised."""
    docs = customer_inspection_docs(Tables(spark, sf_dir).customer)
    docs = docs.withColumn("_id", F.struct(F.lpad(F.hex("certificate_number"), 24, "0").alias("$oid")))
    path = scratch_path(spark, "inspection_json")
    write_documents(docs, path, mode="overwrite")
    scanned = oid_to_text(read_json_documents(spark, path, INSPECTION_JSON_SCHEMA, multiline=False))
    inspection, _ = normalise_inspections(scanned)
    return inspection


@register("json_array_scan", """
SELECT CAST(c_custkey AS VARCHAR) AS certificate_number, c_name AS business_name, c_mktsegment AS sector FROM customer
""")
def q_json_array_scan(spark: SparkSession, sf_dir: str):
    """Documents exported as JSON arrays, one array of at most 1000 documents a file."""
    docs = customer_inspection_docs(Tables(spark, sf_dir).customer)
    part = F.floor(F.col("certificate_number") / 1000).alias("part")
    arrays = docs.groupBy(part).agg(F.to_json(F.collect_list(F.struct(*docs.columns))).alias("value"))
    path = scratch_path(spark, "json_array")
    arrays.write.partitionBy("part").text(path)
    schema = "certificate_number bigint, business_name string, sector string"
    scanned = read_json_documents(spark, path, schema)
    return scanned.select(F.col("certificate_number").cast("string").alias("certificate_number"), "business_name", "sector")


@register("parquet_gzip", f"SELECT {EVENT_COLS} FROM events")
def q_parquet_gzip(spark: SparkSession, sf_dir: str):
    """Parquet written with the gzip codec and read back."""
    path = scratch_path(spark, "gzip") + "/events"
    write_parquet(Tables(spark, sf_dir).events, path, compression="gzip")
    return spark.read.parquet(path)


_AFTER_GAP = f"(SELECT max(event_id) FROM events WHERE ts < {_RUN_TS}) + {2 * BATCH}"


@register("incremental_gap", f"""
SELECT {EVENT_COLS} FROM events
WHERE ts < {_RUN_TS} OR (event_id > {_AFTER_GAP} AND event_id <= {_AFTER_GAP} + {BATCH})
""")
def q_incremental_gap(spark: SparkSession, sf_dir: str):
    """An incremental run over a source whose ids have a gap of two batches after the mark."""
    ev = Tables(spark, sf_dir).events
    path = scratch_path(spark, "incremental_gap") + "/events"
    target = loaded_target(ev)
    load(target, path, WRITE_TRUNCATE)
    resumes = mark_value(target, KEY) + 2 * BATCH
    incremental_extract(target.unionByName(ev.where(F.col(KEY) > resumes)), path, KEY, BATCH)
    return spark.read.parquet(path)


@register("incremental_load", f"""
SELECT {EVENT_COLS} FROM events
WHERE event_id <= (SELECT max(event_id) FROM events WHERE ts < {_RUN_TS}) + {BATCH}
""")
def q_incremental_load(spark: SparkSession, sf_dir: str):
    """One incremental run into a stored target: counts reconciled, the next id
    range after the target's high-water mark appended."""
    ev = Tables(spark, sf_dir).events
    path = scratch_path(spark, "incremental_load") + "/events"
    load(loaded_target(ev), path, WRITE_TRUNCATE)
    incremental_extract(ev, path, KEY, BATCH)
    return spark.read.parquet(path)
