"""Inputs in the reference's shapes, derived by Spark from the driver tables.

The reference reads log files, weather documents, document-store exports,
sales CSVs and scraped spec sheets. The driver supplies TPC-H-like tables
instead, so each builder below renders one of those shapes from them.
Every builder is a lazy DataFrame plan over the whole input table; the
nested ones only collect pre-aggregated rows whose count per group is
bounded by a small fixed domain (hours of a day, event types, quarter
hours), never raw rows of an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.time import stamp_date
from sluice.session import materialize

# ---------------------------------------------------------------- log lines

def event_status(event_type) -> Column:
    return F.when(event_type == "error", F.lit("ERROR")).otherwise(F.lit("INFO"))


def event_action(event_type) -> Column:
    return F.concat(F.lit("app."), F.initcap(event_type), F.lit("Handler"))


def event_message(props, value) -> Column:
    cents = F.round(value * 100).cast("bigint").cast("string")
    return F.concat(props, F.lit(" cents="), cents)


def event_log_lines(events: DataFrame) -> DataFrame:
    """One log4j-style line per event; error events add a stack-trace line.

    ``2024-01-01 00:00:07,179 ERROR [user-8] app.ErrorHandler: {...} cents=655``
    followed by ``\\tat app.ErrorHandler.handle(Handler.java:8)``, which has
    no timestamp and so is dropped by the parser.
    """
    et = F.col("event_type")
    line = F.concat_ws(
        " ",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"),
        event_status(et),
        F.concat(F.lit("[user-"), F.col("user_id").cast("string"), F.lit("]")),
        F.concat(event_action(et), F.lit(":")),
        event_message(F.col("props"), F.col("value")),
    )
    trace = F.concat(F.lit("\tat "), event_action(et), F.lit(".handle(Handler.java:"),
                     F.col("user_id").cast("string"), F.lit(")"))
    lines = F.when(et == "error", F.array(line, trace)).otherwise(F.array(line))
    return events.select(F.explode(lines).alias("value"))


# ---------------------------------------------------------- weather shapes

# Fixed values of this project: the pressure layer that stands for each event
# type in the humidity profile rendered from ``events``.
EVENT_TYPE_LAYER = {"view": "1000mb", "click": "850mb", "purchase": "700mb", "signup": "500mb",
                    "error": "300mb"}


def _hour(ts="ts"):
    return F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz")


def event_grain(events: DataFrame) -> DataFrame:
    """Events rolled up per hour, type and quarter hour: a few rows an hour,
    whatever the number of events or users. Every reading but the distinct
    users comes from these rows."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    return events.groupBy(
        _hour().alias("time_interval"), "event_type", F.floor(F.minute("ts") / 15).cast("int").alias("quarter"),
    ).agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("vmax"), F.min("value").alias("vmin"),
          F.sum(cents).alias("cents"), F.min("user_id").alias("umin"), F.max("user_id").alias("umax"))


def event_users(events: DataFrame) -> DataFrame:
    """Distinct users per hour and per quarter of it, one row an hour.

    One row per hour and user, with the quarters it was seen in as bits, is
    all that is shuffled; both counts come from it.
    """
    quarter = F.floor(F.minute("ts") / 15).cast("int")
    bit = F.element_at(F.array(F.lit(1), F.lit(2), F.lit(4), F.lit(8)), quarter + 1)
    seen = events.groupBy(_hour().alias("time_interval"), "user_id").agg(F.bit_or(bit).alias("seen"))
    in_quarter = [F.count_if(F.col("seen").bitwiseAND(1 << q) > 0) for q in range(4)]
    return seen.groupBy("time_interval").agg(F.count("user_id").alias("users"),
                                             F.array(*in_quarter).alias("users_in_quarter"))


def weather_rollups(events: DataFrame) -> DataFrame:
    """``event_grain`` with the hour's ``event_users`` beside each row, written once: some dozens of rows an hour, nothing
    of the events' size. Readings and both profiles are roll-ups of it."""
    return materialize(event_grain(events).join(event_users(events), "time_interval"), "event_grain")


def _n_of(event_type: str):
    return F.coalesce(F.sum(F.when(F.col("event_type") == event_type, F.col("n"))), F.lit(0)).cast("bigint")


def event_hours(grain: DataFrame) -> DataFrame:
    """Scalar readings per hour (the ``dataseries`` entries), 64-bit whatever the hour holds."""
    return grain.groupBy("time_interval").agg(
        F.sum("n").alias("cloudcover"),
        _n_of("view").alias("highcloud"),
        _n_of("click").alias("midcloud"),
        _n_of("purchase").alias("lowcloud"),
        F.floor(F.max("vmax")).alias("temp2m"),
        _n_of("error").alias("lifted_index"),
        _n_of("signup").alias("rh2m"),
        # max over a small set: keeps the aggregate hash-based (a string max buffer forces a sort).
        F.array_max(F.collect_set("event_type")).alias("prec_type"),
        F.floor(F.sum("cents") / 100).cast("bigint").alias("prec_amount"),
        F.min("umin").alias("snow_depth"),
        F.max("umax").cast("string").alias("wind10m_direction"),
        F.floor(F.min("vmin")).alias("wind10m_speed"),
        F.max("users").alias("msl_pressure"),
    )


def event_rh_layers(grain: DataFrame) -> DataFrame:
    """Humidity profile rows: events per hour and type, layer text like ``850mb``."""
    layer = F.create_map(*[F.lit(x) for kv in EVENT_TYPE_LAYER.items() for x in kv])[F.col("event_type")]
    agg = grain.groupBy("time_interval", "event_type").agg(F.sum("n").alias("rh"))
    return agg.select("time_interval", layer.alias("layer"), "rh")


def event_wind_layers(grain: DataFrame) -> DataFrame:
    """Wind profile rows: per hour and quarter hour, layer text like ``700mb``."""
    agg = grain.groupBy("time_interval", "quarter").agg(
        F.floor(F.max("vmax")).alias("speed"), F.max(F.get("users_in_quarter", F.col("quarter"))).alias("direction"))
    layer = F.concat((F.lit(900) - F.lit(100) * F.col("quarter")).cast("string"), F.lit("mb"))
    return agg.select("time_interval", layer.alias("layer"), "direction", "speed")


def event_weather_documents(events: DataFrame) -> DataFrame:
    """One forecast-shaped document per day: ``init`` plus up to 24 timepoints.

    Profiles are nested from already aggregated rows (at most five types
    and four quarter hours per hour), so every collected list is small and
    bounded whatever the event volume.
    """
    grain = weather_rollups(events)
    rh = event_rh_layers(grain).groupBy("time_interval").agg(
        F.collect_list(F.struct("layer", "rh")).alias("rh_profile"))
    wind = event_wind_layers(grain).groupBy("time_interval").agg(
        F.collect_list(F.struct("layer", "direction", "speed")).alias("wind_profile"))
    pts = event_hours(grain).join(rh, "time_interval").join(wind, "time_interval")
    point = F.struct(
        F.hour("time_interval").alias("timepoint"),
        "cloudcover", "highcloud", "midcloud", "lowcloud", "rh_profile", "wind_profile",
        "temp2m", "lifted_index", "rh2m", "msl_pressure", "prec_type", "prec_amount", "snow_depth",
        F.struct(F.col("wind10m_direction").alias("direction"), F.col("wind10m_speed").alias("speed")).alias("wind10m"),
    )
    day = stamp_date("time_interval")
    return (pts.groupBy(day.alias("day")).agg(F.collect_list(point).alias("dataseries"))
            .select(F.lit("civil").alias("product"), F.concat("day", F.lit("00")).alias("init"), "dataseries"))


# ---------------------------------------------------------- document shapes

def customer_inspection_docs(customer: DataFrame) -> DataFrame:
    """Inspection-style documents, one per customer, with a nested address.

    ``_id`` is the zero-padded key (text that sorts in key order, like an
    ObjectId); some address parts are ``''`` as in the source documents.
    """
    k = F.col("c_custkey")
    address = F.struct(
        F.when(F.col("c_nationkey") == 0, F.lit("")).otherwise(
            F.concat(F.lit("City "), F.col("c_nationkey").cast("string"))).alias("city"),
        F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(
            F.lpad((F.col("c_nationkey") * 1000 + k % 1000).cast("string"), 5, "0")).alias("zip"),
        F.concat(F.col("c_mktsegment"), F.lit(" Street")).alias("street"),
        F.when(k % 7 == 0, F.lit("")).otherwise((k % 100).cast("string")).alias("number"),
    )
    return customer.select(
        F.lpad(k.cast("string"), 10, "0").alias("_id"),
        k.alias("certificate_number"),
        F.col("c_name").alias("business_name"),
        F.col("c_mktsegment").alias("sector"),
        address.alias("address"),
    )


def customer_zip_docs(customer: DataFrame) -> DataFrame:
    """Zip documents of the addresses above: one per zip, with ``[lon, lat]`` and the number of customers."""
    k = F.col("c_custkey")
    area = (F.col("c_nationkey").cast("bigint") * 1000 + k % 1000).alias("area")
    return customer.groupBy(area).agg(F.count(F.lit(1)).alias("pop")).select(
        F.lpad(F.col("area").cast("string"), 5, "0").alias("_id"),
        F.concat(F.lit("City "), F.floor(F.col("area") / 1000).cast("string")).alias("city"),
        F.concat(F.lit("State "), (F.floor(F.col("area") / 1000) % 5).cast("string")).alias("state"),
        "pop", F.array(F.col("area") % 1000 + 0.25, F.floor(F.col("area") / 1000) + 0.5).alias("loc"))


def event_trip_docs(events: DataFrame) -> DataFrame:
    """Bike-trip documents: times as text with four fractional digits,
    names with spaces and capitals as exported."""
    dur = F.floor(F.col("value") * 10).cast("int")
    fmt = "yyyy-MM-dd HH:mm:ss.SSSS"
    return events.select(
        F.col("event_id").cast("string").alias("_id"),
        dur.alias("tripduration"),
        F.date_format("ts", fmt).alias("starttime"),
        F.date_format(F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), dur), fmt).alias("stoptime"),
        F.col("user_id").cast("int").alias("start station id"),
        F.concat(F.lit("Station "), F.col("user_id").cast("string")).alias("start station name"),
        (F.col("user_id") + 1).cast("int").alias("end station id"),
        F.col("event_id").cast("int").alias("bikeid"),
        F.col("event_type").alias("usertype"),
        (F.lit(1950) + F.col("user_id") % 50).cast("int").alias("birth year"),
        (F.col("user_id") % 3).cast("int").alias("gender"),
    )


def part_spec_sheets(part: DataFrame) -> DataFrame:
    """Scraped-style spec sheets as JSON text, one per part.

    Shape: top-level lists and category objects of attribute -> list of
    strings, with abbreviated keys, newlines, a ``Brief`` block, an
    abbreviation with no expansion (``Pix. Density``) and a key collision
    (``Cam. Res.`` expands to the existing ``Camera Res.``).
    """
    price = F.round(F.col("p_retailprice") * 100).cast("bigint").cast("string")
    size = F.col("p_size").cast("string")
    sheet = F.struct(
        F.array(F.concat(F.lit("https://parts.example.com/p/"), F.col("p_partkey").cast("string"))).alias("url"),
        F.create_map(F.lit("Name"), F.array("p_name")).alias("Brief"),
        F.create_map(
            F.lit("Brand"), F.array("p_brand"),
            F.lit("Model"), F.array(F.concat(F.col("p_name"), F.lit("\n"))),
            F.lit("Sec. Type"), F.array("p_type"),
        ).alias("General"),
        F.create_map(
            F.lit("Min. Size"), F.array(size),
            F.lit("Equiv. Price"), F.array(price, F.lit("USD\n, ")),
            F.lit("Pix. Density"), F.array(F.lit("400 ppi")),
        ).alias("Size"),
        F.create_map(
            F.lit("Aux. Cam."), F.array("p_type", "p_brand"),
            F.lit("Cam. Res."), F.array(F.concat(size, F.lit("MP"))),
            F.lit("Camera Res."), F.array(F.concat(F.lit("\n"), size, F.lit(" MP"))),
        ).alias("Camera"),
    )
    return part.select(F.col("p_partkey").alias("doc_id"), F.to_json(sheet).alias("raw"))


# -------------------------------------------------------------- sales rows

def order_sales_rows(orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Sales-record rows (the 14 CSV columns), one per order.

    Money is decimal(18,2) computed in decimal arithmetic; dates are dates.
    Customer, nation and region are small lookups joined to the orders.
    """
    from sluice.operators.joins import lookup_join, small_enough

    nation, region = nation.select("n_nationkey", "n_name", "n_regionkey"), region.select("r_regionkey", "r_name")
    customer = customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    small = small_enough({"customer": customer, "nation": nation, "region": region})
    geo = lookup_join(nation, region, "n_regionkey", "r_regionkey", small=small["region"])
    cust = lookup_join(customer, geo, "c_nationkey", "n_nationkey", small=small["nation"])
    o = lookup_join(orders, cust, "o_custkey", "c_custkey", how="inner", small=small["customer"])
    units = (F.lit(1) + F.col("o_custkey") % 9).cast("int")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    cost = (price * F.lit(0.6).cast("decimal(1,1)")).cast("decimal(18,2)")
    revenue = (price * units).cast("decimal(18,2)")
    total_cost = (cost * units).cast("decimal(18,2)")
    return o.select(
        F.col("r_name").alias("Region"),
        F.col("n_name").alias("Country"),
        F.col("c_mktsegment").alias("Item Type"),
        F.when(F.col("o_orderstatus") == "O", "Online").otherwise("Offline").alias("Sales Channel"),
        F.substring("o_orderpriority", 3, 1).alias("Order Priority"),
        F.to_date("o_orderdate").alias("Order Date"),
        F.col("o_orderkey").alias("Order ID"),
        F.date_add(F.to_date("o_orderdate"), 14).alias("Ship Date"),
        units.alias("Units Sold"),
        price.alias("Unit Price"),
        cost.alias("Unit Cost"),
        revenue.alias("Total Revenue"),
        total_cost.alias("Total Cost"),
        (revenue - total_cost).cast("decimal(18,2)").alias("Total Profit"),
    )


def faulty_sales_lines(sales: DataFrame) -> DataFrame:
    """Sales rows as CSV text lines (one column, named as the header line), four in ten broken by the last digit of their
    order id: 0 a date that is none, 1 a word for the units, 2 the last field missing, 3 a field too many."""
    digit = F.col("Order ID") % 10
    date = lambda c: F.date_format(f"`{c}`", "M/d/yyyy")
    fields = [F.when(digit == 0, "13/45/2012").otherwise(date(c)) if c == "Order Date" else date(c) if c == "Ship Date"
              else F.when(digit == 1, "many").otherwise(F.col(f"`{c}`").cast("string")) if c == "Units Sold"
              else F.col(f"`{c}`").cast("string") for c in sales.columns]
    whole = F.concat_ws(",", *fields[:-1])
    line = F.when(digit == 2, whole).when(digit == 3, F.concat(whole, F.lit(","), fields[-1], F.lit(",x"))).otherwise(
        F.concat(whole, F.lit(","), fields[-1]))
    return sales.select(line.alias(",".join(sales.columns)))


# ------------------------------------------------------------- stored pages

def hard_pages(pages: DataFrame) -> DataFrame:
    """The stored pages' URLs with markup of the kinds that real pages have and patterns over the text get wrong: nested
    markup in list items, items and links without end tags, references in attributes, a base, and links that are none
    because they stand in comments, scripts, styles, templates or plain text. Every third page has no base."""
    n = F.col("page_id").cast("string")
    base = F.when(F.col("page_id") % 3 == 0, F.lit("")).otherwise(
        F.concat(F.lit('<base target=x><BASE href="/base'), n, F.lit('/sub/"><base href="/second/">')))
    return pages.select("page_id", "url", F.concat(
        F.lit('<!DOCTYPE html><HTML><head><title><a href="/title">t</a></title>'), base,
        F.lit("""<script>var s='<li><a href="/script">x</a></li>';</script><style>a{content:"<a href=/style>"}</style>
<!-- <li><a href="/comment">c</a></li> --></head><body><ul class=nav><li><b><a class="a>b" href="item"""), n,
        F.lit(""".html"><i>Item</i> &amp; """), n, F.lit("""</a></b>
<LI>text <a HREF='&#47;e"""), n, F.lit("""&lt;?a=1&amp;b=2#frag'>entity
<li data-x="<a href=/quoted>"><span><a href=unquoted?x="""), n, F.lit("""&copy=1 href=/twice>un</a></span>
<ol><li><a href="//cdn.example.org/./x/../"""), n, F.lit("""">deep</a></ol></ul>
<p><a href=" /sp
ace/"""), n, F.lit("""/.. ">outside</a> <a name=none>none</a> <template><li><a href="/template">t</a></li></template>
<a href="mailto:x@y.example">mail</a> <textarea><a href="/text"></textarea> <a href="#top">top</a> <a href="/open"""), n)
        .alias("html"))
