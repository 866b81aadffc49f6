"""Document-store shapes: normalised inspection tables, typed trips, and
cleaning of ragged scraped spec sheets.

Spec sheets are cleaned inside each row with Spark's higher-order map and
array functions (``map_filter``, ``transform``, ``filter``), so a document
never leaves its partition and there is no explode or shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.reshape import dense_index, empty_to_null, normalise_names

# ------------------------------------------------------------ inspections

ADDRESS_FIELDS = ["city", "zip", "street", "number"]


def normalise_inspections(docs: DataFrame, id_col: str = "_id", address_col: str = "address",
                          key: str = "index") -> tuple[DataFrame, DataFrame]:
    """Split inspection documents into a parent table and an address table.

    ``key='index'`` numbers documents 0..n-1 in ``id_col`` order (a
    distributed dense index); ``key='id'`` reuses ``id_col`` as the link.
    Returns ``(inspection, address)``: the parent without ``id_col`` and the
    nested address but with ``address_id`` and ``certificate_number`` as
    text; the address table with ``''`` as NULL.
    """
    if key == "index":
        keyed = dense_index(docs, [id_col], name="address_id")
    else:
        keyed = docs.withColumn("address_id", F.col(id_col))
    parent_cols = [c for c in docs.columns if c not in (id_col, address_col)]
    inspection = keyed.select(
        *[(F.col(c).cast("string").alias(c) if c == "certificate_number" else F.col(c)) for c in parent_cols],
        "address_id")
    address = keyed.select("address_id", *[F.col(f"{address_col}.{f}").cast("string").alias(f)
                                           for f in ADDRESS_FIELDS])
    return inspection, empty_to_null(address, ADDRESS_FIELDS)


def zips_table(zips: DataFrame, id_col: str = "_id", loc_col: str = "loc") -> DataFrame:
    """``_id`` -> ``zip`` (text), ``loc = [lon, lat]`` -> two columns."""
    return zips.select(
        F.col(id_col).cast("string").alias("zip"), "city", "state", "pop",
        F.get(F.col(loc_col), 1).alias("lat"), F.get(F.col(loc_col), 0).alias("lon"))


# ------------------------------------------------------------------ trips

def typed_trips(trips: DataFrame, time_cols: Sequence[str] = ("starttime", "stoptime"),
                text_cols: Sequence[str] = ("start_station_id", "end_station_id", "bikeid"),
                lenient: bool = False) -> DataFrame:
    """Normalise names (lower case, ``_`` for spaces), parse the time
    columns (fractional seconds kept), and store station and bike ids as text.
    A malformed time fails the job; with ``lenient`` it becomes NULL (count
    them with ``reshape.cast_rejects``)."""
    df = normalise_names(trips)
    out = []
    for c in df.columns:
        col = F.col(f"`{c}`")
        if c in time_cols:
            # Text straight to a zone-free timestamp: no session time zone is involved.
            col = col.try_cast("timestamp_ntz") if lenient else col.cast("timestamp_ntz")
        elif c in text_cols:
            col = col.cast("string")
        out.append(col.alias(c))
    return df.select(*out)


# ------------------------------------------------------------ spec sheets

# Abbreviation expansions applied, in this order, to attribute keys.
KEY_REPLACEMENTS = [
    ("Sec.", "Secondary"),
    ("Aux.", "Auxilary"),
    ("Auxilary4", "Auxilary 4"),
    ("Cam.", "Camera"),
    ("Min.", "Minimum"),
    ("Equiv.", "Equivalent"),
]
EXCLUDED_TOP_KEY = "Brief"
ABBREVIATED = r"\w..\."  # fixed value: what an abbreviated key looks like

_JSON_OPTS = {"allowUnquotedControlChars": "true"}


def _rename_key(k: Column) -> Column:
    for old, new in KEY_REPLACEMENTS:
        k = F.replace(k, F.lit(old), F.lit(new))
    return k


def _without_abbreviated(entries: Column) -> Column:
    """Entries whose expanded key is no abbreviated key of the sheet itself."""
    return F.filter(entries, lambda e: ~F.exists(entries, lambda o: o["key"].rlike(ABBREVIATED)
                                                 & (o["key"] == _rename_key(e["key"]))))


def _parsed_values(v: Column) -> Column:
    """JSON list text (or a bare scalar) to ``array<string>``."""
    return F.coalesce(F.from_json(v, "array<string>", _JSON_OPTS), F.array(v))


def _cleaned_values(arr: Column) -> Column:
    """A one-item list loses its newlines; items of a longer list lose
    ``"\\n, "`` and then newlines."""
    single = F.array(F.replace(F.get(arr, 0), F.lit("\n"), F.lit("")))
    many = F.transform(arr, lambda x: F.replace(F.replace(x, F.lit("\n, "), F.lit("")), F.lit("\n"), F.lit("")))
    return F.when(F.size(arr) == 1, single).otherwise(many)


def _last_per_key(entries: Column) -> Column:
    """Entries whose key does not occur again later: the later entry wins."""
    return F.filter(entries, lambda e, i: ~F.exists(
        F.slice(F.transform(entries, lambda x: x["key"]), i + 2, F.size(entries)), lambda k: k == e["key"]))


def is_spec_sheet(raw_col: str = "raw") -> Column:
    """True for text that is one JSON object; false for NULL, empty and malformed text."""
    return F.from_json(F.col(raw_col), "map<string,string>", _JSON_OPTS).isNotNull()


def malformed_sheets(raw: DataFrame, raw_col: str = "raw") -> DataFrame:
    """The rows ``clean_spec_sheet`` cannot read, unchanged: the reject output."""
    return raw.where(~is_spec_sheet(raw_col))


def clean_spec_sheet(raw: DataFrame, raw_col: str = "raw", keep: Sequence[str] = (),
                     on_malformed: str = "fail", legacy: bool = False) -> DataFrame:
    """Clean scraped spec sheets held as JSON text.

    Text that is not a JSON object fails the job (``on_malformed='fail'``)
    or is kept as a row of NULL maps (``'null'``); callers that store
    sheets route it to a reject output first, see ``malformed_sheets``.

    Top level: ``Brief`` is dropped; a list value becomes its first item
    (``fields``); an object is a category whose attribute keys are expanded
    (``Sec.`` -> ``Secondary`` ...) and whose values are cleaned lists
    (``specs``; a one-item list is the scalar case). Keys that look
    abbreviated but have no expansion are kept with their values; with
    ``legacy`` they are deleted, and with them a key that expands to such a
    name. When two keys expand to the same name the later entry
    wins.
    Output: ``keep + (fields map<string,string>, specs map<string,map<string,array<string>>>)``.

    The work is staged in successive projections so each JSON text is
    parsed once per row; nothing is exploded or shuffled.
    """
    keep = list(keep)
    is_obj = lambda v: F.ltrim(v).startswith("{")
    entries = _without_abbreviated if legacy else (lambda e: e)
    if on_malformed not in ("fail", "null"):
        raise ValueError(f"unknown on_malformed {on_malformed}")
    parsed = F.from_json(F.col(raw_col), "map<string,string>", _JSON_OPTS)
    if on_malformed == "fail":
        shown = F.coalesce(F.substring(raw_col, 1, 80), F.lit("NULL"))
        parsed = F.coalesce(parsed, F.raise_error(F.concat(F.lit("malformed spec sheet: "), shown)))
    top = raw.select(*keep, F.map_filter(parsed, lambda k, v: k != EXCLUDED_TOP_KEY).alias("__top"))
    split = top.select(
        *keep,
        F.transform_values(F.map_filter("__top", lambda k, v: ~is_obj(v)),
                           lambda k, v: F.coalesce(F.get(F.from_json(v, "array<string>", _JSON_OPTS), 0), v)
                           ).alias("fields"),
        F.transform_values(
            F.map_filter("__top", lambda k, v: is_obj(v)),
            lambda k, v: F.transform(entries(F.map_entries(F.from_json(v, "map<string,string>", _JSON_OPTS))),
                                     lambda e: F.struct(_rename_key(e["key"]).alias("key"),
                                                        _parsed_values(e["value"]).alias("arr")))
        ).alias("__cats"))
    cleaned = split.select(*keep, "fields", F.transform_values(
        "__cats", lambda k, es: F.transform(es, lambda e: F.struct(e["key"].alias("key"),
                                                                   _cleaned_values(e["arr"]).alias("value")))
    ).alias("__cats"))
    return cleaned.select(*keep, "fields", F.transform_values(
        "__cats", lambda k, es: F.map_from_entries(_last_per_key(es))).alias("specs"))


def spec_entries(clean: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Long form of cleaned sheets: ``keep + (category, attribute, value_index, value, n_values)``.

    Top-level fields have a NULL category and one value. One pass: both
    kinds of entry go into one array per row, exploded once.
    """
    keep = list(keep)
    tops = F.transform(F.map_entries("fields"), lambda f: F.struct(
        F.lit(None).cast("string").alias("category"), f["key"].alias("attribute"), F.array(f["value"]).alias("vals")))
    cats = F.flatten(F.transform(F.map_entries("specs"), lambda c: F.transform(
        F.map_entries(c["value"]), lambda a: F.struct(c["key"].alias("category"), a["key"].alias("attribute"),
                                                      a["value"].alias("vals")))))
    rows = clean.select(*keep, F.explode(F.concat(tops, cats)).alias("__e"))
    vals = rows.select(*keep, F.col("__e.category").alias("category"), F.col("__e.attribute").alias("attribute"),
                       F.size("__e.vals").alias("n_values"), F.posexplode("__e.vals").alias("value_index", "value"))
    return vals.select(*keep, "category", "attribute", "value_index", "value", "n_values")


def _json_string(value: Column) -> Column:
    """A text as a JSON string."""
    whole = F.to_json(F.array(value))
    return F.substring(whole, F.lit(2), F.length(whole) - 2)


def variant_sheets(clean: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Cleaned sheets as one VARIANT each (``keep + sheet``), in the shape in which documents are stored: top-level fields
    are strings, categories are objects, and an attribute is a string when it has one value and a list when it has more.
    """
    one = lambda v: F.when(F.size(v) == 1, _json_string(F.get(v, 0))).otherwise(F.to_json(v))
    fields = F.transform_values("fields", lambda k, v: F.parse_json(F.coalesce(_json_string(v), F.lit("null"))))
    specs = F.transform_values("specs", lambda k, attributes: F.to_variant_object(F.transform_values(
        attributes, lambda a, v: F.parse_json(F.coalesce(one(v), F.lit("null"))))))
    return clean.select(*keep, F.to_variant_object(F.map_concat(fields, specs)).alias("sheet"))


def variant_entries(sheets: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``keep + (category, attribute, kind, value)`` of VARIANT sheets: ``kind`` is the attribute's type as it is stored,
    ``value`` its JSON; top-level strings have no category."""
    keep = list(keep)
    tvf = sheets.sparkSession.tvf
    tops = (sheets.lateralJoin(tvf.variant_explode(F.col("sheet").outer()))
            .select(*keep, F.col("key").alias("__k"), F.col("value").alias("__v"), F.schema_of_variant("value").alias("__s")))
    nested = F.col("__s").startswith("OBJECT")
    flat = tops.where(~nested).select(*keep, F.lit(None).cast("string").alias("category"), F.col("__k").alias("attribute"),
                                      F.col("__s").alias("kind"), F.to_json("__v").alias("value"))
    deep = (tops.where(nested).lateralJoin(tvf.variant_explode(F.col("__v").outer()))
            .select(*keep, F.col("__k").alias("category"), F.col("key").alias("attribute"),
                    F.schema_of_variant("value").alias("kind"), F.to_json("value").alias("value")))
    return flat.unionByName(deep)


def sheet_schema(sheets: DataFrame) -> str:
    """The schema that all VARIANT sheets fit, found by one aggregate."""
    return sheets.agg(F.schema_of_variant_agg("sheet").alias("s")).first()["s"]
