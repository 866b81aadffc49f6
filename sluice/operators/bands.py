"""Band dimensions parsed from a Variable / Value / Meaning reference table.

A band row maps a code (``Value``) to a range written as text
(``Meaning``): ``"6%-19%"``, ``"-7 to -5"``, ``"0.3-3.4m/s (light)"``,
``"Below 0.3m/s"``, ``"Over 11"``. ``band_dimension`` turns the rows of one
variable into ``(code, [description,] min, max)``; all parsing is Spark
string functions on the rows, and the first and last band are found by
code, not by row position.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import before_last_token, btrim_chars, last_token

FIRST_MARKERS = r"(?i)^\s*(below|under|less than|<)"
LAST_MARKERS = r"(?i)^\s*(over|above|more than|>)"
NUMBER = r"(-?\d+(?:\.\d+)?)"
NO_BOUND = r"(?i)^\s*(none|nan|n/a)?\s*$"  # text that says there is no bound, as in "None"


@dataclass(frozen=True)
class BandSpec:
    """How one variable's Meaning text is read.

    ``split``: ``"-"`` splits ``min-max``; ``"words"`` takes the first and
    third whitespace token (``"-7 to -5"``). ``unit``: characters stripped
    from both ends of each bound (Python ``str.strip`` semantics).
    ``with_description``: the last token is a description in brackets.
    ``fill``: value for a bound that is missing. ``first`` / ``last``:
    ``(min, max)`` overrides for the lowest / highest code; ``None`` keeps
    the parsed value and ``"min"`` / ``"max"`` copy the other bound.
    """

    name: str
    variable: str
    split: str = "-"
    unit: str = ""
    dtype: str = "int"
    with_description: bool = False
    description_chars: str = "(+)"
    fill: float | int | None = None
    first: tuple = (None, None)
    last: tuple = (None, None)


# The six weather band dimensions, their variables, units,
# fill values and the bounds of their open-ended first and last bands.
DIM_CLOUD = BandSpec("cloud", "Cloud Cover", split="-", unit="%", dtype="int")
DIM_LIFTED_INDEX = BandSpec("lifted_index", "Lifted Index", split="words", dtype="int", fill=11,
                            first=("null", -7), last=(11, None))
DIM_LIFTED_INDEX_LEGACY = BandSpec("lifted_index", "Lifted Index", split="words", dtype="int", fill=11,
                                   first=(0, -7), last=(11, None))
DIM_RH = BandSpec("rh", "Relative Humidity", split="-", unit="%", dtype="int", fill=100, last=(99, None))
DIM_WIND_SPEED = BandSpec("wind_speed", "Wind Speed", split="-", unit="m/s", dtype="double",
                          with_description=True, fill=0.3, first=(0, None), last=(55.9, 55.9))
DIM_PREC_AMOUNT = BandSpec("prec_amount", "Precipitation Amount", split="-", unit="mm/hr", dtype="double",
                           fill=0, first=(0, None), last=(75, 75))
DIM_SNOW_DEPTH = BandSpec("snow_depth", "Snow Depth", split="-", unit="cm", dtype="double",
                          fill=0, first=(0, None), last=(250, 250))
WEATHER_BANDS = {
    "DIM_cloud": DIM_CLOUD,
    "DIM_lifted_index": DIM_LIFTED_INDEX,
    "DIM_rh": DIM_RH,
    "DIM_wind_speed": DIM_WIND_SPEED,
    "DIM_prec_amount": DIM_PREC_AMOUNT,
    "DIM_snow_depth": DIM_SNOW_DEPTH,
}


def _bound(text: Column, unit: str, dtype: str) -> Column:
    t = F.trim(text)
    if unit:
        t = btrim_chars(t, unit)
    return t.try_cast(dtype)


def _checked(value: Column, text: Column, allowed: Column, lenient: bool) -> Column:
    """``value``, parsed from ``text``; text that is no number fails the job unless ``allowed`` or ``lenient``."""
    if lenient:
        return value
    bad = text.isNotNull() & value.isNull() & ~text.rlike(NO_BOUND) & ~F.coalesce(allowed, F.lit(False))
    return F.when(bad, F.raise_error(F.concat(F.lit("no number in a band table: "), text))).otherwise(value)


def _override(value, parsed: Column, other: Column, dtype: str) -> Column:
    if value is None:
        return parsed
    if value == "null":
        return F.lit(None).cast(dtype)
    if value in ("min", "max"):
        return other
    return F.lit(value).cast(dtype)


def band_dimension(table: DataFrame, spec: BandSpec, variable_col: str = "Variable",
                   code_col: str = "Value", meaning_col: str = "Meaning",
                   rows: tuple[int, int] | None = None, position_col: str = "row_idx",
                   ends: tuple[int | None, int | None] | None = None, lenient: bool = False) -> DataFrame:
    """Rows of one variable to ``(<name>, [description,] min, max)``.

    The rows are those of the spec's variable, or with ``rows`` the block of
    positions ``rows[0] .. rows[1] - 1`` whatever their variable is called.
    ``ends`` passes in the lowest and highest code when they are known (see
    ``weather_band_dimensions``, which finds all variables' ends in one job).

    A code or bound that is text but no number fails the job; ``lenient``
    makes it NULL, and so the fill value if the spec has one. A bound that is
    missing, or says so ("None"), is the fill value either way.
    """
    if rows is None:
        block = table.filter(F.col(variable_col) == spec.variable)
    else:
        block = table.filter(F.col(position_col).between(rows[0], rows[1] - 1))
    meaning = F.trim(F.col(meaning_col))
    if spec.with_description:
        desc = btrim_chars(last_token(meaning), spec.description_chars)
        ranged = before_last_token(meaning)
    else:
        desc = None
        ranged = meaning
    if spec.split == "words":
        parts = F.split(F.trim(ranged), r"\s+")
        lo_txt, hi_txt = F.get(parts, 0), F.get(parts, 2)
    else:
        parts = F.split(ranged, spec.split, 2)
        lo_txt, hi_txt = F.get(parts, 0), F.get(parts, 1)
    lo, hi = _bound(lo_txt, spec.unit, spec.dtype), _bound(hi_txt, spec.unit, spec.dtype)
    # "Below X" / "Over X": a one-sided band whose number sits in the first part.
    side_num = F.regexp_extract(ranged, NUMBER, 1).try_cast(spec.dtype)
    is_below = ranged.rlike(FIRST_MARKERS) & lo.isNull()
    is_over = ranged.rlike(LAST_MARKERS) & lo.isNull()
    sided = (is_below | is_over) & side_num.isNotNull()
    lo2 = F.when(is_over, side_num).otherwise(_checked(lo, lo_txt, sided, lenient))
    hi2 = F.when(is_below, side_num).otherwise(_checked(hi, hi_txt, sided, lenient))
    code = _checked(F.col(code_col).try_cast("int"), F.col(code_col).cast("string"), F.lit(False), lenient)
    staged = block.select(code.alias("__code"), desc.alias("__desc") if desc is not None else F.lit(None).alias("__desc"),
                         lo2.alias("__lo"), hi2.alias("__hi"))
    if spec.fill is not None:
        staged = staged.fillna({"__lo": spec.fill, "__hi": spec.fill})
    if ends is None:  # two scalars from one aggregate row
        ends = tuple(staged.agg(F.min("__code"), F.max("__code")).first())
    is_first, is_last = F.col("__code") == F.lit(ends[0]), F.col("__code") == F.lit(ends[1])
    lo_c, hi_c = F.col("__lo"), F.col("__hi")
    lo_out = F.when(is_first, _override(spec.first[0], lo_c, hi_c, spec.dtype)).otherwise(lo_c)
    hi_out = F.when(is_first, _override(spec.first[1], hi_c, lo_c, spec.dtype)).otherwise(hi_c)
    lo_out2 = F.when(is_last, _override(spec.last[0], lo_out, hi_out, spec.dtype)).otherwise(lo_out)
    hi_out2 = F.when(is_last, _override(spec.last[1], hi_out, lo_out, spec.dtype)).otherwise(hi_out)
    cols = [F.col("__code").alias(spec.name)]
    if spec.with_description:
        cols.append(F.col("__desc").alias("description"))
    cols += [lo_out2.cast(spec.dtype).alias("min"), hi_out2.cast(spec.dtype).alias("max")]
    return staged.select(*cols)


def weather_band_dimensions(table: DataFrame, legacy: bool = False, lenient: bool = False) -> dict[str, DataFrame]:
    """All six weather dimensions from one reference table; the ends of all variables are one grouped aggregate."""
    specs = dict(WEATHER_BANDS)
    if legacy:
        specs["DIM_lifted_index"] = DIM_LIFTED_INDEX_LEGACY
    code = F.col("Value").try_cast("int")
    variables = [s.variable for s in specs.values()]  # at most one row each comes back
    ends = {r["Variable"]: (r["first"], r["last"]) for r in table.where(F.col("Variable").isin(variables))
            .groupBy("Variable").agg(F.min(code).alias("first"), F.max(code).alias("last")).collect()}
    return {name: band_dimension(table, spec, ends=ends.get(spec.variable, (None, None)), lenient=lenient)
            for name, spec in specs.items()}
