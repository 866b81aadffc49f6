"""Star-schema and lookup joins with a size-checked broadcast.

A dimension is broadcast only after its size was measured: rows and bytes of
the projected columns, by a partial aggregate that sends one row per task.
Above the bound the join is left to the planner: a shuffled sort-merge join
whose skewed partitions AQE splits at run time
(``spark.sql.adaptive.skewJoin.enabled``), so a fact key that holds a third of
all rows is spread over many tasks instead of one. Large facts that meet the
same large dimension again and again are best stored beside it
(``sinks.colocated``), which needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import materialize

# Bytes a dimension's projected columns may hold to be broadcast.
DEFAULT_MAX_BROADCAST_BYTES = 32 << 20
ROW_BYTES = 16  # what a row takes beside its values
JOINS = ("inner", "left", "left_outer", "leftouter", "left_semi", "leftsemi", "left_anti", "leftanti")


def _width(df: DataFrame) -> Column:
    """Bytes of a row: fixed widths, and the measured length of text and of anything nested (as JSON)."""
    total = F.lit(ROW_BYTES)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            total = total + F.coalesce(F.octet_length(c), F.lit(0)) + 8
        elif isinstance(f.dataType, T.BinaryType):
            total = total + F.coalesce(F.length(c), F.lit(0)) + 8
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 8
        else:
            total = total + 8
    return total


def measured_bytes(dfs: dict[str, DataFrame]) -> dict[str, int]:
    """Bytes of several DataFrames in one job (a partial aggregate: one row per task)."""
    parts = [df.agg(F.coalesce(F.sum(_width(df).cast("long")), F.lit(0)).alias("n")).select(F.lit(name).alias("name"), "n")
             for name, df in dfs.items()]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return {r["name"]: r["n"] for r in union.collect()}


def small_enough(dfs: dict[str, DataFrame], max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> dict[str, bool]:
    """For each DataFrame, whether its measured bytes allow a broadcast."""
    return {name: n <= max_bytes for name, n in measured_bytes(dfs).items()}


def fits_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` holds at most ``max_bytes``, measured."""
    return small_enough({"df": df}, max_bytes)["df"]


def checked_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                      small: bool | None = None) -> DataFrame:
    """``broadcast(df)`` when its size is proven small, else ``df`` unchanged.

    ``small`` passes in a check already made (see ``small_enough``).
    """
    if small is None:
        small = fits_broadcast(df, max_bytes)
    return F.broadcast(df) if small else df


def _check_how(how: str) -> None:
    if how not in JOINS:
        raise ValueError(f"a lookup join is one of {', '.join(JOINS)}, not {how}")


def lookup_join(fact: DataFrame, dim: DataFrame, fact_key: str | Sequence[str], dim_key: str | Sequence[str],
                how: str = "left", max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                drop_dim_key: bool = True, small: bool | None = None) -> DataFrame:
    """Join a fact to a dimension on ``fact_key = dim_key`` (left by default).

    The dimension key is dropped from the output so role-playing joins of
    the same dimension do not clash. Joins that keep unmatched dimension
    rows are refused: a fact lookup has none.
    """
    _check_how(how)
    fk = [fact_key] if isinstance(fact_key, str) else list(fact_key)
    dk = [dim_key] if isinstance(dim_key, str) else list(dim_key)
    d = checked_broadcast(dim, max_broadcast_bytes, small)
    cond = [fact[a] == d[b] for a, b in zip(fk, dk)]
    joined = fact.join(d, cond, how)
    if drop_dim_key and how not in ("left_anti", "left_semi", "leftanti", "leftsemi"):
        for b in dk:
            if b not in fk:
                joined = joined.drop(d[b])
    return joined


def role(dim: DataFrame, renames: dict[str, str]) -> DataFrame:
    """One role of a role-playing dimension: the same table under new column names."""
    return dim.select(*[F.col(src).alias(dst) for src, dst in renames.items()])


def anti_join(candidates: DataFrame, ledger: DataFrame, on: str | Sequence[str],
              max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Rows of ``candidates`` whose key is not in ``ledger`` (NOT EXISTS)."""
    keys = [on] if isinstance(on, str) else list(on)
    return candidates.join(checked_broadcast(ledger.select(*keys), max_broadcast_bytes), keys, "left_anti")


def hot_keys(df: DataFrame, key: str, min_rows: int, max_keys: int = 10_000) -> list:
    """The keys holding at least ``min_rows`` rows, hottest first, at most ``max_keys`` of them.

    The bound limits what comes to the driver; a join that salts fewer keys
    gives the same rows.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= min_rows)
    return [r[key] for r in counts.orderBy(F.col("__n").desc(), key).limit(max_keys).collect()]


def salted_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, hot: list,
                buckets: int = 16, how: str = "left") -> DataFrame:
    """Shuffled equi-join that splits hot keys over ``buckets`` sub-keys.

    Fact rows of a hot key get a random salt of their own, equal rows too;
    the salted fact is written once, so a retried task sees the same salts.
    Dimension rows of a hot key are replicated once per salt. Other keys keep
    salt 0. For skew AQE cannot split on its own (a skewed build side, or
    when the skew must be bounded before run time); results equal the plain
    join.
    """
    _check_how(how)
    if not hot:
        return lookup_join(fact, dim, fact_key, dim_key, how=how, small=False)
    salt = F.when(F.col(fact_key).isin(hot), F.floor(F.rand(17) * buckets)).otherwise(0).cast("int")
    salted_fact = materialize(fact.withColumn("__salt", salt), "salted_fact")
    salts = F.when(F.col(dim_key).isin(hot), F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))
    salted_dim = dim.withColumn("__salt", F.explode(salts))
    cond = (salted_fact[fact_key] == salted_dim[dim_key]) & (salted_fact["__salt"] == salted_dim["__salt"])
    joined = salted_fact.join(salted_dim, cond, how)
    out = joined.drop(salted_fact["__salt"]).drop(salted_dim["__salt"])
    if dim_key != fact_key and how not in ("left_anti", "left_semi", "leftanti", "leftsemi"):
        out = out.drop(salted_dim[dim_key])
    return out
