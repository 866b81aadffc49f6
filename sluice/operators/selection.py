"""The n-th key of a table, found by counting.

``orderBy(key).limit(n)`` sorts its n rows in one task, and skipping k batches
that way costs k scans. Here the key is found first, exactly: a round splits
the range that still holds it by pivots, counts the rows of every piece in one
aggregate, and goes on in the one piece. What the driver sees is a few
thousand keys and counts a round, whatever n is; a round over range k reads
the key column of that range only (the range is a pushed-down filter). The
rows themselves are then a plain filter ``key <= n-th key``, in as many tasks
as the table has.

Pivots are picked by a hash of the key, so they are spread as the distinct
keys are, for any orderable type; a key that repeats, however often, is one
pivot. With p pivots a round leaves about 1 / p of the distinct keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIVOTS = 64
ROUNDS = 200  # a guard: every round takes at least one distinct key off the range


def _literal(value, kind: T.DataType) -> Column:
    return F.lit(value).cast(kind)


def _piece(key: Column, pivots: list, kind: T.DataType) -> Column:
    """Number of pivots below the key: piece i holds the keys in (pivot i - 1, pivot i]."""
    total = F.lit(0)
    for p in pivots:
        total = total + (key > _literal(p, kind)).cast("int")
    return total


def nth_key(rows: DataFrame, key: str, n: int, pivots: int = PIVOTS):
    """The smallest key that at least ``n`` rows do not exceed, or None when fewer than ``n`` rows have a key.

    Rows whose key is null are not counted.
    """
    if n < 1:
        raise ValueError("counting starts at 1")
    kind = rows.schema[key].dataType
    keys = rows.select(F.col(f"`{key}`").alias("k")).where("k is not null")
    left, low, high, marks = n, None, None, []
    for turn in range(ROUNDS):
        part = keys
        if low is not None:
            part = part.where(F.col("k") > _literal(low, kind))
        if high is not None:
            part = part.where(F.col("k") <= _literal(high, kind))
        # Per piece: its rows, its ends, and (by hash) some of its keys as the next round's pivots.
        spot = F.xxhash64(F.col("k"), F.lit(turn))
        found = (part.groupBy(_piece(F.col("k"), marks, kind).alias("piece"), F.pmod(spot, F.lit(pivots)).alias("slot"))
                 .agg(F.count(F.lit(1)).alias("n"), F.min_by("k", F.struct(spot, "k")).alias("pick"), F.min("k").alias("lo"),
                      F.max("k").alias("hi"))
                 .orderBy("piece", "pick").collect())  # at most (pivots + 1) * pivots rows, sorted as Spark sorts
        at, chosen = None, []
        for piece in sorted({r["piece"] for r in found}):
            here = [r for r in found if r["piece"] == piece]
            size = sum(r["n"] for r in here)
            if left <= size:
                at, chosen = piece, here
                break
            left -= size
        if at is None:
            return None  # only in the first round: all rows are fewer than n
        low = marks[at - 1] if at > 0 else low
        high = marks[at] if at < len(marks) else high
        if len(chosen) == 1 and chosen[0]["lo"] == chosen[0]["hi"]:
            return chosen[0]["lo"]
        # The smallest key is a pivot too: a piece of its own, so that every round comes closer.
        least = _least(chosen, kind)
        marks = [least, *[r["pick"] for r in chosen if r["pick"] != least]]
    raise RuntimeError(f"no end after {ROUNDS} rounds")


def _least(found: list, kind: T.DataType):
    """The smallest of the rows' ``lo``. Python and Spark agree on the order of what is compared here but for NaN,
    which Spark puts last."""
    values = [r["lo"] for r in found]
    numbers = [v for v in values if v == v]
    return min(numbers) if numbers else values[0]


def first_rows(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` rows in the order of ``key`` (null keys first), as a filter.

    Rows that share the n-th row's key come with it: a batch that resumes after this key would never see them.
    """
    column = F.col(f"`{key}`")
    if n < 1:
        return rows.limit(0)
    nulls = rows.where(column.isNull()).count()
    if n <= nulls:
        return rows.where(column.isNull())
    last = nth_key(rows, key, n - nulls)
    if last is None:
        return rows
    bound = column <= _literal(last, rows.schema[key].dataType)
    return rows.where(bound | column.isNull()) if nulls else rows.where(bound)
