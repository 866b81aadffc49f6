"""Auto-increment ids that go on from load to load.

A load takes a block of ids above every block of the table and notes it in the
commit that shows its rows, so ids are given exactly when rows are. A run that
is loaded again takes its own block: the same rows keep their ids. When another
writer takes the block first, the commit fails and the load numbers its rows
anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sluice.operators.reshape import dense_index
from sluice.sinks.versioned import ATTEMPTS, Version, commit, current, stage


def next_block(before: Version | None, run: str, start: int = 1) -> int:
    """First id of the run's block: its own if it has one, else above all blocks."""
    own = before.part(run) if before else None
    if own and own["rows"]:
        return own["first_id"]
    return max([start, *[p["first_id"] + p["rows"] for p in (before.parts if before else [])]])


def commit_numbered(df: DataFrame, path: str, order_by: Sequence[str], id_col: str = "id", run: str | None = None,
                    start: int = 1, finish=None) -> dict:
    """Append ``df`` as run ``run`` to the versioned table at ``path``, with ids in ``order_by`` order as first column.

    ``finish`` may change the numbered rows (checks, casts) before they are
    written. Returns the block: ``first_id`` and ``rows``. A run repeated with
    more rows than before needs a larger block: it gets one if its block is the
    table's last, and raises a ValueError otherwise.
    """
    spark, run = df.sparkSession, run or uuid.uuid4().hex
    for _ in range(ATTEMPTS):
        before = current(spark, path)
        first = next_block(before, run, start)
        numbered = dense_index(df, order_by, name=id_col, start=first).select(id_col, *[f"`{c}`" for c in df.columns])
        numbered = finish(numbered) if finish else numbered
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in numbered.schema.fields])
        part = stage(numbered, path, run, first_id=first)
        part["rows"] = spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{part['folder']}").count()  # from the footers

        def change(now: Version | None, part=part, schema=schema) -> Version | None:
            if next_block(now, run, start) != part["first_id"]:
                return None  # another writer has taken the block
            others = [p for p in now.parts if p["run"] != run] if now else []
            above = [p for p in others if p["first_id"] >= part["first_id"] and p["rows"]]
            if any(p["first_id"] < part["first_id"] + part["rows"] for p in above):
                raise ValueError(f"run {run} has more rows than its block of ids")
            return Version(0, schema, [*others, part])

        after = commit(spark, path, change)
        if after is not None and part in after.parts:
            return {"first_id": part["first_id"], "rows": part["rows"]}
    raise OSError(f"{path}: other writers were faster {ATTEMPTS} times")
