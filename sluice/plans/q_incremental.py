"""Incremental extraction queries.

Source: ``events`` (``event_id`` grows with ``ts``). Target: what a loader
that last ran on ``RUN_DATE`` holds, i.e. the events before that date.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sluice.operators.incremental import (
    batch_after,
    footer_mark,
    high_water_mark,
    id_range_batches,
    latest,
    mark_value,
    next_id_range,
    reconcile,
    resume_key,
)
from sluice.plans.catalog import register
from sluice.plans.tables import TABLES, Tables

RUN_DATE = "2024-01-16"
BATCH = 1000
KEY = "event_id"
EVENT_COLS = "event_id, ts, user_id, event_type, value, props"
_TARGET = f"(SELECT * FROM events WHERE ts < TIMESTAMP '{RUN_DATE} 00:00:00')"
_MARK = f"(SELECT max(event_id) FROM {_TARGET})"


def loaded_target(events):
    """The target as of the run date: every event stored before it."""
    return events.where(F.col("ts") < F.lit(RUN_DATE).cast("timestamp_ntz"))


@register("incremental_id_range", f"""
SELECT {EVENT_COLS}, CAST(floor((event_id - {_MARK} - 1) / {BATCH}) AS BIGINT) AS batch_id
FROM events WHERE event_id > {_MARK}
""")
def q_incremental_id_range(spark: SparkSession, sf_dir: str):
    """All rows past the target's high-water mark, tagged with their id-range batch."""
    ev = Tables(spark, sf_dir).events
    return id_range_batches(ev, KEY, mark_value(loaded_target(ev), KEY), BATCH)


@register("incremental_next_batch", f"""
SELECT {EVENT_COLS} FROM events
WHERE event_id BETWEEN {_MARK} + 1 AND {_MARK} + {BATCH}
""")
def q_incremental_next_batch(spark: SparkSession, sf_dir: str):
    """One extraction run: ids ``mark+1 .. mark+batch`` (a pushed-down range filter)."""
    ev = Tables(spark, sf_dir).events
    return next_id_range(ev, KEY, mark_value(loaded_target(ev), KEY), BATCH)


@register("reconcile_counts", f"""
SELECT s.n AS source_rows, t.n AS target_rows,
       CASE WHEN t.n = s.n THEN 'up to date' WHEN t.n < s.n THEN 'load' ELSE 'target ahead' END AS status,
       greatest(s.n - t.n, 0) AS pending_rows
FROM (SELECT count(*) AS n FROM events) s, (SELECT count(*) AS n FROM {_TARGET}) t
""")
def q_reconcile_counts(spark: SparkSession, sf_dir: str):
    """Source vs target row counts and the resulting action."""
    ev = Tables(spark, sf_dir).events
    return reconcile(ev, loaded_target(ev))


@register("high_water_mark", "SELECT max(o_orderkey) AS high_water_mark FROM orders")
def q_high_water_mark(spark: SparkSession, sf_dir: str):
    """Latest id of a stored table (``max``; no sort)."""
    return high_water_mark(Tables(spark, sf_dir).orders, "o_orderkey")



@register("stored_mark", "SELECT max(o_orderkey) AS high_water_mark FROM orders")
def q_stored_mark(spark: SparkSession, sf_dir: str):
    """Latest id of a stored Parquet table, from its footers: no column is read."""
    return footer_mark(spark, f"{sf_dir.rstrip('/')}/orders.parquet", "o_orderkey")


@register("row_count", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES))
def q_row_count(spark: SparkSession, sf_dir: str):
    """Row count of each table."""
    t = Tables(spark, sf_dir)
    parts = [getattr(t, name).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count") for name in TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("batch_first", f"SELECT {EVENT_COLS} FROM events ORDER BY event_id LIMIT {BATCH}")
def q_batch_first(spark: SparkSession, sf_dir: str):
    """First extraction with no resume key: the first ``n`` documents by key."""
    return batch_after(Tables(spark, sf_dir).events, KEY, None, BATCH)


@register("batch_half", f"SELECT {EVENT_COLS} FROM events ORDER BY event_id LIMIT (SELECT count(*) // 2 FROM events)")
def q_batch_half(spark: SparkSession, sf_dir: str):
    """A first batch of half the table: its last key is found by counting, its rows are a filter."""
    ev = Tables(spark, sf_dir).events
    return batch_after(ev, KEY, None, ev.count() // 2)


@register("batch_after_id", f"""
SELECT {EVENT_COLS} FROM events WHERE event_id > {_MARK} ORDER BY event_id LIMIT {BATCH}
""")
def q_batch_after_id(spark: SparkSession, sf_dir: str):
    """The next ``n`` documents after the last stored key (a filter up to the n-th key, no sort)."""
    ev = Tables(spark, sf_dir).events
    return batch_after(ev, KEY, mark_value(loaded_target(ev), KEY), BATCH)


@register("source_is_current", f"""
SELECT {EVENT_COLS}, event_id = {_MARK} AS is_current
FROM events WHERE event_id = (SELECT max(event_id) FROM events)
""")
def q_source_is_current(spark: SparkSession, sf_dir: str):
    """Latest source document, and whether the target already holds it."""
    ev = Tables(spark, sf_dir).events
    mark = mark_value(loaded_target(ev), KEY)
    return latest(ev, KEY).withColumn("is_current", F.coalesce(F.col(KEY) == F.lit(mark), F.lit(False)))


@register("resume_key", f"""
SELECT max(event_id) AS resume_key FROM events
WHERE CAST(ts AS DATE) = DATE '{RUN_DATE}' - INTERVAL 1 DAY
""")
def q_resume_key(spark: SparkSession, sf_dir: str):
    """Last key of the previous day's batch: where today's extraction resumes."""
    return resume_key(Tables(spark, sf_dir).events, KEY, "ts", RUN_DATE)
