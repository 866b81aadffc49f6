"""Log parsing queries: batch parse and the checkpointed file stream."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sluice.plans.catalog import register
from sluice.plans.derive import event_log_lines
from sluice.plans.tables import Tables
from sluice.session import scratch_path, spread
from sluice.streaming.logs import (
    parse_log_lines,
    read_parsed_logs,
    read_stream_metrics,
    run_counted_log_stream,
    run_log_stream,
)

EVENT_LOG_SQL = r"""
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') || ',' ||
         lpad(CAST((epoch_us(ts) % 1000000) // 1000 AS VARCHAR), 3, '0') AS "timestamp",
       CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS status,
       'user-' || CAST(user_id AS VARCHAR) AS process,
       'app.' || upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) || 'Handler' AS action,
       props || ' cents=' || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS description
FROM events
"""


@register("log_parse", EVENT_LOG_SQL)
def log_parse(spark: SparkSession, sf_dir: str):
    """Render every event as a log line (plus stack-trace lines), parse, drop unparsed."""
    return parse_log_lines(event_log_lines(spread(Tables(spark, sf_dir).events)))


@register("log_stream", EVENT_LOG_SQL)
def log_stream(spark: SparkSession, sf_dir: str):
    """The same parse as a Structured Streaming job with a CSV sink.

    The rendered lines are written as text files, drained by an
    ``availableNow`` file stream in micro-batches of bounded bytes, then the
    query is started a second time on the same checkpoint: it finds no new
    files and appends nothing, so the sink holds each line exactly once.
    """
    base = scratch_path(spark, "log_stream")
    in_dir, out_dir, ckpt = f"{base}/in", f"{base}/out", f"{base}/checkpoint"
    event_log_lines(spread(Tables(spark, sf_dir).events)).write.mode("overwrite").text(in_dir)
    for _ in range(2):
        run_log_stream(spark, in_dir, out_dir, ckpt)
    return read_parsed_logs(spark, out_dir)


@register("log_metrics", """
SELECT CAST(count(*) + count(*) FILTER (event_type = 'error') AS BIGINT) AS rows_read, CAST(count(*) AS BIGINT) AS rows_parsed,
       CAST(count(*) FILTER (event_type = 'error') AS BIGINT) AS rows_dropped
FROM events
""")
def log_metrics(spark: SparkSession, sf_dir: str):
    """Lines read, parsed and dropped, as the stream counted them batch by batch; its files are archived, and the query is
    started once more and finds nothing."""
    base = scratch_path(spark, "log_metrics")
    event_log_lines(spread(Tables(spark, sf_dir).events)).write.mode("overwrite").text(f"{base}/in")
    for _ in range(2):
        run_counted_log_stream(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", max_files_per_trigger=3,
                               archive_dir=f"{base}/archive")
    return read_stream_metrics(spark, f"{base}/out").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows_read", "rows_parsed", "rows_dropped")])
