"""Log-line parsing (batch and Structured Streaming) and the file-stream job.

``parse_log_lines`` is a pure ``DataFrame -> DataFrame`` function over a
``value: string`` column, so the same plan runs on ``spark.read.text`` and
on ``spark.readStream.text``. It is stateless: every micro-batch is parsed
independently, no watermark or state store is involved, and the file
sink's metadata log gives exactly-once output across restarts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The field patterns of the log format (Hadoop/log4j style lines
# such as "2015-10-17 18:14:59,542 INFO [main] org.apache.Foo: message").
TIMESTAMP_PATTERN = r"(\d{4}\-\d{2}-\d{2}\W\d{2}\:\d{2}\:\S.*?)\s"
PROCESS_PATTERN = r"\[(.*?)\]\s\w.*"
ACTION_PATTERN = r"\]\s(\w.*?)\:"
LEGACY_DESCRIPTION_PATTERN = r"\]\s\w.*?\:\W(\w.*)"
STATUS_SPLIT_LIMIT = 6
STATUS_TOKEN = 2

# Default description: the whole message after the action's own colon and one
# blank, if there is one; a message that starts with "(" or a second space, or
# right after the colon, is kept intact.
DESCRIPTION_PATTERN = r"\]\s\w.*?\:\s?(.*)"

# The CSV writer trims leading/trailing spaces unless told not to; a message
# may start with a space, so both sides keep them.
CSV_KEEP_SPACES = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

PARSED_FIELDS = ["timestamp", "status", "process", "action", "description"]
PARSED_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True) for n in PARSED_FIELDS])


def parse_log_lines(lines: DataFrame, value_col: str = "value", legacy: bool = False,
                    keep_unparsed: bool = False) -> DataFrame:
    """Split raw log lines into timestamp, status, process, action, description.

    Unmatched fields become NULL; lines without a timestamp (stack-trace
    continuation lines) are dropped unless ``keep_unparsed``.
    """
    v = F.col(value_col)
    desc_pattern = LEGACY_DESCRIPTION_PATTERN if legacy else DESCRIPTION_PATTERN
    parsed = lines.select(
        F.nullif(F.regexp_extract(v, TIMESTAMP_PATTERN, 1), F.lit("")).alias("timestamp"),
        F.nullif(F.get(F.split(v, " ", STATUS_SPLIT_LIMIT), STATUS_TOKEN), F.lit("")).alias("status"),
        F.nullif(F.regexp_extract(v, PROCESS_PATTERN, 1), F.lit("")).alias("process"),
        F.nullif(F.regexp_extract(v, ACTION_PATTERN, 1), F.lit("")).alias("action"),
        F.nullif(F.regexp_extract(v, desc_pattern, 1), F.lit("")).alias("description"),
    )
    if keep_unparsed:
        return parsed
    return parsed.dropna(how="any", subset=["timestamp"])


# Input of one micro-batch: bounds what a batch has to finish before its offsets are committed.
MAX_BYTES_PER_TRIGGER = 64 << 30


def file_stream(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None,
                max_bytes_per_trigger: int = MAX_BYTES_PER_TRIGGER, archive_dir: str | None = None,
                max_file_age: str | None = None) -> DataFrame:
    """Text files of a directory as a stream; a micro-batch takes so many bytes, or so many files if that is given.

    ``archive_dir``: files whose batch is done are moved there (below their own
    path), so that the listing does not grow for ever; it must not lie under
    ``input_dir``. ``max_file_age`` (``"7d"``): files so much older than the
    newest one are taken for done, which bounds what the stream remembers.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    else:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_file_age:
        reader = reader.option("maxFileAge", max_file_age)
    return reader.load(input_dir)


def read_log_stream(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """File-stream source over a directory of text files; each file is read once."""
    return file_stream(spark, input_dir, max_files_per_trigger)


def run_log_stream(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_dir: str,
                   max_files_per_trigger: int | None = None, legacy: bool = False,
                   available_now: bool = True, timeout_s: float | None = None):
    """Parse every new file under ``input_dir`` into a checkpointed CSV sink.

    With ``available_now`` the query drains what is present and stops, so a
    scheduled run (or a restart after a failure) resumes from the offsets
    in ``checkpoint_dir`` and writes no duplicates.
    """
    parsed = parse_log_lines(read_log_stream(spark, input_dir, max_files_per_trigger), legacy=legacy)
    writer = (parsed.writeStream.format("csv")
              .options(**CSV_KEEP_SPACES)
              .option("path", output_dir)
              .option("checkpointLocation", checkpoint_dir)
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")
    query = writer.start()
    if available_now:
        query.awaitTermination(timeout_s)
    return query


METRICS = "_metrics"  # a hidden folder: readers of the output skip it
METRIC_FIELDS = ("rows_read", "rows_parsed", "rows_dropped")


def _counted(parsed: DataFrame, name) -> DataFrame:
    """``parsed`` (unparsed lines kept) with its lines counted under the observation ``name`` while they pass."""
    return parsed.observe(name, F.count(F.lit(1)).alias("rows_read"), F.count_if(F.col("timestamp").isNotNull()).alias("rows_parsed"),
                          F.count_if(F.col("timestamp").isNull()).alias("rows_dropped"))


def run_counted_log_stream(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_dir: str,
                           max_files_per_trigger: int | None = None, legacy: bool = False, archive_dir: str | None = None,
                           max_file_age: str | None = None, timeout_s: float | None = None):
    """The log stream with its metrics: lines read, parsed and dropped by every micro-batch.

    Batch n writes ``batch_id=n/`` (CSV) and, in the same pass over its lines,
    its counts, which are stored as ``_metrics/batch_id=n/``. A batch that is
    replayed after a failure replaces both, so after a restart the metrics
    still say what the output holds. The same counts are in the query's
    progress (``lastProgress["observedMetrics"]["log_lines"]``).
    """
    lines = file_stream(spark, input_dir, max_files_per_trigger, archive_dir=archive_dir, max_file_age=max_file_age)
    parsed = _counted(parse_log_lines(lines, legacy=legacy, keep_unparsed=True), "log_lines")

    def store(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"batch-{batch_id}-{uuid.uuid4().hex}")
        (_counted(batch, seen).where(F.col("timestamp").isNotNull()).write.mode("overwrite").options(**CSV_KEEP_SPACES)
         .csv(f"{output_dir}/batch_id={batch_id}"))
        counts = seen.get
        row = batch.sparkSession.createDataFrame([tuple(counts[f] for f in METRIC_FIELDS)],
                                                 ", ".join(f"{f} long" for f in METRIC_FIELDS))
        row.coalesce(1).write.mode("overwrite").json(f"{output_dir}/{METRICS}/batch_id={batch_id}")

    query = (parsed.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint_dir)
             .trigger(availableNow=True).start())
    query.awaitTermination(timeout_s)
    return query


def read_stream_metrics(spark: SparkSession, output_dir: str) -> DataFrame:
    """(rows_read, rows_parsed, rows_dropped, batch_id) of every micro-batch."""
    schema = ", ".join([*[f"{f} long" for f in METRIC_FIELDS], "batch_id long"])
    return spark.read.schema(schema).json(f"{output_dir}/{METRICS}")


def read_parsed_logs(spark: SparkSession, output_dir: str) -> DataFrame:
    """Batch view of the CSV sink; only files committed in its metadata log are read."""
    return spark.read.schema(PARSED_SCHEMA).options(**CSV_KEEP_SPACES).csv(output_dir)
