"""Tables that are never missing and loads that may be repeated.

A table at ``path`` is a list of data folders below ``path/_data`` and commits
below ``path/_commits``. Commit n is one small file that names the folders of
version n; it is written under another name and renamed into place, which is
the moment the version exists. Readers take the newest commit. Whatever a load
did before that rename is seen by nobody, and the versions before stay
readable, so a crash at any step leaves the old table or the new one.

A load carries the id of its run. Repeating a run replaces the folder it
appended, so a run that failed half way, or whose success was not noticed, is
simply started again. A star's run ends with a commit of its own, beside the
tables, that names the version of each table: readers of the star see a fact
only together with the dimensions of its run.

Two writers that reach for the same number do not overwrite each other where
the file system refuses to rename onto an existing file (HDFS does in one
step; the local one checks first): the later one builds its version again on
the other's. Object stores without such a rename need one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sluice.sinks.writers import WRITE_APPEND, WRITE_EMPTY, WRITE_TRUNCATE, is_empty, table_path, write_parquet

ATTEMPTS = 20


@dataclass
class Version:
    """What a commit says: the table's schema, its parts (folder, run, and what the load noted), and its own number."""
    number: int
    schema: T.StructType
    parts: list[dict] = field(default_factory=list)

    def part(self, run: str) -> dict | None:
        return next((p for p in self.parts if p["run"] == run), None)


# ---------------------------------------------------------------- commits

def _hadoop(spark: SparkSession):
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs, jvm, spark.sparkContext._jsc.hadoopConfiguration()


def _filesystem(spark: SparkSession, path: str):
    fs, _, conf = _hadoop(spark)
    return fs.Path(path).getFileSystem(conf)


def _children(spark: SparkSession, folder: str) -> list:
    fs, _, _ = _hadoop(spark)
    system = _filesystem(spark, folder)
    return list(system.listStatus(fs.Path(folder))) if system.exists(fs.Path(folder)) else []


def commit_numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the commits in ``folder``, ascending."""
    names = [s.getPath().getName() for s in _children(spark, folder)]
    return sorted(int(n) for n in names if n.isdigit())


def read_commit(spark: SparkSession, folder: str, number: int) -> dict:
    fs, jvm, _ = _hadoop(spark)
    stream = _filesystem(spark, folder).open(fs.Path(f"{folder}/{number:020d}"))
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def publish(spark: SparkSession, folder: str, number: int, content: dict) -> bool:
    """Make ``content`` commit ``number`` of ``folder``; False if another writer has taken the number."""
    fs, jvm, conf = _hadoop(spark)
    at, beside = fs.Path(f"{folder}/{number:020d}"), fs.Path(f"{folder}/.new-{uuid.uuid4().hex}")
    system = _filesystem(spark, folder)
    stream = system.create(beside, False)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    gateway = spark.sparkContext._gateway
    plain = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)  # without OVERWRITE
    try:
        fs.FileContext.getFileContext(system.getUri(), conf).rename(
            system.makeQualified(beside), system.makeQualified(at), plain)
    except Exception as e:  # noqa: BLE001 - a Java exception
        if "FileAlreadyExists" not in str(e):
            raise
        system.delete(beside, False)
        return False
    return True


# ----------------------------------------------------------------- tables

def _commits(path: str) -> str:
    return f"{path.rstrip('/')}/_commits"


def current(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The newest version of the table at ``path`` (or version ``number``); None if there is none."""
    if number is None:
        numbers = commit_numbers(spark, _commits(path))
        if not numbers:
            return None
        number = numbers[-1]
    said = read_commit(spark, _commits(path), number)
    return Version(number, T.StructType.fromJson(said["schema"]), said["parts"])


def read_version(spark: SparkSession, path: str, version: Version) -> DataFrame:
    folders = [f"{path.rstrip('/')}/{p['folder']}" for p in version.parts]
    if not folders:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).parquet(*folders)


def read_table(spark: SparkSession, path: str, number: int | None = None) -> DataFrame | None:
    """The table as of its newest version (or version ``number``), or None when it does not exist."""
    version = current(spark, path, number)
    return None if version is None else read_version(spark, path, version)


def commit(spark: SparkSession, path: str, change: Callable[[Version | None], Version | None]) -> Version | None:
    """Publish what ``change`` makes of the newest version (None: leave it), again if another writer was faster."""
    for _ in range(ATTEMPTS):
        before = current(spark, path)
        after = change(before)
        if after is None:
            return before
        after.number = before.number + 1 if before else 1
        if publish(spark, _commits(path), after.number, {"schema": after.schema.jsonValue(), "parts": after.parts}):
            return after
    raise OSError(f"{path}: other writers were faster {ATTEMPTS} times")


def _names(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def stage(df: DataFrame, path: str, run: str, compression: str | None = None, **notes) -> dict:
    """Write ``df`` to a folder of its own below the table; nobody sees it before a commit names it."""
    part = {"folder": f"_data/{uuid.uuid4().hex}", "run": run, **notes}
    write_parquet(df, f"{path.rstrip('/')}/{part['folder']}", compression=compression, mode="errorifexists")
    return part


def commit_load(df: DataFrame, path: str, disposition: str = WRITE_APPEND, run: str | None = None,
                compression: str | None = None, **notes) -> str:
    """Load ``df`` as run ``run`` (a new one by default); ``'loaded'`` or ``'skipped'``.

    ``WRITE_APPEND`` adds a part, or replaces the one an earlier attempt of
    the same run added; ``WRITE_TRUNCATE`` makes it the only part;
    ``WRITE_EMPTY`` does so where the table is missing, has no rows, or holds
    what this run loaded. Other runs' parts are never touched by an append. An
    append must have the table's columns and types.
    """
    spark, run = df.sparkSession, run or uuid.uuid4().hex
    if disposition not in (WRITE_APPEND, WRITE_TRUNCATE, WRITE_EMPTY):
        raise ValueError(f"unknown disposition {disposition}")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])

    def check(before: Version | None) -> bool:
        if disposition == WRITE_APPEND and before and _names(before.schema) != _names(schema):
            raise ValueError(f"{path} holds {before.schema.simpleString()}, not {schema.simpleString()}")
        # Only what other runs loaded keeps a load-if-empty away.
        others = [p for p in before.parts if p["run"] != run] if before else []
        return not (disposition == WRITE_EMPTY and others
                    and not is_empty(read_version(spark, path, Version(before.number, before.schema, others))))

    if not check(current(spark, path)):
        return "skipped"
    part = stage(df, path, run, compression, **notes)

    def change(before: Version | None) -> Version | None:
        if not check(before):
            return None
        kept = [p for p in before.parts if p["run"] != run] if before and disposition == WRITE_APPEND else []
        return Version(0, schema, [*kept, part])

    after = commit(spark, path, change)
    return "loaded" if after is not None and part in after.parts else "skipped"


def vacuum(spark: SparkSession, path: str, keep_versions: int = 10, older_than_seconds: float = 7 * 86400) -> int:
    """Delete data folders that none of the newest ``keep_versions`` versions names and that are older than
    ``older_than_seconds`` (younger ones may belong to a load under way); returns how many."""
    fs, jvm, _ = _hadoop(spark)
    numbers = commit_numbers(spark, _commits(path))[-max(1, keep_versions):]
    used = {p["folder"].rsplit("/", 1)[-1] for n in numbers for p in current(spark, path, n).parts}
    limit = jvm.java.lang.System.currentTimeMillis() - 1000 * older_than_seconds
    gone = 0
    for status in _children(spark, f"{path.rstrip('/')}/_data"):
        if status.getPath().getName() not in used and status.getModificationTime() <= limit:
            gone += _filesystem(spark, path).delete(status.getPath(), True)
    return gone


# ------------------------------------------------------------------ stars

def _runs(root: str) -> str:
    return f"{root.rstrip('/')}/_runs"


def load_star_run(spark: SparkSession, root: str, fact_name: str, fact: DataFrame, dims: dict[str, DataFrame], run: str
                  ) -> dict[str, str]:
    """Run ``run`` of a star load: append the fact, load each missing or empty dimension, then show all of it at once.

    Started again after a failure, or after a success, it holds every row once.
    """
    actions = {name: commit_load(df, table_path(root, name), WRITE_EMPTY, run) for name, df in dims.items() if name != fact_name}
    actions = {fact_name: commit_load(fact, table_path(root, fact_name), WRITE_APPEND, run), **actions}
    for _ in range(ATTEMPTS):
        numbers = commit_numbers(spark, _runs(root))
        shown = read_commit(spark, _runs(root), numbers[-1])["tables"] if numbers else {}
        tables = shown | {name: current(spark, table_path(root, name)).number for name in actions}
        if publish(spark, _runs(root), numbers[-1] + 1 if numbers else 1, {"run": run, "tables": tables}):
            return actions
    raise OSError(f"{root}: other writers were faster {ATTEMPTS} times")


def read_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of a star, each as of the last finished run."""
    numbers = commit_numbers(spark, _runs(root))
    tables = read_commit(spark, _runs(root), numbers[-1])["tables"] if numbers else {}
    return {name: read_table(spark, table_path(root, name), number) for name, number in tables.items()}
