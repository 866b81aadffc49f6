"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import scratch_root

# Word rule of the word-based operators, on UTF-8 bytes: A-Z are lower-cased, words are runs of 0-9, a-z and every
# byte of a character from U+0080 on.
_WORD_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                    for b in range(256))


def words_of(raw: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text; null has none."""
    return raw.translate(_WORD_TABLE).split() if raw else []


class HashCache(dict):
    """word -> 64-bit hash, remembered up to a bound and then forgotten."""

    def __init__(self, bound: int = 400_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def binary_text(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding to Python strings."""
    column = batch.column(name)
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def unit_hash(*cols: Column) -> Column:
    """A reproducible uniform number in [0, 1) from the given columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / F.lit(float(1 << 40))


def shared_folder(spark: SparkSession, name: str) -> str:
    """URI of a fresh folder below the shared scratch root, for files that tasks write themselves."""
    root = re.sub(r"^file:/+", "/", scratch_root(spark))
    return f"{root}/sluice-llm/{name}-{uuid.uuid4().hex[:12]}"


def open_folder(uri: str):
    """(file system, path) of a shared folder or file, on the driver or in a task."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def empty_frame(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], T._parse_datatype_string(schema))


def arrow_rows(rows: list[tuple], schema: pa.Schema, size: int = 8192) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``size`` rows from a list of tuples."""
    for i in range(0, len(rows), size):
        columns = list(zip(*rows[i:i + size], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
                                         schema=schema)


def fresh_name(columns: list[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column has that name in any case."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def release() -> None:
    """Give memory that Arrow no longer uses back to the machine: a worker process lives on after its task."""
    pa.default_memory_pool().release_unused()


def with_struct(docs: DataFrame, into: str, fields: str, make, reads: tuple[str, ...] = ("text",),
                keep: list[str] | None = None) -> DataFrame:
    """``docs`` (its columns ``keep``, all by default) with a struct column computed per row in Arrow batches.

    ``make()`` runs once a task and returns a function from a record batch that holds the columns ``reads`` to the
    list of arrays of ``fields``.
    """
    keep = list(docs.columns) if keep is None else keep
    kind = T._parse_datatype_string(fields)
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(into, kind)])
    extra = [c for c in reads if c not in keep]
    names = [f.name for f in kind.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            if batch.num_rows:
                made = pa.StructArray.from_arrays(compute(batch), names=names)
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [made], names=[*keep, into])
        release()

    return docs.select(*keep, *extra).mapInArrow(run, schema)
