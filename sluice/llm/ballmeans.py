"""Product quantisation of vectors: codebooks by ball k-means, exact in whole numbers.

Components become floor(scale * x); vectors are cut into ``parts`` equal
consecutive parts, and every position of a part has a codebook of ``entries``
entries. It starts as the parts of the vectors with the smallest ids. A round
assigns each part to the nearest entry of its codebook and replaces each entry
by the floor of the mean of its parts; after ``rounds`` rounds the parts are
assigned once more. Distances are squared Euclidean, ties go to the lower
index.

The first assignment compares a part with all entries. From then on an entry's
ball says what can change. The ball's radius bounds the distance of its parts
from the moved entry: the largest distance at the last assignment plus how far
the entry moved. Only entries nearer than twice the radius are neighbours of
the ball. A part nearer to its entry than half the way to the nearest
neighbour lies in the stable core and keeps its entry without any comparison.
The others lie in rings: a part in ring j, further than half the way to
neighbour j and no further than half the way to neighbour j + 1, is compared
exactly with the first j neighbours. The tests 4 * d^2 against D^2 use whole
numbers, so no rounding decides.

Each pass reads the vectors with their last codes, in Arrow batches, one chunk
of a batch at a time. It writes them with their new codes and, from every
task, at most ``parts`` * ``entries`` rows of sums, counts and radii; their
total, of the same size, goes to the driver and out again as the codebooks.
No vector is shuffled. Passes are written to the shared folder, so a lost
executor repeats its own tasks and the codebooks never change.

Defined cases: vectors that are null or hold null or non-finite components are
dropped. The first kept vector (smallest id, null ids last, then the smallest
components) says how many components a vector has; the rest of another length
is dropped too. A length that ``parts`` does not divide gives its first parts
one component more. Fewer than ``entries`` vectors give as many entries.
Repeated rows and ids are all kept; entries that start equal stay behind the
lower one, unused. Components of 2^24 and more after scaling raise an
OverflowError, since squares would not be exact. An empty table gives no rows.
Columns not asked for are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import fresh_name
from sluice.session import materialize

CHUNK = 2048  # vectors compared at a time
LIMIT = 1 << 24


@dataclass
class Codebooks:
    """Entries of all parts: ``entries[p, e, k]``, with parts of ``widths[p]`` components (the rest is 0)."""
    entries: np.ndarray
    widths: list[int]

    def sha256(self) -> str:
        """Digest of all components by part, entry and position, comma-joined decimal."""
        flat = [str(x) for p, w in enumerate(self.widths) for x in self.entries[p, :, :w].ravel().tolist()]
        return hashlib.sha256(",".join(flat).encode()).hexdigest()


@dataclass
class Balls:
    """Per part and entry the neighbours of its ball, nearest first."""
    order: np.ndarray  # [p, e, j]: the j-th nearest neighbour of entry e, -1 beyond the last
    far: np.ndarray  # [p, e, j]: its squared distance from e; the largest number beyond the last neighbour


def split(vectors: np.ndarray, widths: list[int]) -> np.ndarray:
    """rows x parts x width, padded with zeros."""
    out = np.zeros((len(vectors), len(widths), max([1, *widths])), np.int64)
    at = 0
    for p, w in enumerate(widths):
        out[:, p, :w] = vectors[:, at:at + w]
        at += w
    return out


def assign_all(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, squared distance) of rows x parts, by comparing with every entry."""
    codes = np.empty(x.shape[:2], np.int64)
    dist = np.empty(x.shape[:2], np.int64)
    for p in range(x.shape[1]):
        d = np.zeros((len(x), entries.shape[1]), np.int64)
        for k in range(x.shape[2]):
            d += np.square(x[:, p, k, None] - entries[p, None, :, k])
        codes[:, p] = d.argmin(axis=1)  # the first of equals
        dist[:, p] = d[np.arange(len(x)), codes[:, p]]
    return codes, dist


def balls(entries: np.ndarray, radii: np.ndarray) -> Balls:
    """Neighbours of every entry, given upper bounds of the balls' radii (parts x entries)."""
    parts, n, _ = entries.shape
    apart = np.square(entries[:, :, None, :] - entries[:, None, :, :]).sum(axis=3)
    apart[:, np.arange(n), np.arange(n)] = -1  # itself comes first and is cut off
    order = np.argsort(apart, axis=2, kind="stable")[:, :, 1:]
    far = np.take_along_axis(apart, order, axis=2)
    # A neighbour lies within twice the radius; equal entries always are. Radii are rounded up.
    near = far <= np.square(2 * radii)[:, :, None]
    none = np.iinfo(np.int64).max
    far = np.concatenate([np.where(near, far, none), np.full((parts, n, 1), none)], axis=2)
    return Balls(np.where(near, order, -1), far)


def assign_near(x: np.ndarray, entries: np.ndarray, last: np.ndarray, known: Balls) -> tuple[np.ndarray, np.ndarray, int]:
    """As :func:`assign_all` for parts whose last entries are ``last``; also the number of exact comparisons made."""
    codes, compared = last.copy(), 0
    part = np.broadcast_to(np.arange(x.shape[1]), last.shape)
    own = np.square(x - entries[part, last]).sum(axis=2)
    dist = own.copy()
    # The stable core is out at once; the rest goes through its ring's neighbours, nearest first.
    row, p = np.nonzero(4 * own >= known.far[part, last, 0])
    j = 0
    while len(row):
        mine = last[row, p]
        other = known.order[p, mine, j]
        d = np.square(x[row, p] - entries[p, other]).sum(axis=1)
        compared += len(row)
        better = (d < dist[row, p]) | ((d == dist[row, p]) & (other < codes[row, p]))
        codes[row[better], p[better]] = other[better]
        dist[row[better], p[better]] = d[better]
        j += 1
        stay = 4 * own[row, p] >= known.far[p, mine, j]
        row, p = row[stay], p[stay]
    return codes, dist, compared


def kept(vectors: DataFrame, id_col: str, vector_col: str, scale: int, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep``, ``id_col`` and the components as whole numbers in ``v`` of all rows that take part."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    fine = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    names = list(dict.fromkeys([id_col, *keep]))
    v = fresh_name(names, "v")
    top = F.lit(float(LIMIT))
    # Beyond the limit components stay that far out; the passes refuse them.
    whole = F.transform(x, lambda c: F.greatest(F.least(F.floor(F.greatest(F.least(c * float(scale), top), -top)), F.lit(LIMIT)),
                                                F.lit(-LIMIT)).cast("int"))
    return vectors.where(fine).select(*[F.col(f"`{c}`") for c in names], whole.alias(v))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims) if dims \
        else np.zeros((len(column), 0), np.int64)


def encode(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", keep: Sequence[str] = (),
           parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> tuple[DataFrame, Codebooks]:
    """(rows, codebooks): every kept row's ``id_col``, the columns ``keep``, ``code`` (two hexadecimal digits a part) and
    ``error`` (its parts' final squared distances); and the final codebooks. A clash of ``keep`` with ``code`` or
    ``error`` is an error."""
    if entries > 256:
        raise ValueError("a code has two hexadecimal digits: at most 256 entries")
    if {"code", "error"} & {c.lower() for c in (id_col, *keep)}:
        raise ValueError("code and error are columns of the result")
    rows = kept(vectors, id_col, vector_col, scale, keep)
    names, v = rows.columns[:-1], rows.columns[-1]

    def smallest(frame: DataFrame) -> list[list[int]]:
        """As many vectors as entries, whatever the table's size."""
        return [r[1] for r in frame.select(F.col(f"`{id_col}`"), v).orderBy(F.col(f"`{id_col}`").asc_nulls_last(), v)
                .limit(entries).collect()]

    seeds = smallest(rows)
    dims = len(seeds[0]) if seeds else 0
    rows = rows.where(F.size(v) == dims)
    if any(len(s) != dims for s in seeds):
        seeds = smallest(rows)
    widths = [dims // parts + (p < dims % parts) for p in range(parts)]
    books = Codebooks(split(np.array(seeds, np.int64).reshape(len(seeds), dims), widths).transpose(1, 0, 2), widths)
    n, wide = len(seeds), max([1, *widths])
    code, error = "code", "error"
    schema = T.StructType([*rows.schema.fields, T.StructField(code, T.BinaryType()), T.StructField(error, T.LongType())])
    known = None
    for turn in range(rounds + 1):
        state = (books.entries, known)

        def run(batches: Iterator[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            now, near = state
            for batch in batches:
                for lo in range(0, batch.num_rows, CHUNK):
                    chunk = batch.slice(lo, CHUNK)
                    flat = _matrix(chunk.column(v), dims)
                    if len(flat) and np.abs(flat).max(initial=0) >= LIMIT:
                        raise OverflowError("a component times the scale does not fit 24 bits")
                    x = split(flat, widths)
                    if near is None:
                        codes, dist = assign_all(x, now)
                    else:
                        last = np.frombuffer(b"".join(chunk.column(code).to_pylist()), np.uint8).reshape(len(x), parts)
                        codes, dist, _ = assign_near(x, now, last.astype(np.int64), near)
                    yield pa.RecordBatch.from_arrays(
                        [*[chunk.column(c) for c in (*names, v)],
                         pa.array([c.tobytes() for c in codes.astype(np.uint8)], pa.binary()),
                         pa.array(dist.sum(axis=1), pa.int64())], names=[*names, v, code, error])

        # The written copy holds the codes the next pass starts from.
        rows = materialize((rows if turn == 0 else rows.drop(error)).mapInArrow(run, schema), "ball-codes")
        if turn < rounds and n:
            books, known = _moved(rows.select(v, code), v, code, books, dims, n, wide)
    return rows.select(*names, F.lower(F.hex(code)).alias(code), error), books


def _moved(rows: DataFrame, v: str, code: str, books: Codebooks, dims: int, n: int, wide: int) -> tuple[Codebooks, Balls]:
    """The codebooks after a round, and the balls around their entries."""
    parts, now, widths = len(books.widths), books.entries, books.widths

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts * n, wide), np.int64), np.zeros(parts * n, np.int64)
        radii = np.zeros(parts * n, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK):
                chunk = batch.slice(lo, CHUNK)
                x = split(_matrix(chunk.column(v), dims), widths)
                own = np.frombuffer(b"".join(chunk.column(code).to_pylist()), np.uint8).reshape(len(x), parts).astype(np.int64)
                cell = (np.arange(parts) * n + own).ravel()
                flat = x.reshape(-1, wide)
                counts += np.bincount(cell, minlength=parts * n)
                for k in range(wide):  # doubles are exact here: 2048 components below 2^24
                    sums[:, k] += np.bincount(cell, flat[:, k], parts * n).astype(np.int64)
                np.maximum.at(radii, cell, np.square(flat - now.reshape(-1, wide)[cell]).sum(axis=1))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(counts[used], pa.int64()), pa.array(radii[used], pa.int64()),
             pa.array(sums[used].tolist(), pa.list_(pa.int64()))], names=["cell", "n", "radius", "sums"])

    found = rows.mapInArrow(partial, "cell bigint, n bigint, radius bigint, sums array<bigint>")
    # Sums as decimals: they fit whatever the number of rows.
    totals = found.groupBy("cell").agg(
        F.sum("n").alias("n"), F.max("radius").alias("radius"),
        *[F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(wide)]).collect()
    flat, reach = now.reshape(-1, wide).copy(), np.zeros(parts * n)
    for r in totals:
        before = flat[r["cell"]].copy()
        flat[r["cell"]] = [int(r[f"s{k}"]) // r["n"] for k in range(wide)]
        moved = float(np.square(flat[r["cell"]] - before).sum()) ** 0.5
        reach[r["cell"]] = (float(r["radius"]) ** 0.5 + moved) * (1 + 1e-9)
    entries = flat.reshape(parts, n, wide)
    return Codebooks(entries, widths), balls(entries, reach.reshape(parts, n))
