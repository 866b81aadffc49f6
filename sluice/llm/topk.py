"""Exact top-k inner-product search by columnar branch and bound.

Vectors are quantised to integers and packed into blocks in vertical layout:
a block holds dimension after dimension of up to ``block_rows`` vectors. Every
block of queries meets every block of candidates once (a stated query set
against all rows, in blocks). Within a pair of blocks the products are
accumulated one block of dimensions at a time; after each, a candidate whose
partial sum plus the bound on the remaining dimensions (the product of the two
remaining Euclidean norms) stays below the k-th best lower bound is dropped
and the survivors are compacted. Each pair yields at most k candidates a
query; a partial group limit and a window keep the k best.

Plan: candidates are dealt out evenly and packed where they are; only the
query blocks, a fixed fraction of the rows, are copied to each candidate
block. No table is broadcast.

Defined cases: vectors that are null or hold null or non-finite components,
and rows without an id, take no part. Rows that repeat an id are rows like any
other: each is a candidate, each is a query of its own if its id is one, and
only a query's own row is left out. Vectors of different lengths have no product with each other. Ties go to the
smaller id. A query with fewer than k candidates gets all of them. Scores are
exact integers; one that does not fit 64 bits raises an OverflowError. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import materialize

BLOCK = "dims int, n int, ids binary, rows binary, columns binary, width string"


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int, parts: int) -> DataFrame:
    """(id, row, v): every row that takes part, with a number of its own and components floor(scale * x) as doubles that
    hold integers, dealt out by id. Written once, so that a row's number is the same wherever it is read."""
    x = F.col(vector_col).cast("array<double>")
    fine = F.col(id_col).isNotNull() & x.isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.rint(c * float(scale)) - F.when(
        F.rint(c * float(scale)) > c * float(scale), 1.0).otherwise(0.0))
    return materialize(vectors.where(fine).select(F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
                                                  whole.alias("v")), "topk-vectors").repartition(parts, "id", "row")


def _packed(frame: DataFrame, rows: int) -> DataFrame:
    """Blocks of up to ``rows`` vectors of one length, dimension after dimension."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

        def block(dims: int) -> pa.RecordBatch:
            ids = np.concatenate([i for i, _, _ in waiting[dims]])
            numbers = np.concatenate([r for _, r, _ in waiting[dims]])
            values = np.concatenate([v for _, _, v in waiting.pop(dims)])
            top = float(np.abs(values).max(initial=0))
            # Small integers travel as 16 bits; others as exact doubles.
            width = "<i2" if top < 2 ** 15 else "<f8"
            return pa.RecordBatch.from_arrays(
                [pa.array([dims], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([ids.astype("<i8").tobytes()]),
                 pa.array([numbers.astype("<i8").tobytes()]), pa.array([np.ascontiguousarray(values.T).astype(width).tobytes()]), pa.array([width])],
                names=["dims", "n", "ids", "rows", "columns", "width"])

        for batch in batches:
            ids, lists = batch.column("id").to_numpy(zero_copy_only=False), batch.column("v")
            numbers = batch.column("row").to_numpy(zero_copy_only=False)
            sizes = np.diff(lists.offsets.to_numpy())
            flat, at = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)])
            for dims in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == dims)
                values = flat[at[own][:, None] + np.arange(dims)]
                for lo in range(0, len(own), rows):
                    part = waiting.setdefault(dims, [])
                    part.append((ids[own[lo:lo + rows]], numbers[own[lo:lo + rows]], values[lo:lo + rows]))
                    if sum(len(i) for i, _, _ in part) >= rows:
                        yield block(dims)
        for dims in list(waiting):
            yield block(dims)

    return frame.mapInArrow(pack, BLOCK)


def _norms(columns: np.ndarray, cuts: list[int]) -> np.ndarray:
    """Euclidean norms of what remains after each cut, rounded up: one row a cut."""
    squares = [np.square(columns[lo:]).sum(axis=0) for lo in cuts]
    return np.sqrt(np.array(squares)) * (1 + 1e-9)


def search_blocks(queries: np.ndarray, query_rows: np.ndarray, columns: np.ndarray, ids: np.ndarray, rows: np.ndarray,
                  k: int, step: int = 8, together: int = 64, chunk: int = 4096, counter: list[int] | None = None
                  ) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per query (row of ``queries``) the ids and scores of its k best among the columns, by branch and bound.

    ``queries`` is queries x dims, ``columns`` dims x candidates; both hold integers as doubles. The candidate whose row
    number is the query's own is left out. ``counter`` collects [multiplications made, multiplications of a full scan].
    """
    dims, n = columns.shape
    top = float(np.abs(queries).max(initial=0)) * float(np.abs(columns).max(initial=0)) * dims
    if top >= 2 ** 53:  # doubles would round: exact Python integers, without bounds
        return [_exact(q, own, columns, ids, rows, k) for q, own in zip(queries, query_rows, strict=True)]
    out = []
    for lo in range(0, len(queries), together):
        some = queries[lo:lo + together]
        # The dimensions that decide most for these queries come first; integer sums do not depend on the order.
        order = np.argsort(-(np.square(some).mean(axis=0) * columns.var(axis=1)) if n and len(some) else np.zeros(dims), kind="stable")
        asked, given = np.ascontiguousarray(some[:, order]), np.ascontiguousarray(columns[order])
        cuts = list(range(max(step, dims // 2 // step * step), dims, step)) + [dims]
        left_c, left_q = _norms(given, cuts), _norms(asked.T, cuts)
        found = [(np.empty(0, np.int64), np.empty(0)) for _ in some]
        # A small first chunk finds the bound that the others start from.
        places = [0, *range(chunk // 16, n, chunk)] if n else []
        for at, stop in zip(places, [*places[1:], n], strict=True):
            # The first half of the dimensions, where bounds seldom decide, for several queries at once.
            first = asked[:, :cuts[0]] @ given[:cuts[0], at:stop]
            for j, partial in enumerate(first):
                best_ids, best = found[j]
                alive = np.flatnonzero(rows[at:stop] != query_rows[lo + j]) + at
                partial = partial[alive - at]
                # What earlier candidates reach already is a bound for all later ones.
                carried = best[-1] if len(best) == k else -np.inf
                made = len(alive) * cuts[0]
                for b, cut in enumerate(cuts):
                    if b:
                        before = cuts[b - 1]
                        partial = partial + asked[j, before:cut] @ given[before:cut, alive]
                        made += len(alive) * (cut - before)
                    if cut < dims and len(alive):
                        rest = left_q[b, j] * left_c[b, alive] + 1e-6
                        bound = max(carried, np.partition(partial - rest, -k)[-k] if len(alive) > k else -np.inf)
                        keep = partial + rest >= bound
                        if 8 * np.count_nonzero(keep) < 7 * len(keep):
                            alive, partial = alive[keep], partial[keep]
                if counter is not None:
                    counter[0] += made
                    counter[1] += (stop - at) * dims
                partial, own = np.concatenate([best, partial]), np.concatenate([best_ids, ids[alive]])
                if len(partial) > k:
                    keep = partial >= np.partition(partial, -k)[-k]
                    partial, own = partial[keep], own[keep]
                ranked = np.lexsort((own, -partial))[:k]
                found[j] = (own[ranked], partial[ranked])
        out += [(own, scores.astype(np.int64)) for own, scores in found]
    return out


def _exact(query: np.ndarray, own: int, columns: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    whole = [int(x) for x in query]
    best = sorted((-sum(a * int(b) for a, b in zip(whole, columns[:, j], strict=True)), int(i))
                  for j, i in enumerate(ids) if rows[j] != own)[:k]
    if any(abs(s) >= 2 ** 63 for s, _ in best):
        raise OverflowError("an inner product does not fit 64 bits")
    return np.array([i for _, i in best], np.int64), np.array([-s for s, _ in best], np.int64)


def _unpack(ids: bytes, columns: bytes, width: str, dims: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, "<i8"), np.frombuffer(columns, width).reshape(dims, n).astype(np.float64)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 256, block_rows: int = 16384, query_rows: int = 1024) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` highest inner products of every query row against all other rows.

    ``is_query`` is a condition on the column ``id``. ``block_rows`` and ``query_rows`` bound a task's memory.
    """
    spark = vectors.sparkSession
    rows = vectors.count()  # from the footers
    cores = max(1, spark.sparkContext.defaultParallelism)
    groups = max(1, -(-rows // block_rows), min(cores, rows // 1024))
    whole = quantised(vectors, id_col, vector_col, scale, groups)
    # pmod: the groups stay right if the session deals rows out to more partitions than asked for.
    candidates = (_packed(whole, block_rows).withColumn("g", F.pmod(F.spark_partition_id(), F.lit(groups)))
                  .repartition(groups, "g"))
    asked = vectors.select(F.col(id_col).cast("long").alias("id")).where(is_query).count()
    # The vectors of one query block travel together; each block is copied to every group of candidate blocks.
    queries = _packed(whole.where(is_query).repartition(max(1, -(-asked // query_rows))), query_rows)
    queries = (queries.select(*[F.col(c).alias(f"q_{c}") for c in queries.columns],
                              F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"))
               .repartition(groups, "g"))
    pairs = queries.join(candidates, "g").where("q_dims = dims").drop("g")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                query_ids, flat = _unpack(r["q_ids"], r["q_columns"], r["q_width"], r["q_dims"], r["q_n"])
                ids, columns = _unpack(r["ids"], r["columns"], r["width"], r["dims"], r["n"])
                query_rows, rows = np.frombuffer(r["q_rows"], "<i8"), np.frombuffer(r["rows"], "<i8")
                found = search_blocks(np.ascontiguousarray(flat.T), query_rows, columns, ids, rows, k)
                sizes = [len(x) for x, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(query_ids, sizes)), pa.array(np.repeat(query_rows, sizes)),
                     pa.array(np.concatenate([x for x, _ in found])), pa.array(np.concatenate([s for _, s in found]))],
                    names=["query_id", "query_row", "id", "score"])

    found = pairs.mapInArrow(search, "query_id bigint, query_row bigint, id bigint, score bigint")
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "id", "score"))
