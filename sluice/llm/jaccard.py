"""Near-duplicate join on n-gram sets: MinHash banding, then exact verification.

1. Each text becomes the set of its five-word shingles (64-bit hashes); a text
   of fewer words is one shingle. Texts with equal sets are one node; a
   node's copies are counted, never paired.
2. The band and row counts are chosen for the target recall at the threshold.
   Band hashes are shuffled; in a bucket of two or more nodes each node gets
   one edge to the bucket's smallest node (linear, not all pairs). Connected
   components of these edges are groups of candidates.
3. The full shingle sets of the candidates only are gathered by group and
   every pair of nodes in a group is verified: a matrix product counts common
   shingles. A group of more than ``block`` nodes or ``block_shingles``
   shingles is split into blocks and each pair of blocks is a task of bounded
   size, so nothing is capped. Only link counts and a spanning forest leave
   the task.
4. Components of the verified links are the classes.

Both sides of every join grow with the input, so all of them are sort-merge
joins at every size and nothing is broadcast.

Result, one row a document: class_id, the smallest doc_id of its class, and
n_links, the number of other documents at or above the threshold.

Verifying inside groups of candidates finds all pairs that share a band, and
those that do not but are joined through others.

Defined cases: null texts and texts without a word have no links and are
classes of their own; a class whose doc_ids are all null has a null class_id;
repeated rows are copies of each other; an empty table gives no rows; other
columns are ignored. Very long texts are read whole; a text's shingle set is
held by one task. Shingle sets are told apart by 128-bit hashes, and every
distinct one gets a number of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import HashCache, binary_text, mix64, release, words_of
from sluice.llm.components import attach, connected_components
from sluice.session import materialize

_STEP = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(threshold: float, recall: float, max_hashes: int = 192) -> tuple[int, int]:
    """(bands, rows): the most rows a band, and so the fewest false candidates, with which a pair at the threshold
    shares a band with at least the target probability, within ``max_hashes`` hash functions."""
    best = None
    for rows in range(1, max_hashes + 1):
        hit = threshold ** rows
        if hit * max_hashes < 1e-6:
            break
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if rows * bands <= max_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("no band count reaches this recall within max_hashes")
    return best


def shingles(words: list[bytes], size: int, cache: HashCache) -> np.ndarray:
    """The sorted distinct shingle hashes of a word list."""
    if not words:
        return np.empty(0, np.uint64)
    h = cache.array(words)
    size = min(size, len(h))
    total = h[:len(h) - size + 1].copy()
    for k in range(1, size):
        total = total * _STEP + h[k:len(h) - size + 1 + k]
    return np.unique(mix64(total + np.uint64(size)))


class Signer:
    """MinHash band keys of shingle sets."""

    def __init__(self, bands: int, rows: int, seed: int = 20240601):
        dice = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = (dice.integers(0, 1 << 31, bands * rows, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
        self.b = dice.integers(0, 1 << 32, bands * rows, dtype=np.uint64).astype(np.uint32)

    def minima(self, grams: np.ndarray, piece: int = 2048) -> np.ndarray:
        x = (grams >> np.uint64(32)).astype(np.uint32)
        return np.minimum.reduce([((x[lo:lo + piece, None] * self.a) + self.b).min(axis=0)
                                  for lo in range(0, len(x), piece)])

    def keys(self, minima: np.ndarray) -> np.ndarray:
        """Band keys (documents x bands) from minima (documents x hashes)."""
        cells = minima.reshape(-1, self.bands, self.rows).astype(np.uint64)
        key = np.broadcast_to(np.arange(self.bands, dtype=np.uint64), cells.shape[:2]).copy()
        for j in range(self.rows):
            key = mix64(key * _STEP + cells[:, :, j])
        return key.view(np.int64)


def set_hash(grams: np.ndarray) -> bytes:
    """128-bit hash of a shingle set."""
    return xxhash.xxh3_128_digest(grams.tobytes())


def _signatures(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, th, set, n, bands) of every document: the hash of its shingle set (null without words) and its size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, signer = HashCache(), Signer(bands, rows)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                sets, sizes, minima = [], [], []
                for raw in binary_text(part):
                    grams = shingles(words_of(raw), size, cache)
                    sets.append(set_hash(grams) if len(grams) else None)
                    sizes.append(len(grams))
                    if len(grams):
                        minima.append(signer.minima(grams))
                keys = signer.keys(np.array(minima)) if minima else np.empty((0, bands), np.int64)
                offsets = np.concatenate([[0], np.cumsum((np.array(sizes, np.int64) > 0) * bands)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("th"), pa.array(sets, pa.binary()), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys.ravel()))],
                    names=["doc_id", "th", "set", "n", "bands"])
        release()

    return docs.mapInArrow(run, "doc_id bigint, th bigint, set binary, n bigint, bands array<bigint>")


def common_counts(sets: list[np.ndarray], cells: int = 1 << 23) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of incidence matrices of at most ``cells`` cells."""
    n = len(sets)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    shared = count[column] > 1  # a shingle of one set is in no intersection
    places = np.cumsum(count > 1) - 1
    column, owner = places[column[shared]], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    wide = max(1, cells // n)
    total = np.zeros((n, n), np.float64)
    columns = int(column[-1]) + 1 if len(column) else 0
    for lo in range(0, columns, wide):
        a, b = np.searchsorted(column, [lo, lo + wide])
        matrix = np.zeros((n, min(wide, columns - lo)), np.float32)
        matrix[owner[a:b], column[a:b] - lo] = 1
        total += matrix @ matrix.T
    return total


def linked(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of sets have a Jaccard similarity of at least ``threshold`` (never a set with itself)."""
    sizes = np.array([len(s) for s in sets], np.float64)
    common = common_counts(sets)
    out = common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-9
    np.fill_diagonal(out, False)
    return out


def _roots(links: np.ndarray) -> np.ndarray:
    """Per row the smallest row index of its component."""
    label = np.arange(len(links))
    while True:
        least = np.minimum(label, np.where(links, label[None, :], len(links)).min(axis=1, initial=len(links)))
        least = least[least]
        if np.array_equal(least, label):
            return label
        label = least


def _verify(threshold: float):
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def verify(table: pa.Table) -> pa.Table:
        comp, block = table.column("comp").to_numpy(), table.column("block").to_numpy()
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy().astype(np.float64)
        raw = table.column("grams").to_pylist()
        # A block may have no node, so what the task is for is not seen from the nodes.
        two_blocks = bool(table.num_rows) and table.column("lo")[0].as_py() != table.column("hi")[0].as_py()
        order = np.lexsort((node, comp))
        # A node is there once a document that repeats its representative row.
        same = np.concatenate([[False], (node[order][1:] == node[order][:-1]) & (comp[order][1:] == comp[order][:-1])])
        order = order[~same]
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for own in np.split(order, np.flatnonzero(np.diff(comp[order])) + 1):
            links = linked([np.frombuffer(raw[i], "<u8") for i in own], threshold)
            if two_blocks:
                links &= block[own][:, None] != block[own][None, :]  # the pairs within a block belong to its own task
            out.append((node[own], (links @ copies[own]).astype(np.int64), node[own][_roots(links)]))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], schema=schema)
    return verify


def near_duplicates(docs: DataFrame, threshold: float = 0.8, size: int = 5, recall: float = 0.998, block: int = 256,
                    block_shingles: int = 1 << 21) -> DataFrame:
    """(doc_id, th, class_id, class_th, n_links) for every row of ``docs`` (doc_id, text).

    ``th`` is the hash of the text; (class_id, class_th) names the class's representative row. ``block`` nodes and about
    ``block_shingles`` shingles bound a block of a large group, two of which meet in a task.
    """
    bands, rows = choose_bands(threshold, recall)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    signed = materialize(_signatures(docs, size, bands, rows), "jaccard-signatures")
    # One row a node: its representative row (nulls last), its copies and its bands, which all copies share.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "th")).alias("rep")
    nodes = materialize(signed.where("set is not null").groupBy("set").agg(
        first, F.count("*").alias("copies"), F.min("n").alias("n"), F.min("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "jaccard-nodes")
    rows_ = nodes.select("node", F.explode("bands").alias("key"))
    # Written, so that the join below reads plain shuffles on both sides, whose hot partitions Spark splits.
    buckets = materialize(rows_.groupBy("key").agg(F.min("node").alias("least"), F.count("*").alias("n"))
                          .where("n > 1").select("key", "least"), "jaccard-buckets")
    candidates = connected_components(rows_.join(buckets.hint("merge"), "key").select(F.col("node").alias("u"), F.col("least").alias("v")))
    candidates = candidates.withColumnRenamed("label", "comp")
    candidates = candidates.join(nodes.select("node", "n").hint("merge"), "node")
    sizes = candidates.groupBy("comp").agg(F.count("*").alias("members"), F.sum("n").alias("weight"))
    known = nodes.select("node", "copies", F.col("rep.doc_id").alias("rep_id"), F.col("rep.th").alias("rep_th"))
    parts = F.greatest(F.ceil(F.col("members") / block), F.ceil(F.col("weight") / block_shingles)).alias("parts")
    groups = materialize(attach(candidates, sizes, "comp", "node").join(known.hint("merge"), "node")
                         .select("comp", "node", "n", "copies", "rep_id", "rep_th", parts), "jaccard-candidates")
    total, weight = groups.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = HashCache()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                grams = [shingles(words_of(raw), size, cache).tobytes() for raw in binary_text(part)]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in ("comp", "parts", "node", "copies")]
                                                 + [pa.array(grams, pa.binary())],
                                                 names=["comp", "parts", "node", "copies", "grams"])
        release()

    own = docs.doc_id.eqNullSafe(groups.rep_id) & (docs.th == groups.rep_th)
    sets = (docs.join(groups.hint("merge"), own).select("comp", "parts", "node", "copies", "text")
            .mapInArrow(gather, "comp bigint, parts bigint, node bigint, copies bigint, grams binary"))
    # Small groups share a task; the blocks of a large one meet in pairs.
    shared = max(1, total // (4 * block), weight // block_shingles)
    sets = (sets.withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
            .withColumn("task", F.when(F.col("parts") == 1, F.pmod(F.xxhash64("comp"), F.lit(shared)))
                        .otherwise(F.col("comp")))
            .withColumn("large", F.col("parts") > 1))
    found = materialize(sets.groupBy("large", "task", "lo", "hi")
                        .applyInArrow(_verify(threshold), "node bigint, links bigint, root bigint"), "jaccard-links")
    degree = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = connected_components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    members = labels.join(nodes.select("node", "rep").hint("merge"), "node")
    least = members.groupBy("label").agg(F.min("rep").alias("class"))
    of_class = attach(members.select("node", "label"), least, "label", "node").select("node", "class")
    classes = materialize(
        nodes.select("set", "node", "copies", "rep").join(of_class.hint("merge"), "node", "left")
        .join(degree.hint("merge"), "node", "left")
        .select("set", F.coalesce("class", "rep").alias("class"),
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "jaccard-classes")
    return (signed.select("doc_id", "th", "set").join(classes.hint("merge"), "set", "left")
            .select("doc_id", "th",
                    F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("class.doc_id")).alias("class_id"),
                    F.coalesce("class.th", "th").alias("class_th"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
