"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The test strings are the 13-word windows of the benchmark items (a shorter
item is one window). Texts and windows are sequences of word numbers; per
window length m there is

* a shift table: for a block of two words, how far the search may move
  because the block ends no window earlier than that. A block no window holds
  moves it by m - 1, a word no window holds by m;
* buckets: windows by the hash of their last block, then of their first
  block, so few windows are compared at a position of shift 0;
* the direct comparison of all m words, which confirms an occurrence.

Items are sent to the executors in chunks of at most ``chunk_bytes`` of
benchmark text; a worker process builds a chunk's tables once, in about 30
times that memory. One chunk is the usual case. With more, the texts are
searched once a chunk and the occurrences are united per row by a shuffle;
the result is the same.

Defined cases: a null or empty text has no words and is clean; a null or
empty item has no windows; items with equal windows all count; repeated items
count once; windows of an item with null id hit, but are not listed; an empty
benchmark leaves every document clean. All columns of the documents are kept;
the result is one struct column whose name gets underscores added if it is
taken.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import binary_text, fresh_name, with_struct, words_of
from sluice.session import materialize

FIELDS = ("struct<n_words: bigint, n_hit: bigint, item_ids: array<string>, "
          "spans: array<struct<first: bigint, last: bigint>>>")


class WuManber:
    """Multi-pattern search for word windows of one length, over numbers of words.

    The items stand one after the other in one array; a window is a place in it. What grows with the benchmark are that
    array, a few numbers a window, and one table from blocks to their shift, or to their bucket where the shift is 0.
    """

    def __init__(self, length: int, items: list[np.ndarray], owners: list[int], words: int):
        """``items`` are the items' word numbers below ``words``, ``owners`` their places in the caller's list."""
        self.length, self.block, self.words = length, min(2, length), words
        self.flat = np.concatenate(items).astype(np.int32)
        sizes = np.array([len(i) for i in items], np.int64)
        first = np.cumsum(sizes) - sizes
        within = np.arange(len(self.flat)) - np.repeat(first, sizes)
        left = np.repeat(sizes, sizes) - within  # words from here to the item's end
        starts = np.flatnonzero(left >= length)
        owner = np.repeat(np.array(owners, np.int64), sizes)[starts]
        # Equal windows become one, with all items that hold it.
        rows = np.ascontiguousarray(self.flat[starts[:, None] + np.arange(length)])
        _, place, same = np.unique(rows.view(np.dtype((np.void, rows.itemsize * length))).ravel(), return_index=True, return_inverse=True)
        pairs = np.unique(np.stack([same, owner], axis=1), axis=0)
        at = starts[place]
        last, head = self._keys(at + length - self.block), self._keys(at)
        order = np.lexsort((head, last))
        self.at, self.head = at[order].astype(np.int64), head[order]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        pairs = pairs[np.argsort(rank[pairs[:, 0]], kind="stable")]
        self.owners = pairs[:, 1]
        self.owner_from = np.searchsorted(rank[pairs[:, 0]], np.arange(len(order) + 1))
        # Within an item a block that ends k words after its start ends a window as soon as a window fits before it.
        blocks = np.flatnonzero(left >= self.block)
        keys, shift = self._keys(blocks), np.maximum(0, length - self.block - within[blocks])
        by = np.lexsort((shift, keys))
        least = np.concatenate([[True], np.diff(keys[by]) != 0])
        keys, shift = keys[by][least], shift[by][least]
        bucket_keys, self.bucket_from = np.unique(last[order], return_index=True)
        self.bucket_from = np.append(self.bucket_from, len(order))
        zero = shift == 0
        shift[zero] = -1 - np.searchsorted(bucket_keys, keys[zero])  # bucket b as -1 - b
        self.table = dict(zip(keys.tolist(), shift.tolist(), strict=True))

    def _keys(self, places: np.ndarray) -> np.ndarray:
        key = self.flat[places].astype(np.int64)
        return key if self.block == 1 else key * self.words + self.flat[places + 1]

    def search(self, words: list) -> list[tuple[int, list[int]]]:
        """(last position, owners) of every occurrence; ``words`` holds None for words of no window."""
        m, size, table, base = self.length, self.block, self.table, self.words
        found, end, n = [], m - 1, len(words)
        while end < n:
            now = words[end]
            if now is None:
                end += m
                continue
            if size == 2:
                before = words[end - 1]
                if before is None:
                    end += m - 1
                    continue
                step = table.get(before * base + now, m - 1)
            else:
                step = table.get(now, 1)
            if step > 0:
                end += step
                continue
            start = end - m + 1
            head = words[start]
            if head is not None and (size == 1 or words[start + 1] is not None):
                lo, hi = self.bucket_from[-1 - step], self.bucket_from[-step]
                key = head if size == 1 else head * base + words[start + 1]
                window = None
                for k in range(lo + int(np.searchsorted(self.head[lo:hi], key)), hi):
                    if self.head[k] != key:
                        break
                    window = window or words[start:end + 1]
                    if self.flat[self.at[k]:self.at[k] + m].tolist() == window:
                        found.append((end, self.owners[self.owner_from[k]:self.owner_from[k + 1]].tolist()))
            end += 1
        return found

    def bytes(self) -> int:
        """About what the tables hold in memory."""
        arrays = (self.flat, self.at, self.head, self.owners, self.owner_from, self.bucket_from)
        return sum(a.nbytes for a in arrays) + 100 * len(self.table)


class Matcher:
    """Wu-Manber tables of one chunk of benchmark items, one per window length."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], size: int):
        self.numbers: dict[bytes, int] = {}
        self.names = [item_id for item_id, _ in items]
        lengths: dict[int, tuple[list, list]] = {}
        for k, (_, raw) in enumerate(items):
            words = words_of(raw)
            if words:
                own = np.array([self.numbers.setdefault(w, len(self.numbers)) for w in words], np.int64)
                arrays, owners = lengths.setdefault(min(size, len(words)), ([], []))
                arrays.append(own)
                owners.append(k)
        self.tables = [WuManber(length, arrays, owners, len(self.numbers)) for length, (arrays, owners) in sorted(lengths.items())]

    def match(self, words: list[bytes]) -> tuple[set, list[tuple[int, int]]]:
        """Items that occur and the merged word spans (first, last) of their occurrences."""
        numbered = list(map(self.numbers.get, words))
        items: set = set()
        spans = []
        for table in self.tables:
            for end, owners in table.search(numbered):
                items.update(owners)
                spans.append((end - table.length + 1, end))
        return {self.names[k] for k in items}, merge(spans)

    def bytes(self) -> int:
        return sum(t.bytes() for t in self.tables) + sum(len(w) + 120 for w in self.numbers)


_BUILT: dict[bytes, Matcher] = {}  # the chunk a worker process has built last


def built(items: list[tuple], size: int, key: bytes) -> Matcher:
    """The matcher of a chunk, built once in a worker process however many tasks it runs."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Matcher(items, size)
    return _BUILT[key]


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def _search(docs: DataFrame, items: list[tuple], size: int, into: str, keep: list[str] | None) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    key = hashlib.sha256(repr((size, items)).encode()).digest()

    def make():
        matcher = built(shared.value, size, key)

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = []
            for lo in range(0, batch.num_rows, 512):
                for raw in binary_text(batch.slice(lo, 512)):
                    words = words_of(raw)
                    ids, spans = matcher.match(words)
                    rows.append((len(words), sum(b - a + 1 for a, b in spans),
                                 sorted(i for i in ids if i is not None),
                                 [{"first": a, "last": b} for a, b in spans]))
            n_words, n_hit, ids, spans = zip(*rows, strict=True)
            span = pa.struct([("first", pa.int64()), ("last", pa.int64())])
            return [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                    pa.array(ids, pa.list_(pa.string())), pa.array(spans, pa.list_(span))]
        return compute

    return with_struct(docs, into, FIELDS, make, keep=keep)


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, into: str = "contamination",
                       keep: list[str] | None = None, chunk_bytes: int = 8 << 20) -> tuple[DataFrame, str]:
    """``docs`` with a struct column (n_words, n_hit, item_ids, spans) and that column's name.

    ``docs`` has ``text``, ``benchmark`` has ``item_id`` and ``text``. ``chunk_bytes`` bounds what is broadcast at
    once, in bytes of benchmark text; a single longer item is a chunk of its own.
    """
    into = fresh_name(docs.columns, into)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("raw"))
    total = items.agg(F.sum(F.length("raw") + 64).alias("n")).first().n or 0
    chunks = max(1, -(-total // chunk_bytes))
    part = F.pmod(F.xxhash64("item_id", "raw"), F.lit(chunks))

    def chunk(k: int) -> list[tuple]:
        return [(r.item_id, r.raw and bytes(r.raw)) for r in items.where(part == k).collect()]

    if chunks == 1:
        return _search(docs, chunk(0), window, into, keep), into
    # Rows get numbers in a written copy, so that every pass sees the same ones.
    row = fresh_name([*docs.columns, into], "row")
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "decontam-rows")
    passes = None
    for k in range(chunks):
        found = _search(numbered, chunk(k), window, into, [row])
        passes = found if passes is None else passes.unionByName(found)
    united = (passes.groupBy(row)
              .agg(F.max(f"{into}.n_words").alias("n_words"),
                   F.array_sort(F.array_distinct(F.flatten(F.collect_list(f"{into}.item_ids")))).alias("item_ids"),
                   F.array_sort(F.flatten(F.collect_list(f"{into}.spans"))).alias("all")))
    united = united.select(row, F.struct(
        "n_words", F.expr(_COVERED).alias("n_hit"), "item_ids", F.expr(_MERGED).alias("spans")).alias(into))
    return numbered.select(*(docs.columns if keep is None else keep), row).join(united, row, "left").drop(row), into


# Spans of all passes, sorted, merged in the row.
_MERGED = """aggregate(all, cast(array() as array<struct<first: bigint, last: bigint>>), (out, s) ->
  if(size(out) > 0 and s.first <= element_at(out, -1).last + 1,
     concat(slice(out, 1, size(out) - 1), array(named_struct('first', element_at(out, -1).first,
            'last', greatest(s.last, element_at(out, -1).last)))),
     concat(out, array(s))))"""
_COVERED = f"aggregate({_MERGED}, 0L, (n, s) -> n + s.last - s.first + 1)"


def is_contaminated(into: str, share: int = 20):
    """The contract's rule: a hit, and at least one word in ``share`` is hit."""
    return (F.col(f"{into}.n_hit") > 0) & (share * F.col(f"{into}.n_hit") >= F.col(f"{into}.n_words"))


def digest(ids: list[str]) -> str:
    """The digest column of the query for a list of item ids, for tests."""
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
