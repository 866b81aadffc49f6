"""Token-id output in binary shards with a shared compression dictionary.

Documents are range-partitioned and sorted by doc_id; each task encodes its
documents and writes one shard, so shards in partition order hold all ids in
ascending doc_id order. Every document is one zstandard frame, compressed
with a dictionary that was trained on the serialized id arrays of a bounded
sample, so a short document is read by one seek and one small decompression.

Shard layout (little-endian)::

    8 bytes magic | 32 bytes SHA-256 of the dictionary | 1 byte id width (2 or 4)
    frames, one per document
    index: per document frame offset u64, frame length u32, ids u64, doc_id i64, doc_id present u8
    footer: index offset u64, documents u64, ids u64, 8 bytes magic

A task that is run again writes a new file; only the files named in the
committed manifest are read, so lost executors and repeated attempts leave no
duplicates.

Defined cases: a null text is empty and holds the end id alone; documents with
a null doc_id come last; repeated doc_ids are ordered by the hash of the text,
then the text; identical rows are all written; an empty table gives no shard
and no rows; columns other than doc_id and text are ignored, whatever their
names.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import empty_frame, open_folder, release, shared_folder, unit_hash
from sluice.session import materialize

MAGIC = b"SLCTOK01"
INDEX = np.dtype([("offset", "<u8"), ("length", "<u4"), ("ids", "<u8"), ("doc_id", "<i8"), ("present", "u1")])
FOOTER = "<QQQ8s"
FOOTER_BYTES = struct.calcsize(FOOTER)
RESULT = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"

_CACHES: dict[str, TextEncoder] = {}

# The steps before the merges of the word-level vocabulary this module has a short cut for (fixed values).
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# Characters for which those steps are plain: printable ASCII, blanks and the precomposed letters of Latin-1, which
# are their own composed form and have one lower-case letter each. Special tokens begin with "<|".
_UNUSUAL = re.compile("[^\t\n\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]|<\\|")
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|"
                    "[^\\sa-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
_BLANKS = re.compile("[ \t\r\n]+")


def _byte_letters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for letters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Pieces(dict):
    """piece -> its ids (little-endian unsigned 32-bit), by the tokenizer's merges; two generations of ``bound``."""

    def __init__(self, model, bound: int):
        super().__init__()
        self.model, self.bound, self.old = model, bound, {}
        self.letters = _byte_letters()

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            mapped = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
            ids = self.made(self.model.tokenize(mapped))
        if len(self) >= self.bound:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids

    def made(self, tokens: list) -> bytes:
        return b"".join([t.id.to_bytes(4, "little") for t in tokens])


class Sizes(Pieces):
    """piece -> the number of its ids, remembered in the same way."""

    def made(self, tokens: list) -> int:
        return len(tokens)


def _list_sums(lists: pa.Array, sizes) -> np.ndarray:
    """For each list of strings the sum of ``sizes`` of its strings; ``sizes`` is asked once, for the distinct ones."""
    strings = lists.flatten().dictionary_encode()
    ends = np.zeros(len(strings) + 1, np.int64)
    np.cumsum(sizes(strings.dictionary)[strings.indices.to_numpy()], out=ends[1:])
    return np.diff(ends[np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])])


class TextEncoder:
    """Ids of whole texts by the tokenizers library, without special tokens added.

    For a vocabulary whose normalisation and splitting are the known ones, blanks are dropped and no step looks across
    them, so the ids of a text are those of its stretches between blanks. Equal stretches of a batch are found in
    Arrow and encoded once: those of usual characters by the library's merges on their pieces, all others by the whole
    tokenizer. Texts of other vocabularies, and those that hold the beginning of a special token, go through the whole
    tokenizer as they are.
    """

    def __init__(self, path: str, bound: int = 150_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        split = made["pre_tokenizer"]["pretokenizers"] if (made.get("pre_tokenizer") or {}).get("type") == "Sequence" else []
        self.known = (made.get("normalizer") == _NORMALIZER and len(split) == 2 and made.get("post_processor") is None
                      and split[0] == {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True}
                      and (split[1]["type"], split[1]["add_prefix_space"], split[1]["use_regex"]) == ("ByteLevel", False, False)
                      and all(t["content"].startswith("<|") for t in made["added_tokens"]))
        self.pieces = Pieces(self.tokenizer.model, bound)
        self.sizes = Sizes(self.tokenizer.model, bound)
        self.bound, self.stretches = bound, {}  # stretch of unusual characters -> number of ids, forgotten beyond the bound

    @classmethod
    def of(cls, path: str) -> TextEncoder:
        if path not in _CACHES:
            _CACHES[path] = cls(path)
        return _CACHES[path]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _stretch(self, text: str) -> bytes:
        if _UNUSUAL.search(text):
            return self._whole(text)
        text = text.lower()
        if text.isalpha():
            return self.pieces[text]
        return b"".join([self.pieces[p] for p in _PIECE.findall(text)])

    def counts(self, texts: pa.Array, chunk_bytes: int = 2 << 20) -> list[int]:
        """The number of ids of each text of a string array; none for null.

        As :meth:`encode`, but the distinct stretches of a chunk are lower-cased and cut into pieces in Arrow too, so that
        Python sees each distinct piece of a chunk once. A chunk of a batch is as large as ``chunk_bytes`` of text, so that
        few are met twice.
        """
        out, lo = [], 0
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        while lo < len(texts):
            before = int(sizes[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(sizes, before + chunk_bytes, side="right")))
            out += self._counts(texts.slice(lo, hi - lo))
            lo = hi
        return out

    def _counts(self, texts: pa.Array) -> list[int]:
        if not self.known or (pc.any(pc.match_substring(texts, "<|")).as_py() or False):
            return [len(self._whole(t or "")) // 4 for t in texts.to_pylist()]
        return _list_sums(pc.ascii_split_whitespace(pc.fill_null(texts, "")), self._stretch_sizes).tolist()

    def _stretch_sizes(self, stretches: pa.Array) -> np.ndarray:
        unusual = pc.match_substring_regex(stretches, _UNUSUAL.pattern)
        cut = pc.replace_substring_regex(pc.utf8_lower(stretches.filter(pc.invert(unusual))), f"({_PIECE.pattern})", r"\1 ")
        odd = unusual.to_numpy(zero_copy_only=False)
        out = np.zeros(len(stretches), np.int64)
        out[~odd] = _list_sums(pc.ascii_split_whitespace(cut), self._piece_sizes)
        known, count = self.stretches, []
        if len(known) > min(self.bound, 100_000):
            known.clear()
        for w in stretches.filter(unusual).to_pylist():
            n = known.get(w)
            if n is None:
                n = known[w] = len(self._whole(w)) // 4
            count.append(n)
        out[odd] = count
        return out

    def _piece_sizes(self, pieces: pa.Array) -> np.ndarray:
        return np.fromiter(map(self.sizes.__getitem__, pieces.to_numpy(zero_copy_only=False)), np.int64, len(pieces))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a string array as little-endian unsigned 32-bit integers; null is empty."""
        if not self.known or (pc.any(pc.match_substring(texts, "<|")).as_py() or False):
            return [np.frombuffer(self._whole(t or ""), "<u4") for t in texts.to_pylist()]
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = lists.flatten().dictionary_encode()
        ids = [self._stretch(w) for w in words.dictionary.to_pylist()]
        flat = np.frombuffer(b"".join(ids), "<u4")
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first, word = np.cumsum(size) - size, words.indices.to_numpy()
        count = size[word]
        ends = np.concatenate([[0], np.cumsum(count)])
        out = flat[np.repeat(first[word] - ends[:-1], count) + np.arange(ends[-1])]
        cuts = ends[np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])]
        return [out[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def train_dictionary(docs: DataFrame, tokenizer_path: str, sample_docs: int = 1000, sample_bytes: int = 8192,
                     dictionary_bytes: int = 32768) -> bytes:
    """A zstandard dictionary for the id arrays, trained on at most ``sample_docs`` documents.

    The sample is bounded (``sample_docs`` arrays of at most ``sample_bytes``) and chosen by a hash. Too few or too
    short arrays for training serve as a raw dictionary instead.
    """
    total = docs.count()
    width = id_width(tokenizer_path)

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder.of(tokenizer_path)
        for batch in batches:
            ids = encoder.encode(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("u"), pa.array(
                [a.astype(width).tobytes()[:sample_bytes] for a in ids], pa.binary())], names=["u", "ids"])

    few = (docs.select("text", unit_hash(F.col("doc_id"), F.col("text")).alias("u"))
           .where(F.col("u") < min(1.0, 1.5 * sample_docs / max(total, 1))).dropDuplicates()
           .mapInArrow(arrays, "u double, ids binary").orderBy("u", "ids").limit(sample_docs))
    samples = [bytes(r.ids) for r in few.collect() if r.ids]
    if sum(map(len, samples)) >= 8 * dictionary_bytes and len(samples) >= 64:
        try:
            return zstandard.train_dictionary(dictionary_bytes, samples, level=3).as_bytes()
        except zstandard.ZstdError:
            pass
    return (b"".join(samples) or bytes(8))[:dictionary_bytes]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(data)


def id_width(tokenizer_path: str) -> str:
    return "<u2" if TextEncoder.of(tokenizer_path).vocabulary <= 1 << 16 else "<u4"


def write_shards(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, dictionary: bytes) -> DataFrame:
    """Write ``docs`` (doc_id, text) as shards below ``folder``; returns the committed manifest, one row a shard."""
    width, key = id_width(tokenizer_path), hashlib.sha256(dictionary).digest()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"{folder}/shard-{context.partitionId():06d}-{context.taskAttemptId()}.tok"
        encoder = TextEncoder.of(tokenizer_path)
        squeeze = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(dictionary), write_checksum=True)
        out, index, at, total = None, [], 0, 0
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for lo in range(0, batch.num_rows, 2048):
                arrays = encoder.encode(batch.column("text").slice(lo, 2048))
                for doc_id, array in zip(ids[lo:lo + 2048], arrays, strict=True):
                    if out is None:
                        store, path = open_folder(folder)
                        store.create_dir(path, recursive=True)
                        out = store.open_output_stream(f"{path}/{name.rpartition('/')[2]}")
                        at = out.write(MAGIC + key + bytes([int(width[2])]))
                    frame = squeeze.compress(np.append(array, np.uint32(end_id)).astype(width).tobytes())
                    out.write(frame)
                    index.append((at, len(frame), len(array) + 1, doc_id or 0, doc_id is not None))
                    at, total = at + len(frame), total + len(array) + 1
        if out is None:
            return
        out.write(np.array(index, INDEX).tobytes() + struct.pack(FOOTER, at, len(index), total, MAGIC))
        out.close()
        release()
        yield pa.RecordBatch.from_arrays([pa.array([context.partitionId()], pa.int32()), pa.array([name]),
                                          pa.array([len(index)], pa.int64()), pa.array([total], pa.int64())],
                                         names=["shard", "path", "docs", "ids"])

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .withColumn("h", F.xxhash64("text"))
               .repartitionByRange(F.col("doc_id").asc_nulls_last(), "h")
               .sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "h", "text").select("doc_id", "text"))
    return materialize(ordered.mapInArrow(write, "shard int, path string, docs bigint, ids bigint"), "token-manifest")


def read_document(path: str, position: int, dictionary: bytes) -> np.ndarray:
    """Ids of the ``position``-th document of a shard: footer, one index entry and one frame are read."""
    store, name = open_folder(path)
    with store.open_input_file(name) as f:
        size = f.size()
        at, n, _, magic = struct.unpack(FOOTER, f.read_at(FOOTER_BYTES, size - FOOTER_BYTES))
        head = f.read_at(41, 0)
        if magic != MAGIC or head[8:40] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path} is no shard of this dictionary")
        if not 0 <= position < n:
            raise IndexError(position)
        entry = np.frombuffer(f.read_at(INDEX.itemsize, at + INDEX.itemsize * position), INDEX)[0]
        frame = f.read_at(int(entry["length"]), int(entry["offset"]))
    return np.frombuffer(zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary)).decompress(frame),
                         f"<u{head[40]}").astype("<u4")


def read_shards(spark: SparkSession, manifest: DataFrame, dictionary: bytes, block: int = 4096) -> DataFrame:
    """Read shards back: per document its id, the number of ids before it, its ids and their CRC-32."""
    shards = manifest.orderBy("shard").collect()  # one row a shard
    if not shards:
        return empty_frame(spark, RESULT)
    base, todo = 0, []
    for s in shards:
        todo.append((s.path, base))
        base += s.ids

    key = hashlib.sha256(dictionary).digest()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                store, name = open_folder(path)
                with store.open_input_file(name) as f:
                    size = f.size()
                    at, n, _, magic = struct.unpack(FOOTER, f.read_at(FOOTER_BYTES, size - FOOTER_BYTES))
                    head = f.read_at(41, 0)
                    if magic != MAGIC or head[:8] != MAGIC or head[8:40] != key:
                        raise ValueError(f"{path} is no shard of this dictionary")
                    for lo in range(0, n, block):
                        index = np.frombuffer(f.read_at(INDEX.itemsize * min(block, n - lo),
                                                        at + INDEX.itemsize * lo), INDEX)
                        crc = []
                        for offset, length in zip(index["offset"].tolist(), index["length"].tolist(), strict=True):
                            ids = np.frombuffer(expand.decompress(f.read_at(length, offset)), f"<u{head[40]}")
                            crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                        counts = index["ids"].astype(np.int64)
                        starts = start + np.cumsum(counts) - counts
                        start += int(counts.sum())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(index["doc_id"].astype(np.int64), mask=index["present"] == 0),
                             pa.array(starts), pa.array(counts), pa.array(crc, pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = spark.createDataFrame(todo, "path string, base bigint").repartition(len(todo))
    return files.mapInArrow(read, RESULT)


def token_output(docs: DataFrame, tokenizer_path: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Encode, write and read back ``docs``: one row a document, see :func:`read_shards`."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "tokens")
    dictionary = train_dictionary(docs, tokenizer_path)
    store, path = open_folder(folder)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/dictionary.zdict") as f:
        f.write(dictionary)
    return read_shards(spark, write_shards(docs, folder, tokenizer_path, end_id, dictionary), dictionary)
