"""Token shards: exact ids, round trip, order, random access."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sluice.llm import tokenout
from sluice.llm.common import shared_folder
from sluice.plans.tables import table

SF_SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)


def ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


def expected(rows):
    out, start = [], 0
    for doc_id, text in rows:
        own = [*ids(text), 2]
        out.append((doc_id, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    return sorted(out, key=str)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.text("aeT'sd vl.é\n\u0301 <|ÀßİΣ½\u00a0\x85\x1c", max_size=40)), max_size=5))
def test_encoder_equals_the_library(texts):
    got = tokenout.TextEncoder.of(PATH).encode(pa.array(texts, pa.string()))
    assert [a.tolist() for a in got] == [ids(t) for t in texts]


def test_special_strings_and_small_memory():
    encoder = tokenout.TextEncoder(PATH, bound=3)
    texts = ["a <|endoftext|> b", "I'LL it's don't 'S", "one two three four five six seven", "one two", None, ""]
    for _ in range(3):
        assert [a.tolist() for a in encoder.encode(pa.array(texts))] == [ids(t) for t in texts]
    other = tokenout.TextEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.known and other.encode(pa.array(["Hi  there"]))[0].tolist() == plain.encode("Hi  there").ids


def test_driver_documents(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    got = tokenout.token_output(docs.repartition(7), PATH)
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_edges(spark):
    rows = [(3, "three three"), (1, None), (2, ""), (-4, "x"), (9, "long words " * 40000), (3, "three three"), (None, "none")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id bigint, text string, start int")
    want = expected([(-4, "x"), (1, None), (2, ""), (3, "three three"), (3, "three three"), (9, rows[4][1]), (None, "none")])
    assert sorted(map(tuple, tokenout.token_output(docs, PATH).collect()), key=str) == want
    assert tokenout.token_output(docs.limit(0), PATH).collect() == []
    # One id with several texts: in a fixed order, and all of them.
    same = spark.createDataFrame([(1, f"text {i % 5}") for i in range(50)], "doc_id bigint, text string")
    a, b = (sorted(map(tuple, tokenout.token_output(d, PATH).collect())) for d in (same, same.repartition(5)))
    assert a == b and len(a) == 50 and len({r[1] for r in a}) == 50


def test_short_document_access_and_wrong_dictionary(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    folder, dictionary = shared_folder(spark, "test-tokens"), tokenout.train_dictionary(docs, PATH, dictionary_bytes=4096)
    manifest = tokenout.write_shards(docs, folder, PATH, 2, dictionary).orderBy("shard").collect()
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    at = 0
    for shard in manifest:
        for k in (0, shard.docs - 1):
            assert tokenout.read_document(shard.path, k, dictionary).tolist() == [*ids(rows[at + k][1]), 2]
        with pytest.raises(IndexError):
            tokenout.read_document(shard.path, shard.docs, dictionary)
        at += shard.docs
    assert at == len(rows)
    with pytest.raises(ValueError):
        tokenout.read_document(manifest[0].path, 0, b"another dictionary")
