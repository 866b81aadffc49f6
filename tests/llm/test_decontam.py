"""Wu-Manber search against window-by-window search."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.llm import decontam
from sluice.llm.common import words_of
from sluice.llm.queries import ORACLES

DOCS = "doc_id bigint, text string, contamination string, n_words int"


def brute(text, items, size):
    words, hit, ids = words_of(text.encode() if text else None), set(), set()
    for item_id, item in items:
        own = words_of(item.encode() if item else None)
        n = min(size, len(own))
        windows = {tuple(own[i:i + n]) for i in range(len(own) - n + 1)} if own else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i:i + n]) in windows:
                hit |= set(range(i, i + n))
                ids.add(item_id)
    return len(words), len(hit), sorted(str(i) for i in ids if i is not None)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab ", max_size=14), max_size=4), st.text("abc ", max_size=60), st.integers(1, 5))
def test_search_finds_every_window(items, text, size):
    matcher = decontam.Matcher([(str(i), t.encode()) for i, t in enumerate(items)], size)
    words = words_of(text.encode())
    ids, spans = matcher.match(words)
    assert (len(words), sum(b - a + 1 for a, b in spans), sorted(ids)) == brute(text, list(enumerate(items)), size)


def rows_and_items():
    dice = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)]
    say = lambda n: " ".join(dice.choices(vocabulary, k=n))
    items = [(i, say(dice.choice([1, 5, 13, 20, 40]))) for i in range(12)] + [(3, None), (12, ""), (13, "..."), (None, say(14))]
    items.append(items[4])
    rows = [(i, say(30) + " " + (items[i % 17][1] or "") + "! " + say(20).upper()) for i in range(40)]
    rows += [(None, items[2][1]), (50, None), (51, ""), (52, "?!"), (53, "w1"), (54, items[4][1] * 3000), rows[0], rows[0]]
    return rows, items


def test_edges_in_one_chunk_and_in_many(spark):
    rows, items = rows_and_items()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS)
    benchmark = spark.createDataFrame([(*r, 1) for r in items], "item_id bigint, text string, raw int")
    want = sorted((str(r[0]), *brute(r[1], items, 13)) for r in rows)
    for options in ({}, {"chunk_bytes": 300}):
        found, name = decontam.find_contamination(docs, benchmark, **options)
        assert found.columns == [*docs.columns, name] and name == "contamination_"
        got = found.select("doc_id", f"{name}.n_words", f"{name}.n_hit", f"{name}.item_ids").collect()
        assert sorted((str(a), b, c, list(d)) for a, b, c, d in got) == want
    empty, name = decontam.find_contamination(docs.limit(0), benchmark)
    assert empty.count() == 0
    clean, name = decontam.find_contamination(docs, benchmark.limit(0))
    assert clean.where(decontam.is_contaminated(name)).count() == 0 and clean.count() == len(rows)


def test_share_rule(spark):
    values = spark.createDataFrame([(0, 0), (1, 20), (1, 21), (0, 5), (13, 260)], "n_hit bigint, n_words bigint")
    judged = values.select(F.struct("n_hit", "n_words").alias("c")).select(decontam.is_contaminated("c")).collect()
    assert [r[0] for r in judged] == [False, True, False, False, True]
    assert "op4_decontamination" in ORACLES


def test_tables_stay_small_and_are_built_once():
    import time
    dice = random.Random(9)
    vocabulary = [f"word{i}" for i in range(40_000)]
    items = [(str(i), " ".join(dice.choices(vocabulary, k=400)).encode()) for i in range(900)]
    size = sum(len(raw) for _, raw in items)
    assert size > 3_000_000
    start = time.perf_counter()
    matcher = decontam.built(items, 13, b"key")
    assert time.perf_counter() - start < 10 and matcher.bytes() < 40 * size
    assert decontam.built([], 13, b"key") is matcher
    text = items[7][1][:300] + b" something else entirely " + items[8][1]
    ids, spans = matcher.match(words_of(text))
    assert ids == {"7", "8"} and len(spans) == 2
