"""The n-gram join against brute force on whole texts."""

import collections
import random

import pytest

from sluice.llm import jaccard
from sluice.llm.common import words_of
from sluice.llm.components import connected_components
from sluice.plans.tables import table

SF_SMALL = "/root/testdata/sf0.001"


def brute(rows, threshold=0.8):
    sets = []
    for _, text in rows:
        w = words_of(text.encode() if text else None)
        n = min(5, len(w))
        sets.append(frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if w else frozenset())
    parent, links = list(range(len(rows))), collections.Counter()

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and common >= threshold * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[max(top(a), top(b))] = min(top(a), top(b))
    ids = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        ids[top(i)] += [doc_id] if doc_id is not None else []
    return sorted(((d, min(ids[top(i)], default=None), links[i]) for i, (d, _) in enumerate(rows)), key=str)


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, class_id string")
    return sorted((tuple(r) for r in jaccard.near_duplicates(df, **options)
                   .select("doc_id", "class_id", "n_links").collect()), key=str)


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.998), (0.8, 0.9), (0.5, 0.95)):
        bands, rows = jaccard.choose_bands(threshold, recall)
        assert bands * rows <= 192 and 1 - (1 - threshold ** rows) ** bands >= recall
    assert jaccard.choose_bands(1.0, 0.99)[0] == 1
    with pytest.raises(ValueError):
        jaccard.choose_bands(0.01, 0.999)


def test_driver_documents(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    assert found(spark, rows) == brute(rows)


def test_edges_and_a_group_over_many_blocks(spark):
    dice = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = [(None, None), (1, None), (2, ""), (3, "..."), (4, "two words"), (5, "Two, words!"), (6, "one"), (None, "one"),
            (7, "x y z " * 30000), (8, "x y z " * 29000)]
    for i in range(20, 70):  # near copies of each other, all different
        text = list(base)
        text[dice.randrange(120)] = f"n{i}"
        rows.append((i, " ".join(text)))
    rows += [(i, " ".join(base)) for i in range(70, 90)] + [(70, " ".join(base))] * 2  # exact copies, repeated rows
    rows += [(95, " ".join(base[:60] + [f"o{i}" for i in range(60)]))]  # half the same: no link
    want = brute(rows)
    assert found(spark, rows) == want
    assert found(spark, rows, block=8) == want  # the same over many pairs of blocks
    assert found(spark, []) == []


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (102, 100), (200, 200), (-5, 300)]
    labels = dict(connected_components(spark.createDataFrame(chain, "u bigint, v bigint")).collect())
    assert all(labels[i] == 0 for i in range(61)) and labels[102] == 100 and labels[300] == -5 and 200 not in labels
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_blocks_are_cut_by_shingles_too(spark):
    dice = random.Random(7)
    base = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(12):
        text = list(base)
        text[dice.randrange(3000)] = f"n{i}"
        rows.append((i, " ".join(text)))
    rows += [(20, "a b c d e f"), (21, "a b c d e f"), (22, "a b c d e g")]
    assert found(spark, rows, block_shingles=5000) == brute(rows)


def test_small_groups_take_small_matrices():
    import time

    import numpy as np
    sets = [np.sort(np.random.default_rng(i).integers(0, 400, 300, dtype=np.uint64)) for i in range(2)]
    sets = [np.unique(s) for s in sets]
    start = time.perf_counter()
    for _ in range(200):
        assert jaccard.common_counts(sets)[0, 1] == len(np.intersect1d(*sets))
    assert time.perf_counter() - start < 1
