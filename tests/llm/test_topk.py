"""Exact top-k search against brute force."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import topk
from sluice.llm.queries import OP1_SQL
from sluice.plans.tables import table

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string"


def brute(rows, k=5, every=50):
    vectors = []
    for vec_id, v, *_ in rows:
        if vec_id is None or v is None or any(x is None or not math.isfinite(np.float32(x)) for x in v):
            continue
        vectors.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for n, (q, own) in enumerate(vectors):
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(own, v, strict=True)), i) for m, (i, v) in enumerate(vectors)
                            if m != n and len(v) == len(own))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    got = topk.top_k(df, F.col("id") % 50 == 0, **options)
    assert got.columns == ["query_id", "rank", "id", "score"]
    return sorted(tuple(r) for r in got.collect())


def test_random_vectors_in_small_blocks(spark):
    dice = np.random.default_rng(1)
    rows = [(i, dice.normal(0, 0.2, 40).tolist(), 0, "x") for i in range(300)]
    assert found(spark, rows, block_rows=64, query_rows=2) == brute(rows)


def test_ties_repeats_nulls_lengths_and_small_tables(spark):
    same = [0.5, -0.25, 0.125]
    rows = [(i, same, 0, None) for i in range(60)] + [(7, same, 0, None), (8, [0.1, 0.1, 0.1], 0, None)]
    rows += [(100, None, 0, None), (150, [1.0, None, 1.0], 0, None), (200, [1.0, float("nan"), 1.0], 0, None),
             (250, [1.0, float("inf"), 1.0], 0, None), (None, same, 0, None), (300, [1.0, 2.0], 0, None),
             (301, [3.0, 2.0], 0, None), (350, [], 0, None), (351, [], 0, None)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    assert found(spark, [(0, same, 0, None)]) == []


def test_large_components_are_exact_or_refused(spark):
    rows = [(0, [1e7, 3e6], 0, None), (1, [2e6, 1e6 + 1], 0, None), (2, [5.0, -1e7], 0, None)]
    assert found(spark, rows) == brute(rows)
    with pytest.raises(OverflowError):
        topk._exact(np.array([2.0 ** 40, 1]), 0, np.array([[2.0 ** 40], [1.0]]), np.array([1]), np.array([1]), 5)


def test_survivors_are_compacted_without_losing_any():
    dice = np.random.default_rng(3)
    columns = np.floor(256 * dice.normal(0, 1, (64, 500)) * dice.exponential(1, 500))
    queries = columns[:, :5].T.copy()
    got = topk.search_blocks(queries, np.arange(5), columns, np.arange(500), np.arange(500), 5, step=8, chunk=120)
    for q, (ids, scores) in enumerate(got):
        whole = queries[q] @ columns
        want = sorted((-whole[i], i) for i in range(500) if i != q)[:5]
        assert [(-int(s), int(i)) for i, s in zip(ids, scores, strict=True)] == [(int(s), i) for s, i in want]


def test_rows_that_repeat_an_id_are_all_candidates_and_queries(spark):
    rows = [(i, [0.1 * (i % 7), -0.05 * (i % 5)], 0, None) for i in range(60)]
    rows += [(7, [9.0, 9.0], 0, None), (50, [1.0, -1.0], 0, None), (50, [0.0, 0.0], 0, None), (0, [2.0, 2.0], 0, None)]
    got = found(spark, rows)
    assert got == brute(rows)
    assert (0, 1, 7, 9 * 256 * 2 * 512) in got  # the second row of id 7 is the best of all
    assert sum(r[0] == 50 for r in got) == 15
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id bigint, embedding float[], label int)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", [r[:3] for r in rows])
    want = con.execute(f"SELECT query_id, rank, vec_id, score FROM ({OP1_SQL})").fetchall()
    assert sorted(want) == got


def test_bounds_prune_on_real_embeddings(spark):
    vectors = table(spark, "/root/testdata/sf0.1", "embeddings").orderBy("vec_id").select("vec_id", "embedding").collect()
    whole = np.floor(256 * np.array([r.embedding for r in vectors], float))
    ids, counter = np.array([r.vec_id for r in vectors]), [0, 0]
    asked = np.flatnonzero(ids % 50 == 0)
    got = topk.search_blocks(whole[asked], asked, np.ascontiguousarray(whole.T), ids, np.arange(len(ids)), 5, counter=counter)
    for q, (own, scores) in zip(asked, got, strict=True):
        every = whole @ whole[q]
        want = sorted((-every[i], ids[i]) for i in range(len(ids)) if i != q)[:5]
        assert [(-int(s), int(i)) for i, s in zip(own, scores, strict=True)] == [(int(s), int(i)) for s, i in want]
    print("share of the products made:", counter[0] / counter[1])
    assert counter[0] < 0.9 * counter[1]
