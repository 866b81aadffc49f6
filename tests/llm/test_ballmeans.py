"""Ball k-means codes against plain rounds over all entries."""

import math

import numpy as np
import pytest

from sluice.llm import ballmeans

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, cell int"


def whole(rows, dims=None):
    out = []
    for r in rows:
        v = r[1]
        if v is not None and all(x is not None and math.isfinite(np.float32(x)) for x in v):
            out.append((r[0], r[2], [math.floor(256 * float(np.float32(x))) for x in v]))
    out.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    return [r for r in out if len(r[2]) == len(out[0][2])]


def brute(rows, parts=16, entries=64, rounds=2):
    """(sorted (id, label, code, error), codebooks) by comparing everything with everything."""
    rows = whole(rows)
    dims = len(rows[0][2]) if rows else 0
    cuts = np.cumsum([0] + [dims // parts + (p < dims % parts) for p in range(parts)])
    cut = [[tuple(v[cuts[p]:cuts[p + 1]]) for p in range(parts)] for _, _, v in rows]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for c in cut:
                held.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            books[p] = [tuple(sum(k) // len(held[i]) for k in zip(*held[i], strict=True)) if i in held else e
                        for i, e in enumerate(books[p])]
    out = []
    for (i, label, _), c in zip(rows, cut, strict=True):
        best = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((i, label, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)))
    return sorted(out, key=str), books


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got, books = ballmeans.encode(df, keep=["label", "cell"], **options)
    assert got.columns == ["vec_id", "label", "cell", "code", "error"]
    want, entries = brute(rows, **options)
    assert sorted((tuple(r) for r in got.drop("cell").collect()), key=str) == want
    flat = [[tuple(e[:w]) for e in books.entries[p].tolist()] for p, w in enumerate(books.widths)]
    assert flat == entries
    return got


def clustered(n, dims, seed=0):
    dice = np.random.default_rng(seed)
    centres = dice.normal(0, 0.4, (12, dims))
    return [(i, (centres[i % 12] + dice.normal(0, 0.05, dims)).tolist(), i % 5 if i % 7 else None) for i in range(n)]


def test_clustered_and_random_vectors(spark):
    check(spark, clustered(400, 32))
    dice = np.random.default_rng(2)
    check(spark, [(i, dice.normal(0, 0.1, 64).tolist(), 0) for i in range(300)])


def test_other_parts_entries_and_rounds(spark):
    rows = clustered(150, 10, 1)
    check(spark, rows, parts=4, entries=7, rounds=5)
    check(spark, rows, parts=3, entries=200, rounds=1)
    check(spark, rows, parts=16, entries=3, rounds=0)


def test_ties_nulls_repeats_and_lengths(spark):
    rows = [(i, [float(i % 3), 0.5, -0.25, 0.0], None) for i in range(90)] + [(7, [1.0, 0.5, -0.25, 0.0], 1)] * 30
    rows += [(200, None, 1), (201, [1.0, None, 1.0, 1.0], 1), (202, [float("nan")] * 4, 1), (203, [float("-inf")] * 4, 1),
             (204, [1.0, 2.0], 1), (205, [], 1), (None, [9.0, 9.0, 9.0, 9.0], 2), (None, [8.0, 9.0, 9.0, 9.0], None)]
    check(spark, rows, parts=2, entries=5)
    check(spark, rows, parts=2)
    check(spark, [])
    check(spark, [(3, None, 1)])
    check(spark, [(3, [0.25, -0.001], 1)], parts=2)
    check(spark, [(3, [], 1), (4, [], None)], parts=2)


def test_what_is_refused(spark):
    df = spark.createDataFrame([(1, [1e9], 0, "x", 1)], SCHEMA)
    with pytest.raises(Exception, match="24 bits"):
        ballmeans.encode(df)[0].collect()
    with pytest.raises(ValueError):
        ballmeans.encode(df, entries=257)
    with pytest.raises(ValueError):
        ballmeans.encode(df.withColumnRenamed("label", "Error"), keep=["Error"])


def test_balls_skip_work_and_change_nothing():
    dice = np.random.default_rng(4)
    x = np.floor(dice.normal(0, 60, (1500, 4, 4))).astype(np.int64)
    entries = x[:64].transpose(1, 0, 2)
    codes, dist = ballmeans.assign_all(x, entries)
    radii = np.zeros((4, 64))
    for p in range(4):
        np.maximum.at(radii[p], codes[:, p], np.sqrt(dist[:, p]))
    moved = entries + dice.integers(-4, 5, entries.shape)
    reach = radii + np.sqrt(np.square(moved - entries).sum(axis=2)) + 1e-6
    got = ballmeans.assign_near(x, moved, codes, ballmeans.balls(moved, reach))
    want = ballmeans.assign_all(x, moved)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
    assert got[2] < 0.5 * x.shape[0] * 4 * 63  # most of the comparisons are not made
    still = ballmeans.assign_near(entries.transpose(1, 0, 2), entries, np.tile(np.arange(64)[:, None], 4),
                                  ballmeans.balls(entries, np.zeros((4, 64))))
    assert still[2] == 0  # every part lies in its core
