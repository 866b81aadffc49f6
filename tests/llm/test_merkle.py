"""Merkle manifest against a recursive tree in plain Python."""

import hashlib

import pytest
from pyspark.sql import functions as F

from sluice.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, idx int, tree string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    doc_id, text, lang, source, n_chars = row[:5]
    return h("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)))


def tree(digests, arity):
    """(root, siblings of every leaf by level as (left, right))."""
    paths = [[] for _ in digests]
    at = list(range(len(digests)))
    while len(digests) > 1:
        for i, k in enumerate(at):
            run = k // arity * arity
            paths[i].append((digests[run:k], digests[k + 1:run + arity]))
        digests = [h("".join(digests[i:i + arity])) for i in range(0, len(digests), arity)]
        at = [k // arity for k in at]
    return digests[0], paths


def brute(rows, arity, seen=leaf):
    """Sorted (doc_id, leaf, subroot, root, proof, folded, verified)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        made[name] = tree([leaf(r) for r in groups[name]], arity)
    if not names:
        return []
    root, tops = tree([made[n][0] for n in names], arity)
    out = []
    for name, top in zip(names, tops, strict=True):
        for r, path in zip(groups[name], made[name][1], strict=True):
            now = seen(r)
            for left, right in path + top:
                now = h("".join([*left, now, *right]))
            beside = "".join(x for left, right in path + top for x in left + right)
            out.append((r[0], leaf(r), made[name][0], root, h(beside), now, now == root))
    return sorted(out, key=str)


def found(spark, rows, arity, **options):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    got = merkle.manifest(df, arity=arity, **options).drop("path")
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def corpus(n):
    rows = [(i * 7 % n, f"Text {i} ÄÖ" if i % 11 else None, ["en", None, ""][i % 3], ["hot", "b", None, "", "Ü"][i % 5] if i % 2 else "hot",
             i if i % 4 else None) for i in range(n)]
    rows += [(3, "copy", "en", "copies", 4)] * 40 + [(None, "no id", "en", "copies", 5), (None, None, None, None, None)]
    return rows + [(5, "x" * 200_000, "en", "single", 1), (3, "other", "en", "copies", 4)]


@pytest.mark.parametrize("arity", [2, 3, 16])
def test_trees_of_every_arity(spark, arity):
    rows = corpus(300)
    got = found(spark, rows, arity)
    assert got == brute(rows, arity) and all(r[-1] for r in got)


def test_tampered_leaves_lead_elsewhere(spark):
    rows = corpus(80)
    lowered = merkle.leaf_digest([F.translate(c, "TÄ", "tÄ") if c == "text" else F.col(c) for c in merkle.FIELDS])
    got = found(spark, rows, 4, seen=F.when(F.col("doc_id") % 5 == 0, lowered))
    want = brute(rows, 4, lambda r: leaf((r[0], r[1] and r[1].replace("T", "t"), *r[2:])) if r[0] is not None and r[0] % 5 == 0
                 else leaf(r))
    assert got == want and 0 < sum(r[-1] for r in got) < len(got)


def test_small_tables(spark):
    one = [(1, "a", "en", "s", 1)]
    assert found(spark, [], 16) == []
    assert found(spark, one, 16) == brute(one, 16)
    same = one * 17  # the last run holds one leaf
    assert found(spark, same, 16) == brute(same, 16)
    each = [(i, "a", "en", f"s{i}", 1) for i in range(20)]
    assert found(spark, each, 16) == brute(each, 16)
    with pytest.raises(ValueError):
        found(spark, one, 1)


def test_path_is_a_proof(spark):
    rows = corpus(60)
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    for r in merkle.manifest(df, arity=4).collect():
        now = r.leaf
        for step in r.path:
            members = [bytes(m).hex() for m in step.members]
            assert members[step.slot] == now
            now = h("".join(members))
        assert now == r.root


def test_no_level_joins_all_pairs(spark):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in corpus(60)], SCHEMA)
    plan = merkle.manifest(df)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
