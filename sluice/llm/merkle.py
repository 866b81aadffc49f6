"""Merkle manifest of a dataset: a tree over the rows of every source, and one over the sources.

H is the lowercase hexadecimal SHA-256. A leaf is H of a row's fields, each
``-`` if null and else its UTF-8 byte count, ``:`` and its value. The leaves of
a source, in order, are cut into runs of ``arity``; H of a run's concatenated
digests is a node of the next level, until one is left: the subroot. Subroots
in order of their source give the root by the same rule.

Every level is one equijoin of the nodes with themselves: a run's first node
(slot zero) computes the indices of its siblings (the other one by XOR for
pairs, its own index plus 1 to ``arity`` - 1 otherwise), each sibling index
meets its node, and the slot-zero row emits the parent. Sources are part of
the key, indices the rest, so a source that holds a third of all rows is
spread like any other. Afterwards the levels are joined from the top down,
each run with the run of its parent, which gives every run the path from it to
the root, and at last every leaf with its run. A path holds arity digests a
level: its length grows with the logarithm of the rows.

Indices come from a range-partitioned sort of digests (no text is shuffled):
a row's index is its place in its partition plus the rows of its source in
earlier partitions. The driver sees the largest source's size and the root.

Defined cases: sources are ordered by their UTF-8 bytes, null first, and rows
by key, null first; rows that repeat a key are ordered by their leaf, and equal
leaves change nothing by changing places; a source of one row has its leaf as
subroot, and a single source's subroot is the root; null and empty fields
differ (``-`` and ``0:``); an empty table has no rows and no root. Columns that
are no field take no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.operators.joins import checked_broadcast
from sluice.session import materialize

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A field as it enters the leaf."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in fields]).cast("binary"), 256))


def _hexed(digests: str) -> str:
    return f"array_join(transform({digests}, d -> lower(hex(d))), '')"


def _parent(digests: str) -> str:
    """SQL for the binary digest of a run from the array of its binary digests."""
    return f"unhex(sha2(cast({_hexed(digests)} as binary), 256))"


def _indexed(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes`` with ``idx`` (from 0, within ``tree`` in the given order) and ``size`` (rows of the tree)."""
    count = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("tree"), *[F.col(c).asc_nulls_first() for c in order]]
    placed = materialize(nodes.repartitionByRange(count, *keys).sortWithinPartitions(*keys)
                         .withColumn("pid", F.spark_partition_id())
                         .withColumn("mid", F.monotonically_increasing_id()), "merkle-order")
    # A partition is sorted, so a tree's rows in it are consecutive: one row per tree and partition that holds it.
    parts = placed.groupBy("tree", "pid").agg(F.count("*").alias("n"), F.min("mid").alias("first"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("tree", "pid", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skipped"),
                          F.sum("n").over(whole).alias("size"))
    joined = placed.join(checked_broadcast(starts), ["tree", "pid"])
    return joined.withColumn("idx", F.col("mid") - F.col("first") + F.col("skipped")).drop("pid", "mid", "first", "skipped")


def sibling_index(idx: Column, shift: Column, arity: int) -> Column:
    """Index of the sibling ``shift`` slots after a node of slot zero."""
    return idx.bitwiseXOR(F.lit(1).cast("long")) if arity == 2 else idx + shift


def level(nodes: DataFrame, arity: int) -> DataFrame:
    """(tree, size, idx, members, digest): the parents of nodes (tree, size, idx, digest), with their children's digests
    in order. ``size`` counts the parents of the tree."""
    zero = nodes.where(F.col("idx") % arity == 0).select(
        "tree", "size", F.col("idx").alias("own"), F.explode(F.sequence(F.lit(1), F.lit(arity - 1))).alias("shift"))
    wanted = (zero.withColumn("idx", sibling_index(F.col("own"), F.col("shift"), arity)).where("idx < size")
              .select("tree", "idx", "own", "shift"))
    siblings = wanted.join(nodes.select("tree", "idx", "digest"), ["tree", "idx"]).select(
        "tree", "own", F.struct("shift", "digest").alias("s"), F.lit(None).cast("long").alias("size"))
    first = nodes.where(F.col("idx") % arity == 0).select(
        "tree", F.col("idx").alias("own"), F.struct(F.lit(0).alias("shift"), "digest").alias("s"), "size")
    # The slot-zero row and its siblings: at most ``arity`` rows.
    runs = siblings.unionByName(first).groupBy("tree", "own").agg(
        F.max("size").alias("size"), F.array_sort(F.collect_list("s")).getField("digest").alias("members"))
    return runs.select("tree", F.ceil(F.col("size") / arity).cast("long").alias("size"),
                       F.floor(F.col("own") / arity).cast("long").alias("idx"), "members",
                       F.expr(_parent("members")).alias("digest"))


def levels(nodes: DataFrame, arity: int) -> list[DataFrame]:
    """The levels above ``nodes`` (tree, size, idx, digest) from the bottom up, each written once."""
    largest = nodes.agg(F.max("size")).first()[0] or 0
    out = []
    while largest > 1:
        out.append(materialize(level(nodes.where("size > 1").select("tree", "size", "idx", "digest"), arity),
                               "merkle-level"))
        nodes, largest = out[-1], -(-largest // arity)
    return out


def roots(nodes: DataFrame, above: list[DataFrame]) -> DataFrame:
    """(tree, digest) of every tree's last node."""
    each = [x.where("size = 1").select("tree", "digest") for x in [nodes, *above]]
    out = each[0]
    for x in each[1:]:
        out = out.unionByName(x)
    return out


STEP = "struct<slot: int, members: array<binary>>"


def with_paths(nodes: DataFrame, above: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """``nodes`` with ``path``, the steps from a node to the end of its tree's path in ``tops`` (tree, path, and what
    else is known of a tree), and the other columns of ``tops``."""
    extra = [c for c in tops.columns if c not in ("tree", "path")]
    known = None  # (tree, run, steps) of the level above: its runs, each with the path that starts with it
    for runs in reversed([nodes, *above]):
        single = runs.where("size = 1").join(tops, "tree")  # one row a tree
        if known is not None:
            step = F.array(F.struct((F.col("idx") % arity).cast("int").alias("slot"), F.col("up_members").alias("members")))
            up = known.select("tree", F.col("idx").alias("up"), F.col("members").alias("up_members"), "path", *extra)
            many = (runs.where("size > 1").withColumn("up", F.floor(F.col("idx") / arity).cast("long"))
                    .join(up, ["tree", "up"]).withColumn("path", F.concat(step, F.col("path"))))
            single = single.unionByName(many.select(*single.columns))
        known = single
    return known


def _folded(start: str, path: str) -> str:
    """SQL for the digest that a leaf's digest and its path lead to."""
    return f"""aggregate({path}, {start}, (h, s) -> unhex(sha2(cast(concat({_hexed('slice(s.members, 1, s.slot)')},
      lower(hex(h)), {_hexed('slice(s.members, s.slot + 2, size(s.members))')}) as binary), 256)))"""


def _siblings(path: str) -> str:
    """SQL for the digests beside a path, level by level, left to right."""
    return f"""array_join(transform({path}, s -> concat({_hexed('slice(s.members, 1, s.slot)')},
      {_hexed('slice(s.members, s.slot + 2, size(s.members))')})), '')"""


def manifest(rows: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "source",
             arity: int = 16, seen: Column | None = None) -> DataFrame:
    """One row per row of ``rows``: (key, leaf, subroot, root, proof, path, folded_root, verified).

    ``leaf``, ``subroot`` and ``root`` are hexadecimal; ``path`` is the list of (slot, members) from the leaf to the
    root and ``proof`` H of the siblings along it. ``seen`` is an expression over ``rows`` for the leaf digest as found
    now (the row's own by default): ``folded_root`` is what it leads to, ``verified`` whether that is the root.
    """
    if arity < 2:
        raise ValueError("a tree needs at least two slots a run")
    own = leaf_digest([F.col(c) for c in fields])
    # A tree's name sorts as its group: null first, then by bytes.
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    now = own if seen is None else F.coalesce(seen, own)
    leaves = materialize(rows.select(F.col(key).alias("key"), tree.alias("tree"), own.alias("digest"), now.alias("seen"),
                                     F.monotonically_increasing_id().alias("row")), "merkle-leaves")
    # The row's number parts equal keys, so that copies of one row can lie in several partitions.
    ordered = materialize(_indexed(leaves, ["key", "digest", "row"]), "merkle-leaves")
    above = levels(ordered.select("tree", "size", "idx", "digest"), arity)
    subroots = roots(ordered, above)
    forest = materialize(_indexed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"]),
                         "merkle-forest")
    crown = levels(forest.select("tree", "size", "idx", "digest"), arity)
    root = roots(forest, crown).first()
    digest = None if root is None else root["digest"]
    end = forest.select("tree").limit(1).withColumn("path", F.expr(f"cast(array() as array<{STEP}>)"))
    tops = materialize(with_paths(forest, crown, end, arity).select(
        F.col("name").alias("tree"), F.col("digest").alias("subroot"), "path"), "merkle-tops")
    found = with_paths(ordered, above, tops, arity)
    folded = F.expr(_folded("seen", "path"))
    return found.select(
        F.col("key").alias(key), F.lower(F.hex("digest")).alias("leaf"), F.lower(F.hex("subroot")).alias("subroot"),
        F.lit(None if digest is None else digest.hex()).cast("string").alias("root"),
        F.sha2(F.expr(_siblings("path")).cast("binary"), 256).alias("proof"), "path",
        F.lower(F.hex(folded)).alias("folded_root"), (folded == F.lit(digest).cast("binary")).alias("verified"))
