"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed by cell (source, language, topic) in one pre-aggregated
shuffle. The cells' token weights are raked: source, language and topic
totals are scaled to their target shares in turn until all three hold. A
cell's weight ratio (raked by original tokens), scaled so that it is a
probability, is the chance that each of its documents is kept; a document is
kept if its hash falls below that, so a run can be repeated.

Tokens are the ids of ``tokenizer``, the one the corpus is written with,
counted once and kept with the row. Without a tokenizer they are stretches
between blanks and line ends, which is right only for scripts with blanks.

Targets are shares given by category, or tempered from the corpus: a
category's share is proportional to its tokens to the power ``temperature``
(1 keeps the mix, 0 makes it even). Probabilities above 1 are cut to 1; the
common factor is the largest at which at most ``clip`` of the expected tokens
is lost that way.

Cells are few next to documents. Up to ``max_cells`` they are raked on the
driver; above that by Spark, in rounds written to the scratch folder. Both
ways run until the largest error of a marginal share is below one tolerance,
and take the exact common factor; they differ by the rounding of sums. Targets
that are not reached in the rounds allowed are reported by a warning.

Defined cases: null source, language and text have a category of their own
(the topic of a null text is ``empty``); a text without tokens has weight 0
tokens and the probability of its cell; a category without a target gets
none of its tokens; targets without tokens are left out and the others
scaled up; repeated rows are kept or dropped together; all columns are kept
and the result is one struct column with a fresh name.
"""

from __future__ import annotations

import warnings

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import fresh_name, unit_hash, with_struct
from sluice.llm.tokenout import TextEncoder
from sluice.session import materialize

MARGINS = ("source", "lang", "topic")
_NULL = "\x00null"  # stands for null in keys
TOLERANCE, ROUNDS = 1e-10, 1000

# Topics by the first sign that is found; otherwise "prose". A sign is one of the words (in any case), or a pattern that is
# only looked for where one of its characters stands.
TOPICS = (("legal", ("license", "licence", "copyright", "warranty", "warranties"), None),
          ("contact", ("@", "+"), r"[0-9A-Za-z]@[0-9A-Za-z]|\+[0-9]"),
          ("table", ("|",), r"\|[^|\n]*\|"), ("web", ("http://", "https://"), None))


def topic(text: Column, topics: tuple = TOPICS) -> Column:
    out = F.when(text.isNull() | (text == ""), F.lit("empty"))
    for name, words, pattern in topics:
        there = None
        for w in words:
            now = F.contains(text if w == w.upper() or "/" in w else F.lower(text), F.lit(w))
            there = now if there is None else there | now
        out = out.when(there if pattern is None else there & text.rlike(pattern), F.lit(name))
    return out.otherwise("prose")


def tokens(text: Column) -> Column:
    """Stretches between blanks and line ends, counted as blanks and line ends plus one; none in null or empty."""
    bare = F.replace(F.replace(text, F.lit(" "), F.lit("")), F.lit("\n"), F.lit(""))
    return F.when(F.length(text) > 0, F.length(text) - F.length(bare) + 1).otherwise(0).cast("long")


def with_cells(docs: DataFrame, tokenizer: str | None, topic_of: Column | None, keep: list[str]) -> tuple[DataFrame, str]:
    """The columns ``keep`` of ``docs`` and, in a struct, what the mix needs of a row: its cell, its tokens and its place
    in the draw. With a tokenizer the ids of each text (none for null) are counted. Written once: no text is read or
    searched a second time, and none is written unless it is kept."""
    made = fresh_name(docs.columns, "mixing_row")
    text, n = F.col("text"), fresh_name([*docs.columns, made], "mixing_ids")

    def make():
        encoder = TextEncoder.of(tokenizer)
        return lambda batch: [pa.array(encoder.counts(batch.column("text")), pa.int64())]

    row = F.struct(F.coalesce(F.col("source").cast("string"), F.lit(_NULL)).alias("source"),
                   F.coalesce(F.col("lang").cast("string"), F.lit(_NULL)).alias("lang"),
                   (topic(text) if topic_of is None else topic_of).alias("topic"),
                   unit_hash(F.col("doc_id"), text).alias("u"))
    rows = docs.withColumn(made, row)
    if tokenizer is None:
        rows, count = rows.withColumn(n, F.struct(tokens(text).alias("n"))), n
    else:
        rows, count = with_struct(rows, n, "struct<n: bigint>", make, keep=[*keep, made]), n
    return materialize(rows.select(*keep, F.col(made).withField("tokens", F.col(count)["n"]).alias(made)), "mixing-rows"), made


def target_shares(totals: pd.Series, target: float | dict) -> pd.Series:
    """Shares of the categories of ``totals`` (tokens by category): tempered, or the given ones scaled to 1."""
    if isinstance(target, dict):
        shares = pd.Series({k: float(target.get(None if k == _NULL else k, 0.0)) for k in totals.index}, dtype=float)
    else:
        shares = totals.astype(float) ** float(target)
    shares = shares.where(totals > 0, 0.0)
    if shares.sum() <= 0:
        raise ValueError("no target category has tokens")
    return shares / shares.sum()


def rake(cells: pd.DataFrame, targets: dict[str, float | dict], tolerance: float = TOLERANCE,
         rounds: int = ROUNDS) -> np.ndarray:
    """Raked tokens of the cells (columns of ``MARGINS`` and ``tokens``); their sum is 1."""
    weight = cells["tokens"].to_numpy(float)
    if not weight.sum():
        return weight
    axes = []
    for m in targets:
        code, names = pd.factorize(cells[m], sort=True)
        totals = pd.Series(np.bincount(code, weight, len(names)), names)
        axes.append((code, target_shares(totals, targets[m]).to_numpy()))
    weight = weight / weight.sum()
    for _ in range(rounds):
        for code, share in axes:
            now = np.bincount(code, weight, len(share))
            factor = np.divide(share, now, out=np.zeros_like(share), where=now > 0)
            weight = weight * factor[code]
        error = max((float(np.abs(np.bincount(code, weight, len(share)) - share).max()) for code, share in axes), default=0.0)
        if error < tolerance:
            return weight
    _unreached(error, rounds)
    return weight


def _unreached(error: float, rounds: int) -> None:
    warnings.warn(f"mixing: targets missed by up to {error:.3g} of all tokens after {rounds} rounds", stacklevel=3)


def rake_frames(cells: DataFrame, targets: dict[str, float | dict], rounds: int = ROUNDS,
                tolerance: float = TOLERANCE) -> DataFrame:
    """The same on a DataFrame of cells: adds the column ``raked``."""
    spark = cells.sparkSession
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    now = cells.withColumn("raked", F.col("tokens") / F.lit(float(max(total, 1))))
    shares = {}
    for m, target in targets.items():
        sums = cells.groupBy(m).agg(F.sum("tokens").cast("double").alias("t")).where("t > 0")
        if isinstance(target, dict):
            given = spark.createDataFrame([(_NULL if k is None else k, float(v)) for k, v in target.items()],
                                          f"{m} string, share double")
            sums = sums.join(given, m)
        else:
            sums = sums.withColumn("share", F.pow("t", F.lit(float(target))))
        whole = sums.agg(F.sum("share")).first()[0]
        shares[m] = materialize(sums.select(m, (F.col("share") / whole).alias("share")), "mixing-shares")
    for _ in range(rounds):
        for m in targets:
            factor = (now.groupBy(m).agg(F.sum("raked").alias("s")).join(shares[m], m, "left")
                      .select(m, F.coalesce(F.when(F.col("s") > 0, F.col("share") / F.col("s")), F.lit(0.0)).alias("f")))
            now = now.join(factor, m).withColumn("raked", F.col("raked") * F.col("f")).drop("f")
        now = materialize(now, "mixing-cells")
        errors = None
        for m in targets:
            each = (now.groupBy(m).agg(F.sum("raked").alias("s")).join(shares[m], m, "left")
                    .select(F.abs(F.col("s") - F.coalesce("share", F.lit(0.0))).alias("e")))
            errors = each if errors is None else errors.unionAll(each)
        error = (errors.agg(F.max("e")).first()[0] or 0.0) if total and errors is not None else 0.0
        if error < tolerance:
            return now
    _unreached(error, rounds)
    return now


def scale(ratio: np.ndarray, raked: np.ndarray, clip: float) -> float:
    """The largest factor c for which cutting c * ratio at 1 loses at most ``clip`` of the expected tokens."""
    some = ratio > 0
    if not some.any():
        return 0.0
    order = np.argsort(-ratio[some], kind="stable")
    r, w = ratio[some][order], raked[some][order]
    # With c = 1 / r[i], cells before i are cut: their expected tokens c * w fall to c * w * r[i] / r.
    lost = np.cumsum(w) - w - (np.cumsum(w / r) - w / r) * r
    fits = np.flatnonzero(lost <= clip * w.sum())
    return float(1 / r[fits[-1]])


def scale_frames(cells: DataFrame, clip: float, ways: int = 4096) -> float:
    """``scale`` of the columns weight and raked of a DataFrame: the range that holds the factor is cut into ``ways``
    parts until a part holds one ratio."""
    some = cells.where("weight > 0")
    low, high, total = some.agg(F.min("weight"), F.max("weight"), F.sum("raked")).first()
    if low is None:
        return 0.0
    w = q = 0.0  # raked and original tokens of the cells above the range
    best = high
    while True:
        at = F.least(F.lit(ways - 1), F.floor((F.lit(high) - F.col("weight")) / F.lit((high - low) or 1.0) * ways))
        parts = (some.where(F.col("weight").between(low, high)).groupBy(at.alias("part"))
                 .agg(F.sum("raked").alias("w"), F.sum(F.col("raked") / F.col("weight")).alias("q"),
                      F.min("weight").alias("low"), F.max("weight").alias("high")).orderBy("part").collect())
        for part in parts:
            # Cells as large as the ratio lose nothing, so only those above count.
            if w - q * part["high"] > clip * total:
                return float(1 / best)
            best = part["high"]
            if part["low"] < part["high"] and w + part["w"] - (q + part["q"]) * part["low"] > clip * total:
                low, high = part["low"], part["high"]
                break
            best, w, q = part["low"], w + part["w"], q + part["q"]
        else:
            return float(1 / best)


def mix(docs: DataFrame, targets: dict[str, float | dict], clip: float = 0.01, max_cells: int = 200_000,
        into: str = "mixing", topic_of: Column | None = None, tokenizer: str | None = None,
        keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """``docs`` (doc_id, text, lang, source; its columns ``keep``, all by default) with a struct column (topic, n_tokens,
    weight, probability, selected).

    ``targets`` maps source, lang and topic to a temperature or to shares by category. ``weight`` is the raked share
    of a cell's tokens by their original share.
    """
    spark = docs.sparkSession
    keep = list(docs.columns) if keep is None else list(keep)
    into = fresh_name(docs.columns, into)
    docs, row = with_cells(docs, tokenizer, topic_of, keep)
    cells = materialize(docs.select(f"{row}.*").groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "mixing-cells")
    if (count := cells.count()) <= max_cells:
        local = cells.orderBy(*MARGINS).toPandas()
        raked = rake(local, targets) if count else np.zeros(0)
        whole = float(local["tokens"].sum())
        own = local["tokens"].to_numpy(float) / max(whole, 1.0)
        ratio = np.divide(raked, own, out=np.zeros_like(own), where=own > 0)
        chance = np.minimum(1.0, ratio * scale(ratio, raked, clip))
        # Bounded by max_cells rows; a cell without tokens keeps its documents.
        chance = np.where(own > 0, chance, 1.0)
        rows = [(*k, float(r), float(p)) for k, r, p in zip(local[list(MARGINS)].itertuples(index=False, name=None),
                                                            ratio, chance, strict=True)]
        factors = F.broadcast(spark.createDataFrame(rows, "source string, lang string, topic string, "
                                                          "weight double, probability double"))
    else:
        raked_cells = rake_frames(cells, targets)
        total = float(raked_cells.agg(F.sum("tokens")).first()[0])
        ratios = raked_cells.withColumn("weight", F.when(F.col("tokens") > 0, F.col("raked") * total / F.col("tokens"))
                                        .otherwise(0.0))
        c = scale_frames(materialize(ratios.select("weight", "raked"), "mixing-ratios"), clip)
        factors = ratios.select(*MARGINS, "weight", F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("weight") * c))
                                .otherwise(1.0).alias("probability"))
    factors = factors.select(*[F.col(m).alias(f"_{m}_cell") for m in MARGINS],
                             F.col("weight").alias("_weight_cell"), F.col("probability").alias("_probability_cell"))
    same = None
    for m in MARGINS:
        now = F.col(row)[m] == F.col(f"_{m}_cell")
        same = now if same is None else same & now
    chosen = F.struct(F.col("_topic_cell").alias("topic"), F.col(row)["tokens"].alias("n_tokens"),
                      F.col("_weight_cell").alias("weight"), F.col("_probability_cell").alias("probability"),
                      (F.col(row)["u"] < F.col("_probability_cell")).alias("selected"))
    return docs.join(factors, same, "left").select(*keep, chosen.alias(into)), into
