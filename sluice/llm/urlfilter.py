"""URL filter: listed rules, and for the rest the ratio of two character language models.

A rule is a host and the beginning of a path; it fits its host, all
subdomains, and paths that start with its own. The longest rule that fits
decides. URLs that rules decide are also the models' labelled corpus: one
variable-order Markov model for accepted and one for rejected URLs, with
Witten-Bell smoothing from the longest seen context of up to ``order``
characters down to a uniform letter.

All of it is DataFrame work: the counts of every context and letter are one
pre-aggregated shuffle of the labelled URLs' grams; each order's
probabilities come from a window over a context, which holds at most one row
a letter, and a join with the next shorter order. Every URL's grams are
joined with their log ratios and summed in whole millionths, so sums do not
depend on the order of addition. All joins are hinted as merges of shuffled
sides: Spark judges the grams by the size of the URLs' file, some hundred
times too small, and would gather them on the driver for a broadcast.
Collected is a histogram with a bounded number of bins.

Calibration: three quarters of the labelled URLs are counted; on the last
quarter, chosen by a hash, the threshold on the length-normalised log ratio
is set so that the shares of wrongly rejected and wrongly accepted URLs have
the least sum.

Defined cases: a null url or one without "://" has an empty host and path, no
rule, and is scored as an empty text; without held-out URLs of both labels
every other URL is allowed; repeated rows are judged alike; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import unit_hash
from sluice.session import materialize

START, END = "\x02", "\x03"
LETTERS = 1 << 16  # the uniform model's letters
BIN = 1000  # millionths of a nat per character in a bin of the histogram
BINS = 20_000  # bins on either side of 0

Rule = tuple[str, str, str]  # host, path, verdict


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def after_scheme(url: Column) -> Column:
    """What follows the first "://", or an empty string."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = after_scheme(url)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return lower_ascii(host), path


def rule_verdict(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule as host + path, verdict) of the longest rule that fits; null if none does. Ties go to the first listed."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for own, start, judged in reversed(sorted(rules, key=lambda r: -len(r[0] + r[1]))):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        name, verdict = F.when(fits, own + start).otherwise(name), F.when(fits, judged).otherwise(verdict)
    return name, verdict


def grams(text: Column, order: int) -> Column:
    """Per letter of the text and for its end, the letter with the ``order`` letters before it."""
    # The letters are cut once: taking the i-th piece of a text again and again reads it from its start every time.
    letters = F.split(F.concat(F.lit(START * order), text, F.lit(END)), "")
    return F.transform(F.array(F.struct(letters.alias("letters"))), lambda s: F.transform(
        F.sequence(F.lit(1), F.size(s["letters"]) - order),
        lambda i: F.array_join(F.slice(s["letters"], i, order + 1), "")))[0]


def log_ratios(counts: DataFrame, order: int) -> DataFrame:
    """(gram, ratio) from (gram, good, bad): the log ratio of the two smoothed models in whole millionths."""
    levels = [counts.select(F.col("gram").alias("s"), "good", "bad")]
    for k in range(order, 0, -1):
        levels.append(levels[-1].groupBy(F.expr(f"right(s, {k})").alias("s"))
                      .agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")))
    shorter = None
    for k, level in enumerate(reversed(levels)):
        seen = Window.partitionBy(F.substring("s", 1, k))  # at most one row a letter
        now = level.select("s", *[c for kind in ("good", "bad") for c in (
            F.col(kind).alias(f"n_{kind}"), F.sum(kind).over(seen).alias(f"all_{kind}"),
            F.count_if(F.col(kind) > 0).over(seen).alias(f"types_{kind}"))])
        if shorter is None:
            now = now.withColumns({f"p_{kind}": F.lit(1.0 / LETTERS) for kind in ("good", "bad")})
        else:
            now = now.withColumn("tail", F.expr(f"right(s, {k})")).join(shorter.hint("merge"), "tail").drop("tail")
        smooth = {kind: F.when(F.col(f"all_{kind}") == 0, F.col(f"p_{kind}")).otherwise(
            (F.col(f"n_{kind}") + F.col(f"types_{kind}") * F.col(f"p_{kind}"))
            / (F.col(f"all_{kind}") + F.col(f"types_{kind}"))) for kind in ("good", "bad")}
        shorter = now.select(F.col("s").alias("tail"), *[p.alias(f"p_{kind}") for kind, p in smooth.items()])
    ratio = F.round((F.ln("p_good") - F.ln("p_bad")) * 1_000_000).cast("long")
    return shorter.select(F.col("tail").alias("gram"), ratio.alias("ratio"))


def threshold(bins: list[tuple[int, int, int]]) -> int | None:
    """The bin from which on URLs are allowed, from (bin, accepted, rejected) counts; None without both kinds."""
    good, bad = sum(g for _, g, _ in bins), sum(b for _, _, b in bins)
    if not good or not bad:
        return None
    ordered = sorted(bins)
    best, least = ordered[0][0], 1.0  # everything allowed: all rejected ones pass
    lost = passed = 0
    for i, (_, g, b) in enumerate(ordered):
        lost, passed = lost + g, passed + b
        error = lost / good + (bad - passed) / bad
        if error < least:
            best, least = ordered[i + 1][0] if i + 1 < len(ordered) else ordered[i][0] + 1, error
    return best


def judge(pages: DataFrame, rules: Sequence[Rule], order: int = 5) -> DataFrame:
    """(page_id, host, path, rule, score, verdict) for every row of ``pages`` (page_id, url).

    ``score`` is the log ratio per letter, rounded to millionths; the threshold is in the same unit.
    """
    host, path = host_and_path(F.coalesce("url", F.lit("")))
    read = (pages.select("page_id", "url", host.alias("host"), path.alias("path"),
                         F.lower(after_scheme(F.coalesce("url", F.lit("")))).alias("letters")))
    rule, verdict = rule_verdict(F.col("host"), F.col("path"), rules)
    # Rows get numbers in a written copy, so that every later step sees the same ones.
    rows = materialize(read.select(F.monotonically_increasing_id().alias("row"), "page_id", "host", "path", "letters",
                                   rule.alias("rule"), verdict.alias("listed"),
                                   (unit_hash(F.lit("calibration"), F.col("url")) < 0.25).alias("held_out")),
                       "url-rows")
    spelled = rows.select("row", "listed", "held_out", F.explode(grams(F.col("letters"), order)).alias("gram"))
    counted = F.col("listed").isNotNull() & ~F.col("held_out")
    counts = materialize(spelled.groupBy("gram").agg(
        F.count_if(counted & (F.col("listed") == "allow")).alias("good"),
        F.count_if(counted & (F.col("listed") == "block")).alias("bad")), "url-counts")
    # Written, so that the join below reads plain shuffles on both sides, whose hot partitions Spark splits. The hint keeps
    # Spark from a broadcast of the grams, which it takes for no larger than the URLs.
    ratios = materialize(log_ratios(counts, order), "url-ratios")
    sums = (spelled.select("row", "gram").join(ratios.hint("merge"), "gram")
            .groupBy("row").agg(F.sum("ratio").alias("total")).hint("merge"))
    scored = materialize(
        rows.join(sums, "row").withColumn("score", F.round(F.col("total") / (F.length("letters") + 1)).cast("long")),
        "url-scores")
    place = F.greatest(F.least(F.floor(F.col("score") / BIN), F.lit(BINS)), F.lit(-BINS))
    bins = (scored.where("listed is not null and held_out").groupBy(place.alias("bin"))
            .agg(F.count_if(F.col("listed") == "allow").alias("good"), F.count_if(F.col("listed") == "block").alias("bad"))
            .collect())  # at most 2 * BINS + 1 rows
    least = threshold([tuple(b) for b in bins])
    judged = F.lit("allow") if least is None else F.when(place >= least, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", (F.col("score") / 1_000_000).alias("score"),
                         F.coalesce("listed", judged).alias("verdict"))
