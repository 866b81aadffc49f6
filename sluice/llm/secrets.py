"""Secrets in texts: base patterns, and strings that look drawn at random.

Base spans are assignments to names such as ``password``, access key ids and
long hexadecimal runs. The method adds strings that no pattern names: two
first-order character Markov models, one of random strings and one of ordinary
identifiers, judge every run of at least ``least`` token characters. A run is
a secret if

    ln P(run | random) - ln P(run | ordinary) >= max(ln(1 / odds), rate * length)

with ``odds`` the odds of a run being a secret before it is read, and ``rate``
the least mean per character, which keeps long identifiers of a vocabulary
that the corpus does not have from adding up. Letters (in their case) and
digits are what the models see; the separators ``+/_=-`` carry nothing, and
what follows one starts anew, so a path or a slug is judged by its words.
Runs of fewer than ``distinct`` different characters (rulers, placeholders)
are none, and runs that overlap a base span are known already.

Training takes labelled samples (value, secret). :func:`labelled` makes them
from all documents: secret are the values of the base spans and, so that the
model knows more alphabets than the patterns, one string a document drawn by
a hash (base64 of the SHA-256 of the doc_id, in its plain or URL-safe form);
ordinary are the words that are left when all base matches are taken out,
without the runs long enough to be judged, whose label nobody knows.
Every distinct value counts once, so copies weigh nothing. Probabilities are
smoothed by Witten and Bell's rule from the pair of characters to the single
one to a uniform character.

Everything is DataFrame and SQL functions. The driver gets the pair counts
alone: at most (characters + 1) * characters * 2 rows, whatever the corpus.
The log ratios return to the plan as one constant array of the same size.

Defined cases: null text is empty; spans are code points, end exclusive; a run
beside a letter or digit that is no token character is part of a longer word
and is not judged; very long texts and runs are read whole, in linear time;
repeated rows get equal spans; without documents, or without samples of one
label, its model is uniform; an empty table gives no rows; other columns are
ignored by :func:`all_spans` and kept by :func:`redact`, whose result column
gets a fresh name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import fresh_name
from sluice.llm.scan import apart, places, quoted, replaced
from sluice.session import materialize

KINDS = ("assign", "access", "hex")
# The contract's patterns, possessive where nothing can be given back. Runs too short for access and hex are dropped
# by the pattern itself: all starts in a run share its end, so a later start is no retry that could succeed.
PATTERNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["\x27]?+\x20*+[:=]\x20*+["\x27]?+([A-Za-z0-9+/_.=-]++)""",
    "access": r"AKIA[A-Z0-9]{14,}+",
    "hex": r"[0-9a-f]{16,}+",
}
CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
WORD = "[A-Za-z0-9+/_=-]++"
ADDED = "random"
SPAN = "struct<start: bigint, rank: int, stop: bigint, kind: string, value: string>"


def base_spans(text: str) -> Column:
    """All base spans of a text, by start, then kind as listed; ``value`` is what is secret of it."""
    parts = []
    for rank, kind in enumerate(KINDS):
        secret = f"regexp_extract(m.value, {quoted(PATTERNS[kind])}, 1)" if kind == "assign" else "m.value"
        spans = f"""transform({places(text, PATTERNS[kind])}, m -> named_struct('start', m.start, 'rank', {rank},
            'stop', m.start + length(m.value), 'kind', '{kind}', 'value', {secret}))"""
        parts.append(f"filter({spans}, s -> length(s.value) >= 12)" if kind == "assign" else spans)
    return F.expr(f"array_sort(cast(concat({', '.join(parts)}) as array<{SPAN}>))")


def find(docs: DataFrame, least: int = 16) -> DataFrame:
    """(doc_id, spans, runs) of every row: base spans, and (start, stop, value) of the runs to judge. Written once."""
    run = rf"(?<![\p{{L}}\p{{M}}\p{{N}}+/_=-])[A-Za-z0-9+/_=-]{{{least},}}+(?![\p{{L}}\p{{M}}\p{{N}}])"
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return materialize(text.select("doc_id", base_spans("text").alias("spans"), F.expr(f"""transform(
        {places("text", run)}, r -> named_struct('start', r.start, 'stop', r.start + length(r.value), 'value', r.value))""").alias("runs")),
                       "secret-spans")


def labelled(docs: DataFrame, found: DataFrame, least: int = 16) -> DataFrame:
    """(value, secret): the samples of a corpus, repeated as often as they occur."""
    drawn = F.rtrim(F.base64(F.unhex(F.sha2(F.col("doc_id").cast("string").cast("binary"), 256))), F.lit("="))
    safe = F.when(F.xxhash64("doc_id") % 2 == 0, F.translate(drawn, "+/", "-_")).otherwise(drawn)
    secret = found.select(F.explode(F.expr("transform(spans, s -> s.value)")).alias("value")).unionAll(
        docs.where("doc_id is not null").select(safe.alias("value")))
    rest = F.col("text")
    for kind in KINDS:
        rest = F.regexp_replace(rest, F.lit(PATTERNS[kind]), F.lit("\n"))
    ordinary = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(rest, F.lit(WORD), F.lit(0)))).alias("value")).where(
        F.length("value") < least)
    return secret.withColumn("secret", F.lit(True)).unionAll(ordinary.withColumn("secret", F.lit(False)))


def _codes(text: str) -> str:
    """SQL for the numbers (from 1) of a text's characters; 0 for a separator."""
    return f"transform(split({text}, ''), c -> instr('{CHARACTERS}', c))"


def train(samples: DataFrame) -> list[int]:
    """Log ratios, random to ordinary, in whole millionths of a nat: of character c after b at b * (n + 1) + c, with
    characters numbered from 1 and b = 0 at the start and after a separator. ``samples`` is (value, secret)."""
    pairs = f"""transform(sequence(1, length(value)), i -> named_struct(
        'b', if(i = 1, 0, codes[i - 2]), 'c', codes[i - 1]))"""
    counts = (samples.where("length(value) > 0").groupBy("secret", "value").agg(F.lit(1))
              .select("secret", "value", F.expr(_codes("value")).alias("codes"))
              .select("secret", F.expr(f"inline({pairs})")).where("c > 0")
              .groupBy("secret", "b", "c").agg(F.count("*").alias("n")).collect())
    tables = {label: {(r["b"], r["c"]): r["n"] for r in counts if r["secret"] == label} for label in (True, False)}
    random, ordinary = log_model(tables[True]), log_model(tables[False])
    return [round(1e6 * (r - o)) for r, o in zip(random, ordinary, strict=True)]


def log_model(counts: dict[tuple[int, int], int]) -> list[float]:
    """ln P(c | b) at b * (n + 1) + c, Witten-Bell smoothed; 0 where c = 0 (a separator)."""
    n = len(CHARACTERS)
    single = [0] * (n + 1)
    after, kinds = [0] * (n + 1), [0] * (n + 1)
    for (b, c), count in counts.items():
        single[c] += count
        after[b] += count
        kinds[b] += 1
    seen, total = sum(1 for x in single if x), sum(single)
    alone = [(x + seen / n) / (total + seen) if total else 1 / n for x in single]
    return [0.0 if c == 0 else math.log((counts.get((b, c), 0) + kinds[b] * alone[c]) / (after[b] + kinds[b])
                                        if after[b] else alone[c]) for b in range(n + 1) for c in range(n + 1)]


def log_ratio(value: str, model: list[int]) -> str:
    """SQL for the log ratio of a run under the two models, in millionths of a nat."""
    # A constant expression: the optimiser folds it into one array of the plan.
    ratios = f"cast(split('{','.join(map(str, model))}', ',') as array<bigint>)"
    return f"""aggregate({_codes(value)}, named_struct('b', 0, 'sum', 0L),
      (s, c) -> named_struct('b', c, 'sum', s.sum + element_at({ratios}, s.b * {len(CHARACTERS) + 1} + c + 1)), s -> s.sum)"""


def all_spans(docs: DataFrame, odds: float = 1e-6, rate: float = 2.0, least: int = 16, distinct: int = 8,
              samples: DataFrame | None = None) -> DataFrame:
    """(doc_id, spans, added) of every row of ``docs`` (doc_id, text): base spans and random strings.

    ``samples`` (value, secret) replaces the labelled samples of ``docs`` itself.
    """
    docs = docs.select("doc_id", "text")
    found = find(docs, least)
    model = train(labelled(docs, found, least) if samples is None else samples)
    bar = round(-1e6 * math.log(odds))
    added = f"""transform(filter({apart('spans', 'runs')}, r -> size(array_distinct(split(r.value, ''))) >= {distinct}
        and {log_ratio('r.value', model)} >= greatest({bar}, {round(1e6 * rate)} * length(r.value))), r -> named_struct('start', r.start, 'rank', {len(KINDS)},
        'stop', r.stop, 'kind', '{ADDED}', 'value', r.value))"""
    return found.select("doc_id", "spans", F.expr(f"cast(if(size(runs) = 0, array(), {added}) as array<{SPAN}>)").alias("added"))


def listed(spans: Column) -> Column:
    """kind:start:end of spans that are in order, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(docs: DataFrame, into: str = "redacted", **options) -> tuple[DataFrame, str]:
    """``docs`` with the text in which every span is replaced by its kind in brackets; of overlapping spans the first
    in order counts. A row's spans are found by its doc_id and text, so rows may share a doc_id."""
    into = fresh_name(docs.columns, into)
    row = fresh_name(docs.columns, "row")
    kept = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "secret-rows")
    spans = all_spans(kept.select(F.col(row).alias("doc_id"), "text"), **options).select(
        F.col("doc_id").alias("_s_row"), F.array_sort(F.concat("spans", "added")).alias("_s_spans"))
    joined = kept.join(spans, kept[row] == spans["_s_row"])
    return joined.select(*[kept[c] for c in docs.columns], F.expr(
        replaced("text", "_s_spans", "concat('[', x.kind, ']')")).alias(into)), into
