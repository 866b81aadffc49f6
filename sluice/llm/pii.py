"""Personal data: pattern matches, and terms that give them away.

Base spans are e-mail addresses, IP addresses, payment cards and phone
numbers, by pattern and check (parts, Luhn, digit counts). The method adds
terms: a word near a protected value discloses it if seeing the word makes
the value likely. Over the whole corpus

    PMI(term; value)  = ln(N * n(term, value) / (n(term) * n(value)))
    IC(value)         = ln(N / n(value))

where all four numbers count documents, copies included: N all of them,
n(term) and n(value) those that hold the term or the value, n(term, value)
those that hold the term within ``reach`` characters of the value. A group of
copies so weighs alike in each of them. Values are also estimated by what they share: the domain of an address, the
network of an IP address, the issuer digits of a card, the area of a phone
number. A term whose PMI is at least ``disclose`` of the
value's information is generalised to a placeholder, from ``remove`` of it
on removed. Terms need ``support`` distinct texts, since a word that was
seen in copies of one text beside a value was not estimated.

Terms are whole words of any length: runs of letters, marks and digits. In a
script without blanks a run between other characters is one word.

``reach`` is for estimating alone. In a text that holds a value, every
occurrence of a term that discloses it is marked, however far from the value.
In texts that do not hold the value the term stays: by itself it names no
protected value there.

Everything is DataFrame and SQL functions. Positions come from the pieces
between matches: both pieces and matches are cut by one pattern. The patterns
are possessive where the contract's give nothing back, so very long runs
neither overflow the stack nor are tried from every start.

Defined cases: null text is empty; spans are code points, end exclusive; a
term that overlaps a base span is none; repeated rows get equal spans; a
value in every text carries no information and discloses nothing; an empty
table gives no rows; all other columns are ignored by :func:`find` and kept
by :func:`sanitise`, whose result column gets a fresh name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import fresh_name
from sluice.llm.scan import apart, cut, pieces_of, places, replaced, scanned
from sluice.session import materialize

KINDS = ("email", "ip", "card", "phone")
# The contract's patterns. A match can only start at the start of a run (or where the last match ended): what follows
# a run decides, so later starts in the same run fail as the first does.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"[\p{L}\p{M}\p{N}]++"
_DIGITS = "length(regexp_replace(m.value, '[^0-9]', ''))"
# The Luhn sum, from the last digit on.
_LUHN = """aggregate(transform(split(reverse(regexp_replace(m.value, '[^0-9]', '')), ''),
    (d, i) -> if(i % 2 = 1, if(cast(d as int) > 4, 2 * cast(d as int) - 9, 2 * cast(d as int)), cast(d as int))),
  0, (s, d) -> s + d) % 10 = 0"""
_IP = """forall(split(m.value, '[.]'), p -> length(regexp_replace(p, '^0+', '')) < 3
  or (length(regexp_replace(p, '^0+', '')) = 3 and regexp_replace(p, '^0+', '') <= '255'))"""
CHECKS = {"email": "true", "ip": _IP, "card": f"if({_DIGITS} between 12 and 19, {_LUHN}, false)",
          "phone": f"{_DIGITS} between 9 and 15"}
# What values of a kind share: domain, first two parts, first six digits, first five digits.
_SHARED = """case s.kind when 'email' then concat('domain:', lower(substring_index(s.value, '@', -1)))
  when 'ip' then concat('network:', substring_index(s.value, '.', 2))
  else concat(s.kind, '-range:', left(regexp_replace(s.value, '[^0-9]', ''), if(s.kind = 'card', 6, 5))) end"""
_MARK = "\\u0001"
# The spans merged where they overlap, in order.
_MERGED = scanned("concat(spans, array(null))",
                  "cast(null as struct<start: bigint, stop: bigint>)",
                  """if(x is null or a.state is null or x.start >= a.state.stop, named_struct('start', x.start, 'stop', x.stop),
                     named_struct('start', a.state.start, 'stop', greatest(a.state.stop, x.stop)))""",
                  "a.state is not null and (x is null or x.start >= a.state.stop)", "a.state", "struct<start: bigint, stop: bigint>")
SPAN = "array<struct<start: bigint, rank: int, stop: bigint, kind: string, value: string>>"


def base_spans(text: str) -> Column:
    """All base spans of a text, by start, then kind as listed."""
    parts = []
    for rank, kind in enumerate(KINDS):
        needs = {"email": f"contains({text}, '@')", "phone": f"contains({text}, '+')"}.get(kind, "true")
        parts.append(f"""if({needs}, transform(filter({places(text, PATTERNS[kind])}, m -> {CHECKS[kind]}),
            m -> named_struct('start', m.start, 'rank', {rank}, 'stop', m.start + length(m.value), 'kind', '{kind}',
                              'value', m.value)), cast(array() as {SPAN}))""")
    return F.expr(f"array_sort(concat({', '.join(parts)}))")


def find(docs: DataFrame, reach: int = 60) -> DataFrame:
    """(doc_id, th, spans, near, held) of every row: base spans, per span the text around it with its place, and the
    whole text if it has spans.

    ``th`` is the hash of the text. Words that ``reach`` cuts in two are left out. Written once for later steps.
    """
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    spans = text.withColumn("th", F.xxhash64("text")).withColumn("spans", base_spans("text"))
    # The text with a mark in the place of every character of a base span: a word that differs there overlaps one.
    masked = replaced("text", _MERGED, f"repeat('{_MARK}', cast(x.stop - x.start as int))")
    held = spans.withColumn("masked", F.expr(f"if(size(spans) > 0, {pieces_of(masked)}, null)")).withColumn(
        "pieces", F.expr(f"if(size(spans) > 0, {pieces_of('text')}, null)")).withColumn("size", F.length("text").cast("long"))
    left, right = f"greatest(s.start - {reach}, 0)", f"least(s.stop + {reach}, size)"
    around = f"""transform(spans, s -> named_struct('entities', array(concat(s.kind, ':', lower(s.value)), {_SHARED}),
      'left_at', {left}, 'left', {cut('pieces', left, 's.start')}, 'left_masked', {cut('masked', left, 's.start')},
      'right_at', s.stop, 'right', {cut('pieces', 's.stop', right)}, 'right_masked', {cut('masked', 's.stop', right)},
      'left_cut', s.start > {reach}, 'right_cut', s.stop + {reach} < size))"""
    return materialize(held.withColumn("near", F.expr(f"if(size(spans) > 0, {around}, null)"))
                       .withColumn("held", F.expr("if(size(spans) > 0, text, null)"))
                       .drop("text", "masked", "pieces", "size"), "pii-spans")


def _copies(found: DataFrame) -> DataFrame:
    """(th, copies): the rows of every distinct text that holds a base span."""
    return found.where("size(spans) > 0").groupBy("th").agg(F.count("*").alias("copies"))


def _terms(found: DataFrame) -> DataFrame:
    """(doc_id, th, entity, term, start, stop) of every word near a base span that overlaps none."""
    each = (found.where("size(spans) > 0").select("doc_id", "th", F.explode("near").alias("n"))
            .select("doc_id", "th", "n.*").withColumn("entity", F.explode("entities")))
    sides = None
    for side, edge in (("left", "start = 0"), ("right", "start + length(value) = length(around)")):
        now = (each.select("doc_id", "th", "entity", F.col(f"{side}_at").alias("at"), F.col(side).alias("around"),
                           F.col(f"{side}_masked").alias("masked"), F.col(f"{side}_cut").alias("cut"))
               .withColumn("words", F.expr(places("around", TERM)))
               .select("*", F.inline("words")).where(~(F.col("cut") & F.expr(edge)))
               .where("substring(masked, cast(start as int) + 1, length(value)) = value"))
        now = now.select("doc_id", "th", "entity", F.lower("value").alias("term"),
                         (F.col("at") + F.col("start")).alias("start"),
                         (F.col("at") + F.col("start") + F.length("value")).alias("stop"))
        sides = now if sides is None else sides.unionAll(now)
    return sides


def disclosing_terms(docs: DataFrame, found: DataFrame, terms: DataFrame, disclose: float, remove: float, support: int
                     ) -> DataFrame:
    """(entity, term, action): terms whose mutual information with a value exceeds the threshold."""
    total = docs.count()
    copies = materialize(_copies(found), "pii-copies")
    pairs = (terms.select("entity", "term", "th").distinct().join(copies, "th").groupBy("entity", "term")
             .agg(F.sum("copies").alias("n_both"), F.count("*").alias("n_texts")).where(F.col("n_texts") >= support))
    values = (found.where("size(spans) > 0").select("th", F.explode(F.flatten("near.entities")).alias("entity")).distinct()
              .join(copies, "th").groupBy("entity").agg(F.sum("copies").alias("n_entity")))
    words = (docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))).alias("term"))
             .groupBy("term").agg(F.count("*").alias("n_term")))
    known = pairs.join(values, "entity").join(words, "term")
    info = F.ln(F.lit(float(max(total, 1))) / F.col("n_entity"))
    pmi = F.ln(F.lit(float(max(total, 1))) * F.col("n_both") / (F.col("n_term").cast("double") * F.col("n_entity")))
    share = F.when(info > 0, pmi / info)
    return (known.where(share >= disclose)
            .select("entity", "term", F.when(share >= remove, "remove").otherwise("generalise").alias("action")))


def _everywhere(found: DataFrame, shown: DataFrame) -> DataFrame:
    """(th, added) of the texts that hold a value and, anywhere, a term that discloses it: the places of these terms."""
    texts = materialize(found.where("size(spans) > 0").groupBy("th").agg(
        F.first("held").alias("held"), F.first("spans").alias("spans"),
        F.first(F.array_distinct(F.flatten("near.entities"))).alias("entities")), "pii-texts")
    words = texts.select("th", F.explode(F.array_distinct(F.regexp_extract_all(
        F.lower("held"), F.lit(TERM), F.lit(0)))).alias("term"))
    # Words that disclose nothing go before the rest meets the text's values.
    some = words.join(shown.select("term").distinct(), "term", "left_semi")
    wanted = materialize(texts.select("th", F.explode("entities").alias("entity")).join(shown, "entity")
                         # One word may disclose several values: it is removed if one of them asks for that.
                         .groupBy("th", "term").agg(F.max("action").alias("action")).join(some, ["th", "term"], "left_semi"),
                         "pii-wanted")
    # Words are taken whole and compared in lower case, as they were counted.
    hit = texts.join(wanted.select("th").distinct(), "th", "left_semi")
    placed = (hit.select("th", F.expr(f"inline({places('held', TERM)})")).withColumn("term", F.lower("value"))
              .join(wanted, ["th", "term"])
              .groupBy("th").agg(F.collect_list(F.struct("start", (F.col("start") + F.length("value")).alias("stop"),
                                                         F.col("action").alias("value"))).alias("found")))
    return placed.join(hit.select("th", "spans"), "th").select("th", F.expr(f"""transform({apart('spans', 'found')},
        m -> named_struct('start', m.start, 'rank', {len(KINDS)}, 'stop', m.stop, 'kind', 'term', 'value', m.value))""")
        .alias("added"))


def all_spans(docs: DataFrame, reach: int = 60, disclose: float = 0.7, remove: float = 0.9, support: int = 2) -> DataFrame:
    """(doc_id, th, spans, added) of every row of ``docs`` (doc_id, text): base spans and spans of disclosing terms."""
    found = find(docs, reach)
    terms = materialize(_terms(found), "pii-terms")
    # Written, so that the joins below read plain shuffles, whose hot partitions Spark splits.
    shown = materialize(disclosing_terms(docs, found, terms, disclose, remove, support), "pii-disclosing")
    added = materialize(_everywhere(found, shown), "pii-added")
    return found.select("doc_id", "th", "spans").join(added.withColumnRenamed("th", "a_th"), F.col("th") == F.col("a_th"), "left").select(
        "doc_id", "th", "spans", F.coalesce("added", F.expr(f"cast(array() as {SPAN})")).alias("added"))


def listed(spans: Column) -> Column:
    """kind:start:end of spans that are in order, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def sanitise(docs: DataFrame, into: str = "sanitised", **options) -> tuple[DataFrame, str]:
    """``docs`` with the text in which spans are replaced: [email] and so on for base spans, [term] for generalised
    terms, nothing for removed ones. Of overlapping spans the first in order counts."""
    into = fresh_name(docs.columns, into)
    spans = all_spans(docs, **options).select(F.col("doc_id").alias("_s_id"), "th", F.array_sort(
        F.concat("spans", "added")).alias("_s_spans")).dropDuplicates(["_s_id", "th"])
    clean = F.when(F.size("_s_spans") > 0, F.expr(replaced(
        "text", "_s_spans", "case when x.kind = 'term' and x.value = 'remove' then '' else concat('[', x.kind, ']') end"))
        ).otherwise(F.col("text"))
    own = docs.withColumn("_s_th", F.xxhash64(F.coalesce("text", F.lit(""))))
    joined = own.join(spans, own.doc_id.eqNullSafe(spans["_s_id"]) & (own["_s_th"] == spans["th"]), "left")
    return joined.select(*[own[c] for c in docs.columns], clean.alias(into)), into
