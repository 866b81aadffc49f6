"""Registered queries of the subpackage and the DuckDB SQL of those that SQL can express.

Every query runs its operator over the whole of its tables and derives the
contract's columns from the operator's result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import (ballmeans, decontam, jaccard, langid, licenses, merkle, mixing, pii, secrets, tokenout, topk, urlfilter,
                        warc)
from sluice.operators.joins import checked_broadcast
from sluice.plans.tables import table

# Temperatures of the mix: sources are evened out most, topics half as much, languages least.
MIX_TARGETS = {"source": 0.5, "lang": 0.8, "topic": 0.7}
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow"))
TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


OP1_SQL = """
WITH vectors AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x AS double)) AS bigint)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id,
         cast(list_dot_product(cast(q.v AS double[]), cast(c.v AS double[])) AS bigint) AS score
  FROM vectors q JOIN vectors c ON q.rid <> c.rid AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, vec_id, score,
         cast(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS integer) AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = langid.is_held_out(F.col("doc_id"))
    model = langid.learn(docs.where(~held_out))
    found, name = langid.identify(docs.select("doc_id", "text"), model, keep=["doc_id"], spans=True)
    spans = F.transform(f"{name}.spans", lambda s: F.concat_ws(":", s["lang"], s["start"], s["end"]))
    return found.select("doc_id", held_out.alias("held_out"), f"{name}.lang_pred", f"{name}.score",
                        F.concat_ws(",", spans).alias("spans"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, name = decontam.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                             keep=["doc_id"])
    return docs.select(
        "doc_id", f"{name}.n_words", f"{name}.n_hit", F.size(f"{name}.item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", f"{name}.item_ids").cast("binary"), 256).alias("items_sha256"),
        decontam.is_contaminated(name).alias("contaminated"))


OP3_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT rid, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
common AS (SELECT a.rid AS x, b.rid AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.rid < b.rid GROUP BY 1, 2),
links AS (SELECT x, y FROM common JOIN n p ON p.rid = x JOIN n q ON q.rid = y WHERE 5 * k >= 4 * (p.n + q.n - k)),
e AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(rid, m) AS (SELECT rid, rid FROM d UNION SELECT e.y, reach.m FROM reach JOIN e ON reach.rid = e.x),
roots AS (SELECT rid, min(m) AS root FROM reach GROUP BY rid),
degrees AS (SELECT x AS rid, count(*) AS n_links FROM e GROUP BY x)
SELECT doc_id, min(doc_id) OVER (PARTITION BY root) AS class_id, coalesce(n_links, 0) AS n_links
FROM d JOIN roots USING (rid) LEFT JOIN degrees USING (rid)
"""


OP4_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m,
         array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT m FROM item_windows),
doc_windows AS (
  SELECT rid, m, i, array_to_string(w[i:i + m - 1], ' ') AS win
  FROM (SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM docs, lengths WHERE len(w) >= m)),
found AS (SELECT d.rid, d.m, d.i, x.item_id FROM doc_windows d JOIN item_windows x ON d.m = x.m AND d.win = x.win),
hits AS (SELECT rid, count(DISTINCT p) AS n_hit
         FROM (SELECT rid, unnest(range(i, i + m)) AS p FROM found) GROUP BY rid),
per_doc AS (SELECT rid, count(DISTINCT item_id) AS n_items,
                   string_agg(DISTINCT cast(item_id AS varchar), ',' ORDER BY cast(item_id AS varchar)) AS ids
            FROM found GROUP BY rid)
SELECT doc_id, cast(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (rid) LEFT JOIN per_doc USING (rid)
"""


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_and_read(table(spark, sf_dir, "pages"))
    return read.where("kind = 'record'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, html, octet_length(encode(html)) AS n, sha1(html) AS h,
             min(page_id) OVER (PARTITION BY html) AS first FROM p),
bits AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i: ['0000', '0001', '0010', '0011', '0100', '0101',
    '0110', '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'][
    strpos('0123456789abcdef', substr(h, cast(i AS int), 1))]), '') AS b
  FROM d)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + cast(16 * cast(substr(b, cast(5 * j + 1 AS int), 1) AS int)
         + 8 * cast(substr(b, cast(5 * j + 2 AS int), 1) AS int) + 4 * cast(substr(b, cast(5 * j + 3 AS int), 1) AS int)
         + 2 * cast(substr(b, cast(5 * j + 4 AS int), 1) AS int)
         + cast(substr(b, cast(5 * j + 5 AS int), 1) AS int) AS int), 1)), '') AS payload_digest,
       CASE WHEN coalesce(page_id = first, first IS NULL) THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN coalesce(page_id = first, first IS NULL) THEN NULL ELSE first END AS refers_to
FROM bits
"""


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    mixed, name = mixing.mix(docs, MIX_TARGETS, tokenizer=public_tokenizers.path(TOKENIZER), keep=["doc_id", "source", "lang"])
    return mixed.select("doc_id", "source", "lang", f"{name}.topic", f"{name}.n_tokens", f"{name}.weight",
                        f"{name}.probability", f"{name}.selected")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.all_spans(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}')) as bigint) as n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts,
                        F.sha2(pii.listed(F.col("spans")).cast("binary"), 256).alias("base_sha256"),
                        pii.listed(F.array_sort(F.concat("spans", "added"))).alias("spans"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, name = licenses.scan_licenses(table(spark, sf_dir, "documents"), keep=["doc_id"])
    found = f"{name}.found"
    return docs.select(
        "doc_id", F.size(found).cast("long").alias("n_places"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda p: p["license"]))), ",").alias("licenses"),
        F.array_max(F.transform(found, lambda p: p["whole"])).alias("coverage"),
        F.array_join(F.transform(found, lambda p: F.concat_ws(":", p["license"], p["start"].cast("string"),
                                                              p["stop"].cast("string"))), ",").alias("spans"))


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenout.token_output(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), END_ID)


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.all_spans(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}')) as bigint) as n_{kind}") for kind in secrets.KINDS]
    return found.select("doc_id", *counts,
                        F.sha2(secrets.listed(F.col("spans")).cast("binary"), 256).alias("base_sha256"),
                        secrets.listed(F.array_sort(F.concat("spans", "added"))).alias("spans"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = merkle.leaf_digest([urlfilter.lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in merkle.FIELDS])
    made = merkle.manifest(docs, seen=F.when(tampered, lowered))
    return made.select("doc_id", "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"), "folded_root", "verified")


def _op12_sql(deep: int = 7, wide: int = 4) -> str:
    """The levels written out: enough for 16^deep rows a source and 16^wide sources."""
    def value(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(cast({c} AS varchar))) || ':' || {c} END"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(value(c) for c in ('doc_id', 'source', 'lang', 'n_chars'))} || {value(text)})"

    def climb(n: str, r: str, count: int) -> str:
        return ",\n".join(f"""{r}{k} AS (SELECT tree, idx // 16 AS run, any_value(size) AS size, list(h ORDER BY idx) AS hs
  FROM {n}{k} WHERE size > 1 GROUP BY tree, idx // 16),
{n}{k + 1} AS (SELECT tree, run AS idx, (size + 15) // 16 AS size, sha256(array_to_string(hs, '')) AS h FROM {r}{k})"""
                           for k in range(count))

    # One step of every path at a time: the digest folded so far and the siblings met.
    steps = [(f"r{k}", "tree", f"idx // {16 ** k}") for k in range(deep)] + [
        (f"u{k}", "''", f"top // {16 ** k}") for k in range(wide)]
    folds = ",\n".join(f"""f{i + 1} AS (SELECT f.* REPLACE (
  CASE WHEN hs IS NULL THEN now ELSE sha256(array_to_string(hs[1:({at}) % 16], '') || now
    || array_to_string(hs[({at}) % 16 + 2:], '')) END AS now,
  CASE WHEN hs IS NULL THEN beside ELSE beside || array_to_string(hs[1:({at}) % 16], '')
    || array_to_string(hs[({at}) % 16 + 2:], '') END AS beside)
  FROM f{i} f LEFT JOIN {r} ON {r}.tree = {tree if tree == "''" else 'f.tree'} AND {r}.run = ({at}) // 16)"""
                        for i, (r, tree, at) in enumerate(steps))
    subroots = " UNION ALL ".join(f"SELECT tree, h FROM n{k} WHERE size = 1" for k in range(deep + 1))
    root = " UNION ALL ".join(f"SELECT h FROM t{k} WHERE size = 1" for k in range(wide + 1))
    return f"""
WITH leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {leaf('text')} AS h,
    {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS lowered,
    xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(cast(doc_id AS varchar), ''),
      lambda c: [cast(ascii(c) AS bigint), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) AS crc
  FROM documents),
n0 AS MATERIALIZED (
  SELECT doc_id, tree, h, CASE WHEN crc % 5 = 0 THEN lowered ELSE h END AS now, count(*) OVER (PARTITION BY tree) AS size,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS idx
  FROM leaves),
{climb('n', 'r', deep)},
subroots AS ({subroots}),
t0 AS (SELECT '' AS tree, tree AS name, h, count(*) OVER () AS size, row_number() OVER (ORDER BY tree) - 1 AS idx FROM subroots),
{climb('t', 'u', wide)},
root AS ({root}),
f0 AS (SELECT n0.doc_id, n0.tree, n0.idx, n0.h AS leaf, t0.h AS subroot, t0.idx AS top, n0.now, '' AS beside
  FROM n0 JOIN t0 ON t0.name = n0.tree),
{folds}
SELECT doc_id, leaf, subroot, root.h AS root, sha256(beside) AS proof_sha256, now AS folded_root, now = root.h AS verified
FROM f{len(steps)}, root
"""


OP12_SQL = _op12_sql()


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = ballmeans.encode(table(spark, sf_dir, "embeddings"), keep=["label"])
    totals = checked_broadcast(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
    return coded.join(totals, coded["label"].eqNullSafe(totals["of"]), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _op13_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    def turn(k: int) -> str:
        """Assignment k + 1 to the entries after k rounds."""
        return f"""a{k + 1} AS MATERIALIZED (
  SELECT x.rid, x.p, any_value(x.w) AS w, min({{'d': x.n - 2 * list_dot_product(x.f, e.f) + e.n, 'e': e.e}}) AS best
  FROM parts x JOIN e{k} e ON e.p = x.p GROUP BY x.rid, x.p)"""

    def move(k: int) -> str:
        """The entries after round k."""
        return f"""m{k} AS (
  SELECT p, e, list(c ORDER BY i) AS w FROM (
    SELECT p, best.e AS e, i, cast(floor(cast(sum(w[i]) AS double) / count(*)) AS bigint) AS c
    FROM a{k}, LATERAL (SELECT unnest(range(1, len(w) + 1)) AS i) GROUP BY p, best.e, i) GROUP BY p, e),
e{k} AS MATERIALIZED (
  SELECT p, e, w, cast(w AS double[]) AS f, list_dot_product(cast(w AS double[]), cast(w AS double[])) AS n
  FROM (SELECT o.p, o.e, coalesce(m.w, o.w) AS w FROM e{k - 1} o LEFT JOIN m{k} m ON m.p = o.p AND m.e = o.e))"""

    steps = ",\n".join(f"{turn(k)},\n{move(k + 1)}" for k in range(rounds)) + ",\n" + turn(rounds)
    return f"""
WITH x AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label,
         list_transform(embedding, lambda x: cast(floor(256 * cast(x AS double)) AS bigint)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT rid, vec_id, v, p, w, cast(w AS double[]) AS f, list_dot_product(cast(w AS double[]), cast(w AS double[])) AS n
  FROM (SELECT rid, vec_id, v, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS w
        FROM x, (SELECT unnest(range({parts})) AS p))),
e0 AS MATERIALIZED (
  SELECT p, e, w, f, n FROM (
    SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id NULLS LAST, v) - 1 AS e, w, f, n FROM parts)
  WHERE e < {entries}),
{steps},
coded AS (
  SELECT rid, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, cast(sum(best.d) AS bigint) AS error
  FROM a{rounds + 1} GROUP BY rid),
books AS (SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM e{rounds})
SELECT vec_id, code, error, cast(sum(error) OVER (PARTITION BY label) AS bigint) AS label_error, codebooks_sha256
FROM coded JOIN x USING (rid), books
"""


OP13_SQL = _op13_sql()


QUERIES = {
    "op1_topk": op1_topk,
    "op2_language_id": op2_language_id,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_decontamination": op4_decontamination,
    "op5_warc": op5_warc,
    "op6_mixing": op6_mixing,
    "op7_url_filter": op7_url_filter,
    "op8_pii": op8_pii,
    "op9_license_scan": op9_license_scan,
    "op10_token_output": op10_token_output,
    "op11_secret_scan": op11_secret_scan,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES = {
    "op12_merkle_manifest": OP12_SQL,
    "op13_vector_codes": OP13_SQL,
    "op5_warc": OP5_SQL,
    "op1_topk": OP1_SQL,
    "op3_ngram_jaccard": OP3_SQL,
    "op4_decontamination": OP4_SQL,
}
