"""Star-schema enrichment, lookups, crawl frontier and set queries."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sluice.operators.crawl import link_events, new_urls, newest_first, page_links, read_ledger
from sluice.operators.joins import lookup_join, role, small_enough
from sluice.operators.ledger import store_urls, unseen
from sluice.operators.reshape import empty_to_null
from sluice.operators.sets import symmetric_difference
from sluice.plans.catalog import register
from sluice.plans.derive import hard_pages
from sluice.plans.tables import Tables
from sluice.session import materialize, scratch_path
from sluice.sinks.colocated import colocated_join, open_colocated, store_colocated
from sluice.sources.html import html_list_links

STAR_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "p_name", "p_brand", "l_suppkey", "s_name",
                "supp_nation", "o_custkey", "c_name", "cust_nation", "o_orderdate", "l_quantity", "revenue"]


def _star_sides(t: Tables):
    """The fact, part, supplier with its nation and orders with their customer, and which dimensions are small."""
    nation = t.nation.select("n_nationkey", "n_name")
    supplier, customer = t.supplier.select("s_suppkey", "s_name", "s_nationkey"), t.customer.select("c_custkey", "c_name", "c_nationkey")
    part, order = t.part.select("p_partkey", "p_name", "p_brand"), t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    # Left joins on a dimension's unique key keep the left row count, and add
    # one name a row: the bound leaves room for that.
    small = small_enough({"nation": nation, "supplier": supplier, "customer": customer, "part": part, "orders": order})
    supp = lookup_join(supplier,
                       role(nation, {"n_nationkey": "sn_nationkey", "n_name": "supp_nation"}),
                       "s_nationkey", "sn_nationkey", small=small["nation"])
    cust = lookup_join(customer,
                       role(nation, {"n_nationkey": "cn_nationkey", "n_name": "cust_nation"}),
                       "c_nationkey", "cn_nationkey", small=small["nation"])
    orders = lookup_join(order, cust, "o_custkey", "c_custkey",
                         small=small["customer"])
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                             (F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).alias("revenue"))
    return fact, part, supp, orders, small


def star_enrich(t: Tables):
    """lineitem with part, supplier, order and customer attributes; ``nation``
    plays two roles (supplier nation, customer nation).

    Dimension chains are resolved on the small side first (supplier with
    its nation, customer with its nation, orders with the customer), so the
    fact meets each dimension once. Every join is a left join on a checked
    broadcast or, above the bound, a skew-aware sort-merge join.
    """
    fact, part, supp, orders, small = _star_sides(t)
    fact = lookup_join(fact, part, "l_partkey", "p_partkey",
                       small=small["part"])
    fact = lookup_join(fact, supp, "l_suppkey", "s_suppkey", small=small["supplier"])
    fact = lookup_join(fact, orders, "l_orderkey", "o_orderkey", small=small["orders"])
    return fact.select(*STAR_COLUMNS)


STAR_SQL = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name, p.p_brand, l.l_suppkey, s.s_name,
       sn.n_name AS supp_nation, o.o_custkey, c.c_name, cn.n_name AS cust_nation, o.o_orderdate,
       l.l_quantity, l.l_extendedprice * (1 - l.l_discount) AS revenue
FROM lineitem l
LEFT JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
"""


@register("star_enrich", STAR_SQL)
def q_star_enrich(spark: SparkSession, sf_dir: str):
    """lineitem enriched with part, supplier, order and customer; nation in two roles."""
    return star_enrich(Tables(spark, sf_dir))


STAR_BUCKETS = 64  # at 100 TB some 100,000, for buckets of a task's size


@register("star_colocated", STAR_SQL)
def q_star_colocated(spark: SparkSession, sf_dir: str):
    """The same star with the fact stored beside orders, its largest dimension, in buckets of the order key: stored once,
    then every enrichment meets orders without a shuffle of either."""
    fact, part, supp, orders, small = _star_sides(Tables(spark, sf_dir))
    path = scratch_path(spark, "star_colocated")
    store_colocated(fact, orders, "l_orderkey", "o_orderkey", path, STAR_BUCKETS)
    joined = colocated_join(open_colocated(spark, path))
    joined = lookup_join(joined, part, "l_partkey", "p_partkey", small=small["part"])
    joined = lookup_join(joined, supp, "l_suppkey", "s_suppkey", small=small["supplier"])
    return joined.select(*STAR_COLUMNS)


@register("inspection_zip", """
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_nationkey, n.n_name
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def q_inspection_zip(spark: SparkSession, sf_dir: str):
    """Parent to child on a 1:1 key, then child to a lookup table (left)."""
    t = Tables(spark, sf_dir)
    customer, nation = t.customer.select("c_custkey", "c_name", "c_nationkey"), t.nation.select("n_nationkey", "n_name")
    small = small_enough({"customer": customer, "nation": nation})
    addr = lookup_join(customer, nation, "c_nationkey", "n_nationkey", small=small["nation"])
    return lookup_join(t.orders.select("o_orderkey", "o_custkey"), addr, "o_custkey", "c_custkey", how="inner",
                       small=small["customer"])


@register("missing_dims", """
(SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)
UNION ALL
(SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)
""")
def q_missing_dims(spark: SparkSession, sf_dir: str):
    """Keys present in exactly one of two key sets: documents without labels
    plus labels of unknown documents."""
    t = Tables(spark, sf_dir)
    return symmetric_difference(t.documents.select("doc_id"), t.labels.select("doc_id"))


@register("html_links", """
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, hrefs[i] AS href, texts[i] AS text
FROM (
  SELECT page_id, hrefs, texts, generate_subscripts(hrefs, 1) AS i
  FROM (SELECT page_id,
               regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a>', 1) AS hrefs,
               regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a>', 2) AS texts
        FROM pages))
""")
def q_html_links(spark: SparkSession, sf_dir: str):
    """List links of every stored page with their position."""
    return html_list_links(Tables(spark, sf_dir).pages)


@register("hard_page_links", r"""
WITH p AS (
  SELECT page_id, cast(page_id AS varchar) AS n, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS origin,
         CASE WHEN page_id % 3 = 0 THEN regexp_extract(url, '^([^?#]*/)', 1)
              ELSE regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/base' || page_id || '/sub/' END AS folder,
         CASE WHEN page_id % 3 = 0 THEN regexp_extract(url, '^([^#]*)', 1) END AS page
  FROM pages),
e AS (
  SELECT page_id, unnest([
    {'pos': 0, 'item': 0, 'list': 0, 'depth': 1, 'href': 'item' || n || '.html', 'text': 'Item & ' || n,
     'url': folder || 'item' || n || '.html'},
    {'pos': 1, 'item': 1, 'list': 0, 'depth': 1, 'href': '/e' || n || '<?a=1&b=2#frag', 'text': 'entity' || chr(10),
     'url': origin || '/e' || n || '<?a=1&b=2'},
    {'pos': 2, 'item': 2, 'list': 0, 'depth': 1, 'href': 'unquoted?x=' || n || '&copy=1', 'text': 'un',
     'url': folder || 'unquoted?x=' || n || '&copy=1'},
    {'pos': 3, 'item': 3, 'list': 1, 'depth': 2, 'href': '//cdn.example.org/./x/../' || n, 'text': 'deep',
     'url': regexp_extract(origin, '^([^:]+:)', 1) || '//cdn.example.org/' || n},
    {'pos': 4, 'item': NULL, 'list': NULL, 'depth': NULL, 'href': '/space/' || n || '/..', 'text': 'outside',
     'url': origin || '/space/'},
    {'pos': 5, 'item': NULL, 'list': NULL, 'depth': NULL, 'href': 'mailto:x@y.example', 'text': 'mail', 'url': NULL},
    {'pos': 6, 'item': NULL, 'list': NULL, 'depth': NULL, 'href': '#top', 'text': 'top', 'url': coalesce(page, folder)}
  ]) AS l FROM p)
SELECT page_id, cast(l.pos AS integer) AS pos, l.href AS href, l.text AS text, cast(l.item AS integer) AS item,
       cast(l.list AS integer) AS list, cast(l.depth AS integer) AS depth, l.url AS url
FROM e
""")
def q_hard_page_links(spark: SparkSession, sf_dir: str):
    """Links of pages with nested markup, missing end tags, a base, and text that only looks like links."""
    return link_events(hard_pages(Tables(spark, sf_dir).pages))


@register("frontier_new_urls", """
WITH links AS (
  SELECT url AS page_url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages),
r AS (
  SELECT CASE WHEN regexp_matches(href, '^https?://') THEN href
              WHEN starts_with(href, '/') AND NOT starts_with(href, '//')
                   AND regexp_extract(page_url, '^(https?://[^/?#]+)', 1) <> ''
              THEN regexp_extract(page_url, '^(https?://[^/?#]+)', 1) || href END AS url
  FROM links)
SELECT DISTINCT url FROM r
WHERE url IS NOT NULL AND NOT EXISTS (SELECT 1 FROM pages p WHERE p.url = r.url)
""")
def q_frontier_new_urls(spark: SparkSession, sf_dir: str):
    """Links found on stored pages that are not stored pages themselves."""
    pages = Tables(spark, sf_dir).pages
    return new_urls(page_links(pages), pages.select("url"))


@register("ledger_new_urls", """
WITH links AS (
  SELECT url AS page_url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages),
r AS (
  SELECT CASE WHEN regexp_matches(href, '^https?://') THEN href
              WHEN starts_with(href, '/') AND NOT starts_with(href, '//')
                   AND regexp_extract(page_url, '^(https?://[^/?#]+)', 1) <> ''
              THEN regexp_extract(page_url, '^(https?://[^/?#]+)', 1) || href END AS url
  FROM links)
SELECT DISTINCT url FROM r
WHERE url IS NOT NULL AND NOT EXISTS (SELECT 1 FROM pages p WHERE p.url = r.url AND p.page_id % 3 < 2)
  AND NOT contains(url, '/the')
""")
def q_ledger_new_urls(spark: SparkSession, sf_dir: str):
    """Links that a bucketed ledger of two batches does not hold: two thirds of the pages' URLs, and some links."""
    pages = Tables(spark, sf_dir).pages
    links = materialize(page_links(pages).distinct(), "ledger-links")
    path = scratch_path(spark, "ledger_urls")
    store_urls(pages.where("page_id % 3 < 2").select("url"), path, 0)
    store_urls(links.where(F.col("url").contains("/the")), path, 1)
    return unseen(links, path)


@register("frontier_by_page_number", r"""
WITH links AS (
  SELECT url AS page_url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages),
u AS (
  SELECT DISTINCT regexp_extract(page_url, '^(https?://[^/?#]+)', 1) || href || '?filter=' ||
         CAST(length(href) AS VARCHAR) AS url
  FROM links WHERE regexp_extract(page_url, '^(https?://[^/?#]+)', 1) <> '')
SELECT url, CAST(regexp_extract(url, '[?&]filter=([0-9]+)', 1) AS BIGINT) AS page_number FROM u
WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE p.url = u.url)
""")
def q_frontier_by_page_number(spark: SparkSession, sf_dir: str):
    """Links not in a text ledger of visited pages, newest first by the page number in their query."""
    pages = Tables(spark, sf_dir).pages
    ledger = scratch_path(spark, "ledger")
    pages.select(F.coalesce("url", F.lit("")).alias("value")).write.text(ledger)
    links = page_links(pages).select(
        F.concat("url", F.lit("?filter="), F.length(F.regexp_replace("url", r"^https?://[^/?#]+", ""))).alias("url"))
    return newest_first(new_urls(links, read_ledger(spark, ledger)))


@register("empty_to_null", r"""
SELECT page_id,
       NULLIF(regexp_extract(url, '\?([^#]*)', 1), '') AS query,
       NULLIF(regexp_extract(url, '#(.*)$', 1), '') AS fragment
FROM pages
""")
def q_empty_to_null(spark: SparkSession, sf_dir: str):
    """URL query and fragment, with the empty string of a missing part as NULL."""
    pages = Tables(spark, sf_dir).pages
    parts = pages.select("page_id", F.regexp_extract("url", r"\?([^#]*)", 1).alias("query"),
                         F.regexp_extract("url", r"#(.*)$", 1).alias("fragment"))
    return empty_to_null(parts)
