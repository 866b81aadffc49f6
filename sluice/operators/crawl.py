"""Crawl frontier: links found on stored pages minus the URLs already stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, anti_join
from sluice.sources.pages import page_parts

ORIGIN = r"^(?i)(https?://[^/?#]+)"
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
DOTS = r"/\.\.?(/|$)"


def _without_dot_segments(path: Column) -> Column:
    """``/a/./b/../c`` to ``/a/c``: segments in order, ``..`` takes back the one before."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    kept = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"), lambda done, x: (
        F.when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(x == ".", done).otherwise(F.concat(done, F.array(x)))))
    # A path that ends in a dot segment names a folder.
    return F.concat(F.lit("/"), F.array_join(F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit(""))))
                                             .otherwise(kept), "/"))


def resolve_href(page_url: Column, href: Column) -> Column:
    """Absolute URL of an ``href`` on ``page_url``, without its fragment.

    Absolute, ``//host``, ``/root``, ``?query``, relative and ``#fragment``
    links are resolved as a browser does, dot segments too; other schemes
    (``mailto:``) and pages without an http origin give NULL. Characters stay
    as they are written: no percent-encoding is added or taken away.
    """
    link = F.regexp_replace(F.trim(href), r"(?s)#.*$", "")
    origin = F.regexp_extract(page_url, ORIGIN, 1)
    page = F.regexp_replace(page_url, r"(?s)#.*$", "")
    bare = F.regexp_replace(page, r"(?s)\?.*$", "")
    path = F.substring(bare, F.length(origin) + 1, F.length(bare))
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, r"(?s)^(.*/)", 1))
    link_path = F.regexp_extract(link, r"(?s)^([^?]*)", 1)
    query = F.substring(link, F.length(link_path) + 1, F.length(link))
    whole = F.when(link_path.startswith("/"), link_path).otherwise(F.concat(folder, link_path))
    dotted = F.concat(F.lit("/"), whole).rlike(DOTS)
    return (F.when(link.rlike(r"^(?i)https?://"), _without_dots(link))
            .when(link.rlike(SCHEME) | (origin == ""), F.lit(None).cast("string"))
            .when(link.startswith("//"), _without_dots(F.concat(F.regexp_extract(page_url, r"^([^:]+:)", 1), link)))
            .when(link == "", page)
            .when(link.startswith("?"), F.concat(bare, link))
            .otherwise(F.concat(origin, F.when(dotted, _without_dot_segments(whole)).otherwise(whole), query)))


def _without_dots(url: Column) -> Column:
    """An absolute URL without the dot segments of its path."""
    origin = F.regexp_extract(url, ORIGIN, 1)
    bare = F.regexp_extract(url, r"(?s)^([^?]*)", 1)
    path = F.substring(bare, F.length(origin) + 1, F.length(bare))
    return F.when(path.rlike(DOTS), F.concat(origin, _without_dot_segments(path), F.substring(
        url, F.length(bare) + 1, F.length(url)))).otherwise(url)


def link_events(pages: DataFrame, keys: Sequence[str] = ("page_id",), url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Every ``<a href>`` of every page: ``keys + (pos, href, text, item, list, depth, url)``.

    ``item``, ``list`` and ``depth`` say in which list item a link stands (NULL outside lists). ``url`` is the absolute
    URL, resolved against the page's ``<base href>`` if it has one, NULL for other schemes.
    """
    keys = list(keys)
    parts = page_parts(pages.withColumn("__page", F.col(url_col)), [*keys, "__page"], html_col, ["base", "links"])
    based = F.when(F.col("base").isNull(), F.col("__page")).otherwise(
        F.coalesce(resolve_href(F.col("__page"), F.col("base")), F.col("__page")))
    each = parts.select(*keys, based.alias("__base"), F.explode("links").alias("__l")).select(*keys, "__base", "__l.*")
    return each.select(*each.drop("__base").columns, resolve_href(F.col("__base"), F.col("href")).alias("url"))


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Every resolvable ``<a href>`` on every page, one row each."""
    parts = page_parts(pages.select(F.col(url_col).alias("__page"), html_col), ["__page"], html_col, ["base", "links"])
    based = F.when(F.col("base").isNull(), F.col("__page")).otherwise(
        F.coalesce(resolve_href(F.col("__page"), F.col("base")), F.col("__page")))
    links = parts.select(based.alias("__base"), F.explode("links.href").alias("__h"))
    # The pattern work of a link is done once: the filter reads the resolved column, not the expression.
    return links.select(F.explode(F.array_compact(F.array(resolve_href(F.col("__base"), F.col("__h"))))).alias("url"))


def query_number(url: Column, param: str) -> Column:
    """Integer value of a query parameter (``filter=1218`` -> 1218), NULL if absent."""
    return F.regexp_extract(url, rf"[?&]{param}=(\d+)", 1).try_cast("long")


def new_urls(candidates: DataFrame, ledger: DataFrame, url_col: str = "url",
             max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Distinct candidate URLs not yet in the ledger (skip already stored pages)."""
    cand = candidates.select(F.col(url_col).alias("url")).distinct()
    led = ledger.select(F.col(url_col).alias("url"))
    return anti_join(cand, led, "url", max_broadcast_bytes)


def read_ledger(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Text ledger of visited URLs, one per line; blank lines dropped."""
    lines = spark.read.text(path)
    return lines.select(F.trim("value").alias("url")).where(F.col("url") != "")


def by_page_number(urls: DataFrame, param: str = "filter", url_col: str = "url") -> DataFrame:
    """Attach the page number from the URL query, for newest-first processing."""
    return urls.withColumn("page_number", query_number(F.col(url_col), param))


def newest_first(urls: DataFrame, param: str = "filter", url_col: str = "url") -> DataFrame:
    """URLs in crawl order: largest page number first (the newest), then those without one, each by URL."""
    return by_page_number(urls, param, url_col).orderBy(F.col("page_number").desc_nulls_last(), url_col)
