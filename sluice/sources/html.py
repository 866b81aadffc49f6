"""Stored HTML pages to rows: list links and reference tables.

Both read the parts that one pass over a page finds (``sources.pages``), where
the page is stored; neither needs a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.sources.pages import Page, page_parts


def html_list_links(pages: DataFrame, keys: Sequence[str] = ("page_id",), html_col: str = "html") -> DataFrame:
    """Links inside list items: ``keys + (pos, href, text)``, pos from 0 within the page.

    Whatever markup stands between the item and its links or inside the link's text is passed over.
    """
    keys = list(keys)
    links = F.filter("links", lambda x: x["item"].isNotNull())
    return (page_parts(pages, keys, html_col, ["links"]).select(*keys, F.posexplode(links).alias("pos", "__l"))
            .select(*keys, "pos", F.col("__l.href").alias("href"), F.col("__l.text").alias("text")))


def page_table(html: str | None, index: int) -> list[list[str]]:
    """The ``index``-th table of a page (nested tables count, negative from the end), or no rows."""
    return Page(html).grid(index)


def _table_rows(pages: DataFrame, table_index: int, keys: list[str], html_col: str) -> DataFrame:
    """``keys + (row_idx, cells, names)``: the rows of each page's table; ``names`` is the page's first row."""
    at = F.lit(table_index) if table_index >= 0 else F.size("tables") + table_index
    table = F.when(at >= 0, F.get("tables", at))
    rows = page_parts(pages, keys, html_col, ["tables"]).select(*keys, table.alias("__t"))
    return rows.select(*keys, F.posexplode("__t").alias("row_idx", "cells"), F.get("__t", F.lit(0)).alias("names"))


def html_table_cells(pages: DataFrame, table_index: int, keys: Sequence[str] = ("page_id",),
                     html_col: str = "html") -> DataFrame:
    """Cells of the ``table_index``-th table of each page (negative counts from
    the end, as ``read_html(..)[-4]``): ``keys + (row_idx, cells)``.

    Every table counts, nested ones after the one they are in; a cell with
    ``rowspan`` or ``colspan`` is repeated in each place it covers; the text
    of a nested table belongs to that table alone.
    """
    return _table_rows(pages, table_index, list(keys), html_col).drop("names")


def html_table(pages: DataFrame, table_index: int, keys: Sequence[str] = ("page_id",),
               html_col: str = "html", header: Sequence[str] | None = None) -> DataFrame:
    """The chosen table as rows with named columns; each page's first row is its header.

    Output columns are ``header`` or, when not given, the header of the first
    page (one small row read on the driver). A page's cells are found by the
    names in its own header, so pages may order columns differently; a name a
    page lacks is NULL there.
    """
    keys = list(keys)
    rows = _table_rows(pages, table_index, keys, html_col)
    if header is None:
        first = (rows.where(F.col("row_idx") == 0)
                 .agg(F.min_by("cells", F.struct(*keys)).alias("cells")).first())
        header = list(first["cells"]) if first and first["cells"] is not None else []
    at = lambda name: F.array_position(F.col("names"), name)
    return (rows.where(F.col("row_idx") > 0)
            .select(*keys, (F.col("row_idx") - 1).alias("row_idx"),
                    *[F.when(at(name) > 0, F.get(F.col("cells"), (at(name) - 1).cast("int"))).alias(name)
                      for name in header]))
