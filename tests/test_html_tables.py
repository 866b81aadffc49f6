"""Reference tables of stored pages: spans, nesting, per-page headers, row blocks."""

from sluice.operators.bands import BandSpec, band_dimension
from sluice.sources.html import html_list_links, html_table, html_table_cells, page_table

SPANS = """<TABLE><tr><th>Variable<th>Value<th>Meaning</tr>
<tr><td rowspan="2">Cloud &amp; Cover</td><td>1</td><td>0%-6%</td></tr>
<tr><td>2</td><td><b>6%</b>-19%</td></tr>
<tr><td colspan=2>wide</td><td>x</td></tr></table>"""
NESTED = "<table><tr><td>outer <table><tr><td>inner</td></tr></table> rest</td><td>b</td></tr><tr><td>c</td></tr></table>"


def test_spanning_cells_are_repeated():
    assert page_table(SPANS, 0) == [["Variable", "Value", "Meaning"], ["Cloud & Cover", "1", "0%-6%"],
                                    ["Cloud & Cover", "2", "6%-19%"], ["wide", "wide", "x"]]
    both = "<table><tr><td rowspan=0>a<td rowspan=2 colspan=2>b</tr><tr><td>c</tr><tr><td>d<td>e</tr></table>"
    assert page_table(both, 0) == [["a", "b", "b"], ["a", "b", "b", "c"], ["a", "d", "e"]]


def test_nested_tables_count_in_the_order_they_open():
    assert page_table(NESTED, 0) == [["outer rest", "b"], ["c"]]
    assert page_table(NESTED, 1) == page_table(NESTED, -1) == [["inner"]]
    assert page_table(NESTED, 2) == [] and page_table(None, 0) == [] and page_table("<td>x", 0) == []


def test_each_page_has_its_own_header(spark):
    turned = "<table><tr><td>Meaning</td><td>Variable</td></tr><tr><td>m</td><td>v</td></tr></table>"
    pages = spark.createDataFrame([(1, SPANS), (2, turned), (3, "no table"), (4, None)], "page_id int, html string")
    rows = html_table(pages, 0, header=["Variable", "Value", "Meaning"]).orderBy("page_id", "row_idx").collect()
    assert [tuple(r) for r in rows] == [(1, 0, "Cloud & Cover", "1", "0%-6%"), (1, 1, "Cloud & Cover", "2", "6%-19%"),
                                        (1, 2, "wide", "wide", "x"), (2, 0, "v", None, "m")]
    assert html_table(pages, 0).columns == ["page_id", "row_idx", "Variable", "Value", "Meaning"]
    assert html_table_cells(pages, 0).count() == 6


def test_bands_of_a_row_block(spark):
    pages = spark.createDataFrame([(1, SPANS)], "page_id int, html string")
    table = html_table(pages, 0, header=["Variable", "Value", "Meaning"])
    spec = BandSpec("cloud", "another name", unit="%")
    assert [tuple(r) for r in band_dimension(table, spec, rows=(0, 2)).orderBy("cloud").collect()] == [(1, 0, 6), (2, 6, 19)]
    assert band_dimension(table, spec).count() == 0


def test_list_links_in_any_spelling(spark):
    html = """<LI class=a> <a id="1" href='x'>one <b>two</b></a></li><li><a href="/y">y</a></li><li><a
      href=z target=_top>z</A></li><li>none</li>"""
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert [(r.pos, r.href, r.text) for r in html_list_links(pages).orderBy("pos").collect()] == [
        (0, "x", "one two"), (1, "/y", "y"), (2, "z", "z")]
