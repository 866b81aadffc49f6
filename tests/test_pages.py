"""The page tokenizer: what is a link, a list item and a table, whatever the markup."""

import random
import re
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from sluice.operators.crawl import link_events, new_urls, page_links, resolve_href
from sluice.sources.html import html_list_links
from sluice.sources.pages import Page, attributes, page_parts


def links(html):
    return [(x["href"], x["text"], x["item"]) for x in Page(html).part("links")]


@pytest.mark.parametrize("html, want", [
    ('<li><b><a href=x>one <i>two</i></a></b></li>', [("x", "one two", 0)]),
    ('<LI>text <a HREF="y">z</a>', [("y", "z", 0)]),
    ('<ul><li><a href=1>a</a> <a href=2>b</a><li><a href=3>c</a></ul><a href=4>d</a>',
     [("1", "a", 0), ("2", "b", 0), ("3", "c", 1), ("4", "d", None)]),
    ('<a href=1>one<a href=2>two', [("1", "one", None), ("2", "two", None)]),
    ('<li><a href=1>one</li><li>two<a href=2>x</ul>', [("1", "one", 0), ("2", "x", 1)]),
    ('<!-- <a href=1> --><a href=2>b</a><!--><a href=3>c</a><!-- <a href=4>', [("2", "b", None), ("3", "c", None)]),
    ('<script>"<a href=1>"</script ><style><a href=2></style><a href=3>c</a><script><a href=4>', [("3", "c", None)]),
    ('<title><a href=1></title><textarea></a><a href=2></textarea><a href=3>c</a>', [("3", "c", None)]),
    ('<template><a href=1>a</a><template></template><a href=2></template><a href=3>c</a>', [("3", "c", None)]),
    ('<noscript><a href=1>a</a></noscript>', [("1", "a", None)]),
    ('<a title="a>b" href = \'q"q\'>a</a><a href="1" HREF="2">b</a><a data-href=3>c</a><abbr href=4>d</abbr><a>e</a>',
     [('q"q', "a", None), ("1", "b", None)]),
    ('<a href="&#47;e&lt;&amp;x&copy=1&copy2&copy;&notit;&hellip">&copy2 &lt;</a>', [("/e<&x&copy=1&copy2©&notit;&hellip", "©2 <", None)]),
    ('<a href=" a\nb\t ">x\ny</a><a href>none</a><a href=""/>', [("ab", "x\ny", None), ("", "none", None), ("", "", None)]),
    # No other quote follows: the value ends at the blank.
    ('<a href="unclosed x>a</a><a href=2>b</a>', [('"unclosed', "a", None), ("2", "b", None)]),
    ("<a\nhref=/x/>t</a>a < b <a1 href=x> <!doctype> </a> <?php <a href=1>?> </", [("/x/", "t", None)]),
    ('<li><table><tr><td><ul><li><a href=1>a</td><td><a href=2>b</table><a href=3>c', [("1", "a", 1), ("2", "b", 0), ("3", "c", 0)]),
    ('<ul><li>a<ul><li><a href=1>x</a></ul><a href=2>y</a></ul>', [("1", "x", 1), ("2", "y", 0)]),
    ("", []), (None, [])])
def test_links(html, want):
    assert links(html) == want


def test_items_lists_and_depth():
    page = Page("<li>loose<ol><li>one <b>1</b><ul><li>deep</ul> tail<li>two</ol> end <ul><li>other")
    assert [(i["item"], i["list"], i["depth"], i["text"]) for i in page.part("items")] == [
        (0, None, 0, "loose end "), (1, 0, 1, "one 1 tail"), (2, 1, 2, "deep"), (3, 0, 1, "two"), (4, 2, 1, "other")]


def test_attributes():
    assert attributes(""" a b=1 C = "x y" d='"' e= f=g/h A=2 """) == {"a": "", "b": "1", "c": "x y", "d": '"', "e": "f=g/h"}


def test_base_counts_for_every_link(spark):
    rows = [("http://h.x/a/b.html", '<base target=t><base href="../c/"><base href="/no/"><a href=d>d</a><a href="?q">q</a><a href="#f">f</a>'),
            ("http://h.x/a/b.html", '<!-- <base href="/no/"> --><base href="//cdn.y/z/w?v"><a href=d>d</a>'),
            ("http://h.x/a/b.html", '<base href="mailto:x"><a href=d>d</a>'),
            ("no page", '<base href="https://o.z/"><a href=d>d</a>'), (None, "<a href=d>d</a>"), ("http://h.x/", None)]
    pages = spark.createDataFrame(rows, "url string, html string")
    assert sorted(r.url for r in page_links(pages).collect()) == sorted([
        "http://h.x/c/d", "http://h.x/c/?q", "http://h.x/c/", "http://cdn.y/z/d", "http://h.x/a/d", "https://o.z/d"])
    known = spark.createDataFrame([("http://h.x/c/d",)], "url string")
    assert new_urls(page_links(pages), known).count() == 5


def test_absolute_links_lose_dot_segments(spark):
    row = spark.createDataFrame([("http://h.x/p",)], "u string").select(
        *[resolve_href("u", F.lit(h)).alias(f"c{i}") for i, h in enumerate(
            ["https://o.z/a/../b/./c?d=/../e#f", "//o.z/..", "http://o.z", "/a/.b/..c"])])
    assert tuple(row.first()) == ("https://o.z/b/c?d=/../e", "http://o.z/", "http://o.z", "http://h.x/a/.b/..c")


def test_link_events_keep_keys_and_places(spark):
    pages = spark.createDataFrame([(1, "k", "http://h.x/", "<a href=a>A</a><li><a href='mailto:b'>B</a>"), (2, "l", "http://h.x/", None)],
                                  "page_id int, links string, url string, html string")
    got = link_events(pages).orderBy("pos").collect()
    assert [tuple(r) for r in got] == [(1, 0, "a", "A", None, None, None, "http://h.x/a"), (1, 1, "mailto:b", "B", 0, None, 0, None)]
    assert html_list_links(pages).count() == 1
    whole = page_parts(pages).orderBy("page_id").collect()
    assert whole[1][1:] == (None, [], [], []) and len(whole[0].links) == 2 and whole[0]["items"][0].text == "B"


class Plain(HTMLParser):
    """Hrefs as the standard library's parser finds them in well-formed pages."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.hrefs = []
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag == "a" and (found := [v for k, v in attrs if k == "href"]):
            self.hrefs.append(found[0] or "")


def test_random_pages_against_the_standard_parser():
    dice = random.Random(3)
    pieces = ["<ul>", "</ul>", "<li>", "</li>", "<b>", "</b>", "text", "a &amp; b", "<!-- c <a href=no> -->", "<script>'<a href=no>'</script>",
              '<a href="/x">', "<a href='y?a=1&amp;b=2' class=z>", "<a id=q href=z>", "</a>", "<a name=n>", "<table><tr><td>", "</td></tr></table>",
              "<p title='<a href=no>'>", "<br/>", "<A HREF=up>", "< b", "<img src=x alt='>'>"]
    for _ in range(400):
        html = "".join(dice.choices(pieces, k=dice.randrange(30)))
        assert [x[0] for x in links(html)] == Plain(html).hrefs, html


@pytest.mark.parametrize("piece", ["<a ", "<a href=", '<a href="', "<!--", "<script>", "<li>", "<ul><li><a href=x>", "</ul>", "<table><tr><td>",
                                   "&", "<", "<a href='x' ", "=", "<a href=x>&lt;", "<ul>x", "<ul><td>", "<ul><li>x</li>"])
def test_time_grows_with_the_page(piece):
    def seconds(n):
        start = time.perf_counter()
        Page(piece * n)
        return time.perf_counter() - start
    seconds(100)
    assert seconds(50_000) < 30 * max(seconds(5_000), 0.01)


def test_no_pattern_is_left(spark):
    import sluice.sources.html as html
    assert not [n for n in vars(html) if isinstance(getattr(html, n), re.Pattern)]
