"""URL rules and language models against a plain Python version."""

import collections
import math
import re

from sluice.llm import urlfilter
from sluice.llm.queries import URL_RULES
from sluice.plans.tables import table

SF_SMALL = "/root/testdata/sf0.001"
PAGES = "page_id bigint, url string, score string, host int"


def split(url):
    at = (url or "").find("://")
    if at < 0:
        return "", "", ""
    rest = url[at + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path, rest.lower()


def rule(host, path):
    fits = [(len(h + p), h + p, v) for h, p, v in URL_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def brute(rows, held, order=5):
    """Verdicts by dictionaries of counts; ``held`` are the urls of the calibration quarter."""
    seen = {k: collections.Counter() for k in ("allow", "block")}
    parts = [(page, *split(url), *rule(*split(url)[:2]), url in held) for page, url in rows]
    for _, _, _, letters, _, listed, out in parts:
        if listed and not out:
            padded = urlfilter.START * order + letters + urlfilter.END
            for i in range(order, len(padded)):
                for k in range(order + 1):
                    seen[listed][padded[i - k:i + 1]] += 1
    total = {k: collections.Counter() for k in seen}
    kinds = {k: collections.Counter() for k in seen}
    for k, counts in seen.items():
        for gram, n in counts.items():
            total[k][gram[:-1]] += n
            kinds[k][gram[:-1]] += 1

    def chance(k, gram):
        p = 1 / urlfilter.LETTERS
        for n in range(order + 1):
            g = gram[order - n:]
            if total[k][g[:-1]]:
                p = (seen[k][g] + kinds[k][g[:-1]] * p) / (total[k][g[:-1]] + kinds[k][g[:-1]])
        return p

    scores, bins = [], collections.defaultdict(lambda: [0, 0])
    for _, _, _, letters, _, listed, out in parts:
        padded = urlfilter.START * order + letters + urlfilter.END
        grams = [padded[i:i + order + 1] for i in range(len(letters) + 1)]
        whole = sum(round((math.log(chance("allow", g)) - math.log(chance("block", g))) * 1e6) for g in grams)
        scores.append(whole / len(grams) / 1e6)
        if listed and out:
            bins[math.floor(round(whole / len(grams)) / urlfilter.BIN)][listed == "block"] += 1
    least = urlfilter.threshold([(b, *n) for b, n in bins.items()])
    return [(p[0], p[1], p[2], p[4], p[5] or ("allow" if least is None or math.floor(s * 1e6 / urlfilter.BIN) >= least
                                              else "block"), s) for p, s in zip(parts, scores, strict=True)]


def compare(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES)
    from pyspark.sql import functions as F

    from sluice.llm.common import unit_hash
    held = {r.url for r in df.where(unit_hash(F.lit("calibration"), F.col("url")) < 0.25).collect()}
    got = urlfilter.judge(df, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score").collect()
    want = brute(rows, held)
    assert len(got) == len(rows)
    for a, b in zip(sorted(map(tuple, got), key=str), sorted(want, key=str), strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 2e-6, (a, b)


def test_driver_pages(spark):
    compare(spark, [tuple(r) for r in table(spark, SF_SMALL, "pages").select("page_id", "url").collect()])


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://A.Example.NET/en/x?q#f"), (6, "http://net"),
            (7, "http://net/"), (8, "http://xnet/"), (9, "http://a.net?x/"), (10, "http://b.org/fr/#x"), (11, "a://b.org://c/fr/"),
            (12, "http://example.com/de"), (13, "http://example.com/de/"), (14, "http://h/" + "y" * 20000), (None, "http://q.net/z"),
            (1, None), (15, "http://É.org/fr/ü"), (16, "http://x.org\n/fr/")]
    compare(spark, rows)
    empty = spark.createDataFrame([], PAGES)
    assert urlfilter.judge(empty, URL_RULES).count() == 0
    only = spark.createDataFrame([(1, "http://a.net/", "", 1), (2, "http://b/", "", 1)], PAGES)
    assert {r.page_id: r.verdict for r in urlfilter.judge(only, URL_RULES).collect()} == {1: "block", 2: "allow"}


def test_grams_are_never_broadcast(spark, monkeypatch):
    """Spark's estimate of the grams is the URLs' file, which fits any threshold long before the grams fit the driver."""
    plans, write = [], urlfilter.materialize

    def watched(df, name):
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(urlfilter, "materialize", watched)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "10m")
        rows = [(i, f"http://h{i % 7}.example.{('net', 'com', 'org')[i % 3]}/{('en', 'de', 'fr')[i // 3 % 3]}/{i}", "x", 1)
                for i in range(200)]
        judged = urlfilter.judge(spark.createDataFrame(rows, PAGES), URL_RULES)
        assert judged.count() == len(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum("SortMergeJoin" in p for p in plans) == 2  # the ratios, and the scores with two joins
    assert not [p for p in plans if "Broadcast" in p]


def test_threshold():
    assert urlfilter.threshold([]) is None and urlfilter.threshold([(1, 3, 0)]) is None
    assert urlfilter.threshold([(-2, 0, 5), (0, 1, 1), (3, 9, 0)]) in (0, 3)
    assert urlfilter.threshold([(-2, 0, 5), (3, 9, 0)]) == 3
    assert urlfilter.threshold([(0, 5, 5)]) == 0
