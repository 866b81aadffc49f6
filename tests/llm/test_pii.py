"""Personal data: base spans against a plain regex scan, disclosing terms, sanitised texts."""

import math
import re

import pytest

from sluice.llm import pii
from sluice.plans.tables import table

SF_SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, spans string, th int"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) \
                    or kind == "card" and 12 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15:
                out.append((m.start(), rank, m.end(), kind))
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS)
    got = pii.all_spans(df, **options).select("doc_id", pii.listed("spans"), "added").collect()
    return sorted(((r[0], r[1], [(s.start, s.stop, s.value) for s in r[2]]) for r in got), key=str)


def test_driver_documents(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    assert [r[:2] for r in found(spark, rows)] == sorted(((i, ",".join(base(t))) for i, t in rows), key=str)


def test_hard_texts(spark):
    texts = ["a@b.c_d@e.ff", "x@y@z.w", "@a.b", "a@b", "a@b.", "é1@b.c-d.e..f", "1.2.3.4.5.6.7.8", "999.1.1.1.2", "01.002.0255.7",
             "256.1.1.1", "1.1.1.256 1.1.1.1", "0000000000000000000000001.1.1.1", "4111 1111-1111 1111", "4111  1111 1111 1111",
             "41111111111111112", "+1 (743) 555-3824", "+12345678", "+123456789(", "++49 30 1234567 +", "ü👍 +49 30 1234567 ö a@b.de",
             "+4111111111111111", "10.0.0.1@x.y", None, "", "7" * 5000, "a" * 60000, "1 " * 9000, "x." * 9000 + "@a" + ".b" * 9000,
             "1." * 9000, "+1" + "(" * 9000, "+1 " * 3000]
    rows = [*enumerate(texts), (None, "a@b.cd"), (3, "a@b"), (3, "a@b")]
    assert [r[:2] for r in found(spark, rows)] == sorted(((i, ",".join(base(t))) for i, t in rows), key=str)
    assert found(spark, []) == []


def corpus():
    rows = [(i, f"ask zebulon about it: ann@corp.example, filler{i % 7} words go on {i}") for i in range(3)]
    rows += [(10 + i, f"the words go on about nothing much, other{i % 5} topic") for i in range(60)]
    rows += [(90, "call zebulon"), (91, "only unique7 beside bob@x.example now")]
    return rows


def test_terms_disclose_by_mutual_information(spark):
    rows = corpus()
    got = {r[0]: r for r in found(spark, rows)}
    n = len(rows)
    share = math.log(n * 3 / (4 * 3)) / math.log(n / 3)  # zebulon: 4 documents, 3 of them beside the address
    assert 0.7 < share < 0.95
    start = rows[0][1].index("zebulon")
    for i in range(3):
        assert (start, start + 7, "remove" if share >= 0.9 else "generalise") in got[i][2]
        assert not any(rows[i][1][a:b] in ("about", "words") for a, b, _ in got[i][2])  # common words give nothing away
    assert got[90][2] == [] and got[10][2] == []  # no protected value in these
    assert got[91][2] == []  # a single text is no estimate
    every = [(i, "zebulon ann@corp.example here") for i in range(5)]
    assert all(r[2] == [] for r in found(spark, every))


def test_copies_do_not_switch_off_sanitising(spark):
    rows = corpus()
    plain = {r[0]: r[2] for r in found(spark, rows)}
    copied = {r[0]: r[2] for r in found(spark, [*rows, *[(1000 + i, rows[0][1]) for i in range(300)]])}
    assert plain[0] and all(copied[i] == plain[i] for i in plain) and copied[1007] == plain[0]


def test_terms_go_from_the_whole_text_that_holds_the_value(spark):
    rows = corpus()
    far = "ask zebulon about it: ann@corp.example, " + "filler words go on " * 40 + "then Zebulon left, zebulons not. ZEBULON"
    got = {r[0]: r for r in found(spark, [*rows, (80, far), (81, far.replace("ann@corp.example", "nobody"))])}
    places = [m.span() for m in re.finditer(r"(?i)\bzebulon\b", far)]
    assert len(places) == 3 and [p for p in places if p in [s[:2] for s in got[80][2]]] == places
    assert far.index("zebulons") not in [s[0] for s in got[80][2]]
    assert got[81][2] == []  # does not hold the value


def test_words_of_any_length_disclose(spark):
    rows = [(i, f"Lee 李明, room b4 k\u0301: lee@corp.example, filler{i} on {i}") for i in range(3)]
    rows += [(10 + i, f"the words go on about nothing much, other{i} topic") for i in range(60)]
    got = {r[0]: r for r in found(spark, rows)}
    for i in range(3):
        gone = [rows[i][1][a:b] for a, b, _ in got[i][2]]
        assert {"Lee", "李明", "b4", "k\u0301"} <= set(gone) and "on" not in gone


@pytest.mark.parametrize("remove", [0.9, 0.71])
def test_sanitise(spark, remove):
    rows = [*corpus(), (92, None), (0, corpus()[0][1])]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, sanitised string, th int")
    clean, name = pii.sanitise(docs, remove=remove)
    assert name == "sanitised_" and clean.columns == [*docs.columns, name]
    got = clean.select("doc_id", name).collect()
    assert len(got) == len(rows)
    texts = dict(map(tuple, got))
    assert "[email]" in texts[0] and "ann@" not in texts[0] and "zebulon" not in texts[0] and "about" in texts[0]
    assert texts[90] == "call zebulon" and not texts[92]


def test_native_plan(spark):
    plan = pii.all_spans(table(spark, SF_SMALL, "documents"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
