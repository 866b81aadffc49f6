"""License scan: planted notices, edited passages, and fingerprints against all shared runs."""

import random

from sluice.llm import licenses
from sluice.llm.common import words_of

SCANNER = licenses.Scanner(licenses.TEMPLATES, 3, 2, 6, 0.8)
MIT = licenses.TEMPLATES[1][1]


def names(text):
    return [(f["license"], round(f["coverage"], 2)) for f in SCANNER.scan(text.encode())]


def test_every_template_is_found_in_prose():
    for name, text in licenses.TEMPLATES:
        prose = "ünnütz the words before, " + text.upper() + " and of the words after."
        found = [f for f in SCANNER.scan(prose.encode()) if f["license"] == name and f["coverage"] == 1]
        assert any(words_of(prose[f["start"]:f["stop"]].encode()) == words_of(text.encode()) for f in found), name


def test_edited_passages_keep_their_coverage():
    dice = random.Random(4)
    words = MIT.split()
    for _ in range(20):
        own = list(words)
        for _ in range(4):
            at = dice.randrange(2, len(own) - 2)
            own[at:at + dice.randrange(2)] = ["changed"] * dice.randrange(2)
        found = SCANNER.scan(("some text " + " ".join(own) + " more text").encode())
        assert [f["license"] for f in found] == ["MIT"] and found[0]["coverage"] >= 0.9
    assert names(" ".join(words[:20])) == []  # a third of it is not enough
    assert names(" ".join(dice.sample(words, len(words)))) == []
    assert names("free of charge to the public") == []


def test_shared_runs_share_a_fingerprint():
    dice = random.Random(6)
    for _ in range(200):
        words = [dice.randrange(1, 40) for _ in range(30)]
        n, at = 4, dice.randrange(26)
        other = [dice.randrange(1, 40) for _ in range(10)] + words[at:at + n] + [0, 0, 5]
        import numpy as np
        a, b = (SCANNER._grams(np.array(x, np.uint64)) for x in (words, other))
        assert {int(a[i]) for i in licenses.winnow(a, 2)} & {int(b[i]) for i in licenses.winnow(b, 2)}


def test_repeats_and_long_texts():
    line = "Released under the MIT License. "
    found = SCANNER.scan((line + "x y z " * 40000 + line * 200).encode())
    assert len(found) == 201 and all(f["coverage"] == 1 for f in found)
    assert found[0]["start"] == 0 and found[0]["stop"] == len(line) - 2


def test_rows(spark):
    rows = [(1, "Licensed under CC BY-NC 4.0.", ""), (2, None, ""), (3, "", ""), (4, "...", ""), (None, MIT, ""), (1, "License", ""),
            (5, "This work is licensed under the GNU General Public License, version 3.", "")] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, Licenses string")
    found, name = licenses.scan_licenses(docs)
    assert name == "licenses_" and found.columns == [*docs.columns, name]
    got = [(r[0], [f.license for f in r[1]]) for r in found.select("doc_id", f"{name}.found").collect()]
    assert len(got) == len(rows) and got.count((5, ["GPL-3.0"])) == 2 and got.count((None, ["MIT"])) == 2
    assert got.count((1, ["CC-BY-NC-4.0"])) == 2 and sum(1 for _, f in got if f) == 6
    assert licenses.scan_licenses(docs.limit(0))[0].count() == 0


def test_whole_texts_and_bodies_without_their_opening():
    texts = dict(licenses.license_texts())
    for name, text in texts.items():
        found = [f for f in SCANNER.scan(("vorab ünnütz " + text + " and after").encode()) if f["kind"] == "text"]
        assert [(f["license"], f["coverage"]) for f in found] == [(name, 1.0)], name
    assert {f["license"] for f in SCANNER.scan(texts["BSD-2-Clause"].encode())} == {"BSD-2-Clause"}
    for name, start in (("MIT", "THE SOFTWARE IS"), ("BSD-3-Clause", "1. Redist"), ("Apache-2.0", "2. Grant"), ("GPL-2.0", "4. You may")):
        body = texts[name][texts[name].index(start):]
        body = body[:len(body) // 2] if len(body) > 5000 else body
        found = [f for f in SCANNER.scan(body.encode()) if f["license"] == name and f["kind"] != "notice"]
        assert len(found) == 1 and found[0]["coverage"] < 1, name
    opening = SCANNER.scan(MIT.encode())
    assert opening[0]["kind"] == "notice" and opening[0]["coverage"] == 1 and opening[0]["whole"] < 0.5


def test_notices_tell_versions_and_relatives_apart():
    assert names("Licensed under CC BY-SA 4.0.") == [("CC-BY-SA-4.0", 1.0)]
    assert names("Licensed under CC BY-NC 1.0.") == []
    assert names("This work is licensed under the GNU General Public License, version 2.")[0] == ("GPL-2.0", 1.0)
    assert {n for n, _ in names("This work is licensed under the GNU Lesser General Public License, version 3.")} == {"LGPL-3.0"}


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = _next_row(row, x, b)
    return row[-1]


def _next_row(row, x, b):
    now = [0]
    for j, y in enumerate(b):
        now.append(max(now[-1], row[j + 1], row[j] + (x == y)))
    return now


def test_common_words_against_the_full_table():
    dice = random.Random(8)
    for _ in range(300):
        a, b = ([dice.randrange(6) for _ in range(dice.randrange(1, 25))] for _ in range(2))
        assert licenses._common(a, b, 30) == longest_common(a, b)
        assert licenses._common(a, b, 2) <= longest_common(a, b)
    assert licenses._common([1], [1], 6) == 1 and licenses._common([1, 2], [2], 6) == 1


def whole(name, text, prose=("vorab " * 30, " und danach " * 20)):
    """The places of whole texts and parts in a text amid prose."""
    found = SCANNER.scan((prose[0] + text + prose[1]).encode())
    return [f for f in found if f["kind"] != "notice"]


def test_insertions_of_any_length_keep_one_place():
    dice = random.Random(9)
    for name in ("MIT", "BSD-3-Clause", "Apache-2.0", "GPL-2.0"):
        words = dict(licenses.license_texts())[name].split()
        for extra in (1, 45, 60):
            at = len(words) // 2
            changed = words[:at] + [f"inserted{dice.randrange(99)}" for _ in range(extra)] + words[at:]
            found = whole(name, " ".join(changed))
            assert [(f["license"], f["kind"], f["coverage"]) for f in found] == [(name, "text", 1.0)], (name, extra)
            assert found[0]["last_word"] - found[0]["first_word"] + 1 >= found[0]["matched"] + extra


def test_changed_words_keep_one_place():
    for name in ("MIT", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "MPL-2.0"):
        words = [w.decode() for w in words_of(dict(licenses.license_texts())[name].encode())]
        changed = ["changed" if i % 5 == 4 else w for i, w in enumerate(words)]
        right = sum(a == b for a, b in zip(words, changed, strict=True)) / len(words)
        found = [f for f in whole(name, " ".join(changed)) if f["license"] == name]
        assert len(found) == 1 and abs(found[0]["coverage"] - right) < 0.01, (name, found)


def test_random_edits_against_the_full_alignment():
    dice = random.Random(10)
    for name in ("MIT", "ISC", "Zlib", "BSD-2-Clause"):
        words = [w.decode() for w in words_of(dict(licenses.license_texts())[name].encode())]
        for _ in range(6):
            own = list(words)
            for _ in range(len(words) // 20):
                at = dice.randrange(len(own))
                what = dice.randrange(3)
                own[at:at + (what != 0)] = [f"new{dice.randrange(50)}" for _ in range(dice.randrange(1, 4))] if what != 1 else []
            found = [f for f in whole(name, " ".join(own)) if f["license"] == name]
            want = longest_common(own, words)
            assert len(found) == 1 and want - 6 <= found[0]["matched"] <= want, (name, found, want)  # ends are extended without gaps


def test_copies_in_one_text_are_places_of_their_own():
    text = dict(licenses.license_texts())["ISC"]
    found = whole("ISC", " something else ".join([text] * 40))
    assert [(f["license"], f["coverage"]) for f in found] == [("ISC", 1.0)] * 40


def test_notices_and_texts_take_linear_time():
    import time

    def seconds(piece, n):
        start = time.perf_counter()
        found = SCANNER.scan((piece * n).encode())
        assert len([f for f in found if f["kind"] != "part"]) >= n
        return time.perf_counter() - start

    notice = "Released under the MIT License. And some other words here. "
    assert seconds(notice, 100_000) < 15 * seconds(notice, 10_000)
    mit = dict(licenses.license_texts())["MIT"] + " Something else in between. "
    assert seconds(mit, 1000) < 15 * seconds(mit, 100)
