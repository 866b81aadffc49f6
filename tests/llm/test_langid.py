"""Language identification: held-out accuracy, code-switched words, edge rows."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import langid
from sluice.plans.tables import table

SF_SMALL = "/root/testdata/sf0.001"


def test_forward_backward_equals_enumeration():
    dice = np.random.default_rng(2)
    sizes, moves = np.array([1, 4, 3]), dice.normal(0, 1, (3, 3))
    emissions = dice.normal(0, 2, (sizes.sum(), 3))
    got, counts = langid.marginals(emissions, sizes, moves)
    want, pairs, at = np.zeros_like(got), np.zeros((3, 3)), 0
    for n in sizes:
        paths = np.array(np.meshgrid(*[range(3)] * n)).reshape(n, -1).T
        logs = np.array([sum(emissions[at + t, p[t]] for t in range(n)) + sum(moves[p[t], p[t + 1]] for t in range(n - 1))
                         for p in paths])
        chance = np.exp(logs - logs.max())
        chance /= chance.sum()
        for p, c in zip(paths, chance, strict=True):
            for t in range(n):
                want[at + t, p[t]] += c
                if t + 1 < n:
                    pairs[p[t], p[t + 1]] += c
        at += n
    assert np.allclose(got, want) and np.allclose(counts, pairs)
    chances = langid.chances_of(emissions, sizes, moves)
    assert np.allclose(chances, want)
    shares = langid.shares_of(chances, sizes)
    assert np.allclose(shares, [want[0:1].mean(0), want[1:5].mean(0), want[5:8].mean(0)])


def test_held_out_accuracy_and_code_switching(spark):
    docs = table(spark, SF_SMALL, "documents")
    held = langid.is_held_out(F.col("doc_id"))
    model = langid.learn(docs.where(~held), docs_per_language=40)
    found, name = langid.identify(docs, model)
    rows = found.where(held).select("lang", f"{name}.*").collect()
    assert len(rows) > 30 and np.mean([r.lang == r.lang_pred for r in rows]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    texts = {r.lang: r.text for r in docs.where("length(text) > 800").collect()}
    mixed = " ".join(texts["en"].split()[:60] + texts["de"].split()[:60])
    tagger = langid.Tagger(model)
    _, _, n, shares = tagger.predict([mixed])[0]
    assert n > 100 and min(shares[model.langs.index("en")], shares[model.langs.index("de")]) > 0.3


def test_edges(spark):
    rows = [(1, "the cat and the dog", "en", 1), (2, "der hund und die katze", "de", 1), (3, None, "en", 1),
            (4, "", "de", 1), (5, "12 34 ½ --- 42", "en", 1), (6, "the " * 30000, None, 1), (7, "der hund", "", 1),
            (None, "the dog", "en", 1), (1, "the cat and the dog", "en", 1), (9, "und", "de", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, Language int")
    model = langid.learn(docs)
    assert model.langs == ["de", "en"]
    found, name = langid.identify(docs, model)
    assert name == "language_" and found.columns == [*docs.columns, name]
    got = [(r.doc_id, r.lang_pred, r.score) for r in found.select("doc_id", f"{name}.*").collect()]
    assert len(got) == len(rows)
    assert {i for i, lang, _ in got if lang == "und"} == {3, 4, 5}
    assert all(s == 0 for _, lang, s in got if lang == "und")
    assert dict((i, lang) for i, lang, _ in got)[6] == "en" and got.count(got[0]) == 2
    # No labelled row, and an empty table.
    bare, name = langid.identify(docs, langid.learn(docs.withColumn("lang", F.lit(None).cast("string"))))
    assert {r[0] for r in bare.select(f"{name}.lang_pred").collect()} == {"und"}
    empty, name = langid.identify(docs.limit(0), langid.learn(docs.limit(0)))
    assert empty.count() == 0


def test_memory_of_words_is_bounded_without_changing_results():
    model = langid.fit([("the cat and the dog sat on a mat", "en"), ("der hund und die katze im haus", "de")] * 5)
    texts = ["the cat sat", "der hund", "und die katze", "on the mat " * 50, "", None, "xyz qq"]
    large, small = langid.Tagger(model), langid.Tagger(model, bound=3, chain_words=4)
    for a, b in zip(large.predict(texts), [small.predict([t])[0] for t in texts], strict=True):
        assert a[0] == b[0] and np.isclose(a[1], b[1])


def test_every_label_is_fitted(spark):
    rows = [(i, f"wort{chr(97 + i % 26)}{chr(97 + i // 26)} " * 4, f"l{i:02d}") for i in range(70)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert langid.learn(docs).langs == [r[2] for r in rows]
    with pytest.raises(ValueError, match="labels"):
        langid.learn(docs, max_langs=69)


def test_memory_does_not_grow_with_the_labels():
    import numpy as np
    few, many = (langid.Tagger(langid.Model([f"l{i}" for i in range(n)], np.zeros((8, n), np.float32), np.zeros((n, n), np.float32)))
                 for n in (4, 200))
    assert many.bound * 200 <= few.bound * 4 * 4 and many.chain_words * 200 <= few.chain_words * 4


def plain_prediction(text, model):
    """One document alone, word by word: forward and backward sums in plain loops."""
    words = [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\W\d_]+", text.lower()) if any(map(str.isalpha, m.group()))]
    seen = [np.exp(langid.Features([w], len(model.weights)).scores(model.weights)[0].astype(float)) for w, _, _ in words]
    move = np.exp(model.transitions.astype(float))
    ahead, back = [seen[0] / seen[0].sum()], [np.ones(len(move))]
    for now in seen[1:]:
        ahead.append((ahead[-1] @ move) * now)
        ahead[-1] = ahead[-1] / ahead[-1].sum()
    for now in seen[:0:-1]:
        back.append(move @ (now * back[-1]))
        back[-1] = back[-1] / back[-1].sum()
    chance = np.array(ahead) * np.array(back[::-1])
    chance /= chance.sum(axis=1, keepdims=True)
    spans = []
    for (_, start, end), c in zip(words, chance, strict=True):
        lang = model.langs[int(c.argmax())]
        if spans and spans[-1][0] == lang:
            spans[-1] = (lang, spans[-1][1], end, spans[-1][3] + 1)
        else:
            spans.append((lang, start, end, 1))
    return chance.mean(axis=0), spans


def test_predictions_and_spans_equal_a_plain_version(spark):
    docs = table(spark, SF_SMALL, "documents")
    model = langid.learn(docs, docs_per_language=30)
    found, name = langid.identify(docs, model, spans=True)
    rows = found.where("length(text) > 0").select("text", f"{name}.*").collect()
    for r in rows[:40]:
        share, spans = plain_prediction(r.text, model)
        assert np.allclose(r.shares, share, atol=1e-4) and r.lang_pred == model.langs[int(share.argmax())]
        assert [(s["lang"], s["start"], s["end"], s["n_words"]) for s in r.spans] == spans
        assert all(0 < s["score"] <= 1 for s in r.spans) and sum(s["n_words"] for s in r.spans) == r.n_words


def test_switches_between_languages_are_found(spark):
    docs = table(spark, SF_SMALL, "documents")
    model = langid.learn(docs, docs_per_language=40)
    texts = {r.lang: r.text for r in docs.where("length(text) > 800").collect()}
    parts = [" ".join(texts[lang].split()[:40]) for lang in ("en", "de", "en")]
    mixed = "  ".join(parts)
    _, _, _, _, spans = langid.Tagger(model).predict([mixed], spans=True)[0]
    truth = np.repeat([0, 1, 0], [len(parts[0]) + 1, len(parts[1]) + 2, len(parts[2]) + 1])
    right = sum((truth[s["start"]:s["end"]] == (s["lang"] == "de")).sum() for s in spans if s["lang"] in ("en", "de"))
    assert {s["lang"] for s in spans} >= {"en", "de"} and right >= 0.9 * sum(map(len, parts))


def test_spans_of_odd_texts():
    model = langid.fit([("the cat and the dog sat on a mat", "en"), ("der hund und die katze im haus", "de")] * 5)
    tagger = langid.Tagger(model)
    texts = [None, "", "12 34 --- ½", "\u0130\u0130 the cat, der hund", "the " * 30000]
    plain, found = tagger.predict(texts), tagger.predict(texts, spans=True)
    assert [f[:4] for f in found] == plain and [f[4] for f in found[:3]] == [[], [], []]
    # A capital dotted I is two characters when lower-cased; places are those of the text.
    assert found[3][4][0]["start"] == 0 and found[3][4][-1]["end"] == len(texts[3])
    assert [texts[3][s["start"]:s["end"]] for s in found[3][4]][-1] == "der hund"
    assert found[4][4] == [{"lang": "en", "start": 0, "end": 4 * 30000 - 1, "n_words": 30000, "score": found[4][4][0]["score"]}]
    # Without a label nothing is labelled.
    assert langid.Tagger(langid.fit([])).predict(["the cat"], spans=True) == [("und", 0.0, 2, [], [])]
