"""Raking against its own marginals, Spark rounds against the driver's, and sampling."""

import numpy as np
import pandas as pd
import pytest

from sluice.llm import mixing
from sluice.plans.tables import table

SF_SMALL = "/root/testdata/sf0.001"
TARGETS = {"source": 0.5, "lang": {"en": 0.5, "de": 0.3, "fr": 0.2}, "topic": 0.0}
DOCS = "doc_id bigint, text string, lang string, source string, topic int, Mixing string"


def cells(seed=1):
    dice = np.random.default_rng(seed)
    rows = [(f"s{a}", b, f"t{c}", int(dice.integers(1, 10_000))) for a in range(6) for b in ("en", "de", "fr") for c in range(3)]
    return pd.DataFrame(rows, columns=[*mixing.MARGINS, "tokens"])


def shares(frame, margin, weight):
    return pd.Series(weight).groupby(frame[margin]).sum() / weight.sum()


def test_marginals_hold():
    own = cells()
    raked = mixing.rake(own, TARGETS)
    assert np.allclose(shares(own, "lang", raked).sort_index(), [0.3, 0.5, 0.2])
    assert np.allclose(shares(own, "topic", raked), 1 / 3)
    root = own.groupby("source")["tokens"].sum() ** 0.5
    assert np.allclose(shares(own, "source", raked), root / root.sum())
    with pytest.raises(ValueError):
        mixing.rake(own, {"lang": {"xx": 1.0}})


def test_scale_is_the_largest_that_loses_no_more():
    dice = np.random.default_rng(2)
    ratio, tokens = dice.lognormal(0, 1, 50), dice.random(50)
    raked = ratio * tokens / (ratio * tokens).sum()
    c = mixing.scale(ratio, raked, 0.05)
    lost = lambda k: 1 - (np.minimum(1, k * ratio) / (k * ratio) * raked).sum()
    assert lost(c) <= 0.05 + 1e-12 and lost(1 / np.sort(ratio)[::-1][np.flatnonzero(1 / np.sort(ratio)[::-1] <= c)[-1] + 1]) > 0.05
    assert mixing.scale(ratio, raked, 0.0) == pytest.approx(1 / ratio.max())


def test_spark_rounds_equal_the_driver(spark):
    own = cells(3)
    frame = mixing.rake_frames(spark.createDataFrame(own), TARGETS, rounds=12).orderBy(*mixing.MARGINS).toPandas()
    want = mixing.rake(own.sort_values(list(mixing.MARGINS), ignore_index=True), TARGETS)
    assert np.allclose(frame["raked"], want, rtol=1e-5)


def test_documents_follow_the_probabilities(spark):
    docs = table(spark, SF_SMALL, "documents")
    mixed, name = mixing.mix(docs, {"source": 0.5, "lang": 0.8, "topic": 0.7})
    rows = mixed.select(*docs.columns, f"{name}.*").toPandas()
    assert len(rows) == docs.count() and rows["probability"].between(0, 1).all()
    assert (rows["n_tokens"] == [t.count(" ") + t.count("\n") + 1 if t else 0 for t in rows["text"]]).all()
    by_lang = (rows["n_tokens"] * rows["weight"]).groupby(rows["lang"]).sum()
    want = rows.groupby("lang")["n_tokens"].sum() ** 0.8
    assert np.allclose(by_lang / by_lang.sum(), want / want.sum(), atol=1e-6)
    again = mixing.mix(docs, {"source": 0.5, "lang": 0.8, "topic": 0.7})[0].select("doc_id", f"{name}.selected").collect()
    assert dict(map(tuple, again)) == dict(zip(rows["doc_id"], rows["selected"], strict=True))
    # Above the bound on cells, by Spark: the same weights, probabilities to the histogram's step.
    far, name = mixing.mix(docs, {"source": 0.5, "lang": 0.8, "topic": 0.7}, max_cells=1)
    far = far.select("doc_id", f"{name}.*").toPandas().set_index("doc_id").loc[rows["doc_id"]]
    assert np.allclose(far["weight"], rows["weight"], rtol=1e-4) and np.allclose(far["probability"], rows["probability"], rtol=0.02)


def test_edges(spark):
    rows = [(1, "a b", "en", "s", 1, ""), (1, "a b", "en", "s", 1, ""), (2, None, "en", "s", 1, ""), (3, "", None, None, 1, ""),
            (None, "Copyright x", None, "s", 1, ""), (4, "w " * 50000, "de", None, 1, ""), (5, "mail a@b.c", "de", "t", 1, "")]
    docs = spark.createDataFrame(rows, DOCS)
    mixed, name = mixing.mix(docs, {"source": 0.5, "lang": 0.5, "topic": 0.5}, topic_of=None)
    assert name == "Mixing_".lower() and mixed.columns == [*docs.columns, name]
    got = mixed.select("doc_id", f"{name}.*").collect()
    assert len(got) == len(rows) and all(r.probability is not None for r in got)
    assert {r.doc_id: r.topic for r in got} == {1: "prose", 2: "empty", 3: "empty", None: "legal", 4: "prose", 5: "contact"}
    assert len({(r.doc_id, r.selected) for r in got if r.doc_id == 1}) == 1
    assert mixing.mix(docs.limit(0), {"source": 0.5})[0].count() == 0
    none = mixing.mix(docs.where("doc_id in (2, 3)"), {"source": 0.5})[0]
    assert none.count() == 2


def test_missed_targets_are_reported_at_every_size(spark):
    own = pd.DataFrame([("a", "x", "t", 1000), ("b", "y", "t", 1000)], columns=[*mixing.MARGINS, "tokens"])
    targets = {"source": {"a": 0.55, "b": 0.45}, "lang": {"x": 0.45, "y": 0.55}}  # no table has both
    with pytest.warns(UserWarning, match="missed"):
        mixing.rake(own, targets, rounds=20)
    with pytest.warns(UserWarning, match="missed"):
        mixing.rake_frames(spark.createDataFrame(own), targets, rounds=2)


def test_scale_of_frames_is_exact(spark):
    dice = np.random.default_rng(5)
    for n, clip in ((300, 0.01), (5, 0.2), (1, 0.0)):
        ratio = np.repeat(dice.lognormal(0, 1, n), 2)
        raked = dice.random(2 * n)
        frame = spark.createDataFrame(pd.DataFrame({"weight": ratio, "raked": raked}))
        for ways in (4, 4096):
            assert mixing.scale_frames(frame, clip, ways) == pytest.approx(mixing.scale(ratio, raked, clip), rel=1e-12)


def test_documents_get_the_same_chances_at_every_size(spark):
    docs = table(spark, SF_SMALL, "documents")
    near, far = (mixing.mix(docs, {"source": 0.5}, max_cells=m)[0].select("doc_id", "mixing.*").orderBy("doc_id")
                 .toPandas() for m in (1000, 1))
    assert np.allclose(far["weight"], near["weight"], rtol=1e-8) and np.allclose(far["probability"], near["probability"], rtol=1e-8)
    assert (far["selected"] == near["selected"]).all()


def test_documents_weigh_by_their_ids(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(1, "\u4e2d\u6587\u6587\u672c" * 50, "zh", "s", 1, ""), (2, "a " + " " * 300 + "b", "en", "s", 1, ""),
            (3, None, "en", "s", 1, "")]
    docs = spark.createDataFrame(rows, DOCS)
    mixed, name = mixing.mix(docs, {"lang": 0.0}, tokenizer=path)
    assert mixed.columns == [*docs.columns, name]
    got = {r[0]: r[1] for r in mixed.select("doc_id", f"{name}.n_tokens").collect()}
    whole = Tokenizer.from_file(path)
    assert got == {i: len(whole.encode(t or "", add_special_tokens=False).ids) for i, t, *_ in rows}
    assert got[1] > 100 > got[2]


def test_counts_are_the_lengths_of_the_ids():
    import pyarrow as pa
    import public_tokenizers
    from sluice.llm.tokenout import TextEncoder
    encoder = TextEncoder(public_tokenizers.path("word_bpe_49k.json"), bound=50)
    texts = pa.array(["a b\tc", None, "", "don't stop 123", "ÄÖ 👍 中文", "word " * 3000, " ", "x<|y", "É" * 40] * 7 + ["tail end"])
    want = [len(ids) for ids in encoder.encode(texts)]
    assert encoder.counts(texts) == want and encoder.counts(texts, chunk_bytes=100) == want
    assert encoder.counts(pa.array([], pa.string())) == []
    plain = pa.array(["some words here", None, "and more words"])
    assert encoder.counts(plain, 1) == [len(ids) for ids in encoder.encode(plain)]


def test_every_usual_character_is_counted_as_the_tokenizer_does():
    import pyarrow as pa
    import public_tokenizers
    from sluice.llm.tokenout import TextEncoder
    encoder = TextEncoder(public_tokenizers.path("word_bpe_49k.json"), bound=50)
    usual = [chr(c) for c in [9, 10, 11, 12, 13, *range(32, 127), *range(0xa0, 0x180)]]
    texts = [f"{c} a{c} {c}b {c}{c}It's{c}12 d'{c}LLe'RE" for c in usual] + ["", " ", "\v x\f\x1cy\x85z ", None]
    want = [len(encoder.tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert encoder.counts(pa.array(texts)) == want and encoder.counts(pa.array(texts, pa.large_string()).slice(3)) == want[3:]
    none = pa.array([None, ""], pa.string())
    assert encoder.counts(none) == [0, 0] and encoder.counts(none.slice(2)) == []


def test_stretches_of_the_same_pieces_cost_no_call_each():
    import sys
    import pyarrow as pa
    import public_tokenizers
    from sluice.llm.tokenout import TextEncoder
    encoder = TextEncoder(public_tokenizers.path("word_bpe_49k.json"))
    words = [f"{w}{a}{v}{b}" for w in ("Some", "some", "OTHER", "wörd") for v in ("and", "Or", "é")
             for a in ",.;:!?-(" for b in ("", ".", ",", "...", "!", "?!", ")", "),")]
    texts, calls = pa.array([" ".join(words)] * 3), []
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event == "call" else None)
    try:
        got = encoder.counts(texts)
    finally:
        sys.setprofile(None)
    assert len(set(words)) == 768 and len(calls) < 500
    assert got == [len(encoder.tokenizer.encode(" ".join(words), add_special_tokens=False).ids)] * 3


def test_draws_against_an_independent_mix(spark):
    """Probability and selection recomputed from the result's own cells, without the module's raking or scaling."""
    docs = table(spark, SF_SMALL, "documents")
    targets = {"source": 0.5, "lang": 0.8, "topic": 0.7}
    rows = [r.asDict() for r in mixing.mix(docs, targets)[0].select("doc_id", "source", "lang", "text", "mixing.*").collect()]
    cells = {}
    for r in rows:
        cells[r["source"], r["lang"], r["topic"]] = cells.get((r["source"], r["lang"], r["topic"]), 0) + r["n_tokens"]
    total = sum(cells.values())
    weight = {k: v / total for k, v in cells.items()}
    for _ in range(400):
        for axis, power in enumerate(targets.values()):
            names = {k[axis] for k in cells}
            own = {n: sum(v for k, v in cells.items() if k[axis] == n) ** power for n in names}
            now = {n: sum(v for k, v in weight.items() if k[axis] == n) for n in names}
            weight = {k: v * own[k[axis]] / sum(own.values()) / now[k[axis]] for k, v in weight.items()}
    ratio = {k: weight[k] * total / cells[k] for k in cells}
    best = 0.0
    for c in sorted(1 / r for r in ratio.values()):
        if sum(weight[k] * (1 - 1 / (c * ratio[k])) for k in cells if c * ratio[k] > 1) <= 0.01 + 1e-12:
            best = c
    from pyspark.sql import functions as F
    from sluice.llm.common import unit_hash
    draw = {r[0]: r[1] for r in docs.select("doc_id", unit_hash(F.col("doc_id"), F.col("text"))).collect()}
    for r in rows:
        chance = min(1.0, best * ratio[r["source"], r["lang"], r["topic"]])
        assert r["probability"] == pytest.approx(chance, rel=1e-6) and r["selected"] == (draw[r["doc_id"]] < r["probability"])


def test_topics_are_found_as_the_patterns_say(spark):
    import re
    from pyspark.sql import functions as F
    texts = ["a LICENSE", "LiCeNcE", "wArranTies", "a@b", "@b", "+1", "1+", "|x|", "|\n|", "HTTP://x", "http://", "https://", "ſ", "", None, "plain"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(mixing.topic(F.col("t"))).collect()]
    rules = (("legal", r"(?i)licen[sc]e|copyright|warrant(y|ies)"), ("contact", r"[0-9A-Za-z]@[0-9A-Za-z]|\+[0-9]"),
             ("table", r"\|[^|\n]*\|"), ("web", r"https?://"))
    assert got == [next((n for n, p in rules if re.search(p, t, re.A)), "prose") if t else "empty" for t in texts]


def test_only_kept_columns_are_written(spark):
    docs = table(spark, SF_SMALL, "documents")
    mixed, name = mixing.mix(docs, {"source": 0.5}, keep=["doc_id"])
    assert mixed.columns == ["doc_id", name] and "text" not in mixed._jdf.queryExecution().executedPlan().toString()
