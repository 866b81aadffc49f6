"""Language identification by a linear-chain conditional random field over words.

Every word (a run of letters, lower-cased) has affix, character n-gram and
lexicon features, hashed to a table of fixed size; learned transitions link
neighbouring words. Forward-backward gives each word's probability of every
language, also in code-switched text; a document's language is the one with
the largest share of these probabilities, and the share is the score. On
request the labelled words leave the operator too, as spans: longest runs of
words whose most probable language is the same, from the first word's start to
the last one's end in code points of the text (end exclusive), with the number
of words and their mean probability of that language.

Fitting: on a bounded sample of labelled rows, about ``docs_per_language``
whole documents of each language, chosen by a hash (the sample is a
documented parameter, and the model has a fixed size whatever the corpus).
Labels of documents stand for their words; training sequences join pieces of
two documents, so that transitions learn what a switch costs.

Prediction reads the text alone. Emission scores are computed once for each
distinct word (remembered up to a bound) and the chains of many documents run
side by side, longest first, as array steps.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
without a labelled row every text is ``und``; such texts have no spans; labels that are empty strings
are null labels; ties go to the language that sorts first; repeated rows are
predicted alike; all columns are kept, the result is one struct column with a
fresh name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import fresh_name, mix64, unit_hash, with_struct

UNKNOWN = "und"
FIELDS = "struct<lang_pred: string, score: double, n_words: bigint, shares: array<double>>"
SPANS = "array<struct<lang: string, start: bigint, end: bigint, n_words: bigint, score: double>>"
_WORD = re.compile(r"[^\W\d_]+")
_EDGE = 1  # stands before and after every word


@dataclass
class Model:
    """A fitted field: feature weights (buckets x languages) and transitions (from x to)."""

    langs: list[str]
    weights: np.ndarray
    transitions: np.ndarray


class Features:
    """Hashed features of words as one flat array; ``starts`` are the first feature of each word."""

    def __init__(self, words: list[str], buckets: int):
        text = "".join(f"\x01{w}\x01" for w in words)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
        first = np.cumsum(sizes) - sizes
        word = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(codes)) - first[word]
        size = sizes[word]
        found, owner = [], []

        def add(kind: int, hashed: np.ndarray, own: np.ndarray) -> None:
            found.append((mix64(hashed * np.uint64(31) + np.uint64(kind)) % np.uint64(buckets)).astype(np.int64))
            owner.append(own)

        # Character n-grams, the edges included; the first and last of each length are its affixes.
        gram = codes.copy()
        for n in range(2, 6):
            gram = gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1:]
            at = place[:len(gram)]
            inside = at + n <= size[:len(gram)]
            if n <= 3:
                add(10 + n, gram[inside], word[:len(gram)][inside])
            affix = inside & ((at == 0) | (at + n == size[:len(gram)]))
            add(20 + n, gram[affix], word[:len(gram)][affix])
        # The word itself.
        whole = np.add.reduceat(mix64(codes + (place.astype(np.uint64) << np.uint64(32))), first)
        add(30, whole, np.arange(len(words)))
        ids, own = np.concatenate(found), np.concatenate(owner)
        order = np.argsort(own, kind="stable")
        self.ids, self.owner = ids[order], own[order]
        self.starts = np.searchsorted(self.owner, np.arange(len(words)))

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.add.reduceat(weights[self.ids], self.starts, axis=0)


def words_in(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def words_at(text: str | None) -> tuple[list[str], np.ndarray]:
    """The words of ``words_in`` and their places in the text: starts and ends in code points, one row a word."""
    if not text:
        return [], np.empty((0, 2), np.int64)
    low = text.lower()
    found = list(_WORD.finditer(low))
    places = np.array([m.span() for m in found], np.int64).reshape(-1, 2)
    if len(low) != len(text):  # a few letters are two when lower-cased
        own = np.repeat(np.arange(len(text)), [len(c.lower()) for c in text])
        places = np.stack([own[places[:, 0]], own[places[:, 1] - 1] + 1], axis=1)
    return [m.group() for m in found], places


def has_letter(word: str) -> bool:
    return any(map(str.isalpha, word))


def marginals(emissions: np.ndarray, sizes: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward for many chains laid end to end.

    ``emissions`` are log scores (words x labels), ``sizes`` the chains' lengths (at least 1). Returns each word's
    label probabilities and the expected transition counts of all chains.
    """
    order = np.argsort(-sizes, kind="stable")
    first, longest = (np.cumsum(sizes) - sizes)[order], sizes[order]
    kinds = transitions.shape[0]
    move = np.exp(transitions - transitions.max()).astype(emissions.dtype)
    seen = np.exp(emissions - emissions.max(axis=1, keepdims=True))
    # The chains that still run at step t are the first active[t].
    active = np.searchsorted(-longest, -np.arange(1, longest[0] + 1), side="right")
    forward, backward = np.empty_like(seen), np.empty_like(seen)
    now = seen[first]
    now /= now.sum(axis=1, keepdims=True)
    forward[first] = now
    for t in range(1, longest[0]):
        at = first[:active[t]] + t
        now = (now[:active[t]] @ move) * seen[at]
        now /= now.sum(axis=1, keepdims=True)
        forward[at] = now
    back = np.ones((len(sizes), kinds), emissions.dtype)
    backward[first + longest - 1] = 1
    counts = np.zeros((kinds, kinds))
    for t in range(longest[0] - 2, -1, -1):
        n = active[t + 1]
        at = first[:n] + t
        ahead = seen[at + 1] * back[:n]
        pair = forward[at][:, :, None] * move * ahead[:, None, :]
        counts += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        fresh = ahead @ move.T
        fresh /= fresh.sum(axis=1, keepdims=True)
        back[:n] = fresh
        backward[at] = fresh
    both = forward * backward
    return both / both.sum(axis=1, keepdims=True), counts


def chances_of(emissions: np.ndarray, sizes: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Each word's label probabilities, by the same recursions without the transition counts."""
    order = np.argsort(-sizes, kind="stable")
    first, longest = (np.cumsum(sizes) - sizes)[order], sizes[order]
    move = np.exp(transitions - transitions.max()).astype(emissions.dtype)
    seen = np.exp(emissions - emissions.max(axis=1, keepdims=True))
    active = np.searchsorted(-longest, -np.arange(1, longest[0] + 1), side="right")
    forward = np.empty_like(seen)
    now = seen[first]
    now /= now.sum(axis=1, keepdims=True)
    forward[first] = now
    for t in range(1, longest[0]):
        at = first[:active[t]] + t
        now = (now[:active[t]] @ move) * seen[at]
        now /= now.sum(axis=1, keepdims=True)
        forward[at] = now
    back, turned = np.ones((len(sizes), move.shape[0]), emissions.dtype), move.T.copy()
    for t in range(longest[0] - 2, -1, -1):
        n = active[t + 1]
        at = first[:n] + t
        fresh = (seen[at + 1] * back[:n]) @ turned
        fresh /= fresh.sum(axis=1, keepdims=True)
        back[:n] = fresh
        forward[at] *= fresh  # from here on the product of both directions
    forward /= forward.sum(axis=1, keepdims=True)
    return forward


def shares_of(chances: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per chain the mean label probabilities."""
    return np.add.reduceat(chances.astype(np.float64), np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]


def spans_of(chances: np.ndarray, places: np.ndarray, langs: list[str]) -> list[dict]:
    """Longest runs of words of one most probable label in a chain, as the fields of ``SPANS``."""
    label = chances.argmax(axis=1)
    first = np.flatnonzero(np.diff(label, prepend=-1))
    last = np.append(first[1:], len(label)) - 1
    sums = np.add.reduceat(chances[np.arange(len(label)), label].astype(np.float64), first)
    return [{"lang": langs[label[i]], "start": int(places[i, 0]), "end": int(places[j, 1]), "n_words": int(j - i + 1),
             "score": min(1.0, float(total) / int(j - i + 1))} for i, j, total in zip(first, last, sums, strict=True)]


def fit(rows: list[tuple[str, str]], buckets: int = 1 << 17, piece: int = 50, epochs: int = 4, batch: int = 256,
        rate: float = 0.05, decay: float = 1e-4, seed: int = 7) -> Model:
    """Fit the field to (text, language) rows by Adam on the chains' conditional likelihood."""
    rows = sorted((lang, text) for text, lang in rows)
    langs = sorted({lang for lang, _ in rows})
    pieces = []
    numbers: dict[str, int] = {}
    for lang, text in rows:
        words = [numbers.setdefault(w, len(numbers)) for w in words_in(text) if has_letter(w)]
        pieces += [(langs.index(lang), np.array(words[i:i + piece])) for i in range(0, len(words), piece)]
    model = Model(langs, np.zeros((buckets, len(langs)), np.float32), np.zeros((len(langs), len(langs)), np.float32))
    if len(langs) < 2 or not pieces:
        return model
    vocabulary = list(numbers)
    dice = np.random.default_rng(seed)
    params = [model.weights, model.transitions]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for _ in range(epochs):
        mixed = [pieces[i] for i in dice.permutation(len(pieces))]
        chains = [mixed[i:i + 2] for i in range(0, len(mixed), 2)]
        for lo in range(0, len(chains), batch):
            some = chains[lo:lo + batch]
            words = np.concatenate([w for c in some for _, w in c])
            truth = np.concatenate([np.full(len(w), label) for c in some for label, w in c])
            sizes = np.array([sum(len(w) for _, w in c) for c in some])
            used, own = np.unique(words, return_inverse=True)
            features = Features([vocabulary[i] for i in used], buckets)
            emissions = features.scores(model.weights)[own].astype(np.float64)
            probability, moved = marginals(emissions, sizes, model.transitions.astype(np.float64))
            miss = probability
            miss[np.arange(len(truth)), truth] -= 1
            by_word = np.stack([np.bincount(own, miss[:, k], len(used)) for k in range(len(langs))], axis=1)
            slope = np.stack([np.bincount(features.ids, by_word[features.owner, k], buckets)
                              for k in range(len(langs))], axis=1)
            inside = np.ones(len(truth) - 1, bool)
            inside[np.cumsum(sizes)[:-1] - 1] = False
            real = np.zeros_like(moved)
            np.add.at(real, (truth[:-1][inside], truth[1:][inside]), 1)
            step += 1
            for p, g, (m, v) in zip(params, (slope, moved - real), moments, strict=True):
                g = (g / len(truth) + decay * p).astype(np.float32)
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return model


class Tagger:
    """Predicts whole texts; remembers the emission scores of up to ``bound`` words and lays out chains of about
    ``chain_words`` words at a time. By default both fall with the number of labels, so that memory does not grow with it.
    """

    def __init__(self, model: Model, bound: int | None = None, chain_words: int | None = None):
        labels = max(1, len(model.langs))
        self.model = model
        self.bound = bound or min(250_000, max(10_000, 4_000_000 // labels))
        self.chain_words = chain_words or min(600_000, max(10_000, 2_400_000 // labels))
        self.rows: dict[str, int] = {}
        self.table = np.empty((0, len(model.langs)), np.float32)
        self.used = 0

    def _rows(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Rows of ``table`` that hold the words' scores; -1 for what is no word."""
        new = list(dict.fromkeys(w for t in texts for w in set(t) if w not in self.rows))
        if len(self.rows) + len(new) > self.bound:
            self.rows, self.used = {}, 0
            new = list(dict.fromkeys(w for t in texts for w in set(t)))
        lettered = [w for w in new if w.isalpha() or has_letter(w)]
        self.rows.update(dict.fromkeys(new, -1))  # words without a letter are no words
        for lo in range(0, len(lettered), 50_000):
            part = lettered[lo:lo + 50_000]
            scores = Features(part, len(self.model.weights)).scores(self.model.weights)
            need = self.used + len(part)
            if need > len(self.table):
                self.table = np.concatenate([self.table[:self.used], np.empty((max(need, 2 * self.used) - self.used,
                                                                               scores.shape[1]), np.float32)])
            self.table[self.used:need] = scores
            self.rows.update(zip(part, range(self.used, need), strict=True))
            self.used = need
        return [np.fromiter(map(self.rows.__getitem__, t), np.int64, len(t)) for t in texts]

    def predict(self, texts: list[str | None], spans: bool = False) -> list[tuple]:
        """(language, score, words, shares), and with ``spans`` the spans, of every text."""
        out: list = []
        held: list[np.ndarray] = []
        places: list[np.ndarray] = []
        waiting = 0
        for lo in range(0, len(texts), 128):
            some = texts[lo:lo + 128]
            if spans:
                found = [words_at(t) for t in some]
                rows = self._rows([words for words, _ in found])
                places += [at[r >= 0] for (_, at), r in zip(found, rows, strict=True)]
            else:
                rows = self._rows([words_in(t) for t in some])
            numbers = [r[r >= 0] for r in rows]
            # The scores are taken now: the memory of words may be cleared later.
            held += [self.table[n] for n in numbers]
            waiting += sum(map(len, numbers))
            if waiting >= self.chain_words:
                out += self._chains(held, places if spans else None)
                held, places, waiting = [], [], 0
        return out + self._chains(held, places if spans else None)

    def _chains(self, held: list[np.ndarray], places: list[np.ndarray] | None) -> list[tuple]:
        langs = self.model.langs
        sizes = np.array([len(h) for h in held], np.int64)
        some = np.flatnonzero(sizes) if langs else np.array([], np.int64)
        none = () if places is None else ([],)
        out = [(UNKNOWN, 0.0, int(n), [], *none) for n in sizes]
        if len(some):
            chances = chances_of(np.concatenate([held[i] for i in some]), sizes[some],
                                 self.model.transitions.astype(np.float32))
            end = np.cumsum(sizes[some])
            for i, share, stop in zip(some.tolist(), shares_of(chances, sizes[some]), end.tolist(), strict=True):
                best = int(np.argmax(share))
                own = () if places is None else (spans_of(chances[stop - sizes[i]:stop], places[i], langs),)
                out[i] = (langs[best], min(1.0, float(share[best])), int(sizes[i]), share.tolist(), *own)
        return out


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, docs_per_language: int = 150, max_langs: int = 256) -> Model:
    """Fit on a bounded sample of the labelled rows of ``docs`` (doc_id, text, lang).

    Each language gives about ``docs_per_language`` documents, however many rows it has: a row is taken if its hash,
    scaled by the language's rows, falls below that number. Every label is fitted. The model's size grows with the
    labels, so more than ``max_langs`` of them are an error; none is left out.
    """
    rows = (docs.where((F.length("lang") > 0) & F.col("text").rlike(r"\p{L}"))
            .select("doc_id", "text", F.col("lang").alias("label")))
    counts = (docs.where(F.length("lang") > 0).groupBy(F.col("lang").alias("label")).count()
              .orderBy(F.col("count").desc(), "label").limit(max_langs + 1).collect())
    if len(counts) > max_langs:
        raise ValueError(f"more than {max_langs} labels in lang; raise max_langs (and the driver's memory) to fit them all")
    if not counts:
        return Model([], np.zeros((1, 0), np.float32), np.zeros((0, 0), np.float32))
    weight = F.create_map(*[F.lit(x) for r in counts for x in (r["label"], float(r["count"]))])
    taken = rows.withColumn("u", unit_hash(F.col("doc_id"), F.col("text")) * F.try_element_at(weight, F.col("label")))
    taken = (taken.where(F.col("u") < float(docs_per_language)).select("label", "u", "text").dropDuplicates()
             .orderBy("u", "label", "text").limit(2 * docs_per_language * len(counts)))
    return fit([(r["text"], r["label"]) for r in taken.collect()])


def identify(docs: DataFrame, model: Model, into: str = "language", keep: list[str] | None = None,
             spans: bool = False) -> tuple[DataFrame, str]:
    """``docs`` with a struct column (lang_pred, score, n_words, shares in the order of ``model.langs``), and in it, with
    ``spans``, the labelled runs of words (``SPANS``)."""
    into = fresh_name(docs.columns, into)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: buckets x languages
    fields = f"{FIELDS[:-1]}, spans: {SPANS}>" if spans else FIELDS
    run = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("n_words", pa.int64()),
                              ("score", pa.float64())]))
    kinds = [pa.string(), pa.float64(), pa.int64(), pa.list_(pa.float64())] + [run] * spans

    def make():
        tagger = Tagger(shared.value)

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            columns = zip(*tagger.predict(batch.column("text").to_pylist(), spans), strict=True)
            return [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
        return compute

    return with_struct(docs, into, fields, make, keep=keep), into
