"""Toxicity of documents: boosted trees over dense features, calibrated by isotonic regression.

The lexicon starts from a few plain insults and is extended by words and word stems that are far more
frequent in toxic than in other documents of the labelled sample. Features are densities of lexicon
words, their nearness to words of second person, capitals, punctuation and obfuscated spellings.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Boosted, boost, calibrated, isotonic
from .labelled import SAMPLE_ROWS, held_out, labelled_sample
from .shingles import chunks, released, slices, WordHashes, WordRows
from .store import opened, send, small_batches

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.5

# Plain insults, words of second person, and look-alike characters.
INSULTS = frozenset(
    "idiot idiots moron morons stupid scum trash loser losers clown pathetic worthless disgusting dumb imbecile"
    " jerk bastard shit fuck fucking bitch asshole".split())
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos usted ustedes ti tus".split())
LOOK_ALIKE = str.maketrans("013457@$!|", "oieastasii")

STEMS = (4, 5, 6)
LEXICON_SIZE = 2_000
STRONG = 2.0                # log odds from which a lexicon entry counts as a hit
NEAR = 3                    # words between a hit and a word of second person
COUNTED_TERMS = 50_000     # terms a task counts before it passes them on

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[\W_]+")


def plain(word: str) -> str:
    """A word without outer punctuation, in lower case."""
    return _EDGES.sub("", word).lower()


def revealed(word: str) -> str:
    """A word with look-alike characters and inner punctuation undone: ``1d.i0t`` is ``idiot``."""
    return _INNER.sub("", word.lower().translate(LOOK_ALIKE))


def terms(word: str) -> set[str]:
    """The word and its stems, marked by a star."""
    return {word} | {word[:k] + "*" for k in STEMS if len(word) > k}


# Columns of a word's features, summed per document.
WORD, HIT, WEIGHT, SECOND, CAPS, UPPER, LETTERS, EXCLAIM, OTHER_PUNCT, OBFUSCATED, HIDDEN = range(11)
N_WORD_FEATURES = 11
N_FEATURES = 15


class Lexicon:
    """What the features of a text need to know of its words."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.read = WordHashes(lower=False).read
        self.rows = WordRows(self.describe, N_WORD_FEATURES, np.float32)

    def weight(self, word: str) -> float:
        return max((self.weights.get(t, 0.0) for t in terms(word)), default=0.0) if word else 0.0

    def describe(self, word: str) -> list[float]:
        out, core = [0.0] * N_WORD_FEATURES, plain(word)
        out[WORD] = 1
        if word.isascii() and word.isalpha():
            out[LETTERS] = len(word)
            out[UPPER] = 0 if word.islower() else sum(c.isupper() for c in word)
        else:
            out[LETTERS] = sum(c.isalpha() for c in word)
            out[UPPER] = sum(c.isupper() for c in word)
            out[EXCLAIM] = word.count("!") + word.count("?")
            out[OTHER_PUNCT] = len(word) - out[LETTERS] - out[EXCLAIM] - sum(c.isdigit() for c in word)
            out[OBFUSCATED] = bool(core) and not core.isalpha() and any(c.isalpha() for c in core)
        out[CAPS] = out[LETTERS] >= 2 and out[UPPER] == out[LETTERS]
        weight = self.weight(core)
        if weight < STRONG and out[OBFUSCATED]:
            weight = self.weight(revealed(core))
            out[HIDDEN] = weight >= STRONG
        out[HIT], out[WEIGHT] = weight >= STRONG, weight
        out[SECOND] = core in SECOND_PERSON
        return out


def features(texts: list[str | None], lexicon: Lexicon) -> np.ndarray:
    """One row of ``N_FEATURES`` per text; null and empty texts are zeros."""
    words = lexicon.read(texts)
    rows, own = lexicon.rows(words)
    n = words.counts
    owner = np.repeat(np.arange(len(texts)), n)
    sums = np.stack([np.bincount(owner, rows[:, k][own], len(texts)) for k in range(N_WORD_FEATURES)], axis=1)
    ends = np.cumsum(n)
    top = np.zeros(len(texts))
    some = np.flatnonzero(n)
    if len(some):
        top[some] = np.maximum.reduceat(rows[:, WEIGHT][own], (ends - n)[some])
    # Hits with a word of second person nearby, inside the same text.
    second = np.concatenate([[0], np.cumsum(rows[:, SECOND][own])])
    at = np.flatnonzero(rows[:, HIT][own])
    first, last = np.maximum(at - NEAR, (ends - n)[owner[at]]), np.minimum(at + NEAR + 1, ends[owner[at]])
    near = np.bincount(owner[at], second[last] > second[first], len(texts))
    words_, letters, hits = np.maximum(sums[:, WORD], 1), np.maximum(sums[:, LETTERS], 1), sums[:, HIT]
    return np.stack([
        np.log1p(sums[:, WORD]), hits / words_, np.log1p(hits), sums[:, WEIGHT] / words_, top, sums[:, SECOND] / words_,
        near / words_, near / np.maximum(hits, 1), sums[:, CAPS] / words_, sums[:, UPPER] / letters, sums[:, EXCLAIM] / words_,
        sums[:, OTHER_PUNCT] / words_, sums[:, OBFUSCATED] / words_, np.log1p(sums[:, HIDDEN]), sums[:, LETTERS] / words_], axis=1)


def _count_terms(batches: Iterator[pa.RecordBatch], wanted: frozenset[str] | None) -> Iterator[pa.RecordBatch]:
    """In how many texts each term occurs, summed per task within a bound."""
    counts: Counter[str] = Counter()

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([*counts]), pa.array([*counts.values()], pa.int64())], names=["term", "n"])

    for batch in slices(batches):
        for text in batch.column(0).to_pylist():
            found: set[str] = set()
            for word in {plain(w) for w in set((text or "").split())} - {""}:
                found |= terms(word)
            counts.update(found if wanted is None else found & wanted)
            if len(counts) > COUNTED_TERMS:
                yield rows()
                counts.clear()
    if counts:
        yield rows()


def _term_counts(texts: DataFrame, wanted: frozenset[str] | None) -> DataFrame:
    counted = texts.select("text").mapInArrow(lambda it: released(_count_terms(it, wanted)), "term string, n bigint")
    return counted.groupBy("term").agg(F.sum("n").alias("n"))


def learn_lexicon(sample: DataFrame, size: int = LEXICON_SIZE) -> dict[str, float]:
    """term -> log odds of toxic against other documents, the ``size`` best, beside the plain insults."""
    n = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, other = n.get(1, 0), sum(v for k, v in n.items() if k != 1)
    lexicon = dict.fromkeys(INSULTS, 2 * STRONG)
    if not toxic or not other:
        return lexicon
    least = max(3, toxic // 200)
    frequent = (
        _term_counts(sample.filter("label = 1"), None).filter(F.col("n") >= least)
        .orderBy(F.desc("n"), "term").limit(20 * size).collect())
    seen = {r["term"]: r["n"] for r in frequent}
    wanted = frozenset(seen)
    elsewhere = {r["term"]: r["n"] for r in _term_counts(sample.filter("label <> 1"), wanted).collect()}
    odds = {t: float(np.log((c + 0.5) / (toxic + 1)) - np.log((elsewhere.get(t, 0) + 0.5) / (other + 1))) for t, c in seen.items()}
    best = sorted((t for t in odds if odds[t] >= STRONG / 2), key=lambda t: (-odds[t], t))[:size]
    return lexicon | {t: odds[t] for t in best}


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    trees: Boosted
    curve: tuple[np.ndarray, np.ndarray]

    def scores(self, texts: list[str | None], words: Lexicon) -> np.ndarray:
        return calibrated(self.trees.margin(features(texts, words)), self.curve)


def _feature_rows(batches: Iterator[pa.RecordBatch], lexicon: dict[str, float]) -> Iterator[pa.RecordBatch]:
    words = Lexicon(lexicon)
    for batch in slices(batches):
        texts, label, part = (batch.column(i).to_pylist() for i in range(3))
        for a, b in chunks(texts):
            yield pa.RecordBatch.from_arrays(
                [pa.array(label[a:b], pa.int32()), pa.array(part[a:b], pa.int32()),
                 pa.array(features(texts[a:b], words).tolist(), pa.list_(pa.float64()))], names=["label", "part", "x"])


def train(sample: DataFrame) -> ToxicityModel:
    """A model from ``text, label, part``: trees on nine tenths by ``part``, the curve on the tenth left.

    With too few cases for that the curve uses all of them. An empty sample gives a constant of one half.
    """
    lexicon = learn_lexicon(sample.filter("part > 0"))      # the curve sees scores of texts that taught nothing
    rows = sample.select("text", "label", "part").mapInArrow(
        lambda it: released(_feature_rows(it, lexicon)), "label int, part int, x array<double>").collect()
    rows.sort(key=lambda r: (r["part"], r["label"], r["x"]))
    x = np.array([r["x"] for r in rows], np.float64).reshape(len(rows), N_FEATURES)
    y, part = np.array([r["label"] for r in rows], float), np.array([r["part"] for r in rows])
    fit = part > 0
    if min(y[~fit].sum(), (1 - y[~fit]).sum()) < 20:
        fit = np.ones(len(y), bool)
    trees = boost(x[fit], y[fit])
    rest = ~fit if (~fit).any() else fit
    return ToxicityModel(lexicon, trees, isotonic(trees.margin(x[rest]), y[rest]))


def _score(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    model = opened(model)
    words = Lexicon(model.lexicon)
    for batch in slices(batches):
        texts = batch.column(batch.num_columns - 1).to_pylist()
        score = np.concatenate([model.scores(texts[a:b], words) for a, b in chunks(texts)]) if texts else np.zeros(0)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], names=["id", "score"])


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` per row of ``docs``; null and empty texts are scored as texts without words."""
    sent = send(docs.sparkSession, model)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(lambda it: released(_score(it, sent)), f"id {rows.schema['id'].dataType.simpleString()}, score double")


def toxicity(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Scores of all documents by a model learned from the labels outside the held-out fold.

    Returns ``id, held_out, score, predicted`` per row, repeated rows too. A null id is scored, not
    held out and never learned from. Without labels of both classes the score is a constant of their
    share. Null and empty texts are texts without words. Long texts are read whole, one at a time; equal
    texts get equal scores. An empty table gives an empty result. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    model = train(labelled_sample(docs, labels, label_col, FOLDS, HELD_OUT, id_col, text_col, sample_rows))
    return score(docs, model, id_col, text_col).select(
        "id", held_out(F.col("id"), FOLDS, HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those predicted toxic, all columns as they were.

    Rows are judged by their texts alone, repeated rows and null ids too; null and empty texts are texts
    without words. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    model = train(labelled_sample(docs, labels, "toxic", FOLDS, HELD_OUT, id_col, text_col))
    sent = send(docs.sparkSession, model)
    place = docs.columns.index(text_col)
    return docs.mapInArrow(lambda it: released(_clean(it, sent, place)), docs.schema)


def _clean(batches: Iterator[pa.RecordBatch], model, place: int) -> Iterator[pa.RecordBatch]:
    model = opened(model)
    words = Lexicon(model.lexicon)
    for batch in slices(batches):
        texts = batch.column(place).to_pylist()
        for a, b in chunks(texts):
            keep = model.scores(texts[a:b], words) < THRESHOLD
            yield batch.slice(a, b - a).filter(pa.array(keep))
