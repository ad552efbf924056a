"""Document quality: random-indexing word vectors, pooled, and a small two-layer network.

A term's index vector has a few signs at places given by its hash. Its word vector adds the index
vectors of the words around it over all documents. A document is the mean of its terms' vectors;
beside words, the way words are written (case, trailing marks, repetition) are terms too. The network
is trained in numpy and its probabilities are calibrated by a temperature.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import SAMPLE_ROWS, held_out, labelled_sample
from .shingles import chunks, released, slices, WordHashes, WordRows
from .store import opened, send, small_batches

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.5

WORD_TERMS, FORM_TERMS = 8192, 1024     # hashed vocabularies of words and of ways to write them
TERMS = WORD_TERMS + FORM_TERMS
REPEATED = WORD_TERMS                   # the form "same as the word before"
DIMENSIONS, SIGNS = 64, 4
NEIGHBOURS = (1, 2)
RANGE = 1024                            # terms whose vectors one row carries
HIDDEN, EPOCHS, RATE = 32, 40, 3e-3

_CORE = re.compile(r"[^\W_]+")


def _form(case: str, marks: str) -> int:
    return WORD_TERMS + 1 + xxhash.xxh3_64_intdigest(case + marks) % (FORM_TERMS - 1)


def describe(word: str) -> tuple[int, int]:
    """The word term and the form term of a word."""
    core, marks = word, ""
    if not word.isalpha():
        core = "".join(_CORE.findall(word))
        marks = _CORE.sub("", word)
    lower = core.lower()
    if lower == core:
        case = "l" if core else "-"
    else:
        case = "U" if len(core) > 1 and core.isupper() else "T"
    return xxhash.xxh3_64_intdigest(lower) % WORD_TERMS, _form(case, marks)


class TermIds:
    """Words as terms, remembered within a bound."""

    def __init__(self):
        self.read = WordHashes(lower=False).read
        self.rows = WordRows(describe, 2, np.int32)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of every term's index vector, from fixed random numbers."""
    rng = np.random.default_rng(1)
    places = np.stack([rng.permutation(DIMENSIONS)[:SIGNS] for _ in range(TERMS)])
    return places, rng.choice([-1, 1], (TERMS, SIGNS))


def dense_index() -> np.ndarray:
    places, signs = index_vectors()
    out = np.zeros((TERMS, DIMENSIONS), np.float32)
    np.put_along_axis(out, places, signs.astype(np.float32), axis=1)
    return out


def term_runs(texts: list[str | None], ids: TermIds) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word terms, form terms and owning text of every word; repetitions have their own form."""
    words = ids.read(texts)
    rows, own = ids.rows(words)
    owner = np.repeat(np.arange(len(texts)), words.counts)
    word, form = rows[own].astype(np.int64).T
    again = np.concatenate([[False], (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])])[: len(word)]
    return word, np.where(again, REPEATED, form), owner


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the index vectors around each term, over a task's texts."""
    places, signs = index_vectors()
    ids, sums = TermIds(), np.zeros(TERMS * DIMENSIONS)

    def add(term: np.ndarray, near: np.ndarray) -> None:
        for k in range(SIGNS):
            sums[:] += np.bincount(term * DIMENSIONS + places[near, k], signs[near, k], len(sums))

    for batch in slices(batches):
        texts = batch.column(0).to_pylist()
        for a, b in chunks(texts, 1 << 21):
            word, form, owner = term_runs(texts[a:b], ids)
            for step in NEIGHBOURS:
                same = np.flatnonzero(owner[step:] == owner[:-step])
                add(word[same], word[same + step])
                add(word[same + step], word[same])
            add(form, word)
    for r, part in enumerate(sums.reshape(-1, RANGE * DIMENSIONS)):
        if part.any():
            yield _range_row(r, part.astype(np.int64))


def _range_row(r: int, part: np.ndarray) -> pa.RecordBatch:
    small = part.astype(np.int32) if abs(part).max(initial=0) < 2**31 else part
    return pa.RecordBatch.from_arrays(
        [pa.array([r], pa.int32()), pa.array([small.itemsize], pa.int32()), pa.array([zlib.compress(small.tobytes(), 1)])],
        names=["range", "width", "sums"])


def _add_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for r, width, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
            part = np.frombuffer(zlib.decompress(data), np.int32 if width == 4 else np.int64)
            sums[r] = sums.get(r, 0) + part.astype(np.int64)
    for r, part in sums.items():
        yield _range_row(r, part)


def word_vectors(texts: DataFrame) -> np.ndarray:
    """Unit vectors of all terms: own index vector and context, over every row of ``texts``.

    The table has a fixed size (about 9,000 terms of 64 numbers), however many words there are.
    """
    ddl = "range int, width int, sums binary"
    partial = texts.select("text").mapInArrow(_contexts, ddl)
    context = np.zeros((TERMS // RANGE, RANGE * DIMENSIONS))
    for r in partial.repartition(len(context), "range").mapInArrow(_add_ranges, ddl).collect():
        context[r["range"]] = np.frombuffer(zlib.decompress(r["sums"]), np.int32 if r["width"] == 4 else np.int64)
    context = context.reshape(TERMS, DIMENSIONS)
    length = np.linalg.norm(context, axis=1, keepdims=True)
    common = context.sum(0) / max(np.linalg.norm(context.sum(0)), 1e-9)
    unit = context / np.maximum(length, 1e-9)
    unit -= np.outer(unit @ common, common)         # what all contexts share tells terms not apart
    return (dense_index() / np.sqrt(SIGNS) + 0.5 * unit).astype(np.float32)


def pooled(texts: list[str | None], vectors: np.ndarray, ids: TermIds) -> np.ndarray:
    """Per text the mean vectors of its words and of its forms, its length and its share of new words."""
    word, form, owner = term_runs(texts, ids)
    n = np.bincount(owner, minlength=len(texts))
    out = np.zeros((len(texts), 2 * DIMENSIONS + 2), np.float32)
    # Each text's distinct terms with their counts, then sums of their vectors.
    for first, term in ((0, word), (DIMENSIONS, form)):
        pair, count = np.unique(owner * TERMS + term, return_counts=True)
        text, term = np.divmod(pair, TERMS)
        starts = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]])[: len(text)])
        if len(starts):
            weighted = vectors[term] * count[:, None].astype(np.float32)
            out[text[starts], first: first + DIMENSIONS] = np.add.reduceat(weighted, starts, axis=0) / n[text[starts], None]
            if first == 0:
                out[:, -1] = np.bincount(text, minlength=len(texts)) / np.maximum(n, 1)
    out[:, -2] = np.log1p(n)
    return out


@dataclass
class QualityModel:
    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float = 1.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return (np.tanh((x - self.centre) / self.scale @ w1 + b1) @ w2 + b2)[:, 0]

    def scores(self, texts: list[str | None], ids: TermIds) -> np.ndarray:
        return _sigmoid(self.margin(pooled(texts, self.vectors, ids)) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, part: np.ndarray, vectors: np.ndarray) -> QualityModel:
    """Train on nine tenths by ``part``, choose the temperature on the rest (on all if it is small)."""
    size = x.shape[1]
    centre, scale = (x.mean(0), x.std(0) + 1e-3) if len(x) else (np.zeros(size), np.ones(size))
    rng = np.random.default_rng(0)
    share = (y.sum() + 0.5) / (len(y) + 1)
    layers = [rng.normal(0, size**-0.5, (size, HIDDEN)), np.zeros(HIDDEN), np.zeros((HIDDEN, 1)), np.array([np.log(share / (1 - share))])]
    model = QualityModel(vectors, centre, scale, layers)
    if len(y) == 0 or y.min() == y.max():
        return model
    held = part == 0
    if min(y[held].sum(), (1 - y[held]).sum()) < 20:
        held = np.zeros(len(y), bool)
    xs, ys = (x[~held] - centre) / scale, y[~held]
    first, second = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    step = 0
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(len(ys)), max(1, len(ys) // 128)):
            w1, b1, w2, b2 = layers
            h = np.tanh(xs[rows] @ w1 + b1)
            d = (_sigmoid((h @ w2 + b2)[:, 0]) - ys[rows])[:, None] / len(rows)
            back = d @ w2.T * (1 - h**2)
            grads = [xs[rows].T @ back + 1e-3 * w1, back.sum(0), h.T @ d + 1e-3 * w2, d.sum(0)]
            step += 1
            for w, g, m, v in zip(layers, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    rest = held if held.any() else np.ones(len(y), bool)
    margin = model.margin(x[rest])
    heats = np.geomspace(0.25, 8, 61)
    loss = [np.mean(np.logaddexp(0, np.where(y[rest] > 0, -margin, margin) / t)) for t in heats]
    model.temperature = float(heats[int(np.argmin(loss))])
    return model


def _pooled_rows(batches: Iterator[pa.RecordBatch], vectors) -> Iterator[pa.RecordBatch]:
    ids, vectors = TermIds(), opened(vectors)
    for batch in slices(batches):
        texts, label, part = (batch.column(i).to_pylist() for i in range(3))
        for a, b in chunks(texts):
            x = pooled(texts[a:b], vectors, ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(label[a:b], pa.int32()), pa.array(part[a:b], pa.int32()), pa.array([r.tobytes() for r in x])],
                names=["label", "part", "x"])


def train(texts: DataFrame, sample: DataFrame) -> QualityModel:
    """Word vectors from all ``texts``, the network from the labelled sample ``text, label, part``."""
    vectors = word_vectors(texts)
    sent = send(texts.sparkSession, vectors)
    rows = sample.select("text", "label", "part").mapInArrow(
        lambda it: released(_pooled_rows(it, sent)), "label int, part int, x binary").collect()
    rows.sort(key=lambda r: (r["part"], r["label"], bytes(r["x"])))
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows], np.float64).reshape(len(rows), 2 * DIMENSIONS + 2)
    return fit(x, np.array([r["label"] for r in rows], float), np.array([r["part"] for r in rows]), vectors)


def _score(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    ids, model = TermIds(), opened(model)
    for batch in slices(batches):
        texts = batch.column(1).to_pylist()
        score = [model.scores(texts[a:b], ids) for a, b in chunks(texts)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.concatenate(score) if score else [], pa.float64())], names=["id", "score"])


def quality(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Scores of all documents by a model learned from the labels outside the held-out fold.

    Returns ``id, held_out, score, predicted`` per row, repeated rows too. Null and empty texts are
    texts without words and get the network's score for those. A null id is scored, not held out and
    never learned from. Without labels of both classes the score is a constant of their share. Long texts
    are read whole, one at a time. Equal texts get equal scores. An empty table gives an empty result.
    Other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    sample = labelled_sample(docs, labels, label_col, FOLDS, HELD_OUT, id_col, text_col, sample_rows)
    sent = send(docs.sparkSession, train(rows, sample))
    scored = rows.mapInArrow(lambda it: released(_score(it, sent)), f"id {rows.schema['id'].dataType.simpleString()}, score double")
    return scored.select(
        "id", held_out(F.col("id"), FOLDS, HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
