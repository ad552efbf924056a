"""A small causal self-attention model over subword ids, in numpy.

One attention layer reads a window of ids and predicts the class of the next id; inside a class, ids
follow their frequency in the corpus. Classes are kinds of subwords that stand in like company, apart
for those that begin a word and those that go on in one, so the chance that a word ends here is known.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

WINDOW, CONTEXT = 16, 4             # ids a window holds; of them, ids it only reads
SCORED = WINDOW - CONTEXT
WIDTH, KEY = 16, 8
WORD_CLASSES, INNER_CLASSES = 40, 23
CLASSES = 1 + WORD_CLASSES + INNER_CLASSES      # class 0 is the end of a text
BATCH = 256
EPOCHS, RATE = 3, 0.01
BUCKETS = 64                        # of neighbours, on each of the places beside an id
BESIDE = (-2, -1, 1, 2)


def windows(ids: np.ndarray, sizes: np.ndarray, end: int, pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows over texts laid end to end.

    ``ids`` are the texts' ids without ends, ``sizes`` how many each has. Every text is read from an
    end on, and predicts its ids and a closing end. Returns the windows, the ids they predict
    (``pad`` where there is none) and, in the order of texts, the places of all predictions in them.
    """
    steps = sizes + 1
    count = -(-steps // SCORED)
    room = CONTEXT + count * SCORED + 1
    first = np.concatenate([[0], np.cumsum(room)])[:-1]
    line = np.full(int(room.sum()), pad, np.int64)
    line[first + CONTEXT] = end
    owner = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    line[first[owner] + CONTEXT + 1 + within] = ids
    target = line.copy()
    target[first + CONTEXT + 1 + sizes] = end
    own = np.repeat(np.arange(len(sizes)), count)
    start = first[own] + SCORED * (np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count))
    read = line[start[:, None] + np.arange(WINDOW)]
    predict = target[start[:, None] + CONTEXT + 1 + np.arange(SCORED)]
    used = np.flatnonzero((np.arange(SCORED) + SCORED * (np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count))[:, None] < steps[own][:, None]).ravel())
    return read, predict, used


def _causal() -> np.ndarray:
    """Distance from each scored place to the places it may read, or WINDOW where it may not."""
    query, key = np.arange(CONTEXT, WINDOW)[:, None], np.arange(WINDOW)[None, :]
    return np.where(key <= query, query - key, WINDOW)


@dataclass
class Attention:
    """Parameters by name; ``classes`` and ``inside`` (log10 share in its class) by id; the last id pads."""

    p: dict[str, np.ndarray]
    classes: np.ndarray
    inside: np.ndarray
    pad: int


def initial(vocabulary: int, classes: np.ndarray, seed: int = 0) -> Attention:
    """An untrained model for ids below ``vocabulary``; that number itself pads."""
    rng = np.random.default_rng(seed)
    p = {
        "e": rng.normal(0, 0.3, (vocabulary + 1, WIDTH)), "q": rng.normal(0, 0.3, (WIDTH, KEY)), "k": rng.normal(0, 0.3, (WIDTH, KEY)),
        "v": rng.normal(0, 0.3, (WIDTH, WIDTH)), "near": np.zeros(WINDOW), "o": rng.normal(0, 0.2, (2 * WIDTH, CLASSES)), "b": np.zeros(CLASSES)}
    return Attention({k: v.astype(np.float32) for k, v in p.items()}, classes, np.zeros(vocabulary + 1, np.float32), vocabulary)


class Training:
    """Adam on the loss of the next id's class, changing a model's parameters in place.

    All parameters but those of ids are views of one row of numbers, which a step changes at once.
    """

    def __init__(self, model: Attention):
        self.model, self.far, self.steps, self.predicted = model, _causal(), 0, 0
        self.names, ends = [k for k in model.p if k != "e"], [0]
        for k in self.names:
            ends.append(ends[-1] + model.p[k].size)
        self.own = {k: slice(a, b) for k, a, b in zip(self.names, ends, ends[1:])}
        self.others = np.empty(ends[-1], np.float32)
        for k, at in self.own.items():
            shape, self.others[at] = model.p[k].shape, model.p[k].ravel()
            model.p[k] = self.others[at].reshape(shape)
        self.first, self.second = np.zeros_like(self.others), np.zeros_like(self.others)
        self.first_e, self.second_e = np.zeros_like(model.p["e"]), np.zeros_like(model.p["e"])

    def step(self, ids: np.ndarray, aim: np.ndarray, rate: float) -> None:
        model, p, n = self.model, self.model.p, len(ids)
        line = ids.ravel()
        x = p["e"].take(line, axis=0)
        own = x.reshape(n, WINDOW, WIDTH)[:, CONTEXT:].reshape(-1, WIDTH)
        asks = p["q"] / np.float32(KEY**0.5)
        q = (own @ asks).reshape(n, SCORED, KEY)
        k, v = (x @ p["k"]).reshape(n, WINDOW, KEY), (x @ p["v"]).reshape(n, WINDOW, WIDTH)
        a = q @ k.transpose(0, 2, 1)
        a += np.where(self.far < WINDOW, p["near"][np.minimum(self.far, WINDOW - 1)], np.float32(-1e4))
        padding = ids == model.pad
        padded = np.flatnonzero(padding.any(1))
        if len(padded):
            a[padded] += np.where(padding[padded], np.float32(-1e4), np.float32(0))[:, None, :]
        a = _exp(a)
        a /= a.sum(-1, keepdims=True)
        h = np.concatenate([(a @ v).reshape(-1, WIDTH), own], axis=1)
        d = h @ p["o"]
        d += p["b"]
        d = _exp(d)

        aims = aim.ravel()
        weight = (aims != model.pad).astype(np.float32)
        predicted = int(np.count_nonzero(weight))
        weight /= max(predicted, 1)
        d *= (weight / np.maximum(d @ np.ones(CLASSES, np.float32), np.float32(1e-30)))[:, None]
        d.ravel()[np.arange(0, d.size, CLASSES) + model.classes.take(aims)] -= weight
        dh = d @ p["o"].T
        da_v = np.ascontiguousarray(dh[:, :WIDTH])
        ds = da_v.reshape(n, SCORED, WIDTH) @ v.transpose(0, 2, 1)
        ds -= np.einsum("ij,ij->i", da_v, h[:, :WIDTH]).reshape(n, SCORED, 1)
        ds *= a
        dv = (a.transpose(0, 2, 1) @ da_v.reshape(n, SCORED, WIDTH)).reshape(-1, WIDTH)
        dk = (ds.transpose(0, 2, 1) @ q).reshape(-1, KEY)
        dq = (ds @ k).reshape(-1, KEY)
        grads = {
            "o": (d.T @ h).T, "b": np.ones(len(d), np.float32) @ d, "q": own.T @ dq / np.float32(KEY**0.5), "k": x.T @ dk, "v": x.T @ dv,
            "near": np.bincount(self.far.ravel(), ds.sum(0).ravel(), WINDOW + 1)[:WINDOW]}
        dx = dk @ p["k"].T
        dx += dv @ p["v"].T
        dx.reshape(n, WINDOW, WIDTH)[:, CONTEXT:] += (dq @ asks.T + dh[:, WIDTH:]).reshape(n, SCORED, WIDTH)
        # Numbers of two bytes are sorted by radix.
        line = line.astype(np.uint16) if model.pad < 1 << 16 else line
        order = np.argsort(line, kind="stable")
        sorted_ids = line[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_ids[1:] != sorted_ids[:-1]]))
        used, de = sorted_ids[first], np.add.reduceat(dx.take(order, axis=0), first, axis=0)
        self.steps += 1
        self.predicted += predicted
        rate = rate * (1 - 0.999**self.steps) ** 0.5 / (1 - 0.9**self.steps)
        _adam(self.others, np.concatenate([grads[k].ravel() for k in self.names]).astype(np.float32), self.first, self.second, rate)
        e, m, s = (t.take(used, axis=0) for t in (p["e"], self.first_e, self.second_e))
        _adam(e, de, m, s, rate)
        p["e"][used], self.first_e[used], self.second_e[used] = e, m, s


def _exp(z: np.ndarray) -> np.ndarray:
    """e to the power of ``z``, in place; a bound keeps sums finite."""
    if z.size and z.max() > 60:
        np.minimum(z, 60, out=z)
    return np.exp(z, out=z)


def batches(read: np.ndarray, predict: np.ndarray, rng: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All windows in random batches."""
    order = rng.permutation(len(read))
    for start in range(0, len(order), BATCH):
        rows = order[start: start + BATCH]
        yield read[rows], predict[rows]


def train(model: Attention, read: np.ndarray, predict: np.ndarray, seed: int = 0) -> None:
    """All epochs over windows in memory."""
    rng, run = np.random.default_rng(seed), Training(model)
    total = EPOCHS * -(-len(read) // BATCH)
    for _ in range(EPOCHS):
        for ids, aim in batches(read, predict, rng):
            run.step(ids, aim, RATE * (1 - (run.steps + 1) / (total + 1)))


def to_rows(p: dict[str, np.ndarray]) -> np.ndarray:
    """All parameters as rows of WIDTH numbers: those of ids first, in their order."""
    return np.concatenate([p["e"], *(p[k].reshape(-1, WIDTH) for k in sorted(p) if k != "e")])


def from_rows(rows: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in ["e", *sorted(k for k in like if k != "e")]:
        n = like[k].size // WIDTH
        out[k] = rows[at: at + n].reshape(like[k].shape).astype(np.float32)
        at += n
    return out


def _adam(w: np.ndarray, g: np.ndarray, m: np.ndarray, v: np.ndarray, rate: float) -> None:
    m += 0.1 * (g - m)
    v += 0.001 * (g * g - v)
    w -= rate * m / (np.sqrt(v) + 1e-8)


class Scorer:
    """A trained model with its projections worked out per id.

    Keys have one place more, which keeps the padding from being read; values have one more, which
    sums the attention they get.
    """

    def __init__(self, model: Attention):
        p = model.p
        self.model, self.pad = model, model.pad
        e = p["e"]
        one = np.ones((len(e), 1), np.float32)
        blocked = np.zeros((len(e), 1), np.float32)
        blocked[self.pad] = -1e4
        self.query = np.concatenate([e @ p["q"] / np.float32(KEY**0.5), one], axis=1).astype(np.float32)
        self.key = np.concatenate([e @ p["k"], blocked], axis=1).astype(np.float32)
        self.value = np.concatenate([e @ p["v"], one], axis=1).astype(np.float32)
        far = _causal()
        self.bias = np.where(far < WINDOW, p["near"][np.minimum(far, WINDOW - 1)], -1e4).astype(np.float32)
        self.out = np.concatenate([p["o"], p["b"][None, :]])      # what is read has a 1 at its end
        self.sums = np.zeros((CLASSES, 2), np.float32)
        self.sums[:, 0] = 1
        self.sums[: 1 + WORD_CLASSES, 1] = 1

    def __reduce__(self):
        return Scorer, (self.model,)        # what is worked out from it need not travel

    def __call__(self, read: np.ndarray, predict: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of the chance of each predicted id, and of the chance that no word goes on there."""
        own, total = np.empty(predict.size, np.float32), np.empty((predict.size, 2), np.float32)
        e, classes = self.model.p["e"], self.model.classes
        h = np.ones((BATCH * SCORED, 2 * WIDTH + 1), np.float32)
        for start in range(0, len(read), BATCH):
            ids, aim = read[start: start + BATCH], predict[start: start + BATCH].ravel()
            asked = ids[:, CONTEXT:].ravel()
            n, part = len(ids), h[: len(asked)]
            query = self.query.take(asked, axis=0).reshape(n, SCORED, -1)
            line = ids.ravel()
            scores = query @ self.key.take(line, axis=0).reshape(n, WINDOW, -1).transpose(0, 2, 1)
            scores += self.bias
            heard = (_exp(scores) @ self.value.take(line, axis=0).reshape(n, WINDOW, -1)).reshape(len(asked), -1)
            np.divide(heard[:, :WIDTH], heard[:, WIDTH:], out=part[:, :WIDTH])
            part[:, WIDTH: 2 * WIDTH] = e.take(asked, axis=0)
            z = _exp(part @ self.out)
            rows = slice(start * SCORED, start * SCORED + len(aim))
            own[rows] = z[np.arange(len(z)), classes[aim]]
            total[rows] = z @ self.sums
        with np.errstate(divide="ignore"):
            whole = np.log10(total[:, 0])
            chance = np.log10(own) - whole + self.model.inside[predict.ravel()]
            border = np.log10(total[:, 1]) - whole
        return np.maximum(chance, -300).reshape(predict.shape), np.maximum(border, -30).reshape(predict.shape)


def neighbour_places(vocabulary: int, seed: int = 0) -> np.ndarray:
    """The bucket of every id as a neighbour."""
    return np.random.default_rng(seed).integers(0, BUCKETS, vocabulary)


class Neighbours:
    """Counts of ids and of the hashed ids beside them, over texts that are read from an end to an end."""

    def __init__(self, vocabulary: int, end: int):
        self.end, self.place = end, neighbour_places(vocabulary)
        self.row = np.full(vocabulary, -1)      # ids met have a row each
        self.met = np.zeros(0, np.int64)
        self.n = np.zeros((0, 1 + len(BESIDE) * BUCKETS), np.int64)
        self.waiting, self.amount = [], 0       # cells not counted yet: each count passes over the whole table

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        """``sizes`` tells how many of the ``ids`` each text has."""
        owner = np.repeat(np.arange(len(sizes)), sizes + 2)
        line = np.full(len(owner), self.end, np.int64)
        line[np.arange(len(ids)) + 2 * np.repeat(np.arange(len(sizes)), sizes) + 1] = ids
        new = np.unique(line[self.row[line] < 0])
        self.row[new] = np.arange(len(self.met), len(self.met) + len(new))
        self.met = np.concatenate([self.met, new])
        if len(self.met) > len(self.n):
            more = max(len(self.met), 2 * len(self.n)) - len(self.n)
            self.n = np.concatenate([self.n, np.zeros((more, self.n.shape[1]), np.int64)])
        rows, beside, width = self.row[line], self.place[line], self.n.shape[1]
        cells = [rows * width]
        for k, step in enumerate(BESIDE):
            own, other = (slice(-step, None), slice(None, step)) if step < 0 else (slice(None, -step), slice(step, None))
            together = owner[own] == owner[other]
            cells.append((rows[own] * width + 1 + k * BUCKETS + beside[other])[together])
        self.waiting += cells
        self.amount += sum(map(len, cells))
        if self.amount > max(1_000_000, self.n.size // 4):
            self._count()

    def _count(self) -> None:
        if self.waiting:
            self.n += np.bincount(np.concatenate(self.waiting), minlength=self.n.size).reshape(self.n.shape)
            self.waiting, self.amount = [], 0

    def cells(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbered cells that are not 0, and their counts; a cell is ``id * width`` and on."""
        self._count()
        rows, columns = np.nonzero(self.n)
        return self.met[rows] * self.n.shape[1] + columns, self.n[rows, columns]


def cluster(ids: np.ndarray, starts_word: np.ndarray, end: int) -> np.ndarray:
    """``grouped`` for texts in memory, each followed by an end."""
    near = Neighbours(len(starts_word), end)
    near.add(ids[ids != end], np.diff(np.flatnonzero(ids == end), prepend=-1) - 1)
    return grouped(*near.cells(), starts_word, end)


def grouped(cells: np.ndarray, n: np.ndarray, starts_word: np.ndarray, end: int) -> np.ndarray:
    """A class for every id (and the padding id): by the company it keeps, from all ``Neighbours.cells``.

    Ids are described by hashed counts of their neighbours and grouped by k-means, those that begin
    a word apart from the others. Ids seen two times or fewer share the last class of their kind.
    """
    vocabulary, width = len(starts_word), 1 + len(BESIDE) * BUCKETS
    owner, column = cells // width, cells % width
    seen = np.zeros(vocabulary, np.int64)
    seen[owner[column == 0]] = n[column == 0]
    frequent = np.flatnonzero(seen > 2)
    row = np.full(vocabulary, -1)
    row[frequent] = np.arange(len(frequent))
    features = np.zeros((len(frequent), width - 1), np.float32)
    used = (column > 0) & (row[owner] >= 0)
    features[row[owner[used]], column[used] - 1] = n[used]
    vectors = np.sqrt(features / np.maximum(features.sum(1, keepdims=True), 1))
    out = np.zeros(vocabulary + 1, np.int64)
    for kind, first, amount in ((True, 1, WORD_CLASSES), (False, 1 + WORD_CLASSES, INNER_CLASSES)):
        own = np.flatnonzero((starts_word == kind) & (np.arange(vocabulary) != end))
        out[own] = first + amount - 1
        known = own[row[own] >= 0]
        if len(known) < amount:
            out[known] = first + np.arange(len(known))
            continue
        weight = seen[known].astype(np.float32)
        points = vectors[row[known]]
        centres = points[np.argsort(-weight)[: amount - 1]]
        for _ in range(12):
            nearest = (points @ centres.T - (centres**2).sum(1) / 2).argmax(1)
            for c in range(amount - 1):
                inside = nearest == c
                if inside.any():
                    centres[c] = np.average(points[inside], axis=0, weights=weight[inside])
        out[known] = first + nearest
    return out
