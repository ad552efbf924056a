"""Language-model scores of whole documents.

Words, subwords and the subwords beside them are counted over all training documents. A causal
self-attention model over subword ids gives every word its chance in context. It is trained in numpy on
all training documents, in rounds: workers take steps from common parameters, whose changes are averaged.
The score mixes the chance with the word's share of the corpus, by weights fitted on the tokens of all
training documents, each less its own count. A word that no training document holds has the chance of its
spelling, and beside it the base score's: one count of the corpus.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attention
from .labelled import fold
from .shingles import chunks, released, slices, WordHashes, Words
from .store import land, opened, send, small_batches
from .tokens import ByteMerges, WordTokens

FOLDS, HELD_OUT = 7, 2
END = b"\n"                     # stands for the end of a text among the words; no word is white space
COMMON_WORDS = 300_000          # words whose counts every worker holds, at most
COUNTED_WORDS = 400_000         # words a task counts before it passes them on
CELL_BYTES = 6                  # an end and a cell's number
SAMPLE_DOCS = 800               # texts a round of training takes at least, or all there are
SHARD_DOCS = 800                # texts that take steps from common parameters one after another, at least
BINS, BIN = 2001, 0.01          # of log10 ratios of chance and share
ROW = "__row"


def vocabulary() -> str:
    """The place of the tokenizer on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def sent_merges(spark: SparkSession, tokenizer: Callable[[], str]) -> Broadcast:
    """The tokenizer's merges, worked out once for all tasks."""
    return send(spark, ByteMerges.of(tokenizer()))


class WordCounts:
    """Counts of words by their hash, with the words themselves."""

    def __init__(self):
        self.keys, self.places, self.n, self.words = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), []

    def add(self, words: Words) -> None:
        unique, first, _, n = words.distinct
        at = np.minimum(np.searchsorted(self.keys, unique), max(len(self.keys) - 1, 0))
        known = self.keys[at] == unique if len(self.keys) else np.zeros(len(unique), bool)
        self.n[self.places[at[known]]] += n[known]
        new = np.flatnonzero(~known)
        where = np.searchsorted(self.keys, unique[new])
        self.keys = np.insert(self.keys, where, unique[new])
        self.places = np.insert(self.places, where, len(self.n) + np.arange(len(new)))
        self.n = np.concatenate([self.n, n[new]])
        self.words += words.some(first[new])

    def rows(self, texts: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([*self.words, END], pa.binary()), pa.array(np.append(self.n, texts), pa.int64())], names=["word", "n"])


def _count(batches: Iterator[pa.RecordBatch], path: Callable[[], str], sent, size: int) -> Iterator[pa.RecordBatch]:
    """Counts of words and of cells of neighbours; the latter's number stands after an end."""
    counts, n_texts = WordCounts(), 0
    tokens, near = WordTokens(path(), " ", True, opened(sent)), attention.Neighbours(size, size - 1)
    for batch in slices(batches):
        texts = batch.column(0).to_pylist()
        for a, b in chunks(texts):
            words = tokens.read(texts[a:b])
            counts.add(words)
            near.add(*_text_ids(tokens, words))
            n_texts += b - a
            if len(counts.n) > COUNTED_WORDS:
                yield counts.rows(n_texts)
                counts, n_texts = WordCounts(), 0
    if n_texts:
        yield counts.rows(n_texts)
    cells, n = near.cells()
    for a in range(0, len(cells), COUNTED_WORDS):
        own = cells[a: a + COUNTED_WORDS]
        signs = np.empty((len(own), CELL_BYTES), np.uint8)
        signs[:, 0] = END[0]
        signs[:, 1:] = own.astype(">u8")[:, None].view(np.uint8)[:, 9 - CELL_BYTES:]
        fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(CELL_BYTES), len(own), [None, pa.py_buffer(signs)])
        yield pa.RecordBatch.from_arrays([fixed.cast(pa.binary()), pa.array(n[a: a + COUNTED_WORDS])], names=["word", "n"])


def _text_ids(tokens: WordTokens, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts end to end, and how many each text has."""
    ids, per_word = tokens.encode_words(words)
    ends = np.concatenate([[0], np.cumsum(per_word)])[np.cumsum(words.counts)]
    return ids.astype(np.int64), np.diff(ends, prepend=0)


def word_counts(texts: DataFrame, tokenizer: Callable[[], str], merges: Broadcast, size: int) -> tuple[DataFrame, DataFrame]:
    """``word, n`` over all rows of ``texts``, and ``cell, n`` of the neighbours of their subwords.

    The end of a text is counted as a word of its own.
    """
    both = land(
        texts.select("text").mapInArrow(lambda it: released(_count(it, tokenizer, merges, size)), "word binary, n bigint")
        .groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    cell = F.col("word").startswith(F.lit(END)) & (F.length("word") > 1)
    return both.filter(~cell), both.filter(cell).select(F.conv(F.hex(F.substring("word", 2, CELL_BYTES)), 16, 10).cast("bigint").alias("cell"), "n")


TRAINED = "row bigint, weight double, " + ", ".join(f"x{i} double" for i in range(attention.WIDTH))


def _steps(batches: Iterator[pa.RecordBatch], sent, path: Callable[[], str], merges, epoch: int, expected: float) -> Iterator[pa.RecordBatch]:
    """The changes of the parameters by one pass over a task's texts, times the weight they have."""
    common: attention.Attention = opened(sent)
    tokens, end = WordTokens(path(), " ", True, opened(merges)), common.pad - 1
    run = attention.Training(replace(common, p={k: v.copy() for k, v in common.p.items()}))
    uses = np.zeros(len(common.p["e"]), np.int64)
    done, rng = 0, np.random.default_rng([epoch, TaskContext.get().partitionId()])
    for batch in slices(batches):
        texts = batch.column(0).to_pylist()
        for a, b in chunks(texts):
            read, predict, _ = attention.windows(*_text_ids(tokens, tokens.read(texts[a:b])), end, common.pad)
            part = -(-len(read) // attention.BATCH)
            for i, (ids, aim) in enumerate(attention.batches(read, predict, rng)):
                passed = min(1.0, (done + (b - a) * i / part) / expected)
                run.step(ids, aim, attention.RATE * max(0.01, 1 - (epoch + passed) / attention.EPOCHS))
            uses += np.bincount(read.ravel(), minlength=len(uses))
            done += b - a
    if done:
        before = attention.to_rows(common.p)
        weight = np.full(len(before), run.predicted, np.float64)
        weight[: len(uses)] = uses
        rows = np.flatnonzero(weight)
        moved = (attention.to_rows(run.model.p)[rows] - before[rows]) * weight[rows, None]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows), pa.array(weight[rows]), *(pa.array(moved[:, i]) for i in range(attention.WIDTH))],
            names=[c.split()[0] for c in TRAINED.split(", ")])


def _train_attention(model: attention.Attention, texts: DataFrame, n_texts: int, tokenizer: Callable[[], str], merges: Broadcast, least: int) -> None:
    """Rounds over all ``texts``; after each, rows of parameters move by the weighted mean of their changes.

    Rounds share the texts out by their hash, and where a share would be fewer than ``least`` texts, they
    overlap, so that every text is in one round or more.
    """
    rounds, steps = attention.EPOCHS, 1 << 40
    share = min(1.0, max(1 / rounds, least / max(n_texts, 1)))
    dealt = texts.select(F.coalesce("text", F.lit("")).alias("text"))
    place = F.pmod(F.xxhash64("text"), F.lit(steps))
    parts = texts.select(F.spark_partition_id().alias("part")).distinct().count()
    workers = max(1, min(parts, round(share * n_texts / SHARD_DOCS)))
    for epoch in range(rounds):
        sent = send(texts.sparkSession, model)
        own = F.pmod(place - epoch * steps // rounds, F.lit(steps)) < math.ceil(share * steps)
        moved = dealt.filter(own).coalesce(workers).mapInArrow(
            lambda it: released(_steps(it, sent, tokenizer, merges, epoch, max(1.0, share * n_texts / workers))), TRAINED).groupBy("row").agg(
            F.sum("weight"), *[F.sum(f"x{i}") for i in range(attention.WIDTH)]).toArrow()
        rows = attention.to_rows(model.p).astype(np.float64)
        at, weight = moved.column(0).to_numpy(), moved.column(1).to_numpy()
        for i in range(attention.WIDTH):
            rows[at, i] += moved.column(2 + i).to_numpy() / weight
        model.p = attention.from_rows(rows, model.p)
        sent.destroy()


@dataclass
class Model:
    scorer: attention.Scorer
    end: int
    common: np.ndarray          # hashes of the common words, sorted
    common_n: np.ndarray        # and their counts
    least_common: int           # words counted this often or more are in ``common``
    texts: int                  # training texts, so the count of ends
    tokens: int                 # N
    types: int                  # V

    def counts(self, words: Words) -> np.ndarray:
        """The counts of common words, 0 for others."""
        if not len(self.common):
            return np.zeros(len(words.hashes), np.int64)
        unique, _, inverse, _ = words.distinct
        at = np.minimum(np.searchsorted(self.common, unique), len(self.common) - 1)
        return np.where(self.common[at] == unique, self.common_n[at], 0)[inverse]

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + 1) / (self.tokens + self.types + 1))

    @property
    def uncounted(self) -> float:
        """The base score's chance of a word that no training document holds."""
        return 1 / (self.tokens + self.types + 1)


def with_ends(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words, and where ends stand when every text's words are followed by an end."""
    texts = np.arange(len(counts))
    return np.arange(counts.sum()) + np.repeat(texts, counts), np.cumsum(counts) + texts


def in_context(words: Words, tokens: WordTokens, scorer: attention.Scorer, end: int) -> np.ndarray:
    """log10 of the attention model's chance of every word and of the end, text after text."""
    ids, per_word = tokens.encode_words(words)
    last = np.cumsum(per_word)
    ends = np.concatenate([[0], last])[np.cumsum(words.counts)]
    sizes = np.diff(np.concatenate([[0], ends]))
    read, predict, used = attention.windows(ids, sizes, end, scorer.pad)
    chance, border = (x.ravel()[used] for x in scorer(read, predict))
    # A text's predictions are its ids and then its end; words start at the first of their ids.
    word_at, end_at = with_ends(words.counts)
    starts = np.empty(len(word_at) + len(end_at), np.int64)
    starts[word_at] = last - per_word + np.repeat(np.arange(len(words.counts)), words.counts)
    starts[end_at] = ends + np.arange(len(words.counts))
    sums = np.add.reduceat(chance.astype(np.float64), starts)
    # The chance of a word is that of its ids, given that a word starts, and that none goes on after.
    after = np.concatenate([border[starts[1:]], [0.0]])
    after[end_at] = 0
    return sums - border[starts] + after


SCORED = f"{ROW} bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, shares double, ratios binary, word binary, chance float, bin bigint, tokens bigint"
SCORED_NAMES = [c.split()[0] for c in SCORED.split(", ")]


def _rows(n: int, **columns: pa.Array) -> pa.RecordBatch:
    """``n`` rows of ``SCORED`` and their ids, null where nothing is given."""
    kinds = {"boolean": pa.bool_(), "bigint": pa.int64(), "double": pa.float64(), "float": pa.float32(), "binary": pa.binary()}
    nulls = {c.split()[0]: kinds[c.split()[1]] for c in SCORED.split(", ")}
    names = [*SCORED_NAMES, "id"]
    return pa.RecordBatch.from_arrays([columns[k] if k in columns else pa.nulls(n, nulls[k]) for k in names], names=names)


def _score(batches: Iterator[pa.RecordBatch], sent, path: Callable[[], str], merges) -> Iterator[pa.RecordBatch]:
    """Per text what its common words add, but for the weights of the mixture; its other words follow one by one.

    ``shares`` sums the log10 of the words' shares, ``ratios`` holds log10 of chance by share of each, as
    float32. At the end of a task ``bin, tokens`` count the ratios in training texts, where a word's share
    is less by its own occurrence.
    """
    model: Model = opened(sent)
    tokens, tally, kind = WordTokens(path(), " ", True, opened(merges)), np.zeros(UNKNOWN + 1 + BINS // 2, np.int64), pa.null()
    for batch in slices(batches):
        rows, texts, kind = batch.column(0).to_numpy(), batch.column(1).to_pylist(), batch.column(2).type
        out = batch.column(3).to_numpy(zero_copy_only=False)
        for a, b in chunks(texts):
            words = tokens.read(texts[a:b])
            chance = np.maximum(in_context(words, tokens, model.scorer, model.end), -300)
            word_at, end_at = with_ends(words.counts)
            n = np.full(len(chance), model.texts, np.int64)
            n[word_at] = model.counts(words)
            owner = np.repeat(np.arange(b - a), words.counts + 1)
            learned = ~out[a:b][owner]
            tally += np.bincount(_ratio_bin(chance, n - 1, model.tokens)[learned & (n > 0)] + BINS // 2, minlength=len(tally))
            known = n > 0
            share = np.log10(n[known] / max(model.tokens, 1))
            ratios = (chance[known] - share).astype("<f4")
            n_known = np.bincount(owner[known], minlength=b - a)
            ends = np.concatenate([[0], np.cumsum(n_known * ratios.itemsize)]).astype(np.int32)
            yield _rows(
                b - a, **{ROW: pa.array(rows[a:b])}, id=batch.column(2).slice(a, b - a), held_out=batch.column(3).slice(a, b - a),
                n_tokens=pa.array(words.counts + 1), n_known=pa.array(n_known), base=pa.array(np.bincount(owner[known], model.base(n[known]), b - a)),
                shares=pa.array(np.bincount(owner[known], share, b - a)),
                ratios=pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(ends), pa.py_buffer(ratios)]))
            alone = np.flatnonzero(~known[word_at])
            rest = word_at[alone]
            yield _rows(
                len(rest), **{ROW: pa.array(rows[a:b][owner[rest]])}, id=pa.nulls(len(rest), kind), held_out=pa.array(~learned[rest]),
                word=pa.array(words.some(alone), pa.binary()), chance=pa.array(chance[rest].astype(np.float32)))
    bins = np.flatnonzero(tally)
    if len(bins):
        yield _rows(len(bins), id=pa.nulls(len(bins), kind), bin=pa.array(bins - BINS // 2), tokens=pa.array(tally[bins]))


MIXED = f"{ROW} bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double"


def _mix(batches: Iterator[pa.RecordBatch], weights: tuple[float, float, float]) -> Iterator[pa.RecordBatch]:
    """The texts' scores over their common words."""
    share, attention_, _ = weights
    for batch in slices(batches):
        names = batch.schema.names
        ratios = batch.column(names.index("ratios")).to_pylist()
        flat = np.frombuffer(b"".join(ratios), "<f4").astype(np.float64)
        owner = np.repeat(np.arange(len(ratios)), [len(r) // 4 for r in ratios])
        score = np.bincount(owner, np.log10(share + attention_ * 10.0**flat), len(ratios)) + batch.column(names.index("shares")).to_numpy()
        kept = [*(c.split()[0] for c in MIXED.split(", ")[:-1]), "id"]
        yield pa.RecordBatch.from_arrays([*(batch.column(names.index(k)) for k in kept[:-1]), pa.array(score), batch.column(names.index("id"))],
                                         names=[*kept[:-1], "score", "id"])


def _common_words(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes and counts of the most frequent words, at most ``most`` of them, and the count from which words are in."""
    by_count = counts.groupBy("n").agg(F.count("*").alias("words"))
    more = by_count.orderBy(F.desc("n")).limit(most).collect()      # each count holds a word at least
    least, held = 1, 0
    for r in more:
        held += r["words"]
        if held > most:
            least = r["n"] + 1
            break
    rows = counts.filter((F.col("n") >= least) & (F.col("word") != F.lit(END))).collect()
    hashes, n = _hashes([bytes(r["word"]) for r in rows]), np.array([r["n"] for r in rows], np.int64)
    order = np.argsort(hashes)
    return hashes[order], n[order], least


def _hashes(words: list[bytes]) -> np.ndarray:
    return WordHashes()([w.decode("utf-8", "surrogatepass") for w in words])[0]


def _ratio_bin(chance: np.ndarray, n: np.ndarray, tokens: int) -> np.ndarray:
    """The bin of the log10 ratio of chance (a log10) and share of the tokens; ``UNKNOWN`` for a count of 0 or less."""
    ratio = chance - np.log10(np.maximum(n, 1) / max(tokens, 1))
    return np.where(n > 0, np.clip(np.rint(ratio / BIN), -(BINS // 2), BINS // 2), UNKNOWN).astype(np.int64)


UNKNOWN = BINS                  # the bin of words that training lacks but for their own occurrence


def _fit_weights(tally: dict[int, int]) -> tuple[float, float, float]:
    """Weights of share, attention and unknown words, by expectation and maximisation.

    ``tally`` counts tokens by the bin of their ratio of chance and share; unknown words have their
    share of the tokens as weight.
    """
    weights = np.array([0.5, 0.3, 0.2])
    bins, n = np.array(sorted(tally), np.int64), np.array([tally[b] for b in sorted(tally)], np.float64)
    unknown = bins == UNKNOWN
    parts = np.stack([~unknown, np.where(unknown, 0.0, 10.0 ** (bins * BIN)), unknown], axis=1).astype(float)
    for _ in range(100 if n.sum() else 0):
        own = parts * weights
        weights = (own / own.sum(1, keepdims=True) * n[:, None]).sum(0) / n.sum()
        weights = np.maximum(weights, 1e-4)
        weights /= weights.sum()
    return tuple(weights.tolist())


def train(
    texts: DataFrame, tokenizer: Callable[[], str] = vocabulary, sample_docs: int = SAMPLE_DOCS, merges: Broadcast | None = None,
) -> tuple[Model, DataFrame]:
    """The model and the counts of all words of ``texts``.

    Counts of words, of subwords and of their neighbours, and so the classes, cover every row, and so do the
    attention model's weights. A round of its training takes ``sample_docs`` texts at least, or all there are.
    ``merges`` are the tokenizer's, as ``sent_merges`` gives them.
    """
    path, merges = tokenizer(), merges or sent_merges(texts.sparkSession, tokenizer)
    with open(path, encoding="utf-8") as file:
        names = json.load(file)["model"]["vocab"]
    size = max(names.values()) + 2
    end = size - 1
    starts_word = np.zeros(size, bool)
    starts_word[[i for name, i in names.items() if name.startswith("Ġ")]] = True

    counts, beside = word_counts(texts, tokenizer, merges, size)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    common, common_n, least = _common_words(counts, COMMON_WORDS)
    n_texts = counts.filter(F.col("word") == F.lit(END)).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    found = beside.toArrow()
    cells, n = found.column(0).to_numpy(), found.column(1).to_numpy()
    width = 1 + len(attention.BESIDE) * attention.BUCKETS
    own = cells % width == 0
    id_counts = np.zeros(size + 1, np.float64)
    id_counts[cells[own] // width] = n[own]
    id_counts[end] = 0
    classes = attention.grouped(cells, n, starts_word, end)

    model = attention.initial(size, classes)
    _train_attention(model, texts, n_texts, tokenizer, merges, sample_docs)
    per_class = np.bincount(classes, id_counts + 1, attention.CLASSES)
    model.inside = np.log10((id_counts + 1) / per_class[classes]).astype(np.float32)
    model.inside[end] = 0
    return Model(attention.Scorer(model), end, common, common_n, least, n_texts, total["n"], total["v"]), counts


def lm_score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: Callable[[], str] = vocabulary,
    sample_docs: int = SAMPLE_DOCS,
) -> DataFrame:
    """Scores of all documents, learned from those outside the held-out fold.

    Returns per row ``id, held_out, n_tokens, n_known, train_tokens, base_score, score``: words and one
    end per text are tokens, known ones occur in training documents; ``base_score`` is the log10
    chance by add-one word counts, ``score`` the model's.

    Null and empty texts are an end alone. Rows that repeat an id are scored one by one. A null id is
    not held out. Long texts are scored whole, in windows. An empty table gives an empty result. Other
    columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    key = F.col(f"`{id_col}`")
    out = F.coalesce(fold(key, FOLDS) == HELD_OUT, F.lit(False))
    rows = docs.select(
        F.monotonically_increasing_id().alias(ROW), F.col(f"`{text_col}`").cast("string").alias("text"), key.alias("id"),
        out.alias("held_out"))
    merges = sent_merges(spark, tokenizer)
    model, counts = train(rows.filter("NOT held_out").select("text"), tokenizer, sample_docs, merges)
    sent = send(spark, model)
    kind = rows.schema["id"].dataType.simpleString()
    partial = land(rows.mapInArrow(lambda it: released(_score(it, sent, tokenizer, merges)), f"{SCORED}, id {kind}"), "scored-texts")

    # Words that not every worker knows meet their counts here.
    rare = land(partial.filter("word IS NOT NULL").select(ROW, "held_out", "word", "chance").join(
        counts.filter(F.col("n") < model.least_common), "word", "left").select(ROW, "held_out", "chance", F.coalesce("n", F.lit(0)).alias("n")),
        "scored-words")
    n, spelled = F.col("n"), F.pow(F.lit(10.0), F.col("chance").cast("double"))
    others = n - 1          # less the word's own occurrence
    last = F.lit(float(BINS // 2))
    ratio = F.rint((F.col("chance") - F.log10(others / F.lit(float(max(model.tokens, 1))))) / BIN)
    place = F.when(others <= 0, F.lit(UNKNOWN)).otherwise(F.greatest(-last, F.least(last, ratio)).cast("bigint"))
    tally = partial.filter("bin IS NOT NULL").select("bin", "tokens").unionByName(
        rare.filter("NOT held_out").select(place.alias("bin"), F.lit(1).cast("bigint").alias("tokens"))).groupBy("bin").agg(
        F.sum("tokens").alias("tokens")).collect()
    weights = share, attention_, unknown = _fit_weights({r["bin"]: r["tokens"] for r in tally})

    mixed = F.when(n > 0, share * n / max(model.tokens, 1) + attention_ * spelled).otherwise(
        (attention_ + unknown) * spelled + model.uncounted)
    no_id = F.lit(None).cast(kind)
    scored = partial.filter("ratios IS NOT NULL").select(
        *[c for c in SCORED_NAMES if c not in ("word", "chance", "bin", "tokens")], "id").mapInArrow(
        lambda it: released(_mix(it, weights)), f"{MIXED}, id {kind}").unionByName(rare.select(
            ROW, F.lit(None).cast("boolean").alias("held_out"), F.lit(None).cast("bigint").alias("n_tokens"),
            (n > 0).cast("bigint").alias("n_known"), F.log10((n + 1) / F.lit(float(model.tokens + model.types + 1))).alias("base"),
            F.log10(mixed).alias("score"), no_id.alias("id")))
    sums = scored.groupBy(ROW).agg(
        F.first("id", ignorenulls=True).alias("id"), F.max("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("score").alias("score"))
    return sums.select("id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
