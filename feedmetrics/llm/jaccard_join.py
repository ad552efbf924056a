"""Near duplicates by word shingles: a parity-sketch join, exact for its threshold.

A set of shingles is hashed into a long bit sketch in which every shingle flips one position, so the
positions where two sketches differ are at most as many as the shingles that only one set holds.
Per band of set sizes the sketch is cut into parts; a shingle that only one set holds spoils at most
one part. With the overlap that the threshold asks for, a known number of parts must be equal, and
so (pigeonhole) some of the first few parts in any fixed order. Parts that are rare in the corpus
come first in that order; those that many documents share come last. Pairs that share a part are
compared by a 512-bit parity sketch, and those it cannot rule out by their full sets.

Exactly equal sets are one node. Parts that many rows share pair each row with the first only. So a
large group of near copies costs about one check per member, and its parts lie in one component then.

A large part whose rows are still in several components is a common passage. Its pairs are not looked
at: the rows that hold it take part in another round, in which such parts come last in the order, behind
all parts that were not seen to be common. Any order finds all links, so the rounds lose none. Only rows
that hardly hold anything but common passages keep some of them; they are compared in blocks at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .shingles import chunks, mix, released, SHINGLE, shingle_sets, slices, WordHashes
from .store import drop_rows, land, no_rows, numbered, small_batches, small_enough, without

PERCENT = 75                    # links: 100 * intersection >= 75 * union
ROW = "__row"
BASE = 64                       # sets below this size use one part per shingle
SKETCH_LONGS = 8                # 512 bits to rule out pairs
SLOT_BITS, RANGE_BITS = 20, 14  # counters of the parts' rarity, and how many one row carries
FLUSH = 300_000                 # parts a task holds before it passes them on
PARTS_PER_TASK = 400_000
HOT = 200_000                   # a part shared by more documents is spread over several tasks
FEW = 16                        # rows that share a part and are paired at once
BLOCK = 4096                    # members of a part compared with one another by one key
MARK_BITS = 20, 28              # bits, as powers of two, that mark common parts: at least and at most (32 MB)
MARKS_PER_ROW = 17              # of them, as a power of two, in one row
MEETINGS_PER_WORD = 300         # pairs in blocks that cost as much as another round does for each word
EARLIER = 16                    # lesser parts by which a pair knows that it is met elsewhere


def most_apart(a, b, percent: int = PERCENT):
    """How many shingles at most only one of two linked sets of sizes ``a`` and ``b`` holds."""
    return (a + b) * (100 - percent) // (100 + percent)


def bands(n: np.ndarray, percent: int = PERCENT) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each band: which sets take part, the number of parts, and the bound on spoiled parts.

    Band 0 holds sizes below ``BASE``, band k sizes ``[S, 4 S)`` with ``S = BASE * 4 ** (k - 1)``. The
    smaller set of a pair decides, so each band also takes the sets above it that a member may link to.
    """
    out, low, high = [], 1, BASE
    while low <= n.max(initial=0):
        inside = (n >= low) & (n < high)
        above = (n >= high) & (percent * n <= 100 * (high - 1))
        largest = np.where(inside, n * 100 // percent, high - 1)
        out.append((inside | above, np.full(len(n), 0 if low == 1 else 4 * low), most_apart(n, largest, percent)))
        low, high = high, high * 4
    return out


class Parts:
    """The sketch parts of a batch of sets, band by band."""

    def __init__(self, values: np.ndarray, ends: np.ndarray, weak: frozenset[int] = frozenset(), percent: int = PERCENT):
        self.values, self.ends, self.weak, self.percent = values, ends, weak, percent
        self.sizes = np.diff(np.concatenate([[0], ends])).astype(np.int64)

    def __iter__(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(band, set of each part, part's number, spoiled parts at most by set)"""
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        for k, (member, m, bound) in enumerate(bands(self.sizes, self.percent)):
            if not member.any():
                continue
            inside = member[owner]
            who, token = owner[inside], mix(self.values[inside] ^ np.uint64(k + 1))
            if k == 0 or k in self.weak:
                yield k, who, token, bound
                continue
            place = who.astype(np.int64) << 32 | (self.values[inside] % np.uint64(m[0])).astype(np.int64)
            order = np.argsort(place)
            place, token = place[order], token[order]
            first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            parity = np.bitwise_xor.reduceat(token, first)
            yield k, (place[first] >> 32), mix(parity + (place[first] & 0xFFFFFFFF).astype(np.uint64)), bound


def _slot(parts: np.ndarray) -> np.ndarray:
    return (parts >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def parity_sketch(values: np.ndarray, bits: int = 64 * SKETCH_LONGS) -> np.ndarray:
    """``bits`` bits (a power of two), each shingle flips one; as bytes.

    The sketch of half as many bits is the exclusive or of its halves.
    """
    odd = np.bincount((mix(values) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8))


def detailed_bits(n: int) -> int:
    """Bits of the sketch that tells sets of this size apart: a power of two from 4 n on."""
    return max(64 * SKETCH_LONGS, 1 << (4 * n - 1).bit_length())


SUMMARY = (
    f"{ROW} bigint, n int, digest binary, sketch array<bigint>, detail binary, weak int, parts bigint, range int,"
    " dense boolean, counts binary")


def _summaries(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Per text its size, digest and sketch; per task how often parts occur, by hashed counters."""
    words, counters, weak, total = WordHashes(), np.zeros(1 << SLOT_BITS, np.int32), set(), 0
    for batch in slices(batches):
        rows, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for a, b in chunks(texts):
            values, ends = shingle_sets(texts[a:b], words, size)
            sets = np.split(values, ends[:-1])
            for k, who, parts, bound in Parts(values, ends, percent=percent):
                counters += np.bincount(_slot(parts), minlength=len(counters)).astype(np.int32)
                held = np.bincount(who, minlength=b - a)
                member = held > 0
                total += int(np.minimum(held, bound + 1)[member].sum())
                if (held[member] <= bound[member]).any():
                    weak.add(k)
            yield _arrow(SUMMARY, {
                ROW: rows[a:b], "n": [len(s) for s in sets],
                "digest": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                "sketch": [parity_sketch(s).view(np.int64).tolist() for s in sets],
                "detail": [parity_sketch(s, detailed_bits(len(s))).tobytes() for s in sets],
            })
    for r, part in enumerate(counters.reshape(-1, 1 << RANGE_BITS)):
        used = np.flatnonzero(part)
        if len(used):
            dense = 3 * len(used) > len(part)
            data = part.tobytes() if dense else used.astype(np.uint16).tobytes() + part[used].tobytes()
            yield _arrow(SUMMARY, {"range": [r], "dense": [dense], "counts": [data]})
    yield _arrow(SUMMARY, {"weak": [*weak], "parts": [0] * len(weak)})
    yield _arrow(SUMMARY, {"parts": [total]})


_TYPES = {
    "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(),
    "array<bigint>": pa.list_(pa.int64()),
}


def _arrow(ddl: str, columns: dict) -> pa.RecordBatch:
    length = len(next(iter(columns.values())))
    absent = {k: pa.nulls(length, t) for k, t in _TYPES.items()}
    fields = [f.split() for f in ddl.split(",")]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[n], _TYPES[t]) if n in columns else absent[t] for n, t in fields], names=[n for n, _ in fields])


def _sum_counters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for r, dense, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
            held = sums.setdefault(r, np.zeros(1 << RANGE_BITS, np.int64))
            if dense:
                held += np.frombuffer(data, np.int32)
            else:
                n = len(data) // 6
                held[np.frombuffer(data[: 2 * n], np.uint16)] += np.frombuffer(data[2 * n:], np.int32)
    yield _arrow("range int, counts binary", {
        "range": [*sums], "counts": [np.minimum(s, 2**31 - 1).astype(np.int32).tobytes() for s in sums.values()]})


def _rarity(summary: DataFrame) -> np.ndarray:
    """How often parts occur in the corpus, in 2**20 hashed counters (4 MB, whatever the corpus)."""
    partial = summary.filter("range IS NOT NULL").select("range", "dense", "counts")
    out = np.zeros((1 << (SLOT_BITS - RANGE_BITS), 1 << RANGE_BITS), np.int32)
    for r in partial.repartition(len(out), "range").mapInArrow(_sum_counters, "range int, counts binary").collect():
        out[r["range"]] = np.frombuffer(r["counts"], np.int32)
    return out.reshape(-1)


PREFIXES = "task int, hot boolean, parts binary, rows binary"


def _marked(parts: np.ndarray, marks: np.ndarray | None) -> np.ndarray:
    """Whether parts have the bit of a common one; some others have it by chance, which costs time only."""
    if marks is None:
        return np.zeros(len(parts), bool)
    bits = 3 + (len(marks) - 1).bit_length()
    slot = parts >> np.uint64(64 - bits)
    return (marks[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _marks(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """The bits of common parts, by ranges of ``2 ** MARKS_PER_ROW`` of them."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        slot = batch.column(1).to_numpy().view(np.uint64) >> np.uint64(64 - bits)
        within = (slot & np.uint64((1 << MARKS_PER_ROW) - 1)).astype(np.int64)
        for r in np.unique(batch.column(0).to_numpy()).tolist():
            own = within[batch.column(0).to_numpy() == r]
            np.bitwise_or.at(held.setdefault(r, np.zeros(1 << MARKS_PER_ROW - 3, np.uint8)), own >> 3, (1 << (own & 7)).astype(np.uint8))
    yield _arrow("range int, counts binary", {"range": [*held], "counts": [h.tobytes() for h in held.values()]})


def _with_marks(marks: np.ndarray | None, parts: DataFrame) -> np.ndarray:
    """``marks`` with the bits of ``parts`` set; at first 16 bits or more for each, as far as ``MARK_BITS`` go."""
    if marks is None:
        low, high = MARK_BITS
        marks = np.zeros(1 << min(high, max(low, (16 * parts.count()).bit_length())) - 3, np.uint8)
    bits = 3 + (len(marks) - 1).bit_length()
    ranges = 1 << bits - MARKS_PER_ROW
    rows = parts.select(F.shiftrightunsigned("part", 64 - bits + MARKS_PER_ROW).cast("int").alias("range"), "part")
    for r in rows.repartition(min(ranges, 64), "range").mapInArrow(lambda it: _marks(it, bits), "range int, counts binary").collect():
        start = r["range"] << MARKS_PER_ROW - 3
        marks[start: start + len(r["counts"])] |= np.frombuffer(r["counts"], np.uint8)
    return marks


def _prefixes(batches, counters, marked, weak: frozenset[int], tasks: int, hot_above: int, size: int, percent: int):
    """The first parts of each set in the common order, packed by the task that gathers them."""
    rarity, words, held, amount = counters.value, WordHashes(), [], 0
    marks = marked.value if marked else None

    def packed():
        parts, rows = (np.concatenate(x) for x in zip(*held))
        often = rarity[_slot(parts)]
        hot = often > hot_above
        salt = np.where(hot, rows % (often // hot_above + 1), 0).astype(np.uint64)
        task = ((mix(parts + salt) >> np.uint64(16)) % np.uint64(tasks)).astype(np.int64)
        order = np.argsort(task << 1 | hot, kind="stable")
        task, hot, parts, rows = task[order], hot[order], parts[order], rows[order]
        cut = np.flatnonzero(np.diff(task << 1 | hot)) + 1
        first = np.concatenate([[0], cut])
        return _arrow(PREFIXES, {
            "task": task[first].tolist(), "hot": hot[first].tolist(),
            "parts": [p.tobytes() for p in np.split(parts, cut)], "rows": [r.tobytes() for r in np.split(rows, cut)]})

    for batch in slices(batches):
        numbers, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        for a, b in chunks(texts):
            values, ends = shingle_sets(texts[a:b], words, size)
            for _, who, parts, bound in Parts(values, ends, weak, percent):
                order = np.lexsort((parts, rarity[_slot(parts)], _marked(parts, marks), who))
                who, parts = who[order], parts[order]
                rank = np.arange(len(who)) - np.searchsorted(who, who)
                first = rank <= bound[who]
                held.append((parts[first], numbers[a:b][who[first]]))
                amount += int(first.sum())
            if amount >= FLUSH:
                yield packed()
                held, amount = [], 0
    if held:
        yield packed()


SHARED = "part bigint, a bigint, b bigint"


def _shared_parts(batches: Iterator[pa.RecordBatch], few: int) -> Iterator[pa.RecordBatch]:
    """What rows share parts: all pairs of a part with at most ``few`` rows, else its rows one by one."""
    cold = []
    for batch in batches:
        for hot, parts, rows in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            parts, rows = np.frombuffer(parts, np.int64), np.frombuffer(rows, np.int64)
            if hot:
                yield _arrow(SHARED, {"part": parts, "a": rows})
            else:
                cold.append((parts, rows))
    if not cold:
        return
    parts, rows = (np.concatenate(x) for x in zip(*cold))
    order = np.lexsort((rows, parts))
    parts, rows = parts[order], rows[order]
    first = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]]))
    size = np.diff(np.concatenate([first, [len(parts)]]))
    size = np.repeat(size, size)
    many = size > few
    yield _arrow(SHARED, {"part": parts[many], "a": rows[many]})
    some = (size > 1) & ~many
    parts, rows = parts[some], rows[some]
    names, place = np.unique(rows, return_inverse=True)
    pairs = [place[step:][same] * len(names) + place[:-step][same]
             for step in range(1, few) if (same := parts[step:] == parts[:-step]).any()]
    if pairs:
        both = np.unique(np.concatenate(pairs))
        yield _arrow(SHARED, {"a": names[both // len(names)], "b": names[both % len(names)]})


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    words = WordHashes()
    for batch in slices(batches):
        rows, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for a, b in chunks(texts):
            values, ends = shingle_sets(texts[a:b], words, size)
            yield _arrow(f"{ROW} bigint, shingles binary", {
                ROW: rows[a:b], "shingles": [s.tobytes() for s in np.split(values, ends[:-1])]})


def _close(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs that their detailed sketches allow to link."""
    for batch in slices(batches):
        keep = []
        for n, m, x, y in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5, 6))):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            if len(x) < len(y):
                x, y = y, x
            x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
            keep.append(int(np.bitwise_count(x ^ y).sum()) * (100 + percent) <= (n + m) * (100 - percent))
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep, pa.bool_())) for i in range(3)], names=["a", "b", "apart"])


def _verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        a, b, left, right = (batch.column(i).to_pylist() for i in range(4))
        keep = []
        for x, y in zip(left, right):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= percent * (len(x) + len(y) - both))
        yield _arrow("a bigint, b bigint, linked boolean", {"a": a, "b": b, "linked": keep})


def _apart(a: str, b: str) -> Column:
    """In how many bits the parity sketches of two nodes differ."""
    return reduce(lambda x, y: x + y, [
        F.bit_count(F.get(f"{a}.sketch", F.lit(i)).bitwiseXOR(F.get(f"{b}.sketch", F.lit(i)))) for i in range(SKETCH_LONGS)])


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether sizes and parity sketches of two nodes allow a link."""
    n, m = F.col(f"{a}.n").cast("bigint"), F.col(f"{b}.n").cast("bigint")
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (
        _apart(a, b) * (100 + percent) <= (n + m) * (100 - percent))


class _Links:
    """Verified links, and the components they make so far."""

    def __init__(self, texts: DataFrame, size: int, percent: int):
        self.texts, self.size, self.percent = texts, size, percent
        self.found: list[DataFrame] = []
        self.checked: list[DataFrame] = []
        self.labels = no_rows(texts.sparkSession, T.StructType().add("row", T.LongType()).add("label", T.LongType()))

    def labelled(self, df: DataFrame, row: str, name: str) -> DataFrame:
        labels = self.labels.select(F.col("row").alias(row), F.col("label").alias(name))
        return df.join(labels, row, "left").withColumn(name, F.coalesce(name, row))

    def sets(self, pairs: DataFrame) -> DataFrame:
        """``__row, shingles`` of the ends of pairs."""
        ends = land(pairs.select(F.col("a").alias(ROW)).union(pairs.select("b")).distinct(), "ends")
        texts = self.texts.join(F.broadcast(ends) if small_enough(ends) else ends, ROW, "left_semi")
        size = self.size
        return land(texts.mapInArrow(lambda it: released(_sets(it, size)), f"{ROW} bigint, shingles binary"), "sets")

    def check(self, pairs: DataFrame, sets: DataFrame | None = None) -> None:
        """Compare the full sets of pairs ``a, b`` in different components and take in those that link.

        A pair is compared once. ``sets`` may be given for pairs whose sets are at hand.
        """
        open_ = self.labelled(self.labelled(pairs.select("a", "b"), "a", "la"), "b", "lb").filter("la <> lb").select("a", "b")
        for done in self.checked:
            open_ = open_.join(done, ["a", "b"], "left_anti")
        pairs = land(open_, "pairs")
        if pairs.isEmpty():
            return
        self.checked.append(pairs)
        sets = self.sets(pairs) if sets is None else sets
        left = sets.select(F.col(ROW).alias("a"), F.col("shingles").alias("left"))
        right = sets.select(F.col(ROW).alias("b"), F.col("shingles").alias("right"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
        percent = self.percent
        checked = both.mapInArrow(lambda it: released(_verified(it, percent)), "a bigint, b bigint, linked boolean")
        links = land(checked.filter("linked").select("a", "b"), "links")
        if links.isEmpty():
            return
        self.found.append(links)
        self.labels = land(components(reduce(DataFrame.union, self.found)), "labels")


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that sizes and sketches allow to link, and how far ``apart`` their sketches are.

    The small sketches of all pairs come first; the detailed ones are read for the pairs they leave.
    """
    x, y = (nodes.select(F.col(ROW).alias(c), "n", "sketch").alias(k) for c, k in (("a", "x"), ("b", "y")))
    kept = pairs.join(x, "a").join(y, "b").filter(_possible("x", "y", percent))
    kept = land(kept.select("a", "b", (_apart("x", "y") / (F.col("x.n") + F.col("y.n"))).alias("apart")), "possible-pairs")
    x, y = (nodes.select(F.col(ROW).alias(c), F.col("n").alias(f"n_{c}"), F.col("detail").alias(f"detail_{c}")) for c in "ab")
    both = kept.join(x, "a").join(y, "b").select("a", "b", "apart", "n_a", "n_b", "detail_a", "detail_b")
    return both.mapInArrow(lambda it: released(_close(it, percent)), "a bigint, b bigint, apart double")


def _mixed(members: DataFrame, links: _Links, block: int) -> tuple[DataFrame, DataFrame]:
    """The parts whose rows are in several components, and ``part, __row, label, main, blocks`` of their rows, landed.

    ``main`` is the most frequent component of the part, ``blocks`` how many blocks its rows are compared
    in, ``meetings`` how many pairs that would be.
    """
    known = links.labelled(members, ROW, "label")
    by_label = known.groupBy("part", "label").agg(F.count("*").alias("c"))
    size = F.col("size").cast("double")
    mixed = land(by_label.groupBy("part").agg(
        F.count("*").alias("labels"), F.sum("c").alias("size"), F.max("c").alias("most"),
        F.max_by("label", F.struct("c", "label")).alias("main")
    ).filter("labels > 1").select(
        "part", "main", F.ceil(size / block).cast("int").alias("blocks"), ((size - F.col("most")) * size).alias("meetings")), "mixed-parts")
    here = mixed.drop("meetings")
    return mixed, land(known.join(F.broadcast(here) if small_enough(here) else here, "part"), "mixed-members")


def _remaining_pairs(known: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """All possible pairs that share one of these parts and are in different components.

    Per part, members outside its most frequent component meet all members. Both sides are cut into blocks,
    so no key holds more than a block of either. A pair that shares many parts is written for the least of
    them: a member carries the first of its lesser parts, and a pair with one of them in common is left
    to that one. (Beyond ``EARLIER`` of them a pair may be written more than once, but never not at all.)
    """
    first = known.groupBy(ROW).agg(F.slice(F.array_sort(F.collect_list("part")), 1, EARLIER).alias("first"))
    lesser = F.filter("first", lambda q: q < F.col("part"))
    known = known.join(first, ROW).join(nodes.drop("detail", "digest"), ROW).withColumn("lesser", lesser).drop("first").withColumn(
        "own", F.pmod(F.xxhash64(ROW), "blocks").cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    x = known.filter("label <> main").select("*", F.col("own").alias("left"), F.explode(every).alias("right")).alias("x")
    y = known.select("*", F.col("own").alias("right"), F.explode(every).alias("left")).alias("y")
    meet = (
        (F.col("x.part") == F.col("y.part")) & (F.col("x.left") == F.col("y.left")) & (F.col("x.right") == F.col("y.right"))
        & (F.col("x.label") != F.col("y.label")) & _possible("x", "y", percent) & ~F.arrays_overlap("x.lesser", "y.lesser"))
    pairs = x.join(y, meet).select(
        F.greatest(f"x.{ROW}", f"y.{ROW}").alias("a"), F.least(f"x.{ROW}", f"y.{ROW}").alias("b")).distinct()
    return _likely(pairs, nodes, percent)


@dataclass
class _Sizes:
    """What the rounds have in common."""

    counters: object            # broadcast: how often parts occur
    marked: object              # broadcast: bits of common parts, or none
    weak: frozenset[int]
    tasks: int
    hot_above: int
    size: int
    percent: int
    few: int


def _round(texts: DataFrame, nodes: DataFrame, links: _Links, how: _Sizes) -> DataFrame:
    """Join ``texts`` by their first parts, take in the links found, and return ``part, __row`` of large parts.

    All pairs of parts that few rows share, and for the other parts each row with the first one, are
    compared: each row with its nearest other first, then whatever is still in different components.
    """
    packed = texts.mapInArrow(
        lambda it: released(_prefixes(it, how.counters, how.marked, how.weak, how.tasks, how.hot_above, how.size, how.percent)), PREFIXES)
    shared = land(packed.repartition(how.tasks, "task").mapInArrow(lambda it: released(_shared_parts(it, how.few)), SHARED), "shared-parts")
    members = shared.filter("part IS NOT NULL").select("part", F.col("a").alias(ROW))
    first = land(members.groupBy("part").agg(F.min(ROW).alias("b")), "first-rows")
    stars = members.select("part", F.col(ROW).alias("a")).join(
        F.broadcast(first) if small_enough(first) else first, "part").filter("a <> b").select("a", "b")
    pairs = shared.filter("part IS NULL").select("a", "b").union(stars).distinct()
    likely = land(_likely(pairs, nodes, how.percent), "likely-pairs")
    sets = links.sets(likely)
    links.check(likely.groupBy("a").agg(F.min_by("b", "apart").alias("b")), sets)
    links.check(likely, sets)
    return members


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_col: str | None = None,
    size: int = SHINGLE,
    percent: int = PERCENT,
    hot_above: int = HOT,
    few: int = FEW,
    block: int = BLOCK,
    meetings_per_word: float = MEETINGS_PER_WORD,
) -> DataFrame:
    """Groups of documents linked by ``100 * intersection >= percent * union`` of their shingle sets.

    Returns per row ``id, n_shingles, component_id, kept, __row``: the set's size, the smallest id that
    links lead to, and whether this row is the one of its group that stays (smallest id, then first
    row). ``__row`` is ``row_col`` (a unique number fixed for every reading) or made here.

    Texts without words, null ones too, link with nothing and are kept. Fewer words than ``size``
    are one shingle. A null id is largest. Rows that repeat an id stay apart as nodes and link by
    their texts. An empty table gives an empty result. Other columns are not read.

    ``percent`` is from 51 to 100. Shingles are 64-bit hashes of words. Nothing limits the number of
    partners or the size of a group; ``hot_above``, ``few``, ``block`` and ``meetings_per_word`` spread the
    work and change no result. Very long texts are sets like any other: a task holds one of them at a time.
    """
    spark = docs.sparkSession
    small_batches(spark)
    number = F.col(f"`{row_col}`") if row_col else F.monotonically_increasing_id()
    rows = docs.select(number.alias(ROW), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = rows if row_col else land(rows, "jaccard-docs")
    texts = rows.select(ROW, "text")

    summary = land(texts.mapInArrow(lambda it: released(_summaries(it, size, percent)), SUMMARY), "summaries")
    counters = spark.sparkContext.broadcast(_rarity(summary))
    facts = summary.filter("parts IS NOT NULL").agg(F.sum("parts").alias("parts"), F.collect_set("weak").alias("weak")).first()
    weak, tasks = frozenset(facts["weak"]), int((facts["parts"] or 0) // PARTS_PER_TASK) + 1

    own = summary.filter(f"{ROW} IS NOT NULL").select(ROW, "n", "digest", "sketch", "detail")
    equal = own.filter("n > 0").groupBy("digest").agg(F.min(ROW).alias("node"))
    nodes_of = land(own.select(ROW, "n", "digest").join(equal, "digest", "left").select(
        ROW, "n", F.coalesce("node", ROW).alias("node")), "nodes")
    copies = land(nodes_of.filter(f"node <> {ROW} OR n = 0").select(ROW), "copies")
    nodes = own.select(ROW, "n", "sketch", "detail")

    links = _Links(texts, size, percent)
    open_ = marks = marked = None
    rows_before = float("inf")
    while True:
        mine = texts.select(ROW, "text")
        if open_ is None:
            mine = drop_rows(mine, copies, ROW)
        else:
            mine = mine.join(F.broadcast(open_) if small_enough(open_) else open_, ROW, "left_semi")
        members = _round(mine, nodes, links, _Sizes(counters, marked, weak, tasks, hot_above, size, percent, few))
        mixed, known = _mixed(members, links, block)
        open_ = land(known.select(ROW).distinct(), "open")
        left = open_.join(nodes, ROW).agg(F.count("*").alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
        meetings = mixed.agg(F.coalesce(F.sum("meetings"), F.lit(0.0)).alias("n")).first()["n"]
        # Another round costs some work for each word, the blocks some for each pair; results are the same.
        if meetings <= meetings_per_word * left["words"] or 2 * left["rows"] > rows_before:
            break
        marks = _with_marks(marks, mixed.select("part"))
        marked = spark.sparkContext.broadcast(marks)
        rows_before, tasks = left["rows"], int(left["words"] // PARTS_PER_TASK) + 1
    links.check(_remaining_pairs(known, nodes, percent))

    placed = land(links.labelled(nodes_of, "node", "label").join(rows.select(ROW, "id"), ROW).select(ROW, "id", "n", "label"), "placed")
    best = placed.groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", ROW)).alias("best"))
    return placed.join(best, "label").select(
        "id", F.col("n").cast("bigint").alias("n_shingles"), F.col("best.id").alias("component_id"),
        (F.col(ROW) == F.col(f"best.{ROW}")).alias("kept"), ROW)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near duplicates, all its columns as they were.

    Nulls, ties and repeated rows are treated as in ``near_duplicates``.
    """
    rows, row = numbered(docs, "jaccard-docs")
    gone = land(near_duplicates(rows, id_col, text_col, row).filter("NOT kept").select(ROW), "near-copies")
    return without(rows, row, gone)
