"""The prefix trie against a dictionary of every beginning of every rebuilt conversation."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from feedmetrics.llm import conversation_trie as op

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows, family=20, heads=4):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    if not family:
        return own
    out = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % family) * (1 if c > 0 else -1)
        out[c] = own.get(base, [])[:h] + said[h:]
    return out


def expected(rows, family=20):
    members, ends = defaultdict(list), defaultdict(list)
    for c, said in rebuilt(rows, family).items():
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
        ends[tuple(said)].append(c)
    children = defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    saved, leaves = defaultdict(int), defaultdict(int)
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * (len(k[-1][1].encode().split()) if k else 0)
            leaves[k[:d]] += not children[k]
    return sorted(
        (min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
         hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest())
        for k, m in members.items())


def got(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, rows, slices=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(slices, F.xxhash64("text", "turn"))


def random_rows(seed, convs=120, low=0):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(low, low + 3 * convs), convs):
        for t in range(rng.choice([1, 1, 2, 3, 5])):
            rows.append((c, rng.choice([t, t, 1]), rng.choice(["user", "assistant"]), rng.choice(["a b", "a b", "c", "", " x  y\x0bz é"])))
    return rows


@pytest.mark.parametrize("seed, low", [(1, 0), (2, -180), (3, 10**12)])
def test_random_conversations(spark, seed, low):
    rows = random_rows(seed, low=low)
    assert got(op.report(op.prefixes(frame(spark, rows), op.FAMILY))) == expected(rows)


def test_without_families(spark):
    rows = random_rows(4)
    assert got(op.report(op.prefixes(frame(spark, rows)))) == expected(rows, None)


EDGE = [
    (1, 0, "user", "hi there"), (1, 1, "assistant", None), (2, None, None, "hi"), (2, 0, "user", "hi"), (2, 0, "assistant", "hi"),
    (3, 0, "user", "hi there"), (3, 0, "user", "hi there"), (21, 0, "user", "only one"), (23, 5, "user", "x"), (23, None, "user", "y"),
    (None, 0, "user", "nobody's"), (40, None, None, None), (41, 0, "a", "bc"), (42, 0, "ab", "c"), (-1, 0, "user", "neg"), (-20, 0, "user", "base"),
    (-21, 0, "user", "neg"), (-21, 1, "user", "neg"),
]


def test_nulls_ties_repeats_and_turnless(spark):
    rows = got(op.report(op.prefixes(frame(spark, EDGE), op.FAMILY)))
    assert rows == expected(EDGE)
    assert any(not said for said in rebuilt(EDGE).values())


def test_empty_table_and_other_columns(spark):
    assert got(op.report(op.prefixes(frame(spark, []), op.FAMILY))) == []
    assert got(op.report(op.prefixes(frame(spark, [r for r in EDGE if r[0] is None]), op.FAMILY))) == []
    clash = frame(spark, EDGE).withColumns({n: F.lit("x") for n in ("base", "conv", "node", "parent", "depth", "ends", "segment")})
    assert got(op.report(op.prefixes(clash, op.FAMILY))) == expected(EDGE)


def test_long_conversations_and_many_copies(spark, monkeypatch):
    """Sequences over several segments, end lists over several pieces, and parents of many children."""
    monkeypatch.setattr(op, "SEGMENT", 8)
    monkeypatch.setattr(op, "CHUNK_BITS", 3)
    monkeypatch.setattr(op, "FLUSH", 16)
    long = [(0, t, "user", f"t{t}") for t in range(100)] + [(5, t, "user", f"t{t}") for t in range(60)]
    copies = [(c, t, "user", f"same {t}") for c in range(100, 160) for t in range(2)]
    rows = long + copies + [(c, t, "user", ["same 0", f"own {c}"][t]) for c in range(200, 260) for t in range(2)]
    assert got(op.report(op.prefixes(frame(spark, rows), None))) == expected(rows, None)
    assert got(op.report(op.prefixes(frame(spark, rows), op.FAMILY))) == expected(rows)


def test_parents_of_many_children(spark):
    rows = [(c, t, "user", ["same", f"own {c}"][t]) for c in range(1500) for t in range(2)]
    assert got(op.report(op.prefixes(frame(spark, rows)))) == expected(rows, None)
