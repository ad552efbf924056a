"""Packing: token ids, places, and the number of sequences."""

import os
import random
import subprocess
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedmetrics.llm import configurations, lm_score, packing
from feedmetrics.llm.shingles import lowered_words
from feedmetrics.llm.tokens import WordTokens

SIGNS = [
    "a", "B", "the", "é", "É", "İ", "Σ", "ŉ", "ǅ", "µ", "×", " ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x85", "\xa0", " ", "　", "́",
    "'s", "'", "1", "!", "...", "<|endoftext|>", "<|startoftext|>", "<|", "日", "😀", "​", "﻿", "ﬁ", "\x00", "ß", "_", "²"]


@pytest.mark.parametrize("path,prefix,plain", [(packing.vocabulary(), "", False), (lm_score.vocabulary(), " ", True)])
def test_words_have_the_tokenizers_own_ids(path, prefix, plain):
    rng = random.Random(1)
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 14))) for _ in range(4000)] + [None, ""]
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = plain
    own = WordTokens(path, prefix, plain)
    got = [ids for a in range(0, len(texts), 7) for ids in own.encode_all(texts[a: a + 7])]
    for text, ids in zip(texts, got):
        if prefix:
            words = lowered_words(text)
            want = [i for w in words for i in tokenizer.encode(prefix + w.decode(), add_special_tokens=False).ids]
        else:       # white space never joins words, so the text as a whole has the same ids
            want = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert list(ids) == want


def test_a_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr("feedmetrics.llm.tokens.CACHED_WORDS", 50)
    texts = [f"word{i} and word{i % 7}" for i in range(300)]
    fresh = WordTokens(packing.vocabulary())
    small = [list(x) for a in range(0, 300, 9) for x in fresh.encode_all(texts[a: a + 9])]
    assert len(fresh.keys) <= 50
    tokenizer = Tokenizer.from_file(packing.vocabulary())
    assert small == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def histogram(seed, n, capacity):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(rng.lognormal(np.log(capacity / 6), 1.1, n).astype(int) + 1, capacity)
    return dict(Counter(lengths.tolist()))


@pytest.mark.parametrize("seed,n,capacity", [(0, 0, 64), (1, 1, 64), (2, 30, 64), (3, 500, 100), (4, 20_000, 2048), (5, 3_000_000, 2048)])
def test_pack_keeps_all_items_and_wastes_little(seed, n, capacity):
    counts = histogram(seed, n, capacity)
    runs = configurations.pack(counts, capacity)
    held = Counter()
    for run in runs:
        assert run.bins > 0 and 0 < sum(run.lengths) <= capacity
        for s in run.lengths:
            held[s] += run.bins
    assert held == Counter(counts)
    least = -(-sum(s * c for s, c in counts.items()) // capacity)
    assert sum(r.bins for r in runs) <= least * 1.003 + 3
    assert len(runs) < 6 * capacity


def test_few_sizes_finds_the_optimum():
    # Sizes 6, 4, 3 in bins of 12: 6+6, 4+4+4 and 3+3+3+3 leave nothing over.
    chosen = configurations.few_sizes(np.array([6, 4, 3]), np.array([200, 300, 400]), 12)
    assert sum(n for n, _ in chosen) == 300
    assert (sum(n * p for n, p in chosen) == [200, 300, 400]).all()


ROWS = [(1, "one two three"), (2, None), (3, ""), (4, "word " * 5000), (4, "word " * 5000), (None, "null id"), (6, "é" * 3000), *((10 + i, f"text {i} " * (i % 90)) for i in range(400))]


@pytest.mark.parametrize("capacity", [2048, 100])
def test_places(spark, capacity):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(6).withColumn("rank", F.lit("clash"))
    rows = packing.pack_documents(docs, capacity=capacity, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(packing.vocabulary())
    want = Counter()
    for doc, text in ROWS:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for k, start in enumerate(range(0, len(ids), capacity)):
            want[doc, k, start, tuple(ids[start: start + capacity])] += 1
    assert Counter((r["id"], r["piece"], r["start"], tuple(r["ids"])) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    least = -(-sum(r["length"] for r in rows) // capacity)
    assert len(sequences) <= least * 1.02 + 2


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_a_tokenizer_keeps_only_its_own_memory():
    """What reading the vocabulary took beyond the tokenizer goes back to the machine."""
    held = """
import re, sys
sys.path.insert(0, sys.argv[1])
from feedmetrics.llm import packing
from feedmetrics.llm.shingles import released
from feedmetrics.llm.tokens import WordTokens
def mb():
    return sum(map(int, re.findall(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024
list(released(iter([])))
before = mb()
tokens = WordTokens(packing.vocabulary())
after = mb()
list(released(iter([])))
print(after - before, after - mb())
"""
    if not os.path.exists("/proc/self/smaps_rollup"):
        pytest.skip("no figures of memory here")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", held, root], capture_output=True, text=True, check=True).stdout.split()
    assert float(out[1]) < 10, out
