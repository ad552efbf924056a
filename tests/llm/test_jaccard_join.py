"""Near duplicates against all pairs of sets."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedmetrics.llm import jaccard_join as op
from feedmetrics.llm import shingles


def sets(texts, size=5):
    out = []
    for t in texts:
        w = shingles.lowered_words(t)
        out.append({tuple(w[i: i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    return out


def expected(rows, size=5, percent=75):
    own = sets([t for _, t in rows], size)
    label = list(range(len(rows)))
    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(own[i] & own[j])
            if both and 100 * both >= percent * len(own[i] | own[j]):
                label[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    out = []
    for members in groups.values():
        ids = [rows[i][0] for i in members]
        least = min((d for d in ids if d is not None), default=None)
        out += [(rows[i][0], len(own[i]), least) for i in members]
    return sorted(out, key=str)


def corpus(seed, sizes, copies=8, common=40):
    """Texts of given lengths with near copies around the threshold, and a passage that many share."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(common)]
    texts = []
    for n in sizes:
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
        if rng.random() < 0.5:
            base += passage
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                own[rng.randrange(len(own))] = f"e{rng.randint(0, 10**6)}"
            if rng.random() < 0.3:
                own = own[: rng.randint(1 + 3 * len(own) // 4, len(own))]
            texts.append(" ".join(own))
        texts.append("\t".join(base).upper())
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    return rows + [(None, texts[0]), (5, texts[1]), (5, texts[1]), (9001, None), (9002, ""), (9003, " \n"), (9004, "a b"), (9005, "A\tb"), (9006, "a")]


def got(df):
    return sorted([(r["id"], r["n_shingles"], r["component_id"]) for r in df.collect()], key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("seed,sizes,options", [
    (1, [1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 14, 20, 30, 45, 60, 62, 64, 70, 85, 90, 120, 200, 250, 256, 260, 330, 345, 500, 900], {}),
    (2, [12, 40, 66, 130, 300], {"hot_above": 3, "few": 3, "block": 4, "percent": 60}),
])
def test_against_all_pairs(spark, seed, sizes, options):
    rows = corpus(seed, sizes)
    result = op.near_duplicates(frame(spark, rows), **options)
    assert got(result) == expected(rows, percent=options.get("percent", 75))


@pytest.mark.parametrize("few", [2, 16])
def test_pairs_missed_by_the_stars(spark, few):
    """Chains: neighbours link, ends do not, and the first member of a part links to few."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[4 * i: 4 * i + 60])) for i in range(60)]
    assert got(op.near_duplicates(frame(spark, rows), few=few)) == expected(rows)


def test_word_hashes():
    words = shingles.WordHashes()
    texts = ["The cat\tsat", None, "", " \n ", "the  CAT", "é É x" * 3, "a" * 70_000 + " ab ba", "\x1fa \x85 \u00a0b"]
    hashes, counts = words(texts)
    own = [shingles.lowered_words(t) for t in texts]
    assert counts.tolist() == [len(w) for w in own]
    seen = {}
    for w, h in zip([w for ws in own for w in ws], hashes.tolist()):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    alone = np.concatenate([words([t])[0] for t in texts])
    assert (alone == hashes).all()


def test_parts_agree_as_promised():
    """Of two linked sets, the first parts in any common order share one."""
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 7, 40, 63, 64, 80, 85, 200, 255, 256, 300, 341, 1500):
        for _ in range(20):
            a = rng.integers(0, 2**63, n).astype(np.uint64)
            other = rng.integers(0, 2**63, n).astype(np.uint64)
            drop = int(rng.integers(0, n // 4 + 1))
            add = int(rng.integers(0, n // 4 + 1))
            b = np.concatenate([a[drop:], other[:add]])
            both, union = n - drop, n + add
            if not both or 100 * both < 75 * union:
                continue
            found = []
            for s in (np.unique(a), np.unique(b)):
                own = set()
                for _, _, parts, bound in op.Parts(s, np.array([len(s)])):
                    assert len(parts) > bound[0]
                    own |= set(np.sort(parts)[: bound[0] + 1].tolist())
                found.append(own)
            assert found[0] & found[1], (n, drop, add)


def test_a_parity_sketch_never_overstates():
    rng = np.random.default_rng(1)
    for n in (1, 10, 300, 2000):
        a, other = rng.integers(0, 2**62, (2, n)).astype(np.uint64)
        b = np.concatenate([a[: n - n // 8], other[: n // 8]])
        for bits in (512, op.detailed_bits(n)):
            x, y = op.parity_sketch(a, bits), op.parity_sketch(b, bits)
            assert np.bitwise_count(x ^ y).sum() <= 2 * (n // 8)
            assert (np.bitwise_xor(*np.split(op.parity_sketch(a, 2 * bits), 2)) == x).all()


def test_drop_near_duplicates(spark):
    rows = corpus(4, [30, 90, 300])
    table = frame(spark, rows).withColumns({"__row": F.lit("mine"), "label": F.lit(2)})
    out = op.drop_near_duplicates(table)
    assert out.dtypes == table.dtypes
    kept = [r["doc_id"] for r in out.collect()]
    groups = expected(rows)
    alone = sum(1 for _, n, _ in groups if n == 0)
    assert len(kept) == alone + len({c for _, n, c in groups if n})
    assert {c for _, n, c in groups if n} <= set(kept)


def test_empty_table(spark):
    assert op.near_duplicates(frame(spark, [])).collect() == []


def passages(docs, seed=9):
    """Different documents made of the same common passages, some of more than 1,000 shingles, some near copies."""
    rng = random.Random(seed)
    common = [[f"p{k}w{i}" for i in range(140)] for k in range(7)]
    rows = []
    for d in range(docs):
        own = [f"d{d}w{i}" for i in range(rng.choice([0, 40, 300, 1200]))]
        words = [w for p in rng.sample(common, rng.randint(2, 6)) for w in p] + own
        rows.append((2 * d, " ".join(words)))
        if rng.random() < 0.4:
            at = rng.randrange(len(words) - 20)
            rows.append((2 * d + 1, " ".join(words[:at] + ["changed"] * rng.choice([1, 12]) + words[at + rng.choice([0, 15]):])))
    return rows


@pytest.mark.parametrize("options", [
    {}, {"few": 2}, {"few": 2, "meetings_per_word": 0}, {"few": 4, "meetings_per_word": 0, "block": 8}, {"few": 2, "block": 3}])
def test_common_passages(spark, options):
    rows = passages(45)
    assert got(op.near_duplicates(frame(spark, rows), **options)) == expected(rows)


@pytest.mark.parametrize("options", [{"few": 2, "meetings_per_word": 0}, {"few": 2, "block": 2}])
def test_chains_over_rounds(spark, options):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[4 * i: 4 * i + 60])) for i in range(60)]
    assert got(op.near_duplicates(frame(spark, rows), **options)) == expected(rows)


def test_rows_with_rare_parts_leave_after_a_round(spark, monkeypatch):
    """What is compared in blocks does not hold documents that only share passages."""
    seen = []
    monkeypatch.setattr(op, "_remaining_pairs", lambda known, nodes, percent: seen.append(known.count()) or known.selectExpr(
        "part as a", "part as b", "0D as apart").limit(0))
    rows = [(d, " ".join([f"p{i}" for i in range(150)] + [f"d{d}w{i}" for i in range(600)])) for d in range(60)]
    op.near_duplicates(frame(spark, rows), few=2, meetings_per_word=0).collect()
    assert seen[-1] == 0


def test_pairs_are_written_once(spark):
    """Many shared parts, one row for a pair: the join that looks at pairs in blocks does not repeat them."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for d in range(40):         # about 0.6 to 0.7 alike: candidates, but not linked
        words = list(base)
        for i in rng.sample(range(200), 7):
            words[i] = f"d{d}x{i}"
        rows.append((d, " ".join(words)))
    assert got(op.near_duplicates(frame(spark, rows), few=2)) == expected(rows)


def test_words_that_polynomials_confuse():
    """The Thue-Morse word and its complement: equal under polynomials modulo a power of two, whatever the base."""
    words = shingles.WordHashes()
    for length in (256, 512, 1024, 2048, 4096):
        word = "a"
        while len(word) < length:
            word += word.translate(str.maketrans("ab", "ba"))
        both, _ = words([f"{word} {word.translate(str.maketrans('ab', 'ba'))}"])
        assert both[0] != both[1]


def test_long_words_and_every_length():
    words = shingles.WordHashes()
    own = [b"x" * n + c for n in range(0, 600) for c in (b"a", b"b")] + [b"y" * 3_000_000 + c for c in (b"", b"z")]
    hashes, counts = words([b" ".join(own).decode()])
    assert counts.tolist() == [len(own)] and len(set(hashes.tolist())) == len(own)
    assert words([own[900].decode(), " " + own[901].decode() + "\n"])[0].tolist() == hashes[900:902].tolist()
