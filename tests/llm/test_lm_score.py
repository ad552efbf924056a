"""Language-model scores: counts, windows, and what the model makes of held-out texts."""

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from feedmetrics.llm import attention, lm_score, tokens
from feedmetrics.llm.shingles import lowered_words
from feedmetrics.llm.tokens import WordTokens

SF = "/root/testdata/sf0.01"


def held_out(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def expected(rows):
    """base_score and counts by the formula."""
    counts = Counter()
    for doc, text in rows:
        if not held_out(doc):
            counts.update([*lowered_words(text), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc, text in rows:
        tokens = [*lowered_words(text), None]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        out.append((doc, held_out(doc), len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 4)))
    return sorted(out, key=str)


def got(result):
    return sorted([(r["id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in result], key=str)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    result = lm_score.lm_score(docs).collect()
    assert got(result) == expected([(r["doc_id"], r["text"]) for r in docs.collect()])
    out = [r for r in result if r["held_out"]]
    assert all(r["score"] < 0 for r in result)
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_rare_words_and_edges(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "COMMON_WORDS", 5)
    rows = [(i, f"the cat {i} sat on The mat w{i % 3}") for i in range(60)] + [
        (None, "the null id"), (70, None), (71, ""), (71, ""), (72, " \n"), (73, "new words only é😀"), (74, "the " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash")).repartition(3)
    result = lm_score.lm_score(docs).collect()
    assert got(result) == expected(rows)
    empty = {r["score"] for r in result if r["id"] in (70, 71, 72)}
    assert len(empty) == 1


def test_empty_table(spark):
    assert lm_score.lm_score(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    alone = lm_score.lm_score(spark.createDataFrame([(2, "x")], "doc_id long, text string")).collect()
    assert len(alone) == 1 and np.isfinite(alone[0]["score"])


def test_windows_score_each_id_once():
    rng = np.random.default_rng(0)
    sizes = np.array([0, 1, 5, 11, 12, 13, 40, 0, 100])
    ids = rng.integers(0, 900, sizes.sum())
    read, predict, used = attention.windows(ids, sizes, 901, 902)
    aims = predict.ravel()[used]
    want, texts = [], np.split(ids, np.cumsum(sizes)[:-1])
    for t in texts:
        want += [*t, 901]
    assert aims.tolist() == want
    # every prediction sees at least CONTEXT ids before it, or all of its text
    rows, places = used // attention.SCORED, used % attention.SCORED
    k = 0
    for t in texts:
        line = [901, *t]
        for i in range(len(line)):
            seen = [x for x in read[rows[k], : attention.CONTEXT + 1 + places[k]] if x != 902]
            assert seen == line[: i + 1][-len(seen):] and len(seen) >= min(i + 1, attention.CONTEXT + 1)
            k += 1


def tiny(seed=0):
    rng = np.random.default_rng(seed)
    tokens = WordTokens(lm_score.vocabulary(), " ", True)
    size = 50_258
    starts = np.zeros(size, bool)
    names = tokens.tokenizer.get_vocab()
    starts[[i for n, i in names.items() if n.startswith("Ġ")]] = True
    docs = [" ".join(rng.choice(["red", "green", "blue", "unseenword"], 30)) for _ in range(40)]
    encoded = [x.astype(np.int64) for x in tokens.encode_all(docs)]
    stream = np.concatenate([x for e in encoded for x in (e, [size - 1])])
    model = attention.initial(size, attention.cluster(stream, starts, size - 1))
    read, predict, _ = attention.windows(np.concatenate(encoded), np.array([len(e) for e in encoded]), size - 1, size)
    attention.train(model, read, predict)
    counts = np.ones(size + 1)
    model.inside = np.log10(counts / np.bincount(model.classes, counts, attention.CLASSES)[model.classes]).astype(np.float32)
    model.inside[size - 1] = 0
    return tokens, attention.Scorer(model), size - 1


def test_word_chances_add_up_to_the_texts():
    """Chances of words, given that words end, multiply to the chance of all ids."""
    tokens, scorer, end = tiny()
    text = tokens.read(["red unseenword, green"])
    words = lm_score.in_context(text, tokens, scorer, end)
    ids, sizes = tokens.encode_words(text)
    read, predict, used = attention.windows(ids, np.array([len(ids)]), end, scorer.pad)
    chance, border = (x.ravel()[used] for x in scorer(read, predict))
    assert len(words) == 4
    assert abs(words.sum() - (chance.sum() - border[0])) < 1e-3


def test_a_texts_score_does_not_depend_on_its_neighbours():
    tokens, scorer, end = tiny()
    texts = ["red " * 50, "", None, "unseenword blue", "Green " * 7]
    together = lm_score.in_context(tokens.read(texts), tokens, scorer, end)
    alone = np.concatenate([lm_score.in_context(tokens.read([t]), tokens, scorer, end) for t in texts])
    assert np.allclose(together, alone, atol=1e-4)


def test_plain_words_are_merged_without_the_tokenizer():
    """Latin words, numbers and marks get the tokenizer's ids by merges of all of them at once; others are left to it."""
    path = lm_score.vocabulary()
    fast, slow = (WordTokens(path, " ", True, m) for m in (tokens.ByteMerges.of(path), None))
    rng = np.random.default_rng(2)
    signs = ["a", "e", "the", "ing", "tion", "Q", "é", "ß", "ı", "ɏ", "zz", "aaa", "0", "17", "2024", "!", "...", "&%", "_", "-", " ", "\n"]
    plain = ["".join(rng.choice(signs, n)) for n in rng.integers(0, 30, 600)]
    for texts in (plain, ["x"], ["é ß"], ["", None]):
        ids, sizes = fast.encode_words(fast.read(texts))
        assert "tokenizer" not in vars(fast)
        want, amounts = slow.encode_words(slow.read(texts))
        assert ids.tolist() == want.tolist() and sizes.tolist() == amounts.tolist()
    odd = [*signs, "'", "'s", "×", "÷", "İ", "ɐ", "日本", "😀", "\u0301", "\u00a0", "\u2003", "\x00", "\x1c", "²", "<|endoftext|>", "a" * 70]
    for texts in [["".join(rng.choice(odd, n)) for n in rng.integers(0, 30, 300)], ["'"], ["日"], ["b" * 3000]]:
        ids, sizes = fast.encode_words(fast.read(texts))
        want = [slow.tokenizer.encode(" " + w.decode(), add_special_tokens=False).ids for t in texts for w in lowered_words(t)]
        assert ids.tolist() == [i for own in want for i in own] and sizes.tolist() == [len(own) for own in want]
    import public_tokenizers

    assert tokens.ByteMerges.of(public_tokenizers.path("word_bpe_49k.json")) is None


def single_words(amount):
    """Words that are one id each, with their ids."""
    names = WordTokens(lm_score.vocabulary(), " ", True).tokenizer.get_vocab()
    words = sorted((n[1:], i) for n, i in names.items() if n[0] == "Ġ" and len(n) > 3 and n[1:].isascii() and n[1:].isalpha() and n[1:].islower())
    return words[:amount]


def trained_model(spark, texts, parts=2, **more):
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(parts)
    return lm_score.train(df, **more)[0].scorer.model


def moved(model):
    before = attention.initial(model.pad, model.classes).p["e"]
    return set(np.flatnonzero((model.p["e"] != before).any(1)).tolist())


def test_whole_documents_are_learned(spark):
    (first, a), (last, z) = single_words(2)
    model = trained_model(spark, [f"{first} {'red green ' * 700} {i} {last}" for i in range(20)])
    assert {a, z} <= moved(model)


def test_learned_documents_and_classes_follow_the_input(spark, monkeypatch):
    words = single_words(400)
    texts = [" ".join([w] * 3) for w, _ in words]
    monkeypatch.setattr(lm_score, "TRAINED_SHARE", 2, raising=False)
    model = trained_model(spark, texts, sample_docs=5)
    assert len(moved(model) & {i for _, i in words}) > 100
    # ids of all documents have a class by their company, whatever the part that is trained on
    monkeypatch.setattr(lm_score, "TRAINED_SHARE", 400)
    for parts in (1, 3):
        few = trained_model(spark, texts, parts, sample_docs=5)
        assert (few.classes[[i for _, i in words]] != attention.WORD_CLASSES).all()
        assert (few.classes == model.classes).all()


def test_copies_leave_room_for_other_texts(spark):
    words = single_words(60)
    texts = [" ".join([w] * 3) for w, _ in words] + [f"{words[0][0]} copied"] * 2000
    assert len(moved(trained_model(spark, texts, sample_docs=60)) & {i for _, i in words}) > 30


def test_every_training_text_is_learned(spark, monkeypatch):
    words = single_words(400)
    texts = [" ".join([w] * 3) for w, _ in words]
    for parts in (1, 3):
        assert {i for _, i in words} <= moved(trained_model(spark, texts, parts, sample_docs=5))
    # and every text's tokens count for the weights of the mixture
    tallies, fit = [], lm_score._fit_weights
    monkeypatch.setattr(lm_score, "_fit_weights", lambda tally: tallies.append(tally) or fit(tally))
    monkeypatch.setattr(lm_score, "COMMON_WORDS", 40)
    rows = [(i, f"{t} {texts[i % 7]}") for i, t in enumerate(texts)] + [(None, None), (900, "")]
    result = lm_score.lm_score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    learned = [(d, t) for d, t in rows if not held_out(d)]
    once = sum(n == 1 for n in Counter(w for _, t in learned for w in lowered_words(t)).values())
    assert sum(tallies[-1].values()) == result[0]["train_tokens"] == sum(len(lowered_words(t)) + 1 for _, t in learned)
    assert tallies[-1].get(lm_score.UNKNOWN, 0) == once


def test_steps_follow_the_gradient():
    """A step's first move, which Adam makes by the gradient's sign, against differences of the loss."""
    rng = np.random.default_rng(5)
    model = attention.initial(40, np.concatenate([rng.integers(1, attention.CLASSES, 39), [0, 0]]))
    read, predict, used = attention.windows(rng.integers(0, 39, 60), np.array([7, 0, 53]), 39, 40)

    def loss(p):
        m = attention.Attention(p, model.classes, model.inside, model.pad)
        return -attention.Scorer(m)(read, predict)[0].ravel()[used].astype(float).mean() * math.log(10)

    before = {k: v.copy() for k, v in model.p.items()}
    attention.Training(model).step(read, predict, 1e-3)
    for name, v in before.items():
        move = model.p[name] - v
        for at in rng.permutation(np.argwhere(move != 0))[:12].tolist():
            up, down = ({k: x.copy() for k, x in before.items()} for _ in range(2))
            up[name][tuple(at)] += 0.02
            down[name][tuple(at)] -= 0.02
            slope = (loss(up) - loss(down)) / 0.04
            assert abs(slope) < 2e-4 or np.sign(slope) == -np.sign(move[tuple(at)]), (name, at)


def test_neighbours_are_counted_inside_texts():
    rng = np.random.default_rng(1)
    sizes = np.array([0, 1, 2, 9, 0, 30])
    ids = rng.integers(0, 20, sizes.sum())
    near = attention.Neighbours(21, 20)
    for texts in (slice(0, 3), slice(3, 6)):        # two calls, as chunks do
        near.add(np.split(ids, np.cumsum(sizes)[[2]])[texts.start > 0], sizes[texts])
    place, want = attention.neighbour_places(21), Counter()
    for t in np.split(ids, np.cumsum(sizes)[:-1]):
        line = [20, *t, 20]
        for i, x in enumerate(line):
            want[x, 0] += 1
            for k, step in enumerate(attention.BESIDE):
                if 0 <= i + step < len(line):
                    want[x, 1 + k * attention.BUCKETS + place[line[i + step]]] += 1
    width = 1 + len(attention.BESIDE) * attention.BUCKETS
    assert {(c // width, c % width): n for c, n in zip(*(x.tolist() for x in near.cells()))} == want


def test_unknown_words_cost_more_than_known_ones(spark):
    rng = np.random.default_rng(3)
    usual = [w for w, _ in single_words(300)]
    make = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n))      # noqa: E731
    learned = [i for i in range(400) if not held_out(i)]
    fluent, junk = [i for i in range(400, 500) if held_out(i)][:2]
    rows = [(i, " ".join([*rng.choice(usual, 30), make(9), make(9)])) for i in learned]
    rows += [(fluent, " ".join(rng.choice(usual, 30))), (junk, " ".join(make(9) for _ in range(30)))]
    scores = {r["id"]: r["score"] for r in lm_score.lm_score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert scores[junk] < 1.2 * scores[fluent]
