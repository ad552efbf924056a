"""Folding of event logs, and the template read back."""

import hashlib
import random

from feedmetrics.llm import chat_format as op

SCHEMA = "conv_id long, seq long, message long, role string, kind string, text string"


def folded(spark, events):
    return sorted(tuple(r) for r in op.fold(spark.createDataFrame(events, SCHEMA)).collect())


def test_deltas_edits_and_regenerations(spark):
    events = [
        (1, 2, 0, None, "delta", "lo"), (1, 1, 0, "user", "delta", "hel"),
        (1, 3, 1, "assistant", "delta", "first"), (1, 4, 2, "user", "delta", "and?"), (1, 5, 3, "assistant", "delta", "so"),
        (1, 6, 1, None, "regenerate", "second"), (1, 7, 1, None, "delta", " try"),      # takes back messages 2 and 3
        (1, 8, 4, "user", "delta", "thanks"), (1, 9, 0, None, "edit", "hi"),
        (2, 1, 0, "user", None, None), (2, 2, 0, None, "strange", "x"),
    ]
    assert folded(spark, events) == [
        (1, 0, "user", "hi"), (1, 1, "assistant", "second try"), (1, 4, "user", "thanks"), (2, 0, "user", "x")]


def reference(events):
    """The same, one event after another."""
    out = {}
    for conv, _, message, role, kind, text in sorted(events):
        log = out.setdefault(conv, {})
        if kind == "regenerate":
            for later in [m for m in log if m > message]:
                del log[later]
        entry = log.setdefault(message, [role, ""])
        entry[1] = text if kind in ("edit", "regenerate") else entry[1] + text
    return sorted((c, m, r, t) for c, log in out.items() for m, (r, t) in log.items())


def test_fold_of_random_logs(spark):
    rng = random.Random(3)
    events = []
    for conv in range(25):
        top = 0
        for seq in range(rng.randint(1, 30)):
            message = rng.randint(max(0, top - 2), top)
            kind = rng.choice(["delta", "delta", "delta", "edit", "regenerate"])
            live = {m for c, m, _, _ in reference(events) if c == conv}
            if message not in live:         # a message taken back is gone; a new one follows
                top += 1
                message, kind = top, "delta"
            events.append((conv, seq, message, "user" if message % 2 else "assistant", kind, f"{seq}."))
    assert folded(spark, events) == reference(events)


TEXTS = [
    "", None, "plain", "</s>[INST] ok [/INST]", "\\", "\\l\\b[ROLE x] [/ROLE]", "<s>", "a\nb\t", "[INST]", " [/INST]", "\\\\c]<", "日本 é😀", "x" * 100_000]


def test_round_trip(spark):
    rng = random.Random(5)
    rows = []
    for conv in [None, *range(30)]:
        for turn in range(rng.randint(1, 6)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "</s>", "[ROLE user]", "", None]), rng.choice(TEXTS)))
    rows += [(99, 0, "user", "same"), (99, 0, "user", "same"), (98, None, "user", "no turn"), (98, 1, "assistant", "answer")]
    rows += [(97, t, "user" if t % 2 else "assistant", f"long {t}") for t in range(3000)]
    chats = op.format_chats(op.events_of_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    want = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")):
        want.setdefault(conv, []).append((role or "", text or ""))
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chats.collect()}
    assert got == want
    for r in op.digests(chats).collect():
        turns = want[r["conv_id"]]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(loss)
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()


def test_empty_log(spark):
    assert op.format_chats(spark.createDataFrame([], SCHEMA)).collect() == []
