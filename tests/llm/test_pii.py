"""Spans against the plain patterns, and the spans that anchors add."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from feedmetrics.llm import pii as op

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
        return 12 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    kinds = list(PATTERNS)
    found = sorted((m.start(), i, m.end()) for i, k in enumerate(kinds) for m in re.finditer(PATTERNS[k], text) if holds(k, m.group()))
    return [(kinds[i], a, b) for a, i, b in found]


def spans(text, find=op.Finder()):
    raw = text.encode()
    return [(s["kind"], s["start"], s["stop"]) for s in op.code_points(raw, find(raw))]


@pytest.mark.parametrize("signs, length", [
    ("a@.-é1", 14), ("0123 -", 40), ("01.2", 24), ("+12 ().-5", 30), ("a@.1+ -é5(", 30), ("0 -", 40), ("+1", 12), ("ab@.(at)[dot] ", 40),
    ("é@.a𝄞", 12), ("25.", 20)])
def test_base_spans_are_those_of_the_patterns(signs, length):
    rng = random.Random(signs)
    for _ in range(4000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, length)))
        assert [s for s in spans(text) if s[0] in PATTERNS] == base(text), text


@pytest.mark.parametrize("text, kind, span", [
    ("ask josé@exämple.com now", "wide_email", "josé@exämple.com"),
    ("“x@y.zä” quoted", "wide_email", "x@y.zä"),
    ("joe (at) site (dot) org.", "hidden_email", "joe (at) site (dot) org"),
    ("joe[AT]site.example.org", "hidden_email", "joe[AT]site.example.org"),
    ("see https://bob:pw@host.io/x", "login", "https://bob:pw@host.io"),
    ("IBAN: DE89 3704 0044 0532 0130 00 account", "account", "DE89 3704 0044 0532 0130 00"),
    ("iban GB82WEST12345698765432", "account", "GB82WEST12345698765432"),
    ("Account no. 1234-5678.", "account", "1234-5678"),
])
def test_added_spans(text, kind, span):
    assert (kind, text.index(span), text.index(span) + len(span)) in spans(text)


@pytest.mark.parametrize("text", [
    "no data here", "https://host.io/a@b", "IBAN DE88 3704 0044 0532 0130 00 x", "account of 2024", "(at) home", "a (at) b", "“@”", "://@", "é@é"])
def test_nothing_added(text):
    assert [s for s in spans(text) if s[0] not in PATTERNS] == []


@pytest.mark.parametrize("unit", [
    "a", "1", "1.", "a@", "+1", "@", "1 ", "a.", "iban ", "é@", "(at)", "x://", "a@b.c@", "account: ", "+1 (", "1-", "https://a", "ébc@é.é ", "é"])
def test_time_grows_with_the_length(unit):
    started = time.monotonic()
    spans(unit * (500_000 // len(unit)))
    assert time.monotonic() - started < 20


ROWS = [
    (1, None), (2, ""), (3, "mail é a.b@c.de and +49 (0)30 1234567, 10.0.0.1"), (3, "again 4111 1111 1111 1111"), (None, "x@y.zz"),
    (4, "z " * 100_000 + "q@r.st"), (5, "x@y.zz"), (6, "256.1.1.1 and 1.2.3.4.5.6.7.8"), (7, "joe (at) site (dot) org 4111111111111111"),
]


def test_report(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumns({"id": F.lit(0), "spans": F.lit("own"), "kind": F.lit("k")})
    want = []
    for doc, text in ROWS:
        found = base(text or "")
        counts = [sum(k == kind for k, _, _ in found) for kind in PATTERNS]
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        every = ",".join(f"{k}:{a}:{b}" for k, a, b in spans(text or ""))
        want.append((doc, *counts, hashlib.sha256(listed.encode()).hexdigest(), every))
    rows = op.report(op.find(docs.repartition(3, F.xxhash64("text"))))
    assert rows.columns == ["id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(want, key=str)
    assert op.report(op.find(docs.limit(0))).collect() == []


def test_query(spark):
    """The whole registered query against the patterns."""
    from feedmetrics.llm import queries

    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = queries.op13_pii(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        found = base(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(k == f[0] for f in found) for k in PATTERNS]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest()
        assert r["spans"] == ",".join(f"{k}:{a}:{b}" for k, a, b in spans(texts[r["doc_id"]]))
    assert sum(r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] for r in rows) > 0
