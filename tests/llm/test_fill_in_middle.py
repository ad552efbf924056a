"""Fill-in-the-middle texts against slices of the text, and the way back."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedmetrics.llm import fill_in_middle as op

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = st.text(alphabet="ab <>PSM\t\né𝄞", max_size=30)
ROWS = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "has <M> inside"), (6, "é 𝄞  über all\n"), (7, "x " * 60_000),
    (7, "same id, other text"), (None, "no id at all"), (8, "a <P b> c"), (9, "y" * 200_000), (10, "same"), (10, "same"), (-3, "below nothing"),
] + [(i, f"word {i} and more  words\nfollow {i} ") for i in range(20, 60)]


def expected(doc, text, seed=42):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[i: i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return doc, len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "spm" if h[3] % 100 < 80 else "psm"
    return doc, len(units), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3, F.xxhash64("text"))


def key(row):
    return str(row)


def test_transform(spark):
    rows = [tuple(r) for r in op.transform(frame(spark)).collect()]
    assert sorted(rows, key=key) == sorted((expected(*r) for r in ROWS), key=key)
    assert {r[2] for r in rows} == {"plain", "psm", "spm"}


def test_restore_needs_output_and_form_only(spark):
    made = op.transform(frame(spark)).withColumns({"restored": F.lit("own"), "__made": F.lit(1), "__form": F.lit("x")})
    back = op.restore(made.select("id", "output", "form", "restored", "__made", "__form"))
    assert back.columns == ["id", "output", "form", "__made", "__form", "restored"]
    assert sorted((r["id"] or 0, r["restored"]) for r in back.collect()) == sorted((d or 0, t or "") for d, t in ROWS)


def test_digests(spark):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = sorted([(*expected(*r)[:5], sha(expected(*r)[5]), sha(r[1] or "")) for r in ROWS], key=key)
    assert sorted([tuple(r) for r in op.digests(op.transform(frame(spark))).collect()], key=key) == want


def test_other_shares_and_seed(spark):
    forms = {r["form"] for r in op.transform(frame(spark), fim_percent=100, spm_percent=0, seed=7).filter("n > 2").collect()}
    assert forms == {"plain", "psm"}        # plain: a text that holds a sentinel
    assert {r["form"] for r in op.transform(frame(spark), fim_percent=0).collect()} == {"plain"}


def test_empty_table_and_other_columns(spark):
    empty = op.digests(op.transform(frame(spark, [])))
    assert empty.collect() == [] and "restored_sha256" in empty.columns
    docs = frame(spark).withColumns({"id": F.lit("a"), "form": F.lit("b"), "output": F.lit("c"), "n": F.lit(1), "digest": F.lit(2)})
    assert op.transform(docs).count() == len(ROWS)
    named = frame(spark).select(F.col("doc_id").cast("string").alias("my id"), F.col("text").alias("my.text"))
    assert op.transform(named, "my id", "my.text").schema["id"].dataType.simpleString() == "string"


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(0, 40), st.integers(0, 40), st.sampled_from(["psm", "spm", "plain"]))
def test_round_trip(text, a, b, form):
    raw = text.encode()
    assert op.unit_ends(raw).tolist() == [len(text[: m.end()].encode()) for m in UNIT.finditer(text)]
    a, b = sorted((min(a, len(raw)), min(b, len(raw))))
    if not any(s in raw for s in op.SENTINELS):
        assert op.rearranged(op.arranged(raw, a, b, form), form) == raw


@pytest.mark.parametrize("cut", [(0, 0, 0), (0, 2, 5), (2, 2, 4), (1, 4, 4)])
def test_rotation(cut):
    start, middle, stop = cut
    buffer = bytearray(b"abcdef")
    op.rotate(buffer, start, middle, stop)
    assert bytes(buffer) == b"abcdef"[:start] + b"abcdef"[middle:stop] + b"abcdef"[start:middle] + b"abcdef"[stop:]
