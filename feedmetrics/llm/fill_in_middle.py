"""Fill-in-the-middle documents by rotating blocks in place, and the way back.

A text's bytes are scanned for its units, two cuts are chosen, and a sentinel is put before each of
the three segments. The order of the segments is then changed inside the buffer: two neighbouring
blocks change places by three reversals. Going back, the inverse rotations bring the segments into
their old order and the sentinels are taken out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import released, slices, WHITE
from .store import small_batches, unused_name

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
PLAIN, PSM, SPM = "plain", "psm", "spm"
FIM_PERCENT, SPM_PERCENT, SEED = 50, 80, 42
FLUSH_BYTES = 1 << 22           # written texts that a task holds at a time


def rotate(buffer: bytearray, start: int, middle: int, stop: int) -> None:
    """Blocks ``[start, middle)`` and ``[middle, stop)`` change places inside the buffer."""
    for a, b in ((start, middle), (middle, stop), (start, stop)):
        buffer[a:b] = buffer[a:b][::-1]


def unit_ends(text: bytes) -> np.ndarray:
    """Where the units end: a word with the white space before it, and white space that ends the text."""
    gap = WHITE[np.frombuffer(text, np.uint8)]
    if not len(gap):
        return np.zeros(0, np.int64)
    ends = np.flatnonzero(~gap & np.append(gap[1:], True)) + 1
    return np.append(ends, len(gap)) if gap[-1] else ends


def code_points(text: bytes, start: int, stop: int) -> int:
    signs = np.frombuffer(text, np.uint8)[start:stop]
    return int(np.count_nonzero((signs & 0xC0) != 0x80))


def arranged(text: bytes, prefix_end: int, middle_end: int, form: str) -> bytes:
    """The text with its segments marked, in the order that ``form`` asks for."""
    if form == PLAIN:
        return text
    buffer = bytearray(text)
    buffer[middle_end:middle_end] = SUFFIX
    buffer[prefix_end:prefix_end] = MIDDLE
    buffer[0:0] = PREFIX
    middle, suffix = prefix_end + len(PREFIX), middle_end + len(PREFIX) + len(MIDDLE)
    rotate(buffer, 0 if form == SPM else middle, suffix, len(buffer))
    return bytes(buffer)


def rearranged(output: bytes, form: str) -> bytes:
    """The text that ``arranged`` was given, from what it wrote.

    The text holds no sentinel, and none can begin inside another or inside the text and end in
    a sentinel, so each is found where it was put.
    """
    if form == PLAIN:
        return output
    buffer = bytearray(output)
    middle = buffer.find(MIDDLE)
    if form == SPM:
        suffix = len(buffer) - buffer.find(PREFIX)      # where the suffix begins once it is back at the end
        rotate(buffer, 0, len(buffer) - suffix, len(buffer))
        middle -= len(buffer) - suffix
    else:
        suffix = buffer.find(SUFFIX)
        length = len(buffer) - middle
        rotate(buffer, suffix, middle, len(buffer))
        suffix, middle = suffix + length, suffix
    for at in (suffix, middle, 0):                      # from the end, so that earlier places hold
        del buffer[at: at + 3]
    return bytes(buffer)


def choose(text: bytes, digest: str, fim_percent: int, spm_percent: int) -> tuple[int, str, int, int]:
    """Number of units, form and the two cuts (byte places), from a text and its id's digest."""
    ends = unit_ends(text)
    n = len(ends)
    first, second, is_fim, is_spm = (int(digest[i: i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(s in text for s in SENTINELS) or is_fim % 100 >= fim_percent:
        return n, PLAIN, 0, 0
    low, high = sorted((first % (n + 1), second % (n + 1)))
    cuts = np.concatenate([[0], ends])
    return n, SPM if is_spm % 100 < spm_percent else PSM, int(cuts[low]), int(cuts[high])


def _flushed(rows: Iterator[tuple], schema: pa.Schema, held_by) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of about ``FLUSH_BYTES``."""
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += held_by(row)
        if size >= FLUSH_BYTES or len(out) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], names=schema.names)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], names=schema.names)


_MADE = pa.schema([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("made", pa.binary())])


def _transform(batches: Iterator[pa.RecordBatch], fim_percent: int, spm_percent: int) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in slices(batches, 100):
            for key, text, digest in zip(*(batch.column(i).to_pylist() for i in range(3))):
                n, form, a, b = choose(text, digest, fim_percent, spm_percent)
                chars = (None, None) if form == PLAIN else (code_points(text, 0, a), code_points(text, a, b))
                yield key, n, form, *chars, arranged(text, a, b, form)

    batches = iter(batches)
    first = next(batches, None)
    if first is None:
        return
    batches = _chained(first, batches)
    schema = pa.schema([pa.field("id", first.schema.field(0).type), *_MADE])
    yield from _flushed(rows(), schema, lambda r: len(r[-1]))


def _chained(first, rest):
    yield first
    yield from rest


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the restored bytes to rows whose last two columns are the output's bytes and its form."""
    for batch in slices(batches, 100):
        made, form = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
        back = [rearranged(m, f) for m, f in zip(made.to_pylist(), form.to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-2], pa.array(back, pa.binary())], names=[*batch.schema.names[:-2], "restored"])


def transform(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT, seed: int = SEED,
) -> DataFrame:
    """Documents as fill-in-the-middle texts: ``id, n, form, prefix_chars, middle_chars, output``.

    ``n`` counts a text's units: words with the white space before them, and white space at its end.
    The digest of seed and id picks two cuts among the units and the form: ``plain`` is the text as it
    is, ``psm`` prefix, suffix, middle, ``spm`` suffix, prefix, middle, each behind its sentinel. The
    lengths of prefix and middle are code points, null if plain.

    Null texts are empty. Empty texts and those that hold a sentinel of their own stay plain. A null
    id has the digest of the seed alone; rows that repeat an id are cut by the same draws, each at
    its own units. Long texts are worked on one at a time, whole: a few copies of one text is the
    memory a task needs. An empty table gives an empty result. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    key = F.col(f"`{id_col}`")
    rows = docs.select(
        key.alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("text"),
        F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256).alias("digest"))
    kind = rows.schema["id"].dataType.simpleString()
    made = rows.mapInArrow(
        lambda it: released(_transform(it, fim_percent, spm_percent)),
        f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, made binary")
    return made.select("id", "n", "form", "prefix_chars", "middle_chars", F.col("made").cast("string").alias("output"))


def restore(made: DataFrame, output_col: str = "output", form_col: str = "form") -> DataFrame:
    """``made`` with ``restored``, the text that each output and form came from; nothing else is read.

    All other columns stay; a column named ``restored`` is replaced. Null outputs are empty, a null
    form is plain. An empty table gives an empty result.
    """
    small_batches(made.sparkSession)
    kept = [c for c in made.columns if c.lower() != "restored"]
    rows = made.select(
        *[F.col(f"`{c}`") for c in kept],
        F.coalesce(F.col(f"`{output_col}`"), F.lit("")).cast("binary").alias(unused_name(made, "__made")),
        F.coalesce(F.col(f"`{form_col}`"), F.lit(PLAIN)).alias(unused_name(made, "__form")))
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in made.select(*[F.col(f"`{c}`") for c in kept]).schema)
    back = rows.mapInArrow(lambda it: released(_restore(it)), f"{names}, restored binary")
    return back.withColumn("restored", F.col("restored").cast("string"))


def digests(made: DataFrame) -> DataFrame:
    """Units, form, lengths and SHA-256 of outputs and of the texts restored from them."""
    return restore(made).select(
        "id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
