"""Personal data in texts: anchors found by one automaton, grown into spans by small local parsers.

Aho-Corasick passes a text once and stops at the signs that such data cannot do without: at-signs,
a plus before a digit, a point between digits, six digits in a row (single spaces or hyphens
between them), schemes and cue words. A parser of each kind then looks left and right of its anchor
for the boundaries and checks what lies between. No parser reads a stretch of text more than a
fixed number of times, whatever the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import product

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shingles import LOWER_AZ, released, slices
from .store import small_batches

EMAIL, IP, CARD, PHONE = BASE_KINDS = ("email", "ip", "card", "phone")
WIDE_EMAIL, HIDDEN_EMAIL, LOGIN, ACCOUNT = MORE_KINDS = ("wide_email", "hidden_email", "login", "account")
KINDS = BASE_KINDS + MORE_KINDS

DIGITS = b"0123456789"
LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
LOCAL = LETTERS + DIGITS + b"._%+-"
WIDE = bytes(range(128, 256))           # bytes of letters beyond ASCII, and of other signs
NUMBER_SIGNS = DIGITS + b" -"
# What the automaton looks for is lower-case, and 0 stands for every digit.
FOLDED = bytes(48 if 48 <= c <= 57 else LOWER_AZ[c] for c in range(256))
CARD_WINDOW = 6

# Cue words and how an address is spelled out.
AT_WORDS = ("(at)", "[at]", "{at}")
SCHEMES = ("://",)
ACCOUNT_CUES = ("iban", "account", "acct", "konto", "compte", "cuenta")

DOMAIN = re.compile(rb"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
WIDE_DOMAIN = re.compile(rb"[A-Za-z0-9\x80-\xff-]++(?:\.[A-Za-z0-9\x80-\xff-]++)++")
SPELLED_DOMAIN = re.compile(rb" ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}) ?[A-Za-z0-9-]++)++", re.I)
FOUR_NUMBERS = re.compile(rb"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
LONG_NUMBER = re.compile(rb"[0-9](?:[ -]?[0-9])++")
PHONE_NUMBER = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")
NUMBER_RUN = re.compile(rb"[0-9 -]*+")
SCHEME_NAME = LETTERS + DIGITS + b"+.-"
LOGIN_PART = re.compile(rb"([^\x00-\x20/?#@\"'<>]++)@(?:[A-Za-z0-9.-]++|\[[0-9A-Fa-f:.]++\])(?::[0-9]++)?")
CUE_END = re.compile(rb"(?:[ \t]*+(?:number|no\.?|nr\.?|num|#|:|=|is))*+[ \t]*+", re.I)
IBAN = re.compile(rb"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
GROUP_END = re.compile(rb"[A-Z0-9](?![A-Za-z0-9])")
ACCOUNT_NUMBER = re.compile(rb"[0-9](?:[ -]?[0-9]){5,16}+(?![ -]?[0-9])")


def run_start(text: bytes, stop: int, floor: int, signs: bytes) -> int:
    """Where the run of ``signs`` that ends at ``stop`` begins, not before ``floor``."""
    size = 64
    while True:
        a = max(floor, stop - size)
        kept = len(text[a:stop].rstrip(signs))
        if kept or a == floor:
            return a + kept
        size *= 4


def luhn(digits: bytes) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = c - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def iban_end(text: bytes, start: int) -> int | None:
    """Where the longest run of groups from ``start`` ends that is an international account number."""
    found = IBAN.match(text, start)
    if not found:
        return None
    for group in reversed([m.end() for m in GROUP_END.finditer(text, start + 14, found.end()) if not text[m.end(): m.end() + 1].isalnum()]):
        plain = text[start:group].replace(b" ", b"").decode("ascii")
        if len(plain) >= 15 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
            return group
    return None


def _small(number: bytes) -> bool:
    """Whether a number is at most 255, however many zeros it begins with."""
    number = number.lstrip(b"0")
    return len(number) < 3 or (len(number) == 3 and number <= b"255")


class Finder:
    """The spans of one text after another; offsets are bytes."""

    def __init__(self):
        self.machine = ahocorasick.Automaton()
        for gaps in product(("", " ", "-"), repeat=CARD_WINDOW - 1):
            self.machine.add_word("0" + "".join(g + "0" for g in gaps), self._number)
        for anchor, parser in [("@", self._at), ("+0", self._plus), ("0.0", self._point)] + [
                (a, self._spelled) for a in AT_WORDS] + [(s, self._scheme) for s in SCHEMES]:
            self.machine.add_word(anchor, parser)
        for cue in ACCOUNT_CUES:
            self.machine.add_word(cue, self._account)
        self.machine.make_automaton()

    def __call__(self, text: bytes) -> list[tuple[int, int, int]]:
        """(start, place of the kind in ``KINDS``, stop) in order."""
        self.text, self.found = text, []
        self.email = self.ip = self.number = self.phone = self.spelled = self.login = self.account = self.wide = 0
        for last, parser in self.machine.iter(text.translate(FOLDED).decode("latin-1")):
            parser(last)
        self.found.sort()
        return self.found

    def _add(self, kind: str, start: int, stop: int) -> None:
        self.found.append((start, KINDS.index(kind), stop))

    def _at(self, at: int) -> None:
        start = run_start(self.text, at, self.email, LOCAL)
        domain = DOMAIN.match(self.text, at + 1)
        if start < at and domain:
            self._add(EMAIL, start, domain.end())
            self.email = domain.end()
        self._wide_at(at, start, domain.end() if domain else at)

    def _wide_at(self, at: int, start: int, stop: int) -> None:
        """An address with letters beyond ASCII that the plain form cuts off or misses."""
        text = self.text
        left = run_start(text, at, self.wide, LOCAL + WIDE)
        domain = WIDE_DOMAIN.match(text, at + 1)
        if not domain or (left >= start and domain.end() <= stop):
            return
        name, host = text[left:at].decode("utf-8", "replace"), domain.group().decode("utf-8", "replace")
        foreign = [i for i, c in enumerate(name) if not (c.isascii() or c.isalnum())]
        name = name[foreign[-1] + 1:] if foreign else name
        host = re.match(r"(?:[^\W_]|-)+(?:\.(?:[^\W_]|-)+)+", host)
        if name and host and not (name + host.group()).isascii():
            end = at + 1 + len(host.group().encode())
            self._add(WIDE_EMAIL, at - len(name.encode()), end)
            self.wide = end

    def _point(self, last: int) -> None:
        if last - 2 < self.ip:
            return
        start = run_start(self.text, last - 1, self.ip, DIGITS)
        numbers = FOUR_NUMBERS.match(self.text, start)
        if numbers:
            self.ip = numbers.end()
            if all(_small(n) for n in numbers.groups()):
                self._add(IP, start, numbers.end())

    def _number(self, last: int) -> None:
        if last < self.number:
            return
        start = run_start(self.text, last, self.number, NUMBER_SIGNS)
        stop = NUMBER_RUN.match(self.text, last).end()
        for number in LONG_NUMBER.finditer(self.text, start, stop):
            digits = number.group().replace(b" ", b"").replace(b"-", b"")
            if 12 <= len(digits) <= 19 and luhn(digits):
                self._add(CARD, *number.span())
        self.number = stop

    def _plus(self, last: int) -> None:
        number = PHONE_NUMBER.match(self.text, last - 1)
        if number and 9 <= sum(48 <= c <= 57 for c in number.group()) <= 15:
            self._add(PHONE, *number.span())

    def _spelled(self, last: int) -> None:
        at = last - 3
        stop = at - 1 if at and self.text[at - 1] == 32 else at
        start = run_start(self.text, stop, min(self.spelled, stop), LOCAL)
        domain = SPELLED_DOMAIN.match(self.text, last + 1)
        if start < stop and domain:
            self._add(HIDDEN_EMAIL, start, domain.end())
            self.spelled = domain.end()

    def _scheme(self, last: int) -> None:
        name = run_start(self.text, last - 2, self.login, SCHEME_NAME)
        found = LOGIN_PART.match(self.text, last + 1)
        if found and name < last - 2:
            self._add(LOGIN, name, found.end())
            self.login = found.end()

    def _account(self, last: int) -> None:
        start = CUE_END.match(self.text, last + 1).end()
        if start < self.account:
            return
        self.account = start + 1
        stop = iban_end(self.text, start)
        if stop:
            self._add(ACCOUNT, start, stop)
            return
        found = ACCOUNT_NUMBER.match(self.text, start)
        if found:
            self._add(ACCOUNT, *found.span())


def code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[dict]:
    """The spans with offsets in code points."""
    places = np.array([(a, b) for a, _, b in spans], np.int64).reshape(-1, 2)
    if len(places) and not text.isascii():
        inside = np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) == 0x80)
        places = places - np.searchsorted(inside, places)
    return [{"kind": KINDS[k], "start": a, "stop": b} for (_, k, _), (a, b) in zip(spans, places.tolist())]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    find = Finder()
    for batch in slices(batches, 100):
        texts = batch.column(1).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([code_points(t, find(t)) for t in texts], _SPANS)], names=["id", "spans"])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data in each text: ``id, spans``, an array of ``kind, start, stop`` in code points.

    Spans are in order of their start, then kind (as in ``KINDS``); ``stop`` is exclusive. Spans of one
    kind do not overlap, those of different kinds may.

    * ``email``, ``ip``, ``card``, ``phone``: the leftmost matches of the usual patterns, addresses with
      parts of at most 255, cards of 12 to 19 digits that pass the Luhn check, phones of 9 to 15 digits
      after a plus. A match that fails its check is passed over as a whole.
    * ``wide_email``: an address with letters beyond ASCII. ``hidden_email``: one with (at) and (dot)
      spelled out. ``login``: a URL up to its host that names a user. ``account``: an international
      account number with right check digits, or 6 to 17 digits, behind a cue word.

    Null and empty texts have no spans. Rows that repeat an id, null ids and equal texts are rows like
    any other. Long texts are read whole, in time that grows with their length. An empty table gives
    an empty result. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        lambda it: released(_find(it)), f"id {kind}, spans array<struct<kind string, start bigint, stop bigint>>")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def report(found: DataFrame) -> DataFrame:
    """Counts and digest of the four base kinds, and all spans as text."""
    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("id", *counts, F.sha2(_listed(of(*BASE_KINDS)), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))
