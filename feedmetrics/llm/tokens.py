"""Token ids of whole texts by a public tokenizer, word by word with a bounded memory."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from functools import cached_property
from itertools import chain, repeat

import numpy as np

from .shingles import give_back, WordHashes, Words

CACHED_WORDS = 400_000

# Latin letters that one code point stands for in every normal form, then ASCII marks but the
# apostrophe, which the tokenizers' patterns treat apart.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿĀ-įı-ɏ]+)([!-&(-/:-@\[-`{-~]*)")
SPACE = "Ġ"


def _byte_signs() -> dict[int, int]:
    """The sign that byte-level vocabularies write for each byte: itself if printable, else 256 and up."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + k for k, b in enumerate(others)}


BYTE_SIGNS = _byte_signs()
LETTER, DIGIT, MARK = 1, 2, 3
NO_MERGE = np.int32(np.iinfo(np.int32).max)
SLOT_BITS = 18
MERGED_BYTES = 64               # longer words are left to the tokenizer


def _byte_kinds() -> np.ndarray:
    """Kinds of ASCII bytes: letters, digits, marks but the apostrophe; 0 for others."""
    kinds = np.zeros(256, np.uint8)
    kinds[33:127] = MARK
    kinds[48:58], kinds[65:91], kinds[97:123], kinds[ord("'")] = DIGIT, LETTER, LETTER, 0
    return kinds


def _latin_pairs() -> np.ndarray:
    """Whether two bytes, as one number, are a Latin letter that ``PLAIN`` knows."""
    out = np.zeros(1 << 16, bool)
    for sign in range(0xC0, 0x250):
        if sign not in (0xD7, 0xF7, 0x130):
            first, second = chr(sign).encode()
            out[first << 8 | second] = True
    return out


class ByteMerges:
    """Merges of a byte-level vocabulary, applied to many words at once.

    Each word is put behind a space and cut where letters, digits and marks meet, as the vocabulary's
    pattern does; in every piece the first of its earliest merges is made, until none is left. Words with
    other characters are left out, and long ones, whose merges one by one would take too long.
    """

    def __init__(self, model: dict):
        ids = model["vocab"]
        names = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        pairs = np.array([(ids[a], ids[b]) for a, b in names], np.uint32).reshape(-1, 2)
        self.keys, self.made = pairs[:, 0] << np.uint32(16) | pairs[:, 1], np.array([ids[a + b] for a, b in names], np.int32)
        self.signs = np.array([ids[chr(BYTE_SIGNS[b])] for b in range(256)], np.int32)
        self.kinds, self.latin = _byte_kinds(), _latin_pairs()
        # A merge is found by its pair's slot; those whose slot is taken have one in the next table.
        self.tables, left = [], np.arange(len(self.keys))
        while len(left):
            multiplier = np.uint32(2654435769 + 2 * 374761393 * len(self.tables) & 0xFFFFFFFF)
            slots, first = np.unique(self._slots(self.keys[left], multiplier), return_index=True)
            table = np.full(1 << SLOT_BITS, -1, np.int32)
            table[slots] = left[first]
            self.tables.append((multiplier, table))
            left = np.delete(left, first)

    @classmethod
    def of(cls, path: str) -> ByteMerges | None:
        """The merges of a tokenizer's file; none where it does more to a word than cutting and merging."""
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model, cut = whole["model"], whole.get("pre_tokenizer") or {}
        more = any(model.get(k) for k in (
            "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges"))
        fits = (model.get("type") == "BPE" and not more and whole.get("normalizer") is None and cut.get("type") == "ByteLevel"
                and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
                and max(model["vocab"].values(), default=0) < 1 << 16 and {chr(c) for c in BYTE_SIGNS.values()} <= model["vocab"].keys())
        return cls(model) if fits else None

    @staticmethod
    def _slots(keys: np.ndarray, multiplier: np.uint32) -> np.ndarray:
        return keys * multiplier >> np.uint32(32 - SLOT_BITS)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The number of the merge of each pair, or ``NO_MERGE``."""
        keys = left.astype(np.uint32) << np.uint32(16) | right.astype(np.uint32)
        out, asked, wanted = np.full(len(keys), NO_MERGE), None, keys
        for multiplier, table in self.tables:
            found = table.take(self._slots(wanted, multiplier))
            hit = self.keys.take(found, mode="wrap") == wanted
            hit &= found >= 0
            out[hit if asked is None else asked[hit]] = found[hit]
            more = np.flatnonzero(~hit & (found >= 0))
            if not len(more):
                break
            asked, wanted = more if asked is None else asked[more], wanted[more]
        return out

    def words(self, words: Words, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the words at ``places`` are plain, their ids end to end, and how many ids each has."""
        line = np.frombuffer(words.line, np.uint8)
        sizes = words.stops[places] - words.starts[places] + 1      # with the space before
        ends = np.cumsum(sizes)
        first = ends - sizes
        signs = line.take(np.repeat(words.starts[places] - 1 - first, sizes) + np.arange(ends[-1] if len(ends) else 0), mode="clip")
        signs[first] = 32
        kinds = self.kinds.take(signs)
        if len(signs) and signs.max() > 127:
            latin = np.flatnonzero(self.latin.take(signs[:-1].astype(np.uint16) << np.uint16(8) | signs[1:]))
            kinds[latin] = kinds[latin + 1] = LETTER
        kinds[first] = kinds[first + 1]
        plain = (np.minimum.reduceat(kinds, first) > 0 if len(first) else np.zeros(0, bool)) & (sizes <= MERGED_BYTES)
        if not plain.all():
            own = np.repeat(plain, sizes)
            signs, kinds, sizes = signs[own], kinds[own], sizes[plain]
            ends = np.cumsum(sizes)
            first = ends - sizes
        new = np.concatenate([[True], kinds[1:] != kinds[:-1]])[: len(kinds)]
        new[first] = True
        pieces = np.flatnonzero(new)
        ids, amounts = self._merged(self.signs.take(signs), np.diff(pieces, append=len(signs)))
        return plain, ids, np.add.reduceat(amounts, np.searchsorted(pieces, first)) if len(first) else sizes

    def _merged(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces of ``sizes`` bytes after all merges, and how many each piece has."""
        amounts, pieces, done, owners = sizes.copy(), np.arange(len(sizes)), [], []
        ranks = np.full(len(ids), NO_MERGE)
        ranks[:-1] = self._ranks(ids[:-1], ids[1:])
        ranks[np.cumsum(sizes) - 1] = NO_MERGE      # of a piece's last id with the next piece
        while len(sizes):
            best = np.minimum.reduceat(ranks, np.cumsum(sizes) - sizes)
            live = best < NO_MERGE
            if not live.all():
                own = np.repeat(live, sizes)
                done.append(ids[~own])
                owners.append(np.repeat(pieces[~live], sizes[~live]))
                amounts[pieces[~live]] = sizes[~live]
                ids, ranks, sizes, pieces, best = ids[own], ranks[own], sizes[live], pieces[live], best[live]
                if not len(sizes):
                    break
            at = np.flatnonzero(ranks == np.repeat(best, sizes))
            if len(at) > len(sizes):        # the same pair again in a piece: the first one goes first
                at = at[np.searchsorted(at, np.cumsum(sizes) - sizes)]
            ids[at] = self.made.take(best)
            stays = np.ones(len(ids), bool)
            stays[at + 1] = False
            ids, ranks, sizes = ids[stays], ranks[stays], sizes - 1
            at -= np.arange(len(at))
            last = np.cumsum(sizes) - 1
            ranks[at] = NO_MERGE
            right, left = at[at < last], at[at > last + 1 - sizes] - 1
            found = self._ranks(ids.take(np.concatenate([right, left])), ids.take(np.concatenate([right, left]) + 1))
            ranks[right], ranks[left] = found[: len(right)], found[len(right):]
        if not done:
            return ids.astype(np.uint32), amounts
        owners = np.concatenate(owners)
        return np.concatenate(done)[np.argsort(owners, kind="stable")].astype(np.uint32), amounts


class WordTokens:
    """Encodes texts, A-Z lower-cased, with a tokenizer that drops white space and never joins across it.

    Such a tokenizer gives a text the ids of its words, one after another, so a word is encoded once
    and remembered by its hash; when the memory is full, words not in it are encoded anew. Words are
    split at ASCII white space only; other characters stay inside a word and are left to the tokenizer.
    """

    def __init__(self, path: str, prefix: str = "", plain_text: bool = False, merges: ByteMerges | None = None):
        """``prefix`` is put before each word; ``plain_text`` reads special tokens as ordinary text.

        ``merges`` are those of the same vocabulary, for a prefix of one space; they encode plain words at once.
        """
        self.path, self.prefix, self.plain_text = path, prefix, plain_text
        self.read = WordHashes().read
        self.keys = np.zeros(0, np.uint64)      # hashes of the remembered words, sorted
        self.places = np.zeros(0, np.int64)     # their places among the ids
        self.ids = np.zeros(0, np.uint32)
        self.ends = np.zeros(1, np.int64)
        self.marks: dict[str, list[int]] = {"": []}
        self.merges = merges

    @cached_property
    def tokenizer(self):
        """Read when a word needs it."""
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.encode_special_tokens = self.plain_text
        give_back()         # reading the file takes more than the tokenizer it makes
        return tokenizer

    @cached_property
    def model(self):
        return self.tokenizer.model

    @cached_property
    def lower(self) -> bool:
        return self.tokenizer.normalizer is not None

    def _plain(self, word: str) -> list[int] | None:
        """The ids of Latin letters with marks after them, as the tokenizer would split them itself.

        Its normalizer only changes the case of such words, and its pattern cuts them before the marks;
        what is left is the byte-pair model. Other words are left to the whole tokenizer.
        """
        if word.isascii() and word.isalpha():
            return [t.id for t in self.model.tokenize(SPACE + word if self.prefix else word)]
        found = PLAIN.fullmatch(word)
        if not found:
            return None
        letters, marks = found.groups()
        if not letters.isascii():
            letters = (letters.lower() if self.lower else letters).encode().decode("latin-1").translate(BYTE_SIGNS)
        ids = [t.id for t in self.model.tokenize(SPACE + letters if self.prefix else letters)]
        if marks and marks not in self.marks:
            self.marks[marks] = [t.id for t in self.model.tokenize(marks)]
        return ids + self.marks.get(marks) if marks else ids

    def _encode_new(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and numbers of ids of distinct words."""
        if len(self.marks) > CACHED_WORDS:
            self.marks = {"": []}
        texts = [w.decode("utf-8", "surrogatepass") for w in words]
        ids = [self._plain(t) for t in texts]
        hard = [i for i, own in enumerate(ids) if own is None]
        for i, e in zip(hard, self.tokenizer.encode_batch_fast([self.prefix + texts[i] for i in hard], add_special_tokens=False)):
            ids[i] = e.ids
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes

    def _encode_places(self, words: Words, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and numbers of ids of the distinct words at ``places``."""
        if self.merges is None:
            return self._encode_new(words.some(places))
        plain, ids, sizes = self.merges.words(words, places)
        if plain.all():
            return ids, sizes
        others, amounts = self._encode_new(words.some(places[~plain]))
        every = np.empty(len(places), np.int64)
        every[plain], every[~plain] = sizes, amounts
        own, out = np.repeat(plain, every), np.empty(every.sum(), np.uint32)
        out[own], out[~own] = ids, others
        return out, every

    def encode_words(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words, and how many each has."""
        unique, first, inverse, _ = words.distinct
        at = np.minimum(np.searchsorted(self.keys, unique), max(len(self.keys) - 1, 0))
        known = self.keys[at] == unique if len(self.keys) else np.zeros(len(unique), bool)
        place = np.empty(len(unique), np.int64)
        place[known] = self.places[at[known]]
        ids, ends = self.ids, self.ends
        new = np.flatnonzero(~known)
        if len(new):
            found, sizes = self._encode_places(words, first[new])
            place[new] = np.arange(len(ends) - 1, len(ends) - 1 + len(new))
            ids = np.concatenate([ids, found])
            ends = np.concatenate([ends, ends[-1] + np.cumsum(sizes)])
            if len(ends) <= CACHED_WORDS:
                self.ids, self.ends = ids, ends
                where = np.searchsorted(self.keys, unique[new])
                self.keys, self.places = np.insert(self.keys, where, unique[new]), np.insert(self.places, where, place[new])
        place = place[inverse]
        sizes = ends[place + 1] - ends[place]
        jump = np.repeat(ends[place] - (np.cumsum(sizes) - sizes), sizes)
        return ids[jump + np.arange(len(jump))], sizes

    def encode_all(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """The ids of each text (uint32); null counts as empty."""
        words = self.read(texts)
        if not self.plain_text and b"<|" in words.line:
            # A special token is one in its own case only, so such texts are not lower-cased first.
            return [np.array(self.tokenizer.encode(t or "", add_special_tokens=False).ids, np.uint32) for t in texts]
        ids, sizes = self.encode_words(words)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(words.counts)]
        return np.split(ids, ends[:-1])


def pieces(ids: np.ndarray, capacity: int) -> Iterator[tuple[int, np.ndarray]]:
    """(start, ids) of the consecutive pieces of at most ``capacity`` ids."""
    for start in range(0, len(ids), capacity):
        yield start, ids[start: start + capacity]
