"""HTML pages as sequences of text blocks with their tag paths, and vectors of these blocks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import xxhash

# Quotes count after an equals sign only. What is matched is not given back.
_TAG_END = re.compile(r"""(?:=\s*+(?>"[^"]*"|'[^']*'|[^\s>"'][^\s>]*)?+|[^>=])*+>""")
_MARKUP = re.compile(r"<(?:(!--)|[!?]|(/?)([a-zA-Z][^\s/>]*+))")
_NAME_END = r"(?=[\s/>])"
# Elements whose text is none of the page, up to their end tag or the end of the page.
RAW = frozenset("script style textarea title iframe".split())
_RAW_END = {name: re.compile(f"</{name}{_NAME_END}", re.I) for name in RAW}
# Where elements end that hold no text of the page; HTML lets some tags end an svg that is left open.
_HIDDEN_END = {name: re.compile(f"(</{name}{_NAME_END})" + more, re.I) for name, more in (
    ("template", ""), ("noscript", ""),
    ("svg", r"|(?=<(?:b|big|blockquote|body|br|center|code|dd|div|dl|dt|em|embed|h[1-6]|head|hr|i|img|li|listing|menu|meta|nobr"
            r"|ol|p|pre|ruby|s|small|span|strong|strike|sub|sup|table|tt|u|ul|var)" + _NAME_END + ")"))}
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_NAME_PART = re.compile(r"[a-zA-Z]+")

# Fixed values of HTML: elements inside a line of text, elements without content, and those that a
# following sibling closes.
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong"
    " sub sup time tt u var wbr".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY = {
    "p": frozenset("p div ul ol dl table h1 h2 h3 h4 h5 h6 section article aside header footer nav form pre blockquote main".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]),
    "head": frozenset(["body"]),
}
ENDED_BY = {tag: [name for name, tags in CLOSED_BY.items() if tag in tags] for tag in frozenset().union(*CLOSED_BY.values())}
SCOPES = frozenset("ul ol dl table body html div section article aside header footer nav main form select".split())


class Node:
    """An open element: its own names, and the node around it. Paths are shared, not copied."""

    __slots__ = ("around", "names", "length")

    def __init__(self, around: "Node | None", names: tuple[str, ...]):
        self.around, self.names = around, names
        self.length = len(names) + (around.length if around else 0)

    def outwards(self) -> Iterator["Node"]:
        node = self
        while node:
            yield node
            node = node.around

    def inherit(self, known: dict["Node", object], mark: Callable[["Node", object], object], start: object) -> object:
        """``mark(node, mark of the node around it)``, worked out once per node, from the outermost in, and kept in ``known``."""
        chain = []
        node = self
        while node and node not in known:
            chain.append(node)
            node = node.around
        value = known[node] if node else start
        for node in reversed(chain):
            value = known[node] = mark(node, value)
        return value


OUTERMOST = Node(None, ())


@dataclass(slots=True)
class Block:
    """Text between two block borders, white space made single, and the innermost element around it."""

    text: str
    node: Node
    linked: int                 # characters inside links

    @property
    def path(self) -> tuple[str, ...]:
        """Tags from the outermost in, each followed by its class and id words."""
        return tuple(n for node in reversed([*self.node.outwards()]) for n in node.names)


def _path_names(tag: str, attributes: str) -> tuple[str, ...]:
    names = [tag]
    if attributes and "=" in attributes:
        for found in _NAMES.findall(attributes):
            names += ["." + w.lower() for w in _NAME_PART.findall(" ".join(found))]
    return tuple(names)


def blocks(html: str | None) -> list[Block]:
    """The text blocks of a page in order; a null or empty page has none.

    Scripts, styles, comments and titles are no text. Missing end tags are supplied as HTML does;
    end tags without a start are ignored; of an svg, template or noscript without an end, the tag alone is
    skipped. Character references are decoded once, after the markup. Where quotes would hide every later
    end of a tag, they count no more for the rest of the page.

    Time and memory grow with the length of the page, whatever is in it: no sign is looked at more than a
    few times, tags left open and deep nesting included.
    """
    out: list[Block] = []
    stack: list[tuple[str, Node]] = []
    opened: dict[str, list[int]] = {}       # where the open elements of each name stand in the stack
    text: list[str] = []
    linked = 0
    html = html or ""

    def close_block() -> None:
        nonlocal linked
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                out.append(Block(joined, stack[-1][1] if stack else OUTERMOST, linked))
            text.clear()
        linked = 0

    def pop_to(index: int) -> None:
        for tag, _ in reversed(stack[index:]):
            opened[tag].pop()
        del stack[index:]

    def closes(tag: str) -> int | None:
        """The place of the open element that a start tag ends, looked for up to the nearest scope."""
        nearest = max((opened[s][-1] for s in SCOPES if opened.get(s)), default=-1)
        ended = max((opened[e][-1] for e in ENDED_BY.get(tag, ()) if opened.get(e)), default=-1)
        return ended if ended >= 0 and ended >= nearest else None

    def add_text(stop: int) -> None:
        nonlocal linked
        if stop > last:
            piece = unescape(html[last: stop])
            text.append(piece)
            if opened.get("a"):
                linked += len(piece)

    last = at = 0
    last_end, quotes = html.rfind(">"), True
    open_ended: set[str] = set()        # names that no end tag follows from here on
    while found := _MARKUP.search(html, at):
        start, at = found.span()
        if found.group(1):
            add_text(start)
            end = html.find("-->", at)
            last = at = end + 3 if end >= 0 else len(html)
            continue
        if start > last_end:            # no tag ends any more
            continue
        tag = (found.group(3) or "").lower()
        whole = _TAG_END.match(html, at) if tag and quotes else None
        if whole is None:
            quotes = quotes and not tag
            end = html.find(">", at)
        else:
            end = whole.end() - 1
        if end < 0:
            continue
        attributes = html[at:end]
        add_text(start)
        last = at = end + 1
        if not tag:
            continue
        closing = found.group(2)
        if tag in _HIDDEN_END:
            if not closing and not (tag == "svg" and attributes.endswith("/")) and tag not in open_ended:
                hidden = _HIDDEN_END[tag].search(html, last)
                stop = hidden.start() if hidden and not hidden.group(1) else html.find(">", hidden.end()) + 1 if hidden else 0
                if stop:
                    last = at = stop
                else:
                    open_ended.add(tag)
            continue
        if tag in RAW and not closing:
            raw = _RAW_END[tag].search(html, last)
            stop = html.find(">", raw.end()) if raw else -1
            last = at = stop + 1 if stop >= 0 else len(html)
            continue
        if tag == "br":
            text.append(" ")
        elif closing:
            if opened.get(tag):
                if tag not in INLINE:
                    close_block()
                pop_to(opened[tag][-1])
        else:
            if tag not in INLINE:
                close_block()
                ended = closes(tag)
                if ended is not None:
                    pop_to(ended)
            if tag not in EMPTY and not attributes.endswith("/"):
                opened.setdefault(tag, []).append(len(stack))
                stack.append((tag, Node(stack[-1][1] if stack else OUTERMOST, _path_names(tag, attributes))))
    add_text(len(html))
    close_block()
    return out


TAG_BITS, WORD_BITS, NUMBERS = 256, 2048, 6
INPUT = TAG_BITS + WORD_BITS + NUMBERS
CACHED_NAMES = 200_000


class Buckets(dict):
    """name -> hashed place below ``n``, remembered within a bound."""

    def __init__(self, n: int, seed: int):
        super().__init__()
        self.n, self.seed = n, seed

    def __missing__(self, name: str) -> int:
        if len(self) >= CACHED_NAMES:
            self.clear()
        self[name] = out = xxhash.xxh3_64_intdigest(name, self.seed) % self.n
        return out


@dataclass
class Vectors:
    """A row per block, of which only the places that are not 0 are held, and six numbers."""

    places: np.ndarray          # of all blocks, one after another
    values: np.ndarray
    ends: np.ndarray            # where each block's places end
    numbers: np.ndarray

    def __len__(self) -> int:
        return len(self.ends)

    def part(self, start: int, stop: int) -> "Vectors":
        a, b = (self.ends[i - 1] if i else 0 for i in (start, stop))
        return Vectors(self.places[a:b], self.values[a:b], self.ends[start:stop] - a, self.numbers[start:stop])

    def dense(self) -> np.ndarray:
        out = np.zeros((len(self), INPUT), np.float32)
        rows = np.repeat(np.arange(len(self)), np.diff(self.ends, prepend=0))
        out[rows, self.places] = self.values
        out[:, -NUMBERS:] = self.numbers
        return out

    def times(self, weights: np.ndarray, held: int = 200_000) -> np.ndarray:
        """``dense() @ weights``, some blocks at a time."""
        out = self.numbers @ weights[-NUMBERS:]
        start = 0
        while start < len(self):
            a = self.ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(self.ends, a + held, side="right")))
            b = self.ends[stop - 1]
            firsts = np.concatenate([[a], self.ends[start: stop - 1]]) - a
            out[start:stop] += np.add.reduceat(weights[self.places[a:b]] * self.values[a:b, None], firsts)
            start = stop
        return out

    def to_bytes(self) -> list[bytes]:
        return [x.tobytes() for x in (self.places, self.values, self.ends, self.numbers)]

    @classmethod
    def from_bytes(cls, parts: list[bytes]) -> "Vectors":
        kinds = (np.int64, np.float32, np.int64, np.float32)
        places, values, ends, numbers = (np.frombuffer(x, k) for x, k in zip(parts, kinds))
        return cls(places, values, ends, numbers.reshape(-1, NUMBERS))


def block_vectors(page: list[Block], tags: Buckets, words: Buckets, start: int = 0, stop: int | None = None) -> Vectors:
    """A row per block from ``start`` to ``stop``: hashed tag path, hashed words, and lengths, links, marks and place in the page."""
    own_page = page[start:stop]
    places, values, numbers = [], [], np.zeros((len(own_page), NUMBERS), np.float32)
    marks: dict[int, np.ndarray] = {}
    known: dict[Node, int] = {}

    def mark(node: Node, outer: int) -> int:
        for name in node.names:
            outer |= 1 << tags[name]
        return outer

    for i, block in enumerate(own_page):
        bits = block.node.inherit(known, mark, 0)
        if bits not in marks:
            if len(marks) >= CACHED_NAMES // 10:
                marks.clear()
            marks[bits] = np.flatnonzero(np.unpackbits(np.frombuffer(bits.to_bytes(TAG_BITS // 8, "little"), np.uint8), bitorder="little"))
        own = block.text.split()
        bag = np.bincount(np.fromiter(map(words.__getitem__, own), np.int64, len(own)))
        held = np.flatnonzero(bag)
        bag = bag[held].astype(np.float32)
        places += [marks[bits], TAG_BITS + held]
        values += [np.ones(len(marks[bits]), np.float32), bag / np.sqrt((bag * bag).sum())]
        n = len(block.text)
        numbers[i] = (
            np.log1p(len(own)) / 4, min(1.0, block.linked / n), block.text[-1] in ".!?", block.node.length / 8,
            (start + i) / len(page), block.text.count(",") / len(own))
    none = np.zeros(0, np.int64)
    ends = np.cumsum([len(a) + len(b) for a, b in zip(places[::2], places[1::2])], dtype=np.int64)
    return Vectors(
        np.concatenate([none, *places]), np.concatenate([none.astype(np.float32), *values]), ends.reshape(-1), numbers)
