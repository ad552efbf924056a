"""Main text of web pages by a recurrent block labeller.

A page is the sequence of its text blocks. A bidirectional LSTM reads for every block its hashed tag
path and words and decides, with the whole page as context, whether the block belongs to the main
text. No labels are given, so the network learns from a sample of the pages that simple rules on
tags and names label, each page in several layouts: with other containers, and with menus, notices,
forms, adverts and comments put in at random.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html_blocks import INPUT, TAG_BITS, WORD_BITS, Block, Buckets, Node, Vectors, block_vectors, blocks
from .labelled import distinct_texts, hashed_sample
from .recurrent import BiLstm
from .shingles import chunks, released, slices
from .store import opened, send, small_batches

SAMPLE_PAGES = 240          # pages the network learns from, at most
LAYOUTS = 4                 # layouts of each of them
TRAIN_BLOCKS = 96           # blocks of a layout that training reads, from a place drawn at random; extraction reads all

# Names of page parts that are not main text, and of those that hold it.
ASIDE_TAGS = frozenset("nav header footer aside form menu button select fieldset dialog figcaption label".split())
ASIDE_NAMES = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent footer"
    " header login masthead menu modal nav navbar navigation newsletter notice pager pagination popup promo promoted"
    " related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget"
    " disclaimer copyright".split())
MAIN_NAMES = frozenset("article main content post entry story body text page".split())


def rule(page: list[Block]) -> list[bool]:
    """Which blocks are main text by the names around them; inside an article or main part if there is one."""
    def mark(node: Node, outer: tuple[bool, bool]) -> tuple[bool, bool]:
        aside = any(n in ASIDE_TAGS or n[0] == "." and n[1:] in ASIDE_NAMES for n in node.names)
        return outer[0] or aside, outer[1] or "article" in node.names or "main" in node.names

    known: dict[Node, tuple[bool, bool]] = {}
    marks = [b.node.inherit(known, mark, (False, False)) for b in page]
    framed = any(inside for _, inside in marks)
    return [not aside and (not framed or inside) for aside, inside in marks]


class _Replaced(dict):
    """node -> the same node with the outermost article as another container, made once per node."""

    def __init__(self, container: tuple[str, ...]):
        super().__init__()
        self.container = container

    def of(self, node: Node) -> tuple[Node, bool]:
        """The node's likeness, and whether the container is in it."""
        chain = []
        while node is not None and node not in self:
            chain.append(node)
            node = node.around
        made, done = self[node] if node is not None else (None, False)
        for node in reversed(chain):
            names = node.names
            if not done and "article" in names:
                at = names.index("article")
                names, done = names[:at] + self.container + names[at + 1:], True
            made = Node(made, names)
            self[node] = made, done
        return made, done


def _relayout(page: list[Block], main: list[bool], rng: np.random.Generator, words: list[str]) -> tuple[list[Block], list[bool]]:
    """The page with another main container and with other parts put in."""
    def some_words(low: int, high: int) -> str:
        return " ".join(rng.choice(words, int(rng.integers(low, high)))) if words else "text"

    container = [("article",), ("main",), ("div", "." + str(rng.choice(sorted(MAIN_NAMES)))), ("div",), ("section",), ()][
        int(rng.integers(6))]
    out, label = [], list(main)
    replaced, plain = _Replaced(container), _Replaced(("article",))
    for block, is_main in zip(page, main):
        out.append(Block(block.text, (replaced if is_main else plain).of(block.node)[0], block.linked))
    names, tags = sorted(ASIDE_NAMES), sorted(ASIDE_TAGS)
    for _ in range(int(rng.integers(0, 6))):
        at = int(rng.integers(0, len(out) + 1))
        outer = out[min(at, len(out) - 1)].node if out and rng.random() < 0.5 else Node(None, ("html", "body"))
        part = (str(rng.choice(tags)),) if rng.random() < 0.4 else (
            str(rng.choice(["div", "section", "ul", "p"])), "." + str(rng.choice(names)))
        inner = (str(rng.choice(["p", "li", "div", "span"])),)
        for _ in range(int(rng.integers(1, 4))):
            text = some_words(1, 40)
            out.insert(at, Block(text, Node(outer, part + inner), len(text) if rng.random() < 0.3 else 0))
            label.insert(at, False)
    return out, label


def _lessons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors and rule labels of sampled pages in several layouts."""
    tags, words = Buckets(TAG_BITS, 1), Buckets(WORD_BITS, 2)
    for batch in batches:
        for html in batch.column(0).to_pylist():
            page = blocks(html)
            main = rule(page)
            rng = np.random.default_rng(xxhash.xxh3_64_intdigest(html or ""))
            vocabulary = sorted({w for b in page for w in b.text.split()})
            for k in range(LAYOUTS):
                shown, label = (page, main) if k == 0 else _relayout(page, main, rng, vocabulary)
                at = int(rng.integers(0, max(1, len(shown) - TRAIN_BLOCKS + 1)))
                x = block_vectors(shown, tags, words, at, at + TRAIN_BLOCKS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.to_bytes()]), pa.array([np.array(label[at: at + TRAIN_BLOCKS], bool).tobytes()])], names=["x", "y"])


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> BiLstm:
    """A labeller learned from at most ``sample_pages`` distinct texts of ``html``, taken by their hash."""
    own = pages.select("html").filter("html IS NOT NULL")
    sample = hashed_sample(own, "html", sample_pages, distinct_texts(own, "html"))
    lessons = sorted(
        ([bytes(x) for x in r["x"]], bytes(r["y"])) for r in sample.mapInArrow(_lessons, "x array<binary>, y binary").collect())
    model = BiLstm(INPUT)
    model.train([Vectors.from_bytes(x) for x, _ in lessons], [np.frombuffer(y, bool) for _, y in lessons])
    return model


def _extract(batches: Iterator[pa.RecordBatch], sent, html_at: int) -> Iterator[pa.RecordBatch]:
    tags, words, model = Buckets(TAG_BITS, 1), Buckets(WORD_BITS, 2), opened(sent)
    for batch in slices(batches):
        htmls = batch.column(html_at).to_pylist()
        kept = [i for i in range(batch.num_columns) if i != html_at]
        for a, b in chunks(htmls, 1 << 21):
            pages = [blocks(h) for h in htmls[a:b]]
            keep = model.label([block_vectors(p, tags, words) for p in pages])
            texts = [" ".join(block.text for block, k in zip(p, ks) if k) for p, ks in zip(pages, keep)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).slice(a, b - a) for i in kept]
                + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([len(p) for p in pages], pa.int32())],
                names=[*(batch.schema.names[i] for i in kept), "text", "n_chars", "n_blocks"])


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """The columns ``keep`` of every page with ``text, n_chars, n_blocks``.

    ``text`` joins the blocks labelled as main text in page order by one space; white space inside a
    block is one space, and character references are decoded. Null, empty and textless pages give an
    empty text. Rows are independent, so repeated rows, null ids and ties need no care; an empty
    table gives an empty result. Other columns are not read.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html_col}`").cast("string").alias("html"))
    sent = send(pages.sparkSession, train(rows))
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "html")
    at = len(keep)
    return rows.mapInArrow(lambda it: released(_extract(it, sent, at)), f"{out}, text string, n_chars bigint, n_blocks int")
