"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks, the runs of text between block-level tags. A block's
features are the tags and names of its ancestors and what its text looks like. The
field weighs features per label (main text or not) and labels of neighbours, is
trained by gradient ascent on the likelihood of labelled pages, and decodes a page by
Viterbi. Pages are independent: one pass, nothing shuffled.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from llm.labelled_pages import Page

#: Labelled pages the field is trained on.
TRAINING_PAGES = 800
STEPS = 300
RATE = 0.4
DECAY = 5e-5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|</[^>]*(?:>|\Z)",
    re.S,
)
_NAME = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[a-z]+")

# Elements of HTML by their role. Fixed values.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea".split())
#: Formulas and drawings stand in a line of text, whatever elements they hold.
_FOREIGN = frozenset("svg math".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
_ENDS_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
_ENDS_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPES = frozenset("ul ol dl table tbody thead select article section div body".split())


@dataclass
class Block:
    """A leaf block: its text and what stands above it."""

    text: str
    path: tuple[tuple[str, str], ...]  # (tag, names) from the outermost ancestor
    linked: int = 0
    bold: bool = False
    names: list[str] = field(default_factory=list)


def blocks_of(html: str) -> list[Block]:
    """The leaf blocks of a page with text, in page order; broken markup is read as far as it goes."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    inline: list[tuple[str, str]] = []
    parts: list[str] = []
    linked = depth_a = foreign = 0
    names: list[str] = []

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                out.append(Block(text, tuple(stack), linked, any(t in ("b", "strong") for t, _ in inline), list(names)))
            parts.clear()
            names.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if depth_a and not text.isspace():
                linked += len(text)

    at = 0
    while True:
        match = _TOKEN.search(html, at)
        if match is None:
            add(html[at:])
            break
        add(html[at : match.start()])
        at = match.end()
        closing, tag, attributes = match.group(1, 2, 3) if match.group(2) else match.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if not html.endswith(">", 0, at) and at == len(html):  # cut inside a tag
            break
        if tag in _FOREIGN:
            foreign = max(0, foreign - 1) if closing else foreign + (not attributes.endswith("/"))
            continue
        if foreign and tag in _ENDS_P:  # such an element ends them, closed or not
            foreign = 0
        if foreign and tag not in _RAW:
            continue
        if tag in _INLINE:
            if tag == "br":
                parts.append(" ")
            elif closing:
                depth_a = max(0, depth_a - 1) if tag == "a" else depth_a
                for k in range(len(inline) - 1, -1, -1):
                    if inline[k][0] == tag:
                        del inline[k]
                        break
            elif tag not in _VOID:
                depth_a += tag == "a"
                name = _names(attributes)
                inline.append((tag, name))
                if name or tag == "label":
                    names.append(f"{tag} {name}")
            continue
        flush()
        depth_a = 0
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    inline.clear()
                    break
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(html, at) if not attributes.endswith("/") else None
            at = end.end() if end else (at if attributes.endswith("/") else len(html))
            continue
        if tag in _ENDS_P:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    del stack[k:]
                    break
                if stack[k][0] in _SCOPES:
                    break
        if tag in _ENDS_SAME:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in _ENDS_SAME[tag]:
                    del stack[k:]
                    break
                if stack[k][0] in _SCOPES - {"div"}:
                    break
        if tag == "body" and any(t == "head" for t, _ in stack):
            del stack[[t for t, _ in stack].index("head") :]
        if tag not in _VOID and not attributes.endswith("/"):
            stack.append((tag, _names(attributes)))
    flush()
    return out


def _names(attributes: str) -> str:
    if not attributes:
        return ""
    found = [a or b or c for a, b, c in _NAME.findall(attributes)]
    return " ".join(_PARTS.findall(" ".join(found).lower()))


def features(blocks: list[Block]) -> list[list[str]]:
    """Feature names of every block of a page."""
    out = []
    last = len(blocks) - 1
    for k, block in enumerate(blocks):
        words = block.text.count(" ") + 1
        share = block.linked / max(1, len(block.text))
        found = {"bias", f"words={min(words.bit_length(), 7)}", f"links={0 if share < 0.05 else 1 if share < 0.5 else 2}"}
        tags = [t for t, _ in block.path if t not in ("html", "body")]
        found.add(f"parent={tags[-1] if tags else 'none'}")
        for tag in tags:
            found.add(f"in={tag}")
        for tag, names in block.path:
            for name in names.split():
                found.add(f"named={name}")
        for name in " ".join(block.names).split():
            found.add(f"named={name}")
        boxes = [names for tag, names in block.path if names and tag != "p"]
        for name in boxes[-1].split() if boxes else ["none"]:
            found.add(f"box={name}")
        if not {"article", "main"}.intersection(tags):
            found.add("loose")
        if block.text[-1] in ".!?:;…":
            found.add("stop")
        if block.bold:
            found.add("bold")
        if "©" in block.text:
            found.add("copyright")
        found.add("first" if k == 0 else "last" if k == last else "inner")
        out.append(sorted(found))
    return out


@dataclass(frozen=True)
class Field:
    """A trained field: weights per feature and label, of neighbouring labels, of the first label."""

    index: dict[str, int]
    weights: np.ndarray
    steps: np.ndarray
    start: np.ndarray

    def decode(self, rows: list[list[str]]) -> list[bool]:
        """The most probable labels of a page; features that training has not seen count nothing."""
        (stay0, up), (down, stay1) = self.steps.tolist()
        weights, index = self.weights, self.index
        back, a, b = [], 0.0, 0.0
        for k, row in enumerate(rows):
            u, v = weights[[index[f] for f in row if f in index]].sum(axis=0).tolist()
            if k == 0:
                a, b = u + float(self.start[0]), v + float(self.start[1])
                continue
            from0, from1 = a + stay0 >= b + down, a + up >= b + stay1
            back.append((from0, from1))
            a, b = u + (a + stay0 if from0 else b + down), v + (a + up if from1 else b + stay1)
        labels = [b > a] if rows else []
        for from0, from1 in reversed(back):
            labels.append(not (from1 if labels[-1] else from0))
        return labels[::-1]


def labelled_rows(pages: Iterable[Page]) -> Iterator[tuple[list[list[str]], list[int]]]:
    """Features and labels of labelled pages; a block that joins several parts takes the first one's label."""
    for page in pages:
        blocks = blocks_of(page.html)
        label, at = [], 0
        for block in blocks:
            while at < len(page.labels) and page.labels[at][0] not in block.text:
                at += 1
            label.append(page.labels[min(at, len(page.labels) - 1)][1])
        yield features(blocks), label


def train(pages: Iterable[Page], steps: int = STEPS) -> Field:
    """Gradient ascent on the likelihood of the labels, by forward-backward over all pages at once."""
    data = [x for x in labelled_rows(pages) if x[0]]
    index: dict[str, int] = {}
    flat, of_block, place, label = [], [], [], []
    longest = max(len(rows) for rows, _ in data)
    for p, (rows, labels) in enumerate(data):
        for k, row in enumerate(rows):
            of_block.extend([len(place)] * len(row))
            flat.extend(index.setdefault(f, len(index)) for f in row)
            place.append((p, k))
            label.append(labels[k])
    flat, of_block, label = np.array(flat), np.array(of_block), np.array(label)
    page, at = np.array(place).T
    lengths = np.bincount(page)
    n = len(data)
    gold = np.zeros((len(label), 2))
    gold[np.arange(len(label)), label] = 1
    follows = np.flatnonzero(page[1:] == page[:-1])
    gold_steps = np.zeros((2, 2))
    np.add.at(gold_steps, (label[follows], label[follows + 1]), 1)
    gold_start = gold[at == 0].sum(axis=0)
    weights, moves, start = np.zeros((len(index), 2)), np.zeros((2, 2)), np.zeros(2)
    squares = [np.full_like(x, 1e-6) for x in (weights, moves, start)]
    for _ in range(steps):
        score = np.zeros((n, longest, 2))
        score[page, at] = np.stack([np.bincount(of_block, weights=weights[flat, y], minlength=len(label)) for y in (0, 1)], axis=1)
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[:, 0] = score[:, 0] + start
        for k in range(1, longest):
            forward[:, k] = score[:, k] + np.logaddexp.reduce(forward[:, k - 1, :, None] + moves, axis=1)
        for k in range(longest - 2, -1, -1):
            ahead = np.logaddexp.reduce(moves[None] + (score[:, k + 1] + backward[:, k + 1])[:, None, :], axis=2)
            backward[:, k] = np.where((k + 1 < lengths)[:, None], ahead, 0.0)
        total = np.logaddexp.reduce(forward[np.arange(n), lengths - 1], axis=1)
        odds = np.exp(forward[page, at] + backward[page, at] - total[page, None])
        a, b = follows, follows + 1
        pair = forward[page[a], at[a]][:, :, None] + moves + (score[page[b], at[b]] + backward[page[b], at[b]])[:, None, :]
        pair = np.exp(pair - total[page[a], None, None]).sum(axis=0)
        gap = gold - odds
        grad_w = np.stack([np.bincount(flat, weights=gap[of_block, y], minlength=len(index)) for y in (0, 1)], axis=1)
        for value, gradient, square in zip(
            (weights, moves, start), (grad_w, gold_steps - pair, gold_start - odds[at == 0].sum(axis=0)), squares, strict=True
        ):
            gradient = gradient / n - DECAY * value
            square += gradient * gradient
            value += RATE * gradient / np.sqrt(square)
    return Field(index, weights, moves, start)


@functools.cache
def default_field() -> Field:
    """The field trained on ``TRAINING_PAGES`` labelled pages; a few seconds, the same every time."""
    return train(Page(seed) for seed in range(TRAINING_PAGES))


def main_text(html: str, trained: Field) -> str:
    """The main text of one page, a line per block."""
    blocks = blocks_of(html)
    return "\n".join(b.text for b, main in zip(blocks, trained.decode(features(blocks)), strict=True) if main)


def extract(pages: DataFrame, trained: Field | None = None) -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per input row.

    ``pages`` needs ``page_id``, ``url`` and ``html``; other columns are ignored. A null
    or empty page, or one without main text, gives an empty text. Nothing is cut.
    """
    sent = pages.sparkSession.sparkContext.broadcast(trained or default_field())  # a few hundred weights

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            texts = [main_text(h or "", known) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
