"""Main text of web pages: boosted trees over DOM nodes, decoded so that no kept node has a dropped ancestor."""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quaymark.llm import boosting, html_samples

# Elements by how they lay out text.
_BLOCK = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead tr ul caption".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe svg title textarea head".split())
#: Of these an element without an end goes on to the end of the page; any other one that has none is as if it weren't there.
_ENDLESS = frozenset("script style title textarea".split())
#: Elements that a new one ends when it begins, up to the container that holds them.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
}
_KEEPS_P = frozenset("button label option optgroup select legend body html".split())
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>"']|"[^"]*+"|'[^']*+'|["'])*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*+)\s*+(?:=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
_NAMED = frozenset(("class", "id", "role", "itemprop", "aria-label"))
_TOKEN = re.compile(r"[a-z]+")
_PUNCT = re.compile(r"[.,;:!?。，]")

#: Features of a node, in the order of ``Page.features``.
WIDTH = 27


@dataclass
class Page:
    """Blocks and runs of text of a page in page order; a run is a leaf of what stands directly in a block."""

    tag: list[str] = field(default_factory=list)
    tokens: list[tuple[str, ...]] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)  # of runs; None: a block
    linked: list[int] = field(default_factory=list)  # characters in links
    tags: list[int] = field(default_factory=list)  # elements in it besides blocks
    controls: list[int] = field(default_factory=list)

    def add(self, tag: str, tokens: tuple[str, ...], parent: int, text: str | None = None, linked: int = 0, tags: int = 0, controls: int = 0) -> int:
        for column, value in zip((self.tag, self.tokens, self.parent, self.text, self.linked, self.tags, self.controls), (tag, tokens, parent, text, linked, tags, controls), strict=True):
            column.append(value)
        return len(self.tag) - 1


def _tokens(attributes: str) -> tuple[str, ...]:
    out: list[str] = []
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name in _NAMED:
            out += _TOKEN.findall(value)
        elif name == "hidden" or name == "style" and "display" in value and "none" in value:
            out.append("hidden")
    return tuple(out)


@lru_cache(maxsize=32)
def _end_of(name: str) -> re.Pattern:
    return re.compile(rf"</{name}\b[^>]*+>", re.I)


def parse(source: str) -> Page:
    """A page's blocks; unclosed and misplaced tags end where browsers would end them, as far as text goes."""
    page = Page()
    root = page.add("html", (), -1)
    stack, texts, links = [root], [], 0
    linked = inline = controls = 0

    def flush() -> None:
        nonlocal linked, inline, controls
        if texts:
            run = " ".join(html.unescape("".join(texts)).split())
            if run:
                page.add("#text", (), stack[-1], run, linked, inline, controls)
            elif controls:
                page.controls[stack[-1]] += controls
            texts.clear()
        elif controls:
            page.controls[stack[-1]] += controls
        linked = inline = controls = 0

    at = 0
    for m in iter(lambda: _TAG.search(source, at), None):
        if m.start() > at:
            piece = source[at : m.start()]
            texts.append(piece)
            if links:
                linked += len(piece)
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            if name == "a":
                links = 0
            elif name in _BLOCK:
                flush()
                links = 0
                for k in range(len(stack) - 1, 0, -1):
                    if page.tag[stack[k]] == name:
                        del stack[k:]
                        break
            continue
        if name in _RAW:
            if name == "head":  # what it holds is raw or void
                continue
            if not m[3].endswith("/"):
                end = _end_of(name).search(source, at)
                at = end.end() if end else len(source) if name in _ENDLESS else at
            controls += name == "textarea"
            continue
        if name in _BLOCK:
            if name in ("html", "body"):
                flush()
                if name == "body" and (found := _tokens(m[3])):
                    page.tokens[root] += found
                continue
            flush()
            if name in _ENDS:
                ended, within = _ENDS[name]
                for k in range(len(stack) - 1, 0, -1):
                    if page.tag[stack[k]] in within:
                        break
                    if page.tag[stack[k]] in ended:
                        del stack[k:]
            elif name not in _KEEPS_P and page.tag[stack[-1]] == "p":
                stack.pop()
            if name not in _VOID:
                stack.append(page.add(name, _tokens(m[3]), stack[-1]))
            links = 0
        else:
            inline += 1
            if name == "a":
                links = 1
            elif name == "br":
                texts.append(" ")
            elif name == "input":
                controls += 1
    if at < len(source):
        texts.append(source[at:])
    flush()
    return page


class Encoding:
    """Of a tag or attribute token the log-odds of main text, as learned; unknown ones are neutral."""

    def __init__(self, tag: dict[str, float], token: dict[str, float]):
        self.tag, self.token = tag, token

    @classmethod
    def learn(cls, pages: list[Page], labels: list[list[int]]) -> Encoding:
        """From the nodes at which a decision is made: those that share not their parent's."""
        sums = (defaultdict(lambda: [1.0, 1.0]), defaultdict(lambda: [1.0, 1.0]))
        for page, label in zip(pages, labels, strict=True):
            for i, (tag, tokens) in enumerate(zip(page.tag, page.tokens, strict=True)):
                if i and not label[page.parent[i]]:
                    continue  # it goes with its parent and tells nothing itself
                sums[0][tag][label[i]] += 1
                for t in set(tokens):
                    sums[1][t][label[i]] += 1
        return cls(*({k: math.log(v[1] / v[0]) for k, v in s.items()} for s in sums))


def features(page: Page, code: Encoding) -> np.ndarray:
    """A row of WIDTH features per node: subtree density, attribute tokens, depth, siblings, ancestors."""
    n = len(page.tag)
    parent = page.parent
    chars, linked, tags, punct, runs, words = ([0] * n for _ in range(6))
    paragraphs, items, controls = [0] * n, [0] * n, list(page.controls)
    depth, begin = [0] * n, [0] * n
    total = 0
    for i in range(n):
        if i:
            depth[i] = depth[parent[i]] + 1
        begin[i] = total
        text = page.text[i]
        if text is not None:
            chars[i] = len(text)
            total += chars[i]
            linked[i] = min(page.linked[i], chars[i])
            punct[i] = len(_PUNCT.findall(text))
            words[i] = text.count(" ") + 1
            runs[i] = 1
            tags[i] = page.tags[i]
        else:
            tags[i] = 1
            paragraphs[i] = page.tag[i] == "p"
            items[i] = page.tag[i] == "li"
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(1, n):
        children[parent[i]].append(i)
    for i in range(n - 1, 0, -1):
        p = parent[i]
        for column in (chars, linked, tags, punct, runs, words, paragraphs, items, controls):
            column[p] += column[i]
    log = math.log1p
    low_tag, low_token, high_token = [0.0] * n, [0.0] * n, [0.0] * n
    rows = np.zeros((n, WIDTH), dtype=np.float32)
    total = total or 1
    place = [0] * n
    most = [0] * n
    for i in range(n):
        for k, c in enumerate(children[i]):
            place[c] = k
            most[i] = max(most[i], chars[c])
    out = []
    for i in range(n):
        p = parent[i]
        own = code.tag.get(page.tag[i], 0.0)
        scores = [code.token.get(t, 0.0) for t in page.tokens[i]]
        own_low, own_high = min(scores, default=0.0), max(scores, default=0.0)
        if p < 0:
            near, before, after, above_tag = [i], 0, 0, 0.0
            low_tag[i] = low_token[i] = high_token[i] = 0.0
        else:
            near = children[p]
            k = place[i]
            before = chars[near[k - 1]] if k else 0
            after = chars[near[k + 1]] if k + 1 < len(near) else 0
            above_tag = code.tag.get(page.tag[p], 0.0)
            low_tag[i] = min(low_tag[p], own)
            low_token[i] = min(low_token[p], own_low)
            high_token[i] = max(high_token[p], own_high)
        c = chars[i] or 1
        up = max(p, 0)
        out.append(
            (
                own, own_low, own_high, low_tag[i], low_token[i], high_token[i], above_tag, depth[i],
                log(chars[i]), linked[i] / c, log(chars[i] / (tags[i] + 1)), punct[i] / c, log(words[i] / (runs[i] or 1)), chars[i] / total, begin[i] / total,
                log(len(near)), place[i], chars[i] / (most[up] or 1), log(before), log(after),
                log(chars[up]), linked[up] / (chars[up] or 1), log(paragraphs[i]), log(items[i]), controls[i], page.text[i] is not None, log(len(children[i])),
            )
        )
    rows[:] = out
    return rows


def decode(page: Page, logit: np.ndarray) -> list[bool]:
    """Kept nodes: the set with the largest sum of log-odds in which each node's ancestors are kept too."""
    worth = logit.tolist()
    for i in range(len(worth) - 1, 0, -1):
        if worth[i] > 0:
            worth[page.parent[i]] += worth[i]
    kept = [True] * len(worth)
    for i in range(1, len(worth)):
        kept[i] = kept[page.parent[i]] and worth[i] > 0
    return kept


@dataclass
class Extractor:
    code: Encoding
    trees: boosting.Trees

    def extract(self, sources: list[str]) -> list[str]:
        """Main text of each page: its kept runs, joined by line ends."""
        pages = [parse(s) for s in sources]
        if not pages:
            return []
        made = [features(p, self.code) for p in pages]
        logit = np.split(self.trees.logit(np.concatenate(made)), np.cumsum([len(x) for x in made])[:-1])
        out = []
        for page, z in zip(pages, logit, strict=True):
            kept = decode(page, z)
            out.append("\n".join(t for t, k in zip(page.text, kept, strict=True) if k and t is not None))
        return out


@lru_cache(maxsize=2)
def trained(pages: int = 1500, seed: int = 7) -> Extractor:
    """Fitted on generated pages of which the main text is known; ``pages`` bounds them."""
    samples = html_samples.generate(pages, seed)
    parsed = [parse(s) for s, _ in samples]
    labels = [_labels(p, main) for p, (_, main) in zip(parsed, samples, strict=True)]
    code = Encoding.learn(parsed, labels)
    x = np.concatenate([features(p, code) for p in parsed])
    y = np.concatenate([np.array(k, dtype=np.float64) for k in labels])
    return Extractor(code, boosting.fit(x, y, np.ones(len(y))))


def _labels(page: Page, main: set[str]) -> list[int]:
    """1 for runs of main text and for blocks that hold one."""
    out = [0] * len(page.tag)
    for i in range(len(out) - 1, -1, -1):
        if page.text[i] is not None:
            out[i] = int(page.text[i] in main)
        if out[i] and i:
            out[page.parent[i]] = 1
    return out


def main_text(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None, extractor: Extractor | None = None) -> DataFrame:
    """The columns ``keep`` (default: all others) and ``text``, the main text of each whole page.

    Within a block white space is one space, blocks are joined by a line end. Null and empty pages have an
    empty text, as have pages without main text; rows that repeat get the same text; an empty table gives an
    empty result. A kept column named ``text`` is an error.
    """
    keep = [c for c in pages.columns if c != html_col] if keep is None else keep
    if "text" in {c.lower() for c in keep}:
        raise ValueError("column text would appear twice")
    extractor = extractor or trained()
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep) + ", text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = extractor.extract([t.as_py() or "" for t in part.columns[-1]])
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], names=[*keep, "text"])

    return pages.select(*[pages[c] for c in keep], pages[html_col].alias("__html")).mapInArrow(run, schema)
