"""Main text of web pages by tag-path ratios.

A page is read as blocks of text, each under a root-to-leaf tag path (block elements with
their class names; inline, replaced and unknown elements don't break a block). Blocks of one path
are aggregated: text length outside links, characters in links, punctuation marks, number
of blocks. A path's ratios are its text per block and its punctuation per block; each is
smoothed over the page's paths with weights that fall with the distance in the tree of
paths (two passes over the tree), the two are fused by their product, and a path whose
fused ratio reaches a share of the page's deviation holds content. Text in elements such as
menus, headers, footers, forms, buttons or hidden ones is left out and lends nothing;
class, id and role names such as sidebar or comments lower what a path has and lends, once
for each element named so, against the path of the page that has fewest. A path under
``article`` or ``main`` weighs more, and where these hold most of the kept text the others
are left out. Paths whose text is mostly links are left out, but not below ``article``, where
a list of references is part of the text.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.common import texts_of

THRESHOLD = 0.05
MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>?", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
# Elements whose content is no markup, read to their own end tag.
RAW = frozenset("script style textarea title xmp noembed noframes".split())
# In these an element that ends in "/>" has no content, whatever it is.
FOREIGN = frozenset(("svg",))
# Formulas are read as part of the text they are in; their annotations repeat them.
ANNOTATION = frozenset(("annotation", "annotation-xml"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that begin and end a block of text; every other one stands in a line of text.
BLOCK = frozenset("address article aside blockquote body br caption center colgroup col dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
                  "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
                  "table tbody td tfoot th thead tr ul".split())
# Elements that close an open one of the same group.
CLOSES = {t: frozenset(g) for g in (("p",), ("li",), ("dt", "dd"), ("tr",), ("td", "th"), ("option",), ("optgroup", "option")) for t in g}
BLOCKS_END_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
BOILERPLATE = frozenset("nav header footer aside form menu dialog noscript template svg iframe object select datalist option button canvas audio video".split())
# Of these the ones that stand in a line of text: it goes on behind them.
WITHIN = BOILERPLATE - BLOCK
# Names that tell what the rest of the page has or lacks.
FLAG = re.compile(r"(?:^|(?<=[\s_-]))(?:has|have|no|not|with|without)[_-]\S*", re.I)
NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|banner|sponsor(?:ed)?|promo|menu|nav|navbar|navigation|breadcrumbs?|header|masthead|footer|"
    r"sidebar|side|widget|related|recommended|cookies?|consent|notice|alert|popup|modal|newsletter|subscribe|signup|login|share|social|"
    r"comments?|replies|reply|respond|disqus|search|toolbar|pagination|pager|copyright|legal|complementary|contentinfo)(?:$|[\s_-])", re.I)
ARTICLE = frozenset(("article", "main"))
UNNAMED = ARTICLE | {"html", "body"}
NAMED = 0.01  # what a noisy name leaves of a path's ratio


class Path:
    """A node in the tree of a page's tag paths, and what it holds."""

    def __init__(self, parent: Path | None, tag: str = "", named: bool = False):
        self.parent, self.children = parent, {}
        self.named = named + (parent.named if parent else 0)
        self.article = tag == "article" or bool(parent and parent.article)
        self.inside = tag in ARTICLE or bool(parent and parent.inside)
        self.chars = self.linked = self.marks = self.blocks = 0

    def child(self, tag: str, label: str, named: bool) -> Path:
        key = (tag, label, named)
        if key not in self.children:
            self.children[key] = Path(self, tag, named)
        return self.children[key]


@dataclass
class Block:
    path: Path
    parts: list[str] = field(default_factory=list)
    linked: int = 0


@dataclass
class Open:
    """An element that is open: its path, and whether it or one around it is left out or foreign."""

    tag: str
    path: Path
    noise: bool
    foreign: bool


def attributes(text: str) -> dict[str, str]:
    """Attribute names in lower case and their values, the first of a name."""
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out


def _blocks(page: str) -> tuple[list[Block], Path]:
    """Text blocks in page order with their paths, and the root of these."""
    root = Path(None)
    stack = [Open("", root, False, False)]
    opened: Counter[str] = Counter()
    out: list[Block] = []
    block: Block | None = None
    links = at = 0

    def add(text: str) -> None:
        nonlocal block
        if not text or stack[-1].noise:
            return
        if block is None:
            if text.isspace():
                return
            block = Block(stack[-1].path)
            out.append(block)
        block.parts.append(text)
        if links:
            block.linked += len(text)

    def close(names: frozenset[str], stop: frozenset[str] = frozenset()) -> None:
        if not any(opened[n] for n in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                opened.subtract(o.tag for o in stack[k:])
                del stack[k:]
                return
            if stack[k].tag in stop:
                return

    while m := MARKUP.search(page, at):
        add(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        broken = tag in BLOCK
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            if broken or tag in BOILERPLATE:
                if broken and not stack[-1].noise:
                    block = None
                close(frozenset((tag,)))
            continue
        ended = m[3].rstrip().endswith("/")
        if tag in ANNOTATION:
            end = None if ended else re.compile(f"</{tag}\\s*>", re.I).search(page, at)
            at = end.end() if end else at
            continue
        if tag in RAW and not (ended and stack[-1].foreign):
            end = re.compile(f"</{tag}\\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        links += tag == "a" and not ended
        found = attributes(m[3]) if m[3].strip() else {}
        hidden = "hidden" in found or found.get("aria-hidden", "").strip().lower() == "true"
        noise = hidden or (tag in BOILERPLATE and not (tag == "header" and stack[-1].path.inside))
        if broken and not stack[-1].noise and not (noise and tag in WITHIN):
            block = None
        if tag in BLOCKS_END_P:
            close(frozenset(("p",)), frozenset(("td", "th", "button")))
            links = 0
        if tag in CLOSES and tag != "p":
            close(CLOSES[tag], frozenset(("ul", "ol", "dl", "table")))
        if tag in VOID or ended or not (broken or noise):
            continue
        label = found.get("class", "").strip()
        names = " ".join((label, found.get("id", ""), found.get("role", ""))).strip()
        named = tag not in UNNAMED and bool(names and NOISE.search(FLAG.sub("", names)))
        above = stack[-1]
        stack.append(Open(tag, above.path.child(tag, label, named) if broken else above.path, noise or above.noise, above.foreign or tag in FOREIGN))
        opened[tag] += 1
    rest = page[at:]
    cut = rest.find("<")
    add(rest if cut < 0 or not re.match(r"</?[a-zA-Z!]", rest[cut:]) else rest[:cut])
    return out, root


def _smoothed(root: Path, left: dict[int, float]) -> dict[int, tuple[float, float, float]]:
    """For each path with text the sums over all such paths of their weight, text and
    punctuation, each lowered by exp(-1/2) for every tag between the two paths."""
    order, near = [root], math.exp(-0.5)
    for p in order:
        order.extend(p.children.values())
    below = {}
    for p in reversed(order):  # what the paths below lend, then what those above and beside do
        w = left.get(id(p), 0.0)
        own = (w, w * p.chars / p.blocks, w * (p.marks + 1) / p.blocks) if w else (0.0, 0.0, 0.0)
        parts = [below[id(c)] for c in p.children.values()]
        below[id(p)] = tuple(own[i] + near * sum(x[i] for x in parts) for i in range(3))
    whole = {id(root): below[id(root)]}
    for p in order[1:]:
        up = whole[id(p.parent)]
        whole[id(p)] = tuple(b + near * (u - near * b) for b, u in zip(below[id(p)], up))
    return {k: whole[k] for k in left}


def main_text(page: str) -> str:
    """The page's content blocks, one to a line."""
    blocks, root = _blocks(page)
    texts = []
    for b in blocks:
        text = " ".join(html.unescape("".join(b.parts)).split())
        texts.append(text)
        if text:
            p = b.path
            linked = min(b.linked, len(text))
            p.chars += len(text) - linked
            p.linked += linked
            p.marks += len(PUNCTUATION.findall(text))
            p.blocks += 1
    order = list({id(b.path): b.path for b in blocks if b.path.blocks}.values())
    usable = [p for p in order if p.article or p.chars > p.linked]
    if not usable:
        return ""
    fewest = min(p.named for p in usable)
    left = {id(p): NAMED ** min(3, p.named - fewest) for p in usable}
    fused: dict[int, float] = {}
    smooth = _smoothed(root, left)
    for p in usable:
        weight, long, marks = smooth[id(p)]
        fused[id(p)] = left[id(p)] * (4.0 if p.inside else 1.0) * long * marks / weight**2
    mean = sum(fused.values()) / len(fused)
    spread = math.sqrt(sum((x - mean) ** 2 for x in fused.values()) / len(fused))
    least = THRESHOLD * max(mean, spread)
    kept = [p for p in usable if fused[id(p)] >= least]
    inside = [p for p in kept if p.inside]
    if 2 * sum(p.chars for p in inside) > sum(p.chars for p in kept):  # an article's own paths are judged among themselves
        kept = inside
    chosen = {id(p) for p in kept}
    return "\n".join(t for b, t in zip(blocks, texts) if t and id(b.path) in chosen)


_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``, repeated ones too: page_id, url, text, n_chars. A null
    or empty page, and one without content, has empty text; an end that breaks off inside a
    tag loses that tag only. Pages are read whole, in time that grows with their length,
    however many paths they have. An empty table gives no rows; other columns are ignored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in texts_of(batch, "html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], schema=_OUT)

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
