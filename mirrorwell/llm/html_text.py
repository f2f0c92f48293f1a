"""Extract the main text of web pages with a tree-structured graphical model.

Every block of a page is a node that is content or not. Its tag, class names and text
give evidence, and parents and children tend to agree; sum-product messages up and down
the tree give each block's probability of being content. Both kinds of potential are
counted on labelled pages: those whose markup marks the main text.
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

#: The model is counted on so many labelled pages at most (those of the smallest hash).
FIT_PAGES = 2_000

_TAG = re.compile(
    r"<!--(?P<comment>.*?)(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)"
    # a quote is one only where a value begins
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*'|[^>\s\"'][^>\s]*+)?+)*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)", re.S)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_SENTENCE = re.compile(r"[.!?…]")
# Fixed sets of HTML itself.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset("script style noscript template iframe object svg title select "
                    "textarea button canvas audio video annotation annotation-xml".split())
_RAW = frozenset("script style textarea title iframe noscript".split())
_NO_NESTING = frozenset("button select".split())
# An unclosed raw element ends here.
_BODY_TAG = re.compile(
    r"<(?:/head|/?(?:body|article|main|section|header|footer|nav|aside|div|p|h[1-6]|ul|ol|dl|table|"
    r"blockquote|pre|figure|form|hr))(?=[\s/>])", re.I)
_INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q "
                    "s samp small span strike strong sub sup time tt u var wbr "
                    "math semantics mi mn mo ms mtext mspace mrow mfrac msup msub msubsup msqrt mroot mover "
                    "munder munderover mtable mtr mtd mstyle mpadded mphantom menclose".split())
#: The tag of a block implied by text outside every block element.
_LOOSE = "#text"
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: What the words of HTML and common class names say before any page is counted: pseudo-counts
#: for content and for the rest, so that kinds of block no labelled page has are judged too.
_MAIN = "article main"
_ASIDE = ("nav header footer aside form menu dialog sidebar comment comments reply replies respond "
          "disqus cookie cookies consent notice banner ad ads advert advertisement sponsor sponsored "
          "promo share social related recommended newsletter subscribe breadcrumb breadcrumbs "
          "pagination pager navbar topbar masthead colophon popup modal widget toolbar search login")
_PSEUDO = 40.0


@dataclass
class Page:
    """Blocks in page order; a block's parent comes before it."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    names: list[list[str]] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    stops: list[int] = field(default_factory=list)
    #: (block, text): white space and character references settled, never empty.
    texts: list[tuple[int, str]] = field(default_factory=list)


def parse(source: str) -> Page:
    """Blocks and texts of a page. Inline markup joins its block's text; a line break is
    white space. Scripts, styles and what never shows are left out; unclosed and stray
    tags are put up with: a silent element that is not closed within its block hides
    nothing, a raw one ends at the next tag of the body. A head holds silent elements
    only, so its own tags, which may be left out, say nothing."""
    page = Page()
    stack: list[int] = []
    pieces: list[str] = []
    link = 0
    link_chars = 0
    silent: str | None = None
    opened: list[int] = []  # where the silent elements of this name begin that are still open
    inner: Counter = Counter()  # blocks open inside the silent element
    unclosed: set[int] = set()

    def open_block(tag: str, names: list[str]) -> None:
        page.parent.append(stack[-1] if stack else -1)
        page.tag.append(tag)
        page.names.append(names)
        page.chars.append(0)
        page.linked.append(0)
        page.stops.append(0)
        stack.append(len(page.tag) - 1)

    def settle() -> None:
        nonlocal link_chars
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                if len(stack) == 1:
                    open_block(_LOOSE, [])
                    stack.pop()
                at = stack[-1] if len(stack) > 1 else len(page.tag) - 1
                page.texts.append((at, text))
                page.chars[at] += len(text)
                page.linked[at] += min(link_chars, len(text))
                page.stops[at] += len(_SENTENCE.findall(text))
        link_chars = 0

    def say(text: str) -> None:
        nonlocal link_chars
        if text and silent is None:
            pieces.append(text)
            if link:
                link_chars += len(text.strip())

    open_block("", [])
    at, size = 0, len(source)
    while at < size or silent is not None:
        found = _TAG.search(source, at)
        if found is None and silent is None:
            say(source[at:])
            break
        name = closing = None
        if found is not None:
            say(source[at:found.start()])
            at = found.end()
            name = found["name"] or found["name2"]
            if name is None:
                continue
            name = name.lower()
            closing = bool(found["end"] or found["end2"])
            slashed = (found["attrs"] or found["attrs2"] or "").rstrip().endswith("/")
            if name in _RAW:
                if not closing and not (slashed and silent == "svg"):
                    if silent is None:
                        settle()
                    end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(source, at)
                    cut = None if end else _BODY_TAG.search(source, at)
                    at = end.end() if end else cut.start() if cut else size
                continue
        if silent is not None:
            lost = 0  # how many of the open silent elements have no end
            if name is None:
                lost = len(opened)
            elif name == silent and closing:
                opened.pop()
            elif name == silent and name in _NO_NESTING:
                lost = 1
            elif name == silent:
                if not slashed:
                    opened.append(at)
            elif closing and inner[name]:
                inner[name] -= 1
            elif closing:
                if name != "p" and any(page.tag[i] == name for i in stack):
                    lost = len(opened)
            elif name not in _VOID and not slashed:
                inner[name] += 1
            if lost:
                unclosed.update(opened[:lost])
                at = opened[0]
            if lost or not opened:
                silent = None
            continue
        if name in _SILENT:
            if not closing:
                settle()
                if not slashed and at not in unclosed:
                    silent, opened, inner = name, [at], Counter()
            continue
        if name == "head":
            settle()
            continue
        if name == "br":
            say(" ")
        elif name in _INLINE:
            if name == "a":
                link = 0 if closing else 1
        elif name in _VOID:
            settle()
        elif closing:
            settle()
            link = 0
            for i in range(len(stack) - 1, 0, -1):
                if page.tag[stack[i]] == name:
                    del stack[i:]
                    break
        else:
            settle()
            link = 0
            # an open paragraph ends where a block begins, an item where the next one does
            while len(stack) > 1 and (page.tag[stack[-1]] == "p" or page.tag[stack[-1]] in _CLOSES.get(name, ())):
                stack.pop()
            names: list[str] = []
            for m in _NAMES.finditer(found["attrs"] or found["attrs2"] or ""):
                names += _WORD.findall((m[1] or m[2] or m[3] or "").lower())
            open_block(name, names)
    settle()
    return page


def evidence(page: Page, block: int) -> list[str]:
    """What is seen of a block."""
    chars = page.chars[block]
    out = [f"tag {page.tag[block]}"] + [f"name {n}" for n in sorted(set(page.names[block]))]
    if chars:
        out.append(f"chars {min(4, int(math.log(chars, 4)))}")
        out.append(f"links {(3 * page.linked[block]) // chars}")
        out.append(f"stops {min(2, page.stops[block])}")
    return out


def labels_of(page: Page) -> list[bool] | None:
    """Which blocks are content, told by markup; None if the page does not mark its main
    text, or marks several."""
    roots = [i for i, t in enumerate(page.tag) if t == "article"] or [
        i for i, t in enumerate(page.tag) if t == "main"]
    if len(roots) != 1:
        return None
    aside = set(_ASIDE.split())
    out = []
    for i, parent in enumerate(page.parent):
        inside = i == roots[0] or (parent >= 0 and out[parent])
        out.append(inside and page.tag[i] not in aside and not aside.intersection(page.names[i]))
    return out


@dataclass(frozen=True)
class Model:
    """Log odds of evidence for content, and how often a block is content given its parent."""

    odds: dict[str, float]
    agree: tuple[tuple[float, float], tuple[float, float]]

    def marginals(self, page: Page) -> list[float]:
        """The probability of being content of each block: messages go up, then down."""
        count = len(page.tag)
        own = []
        for i in range(count):
            score = sum(self.odds.get(e, 0.0) for e in evidence(page, i))
            if page.tag[i] == _LOOSE:
                # no element speaks against it: a weak prior, without the odds of its parent
                score += math.log(self.agree[0][0] / self.agree[0][1]) + 1.0
            score = max(-30.0, min(30.0, score))
            own.append((1.0, math.exp(score)))
        up = [(1.0, 1.0)] * count
        below = own[:]
        for i in range(count - 1, 0, -1):
            no, yes = below[i]
            up[i] = tuple(no * a[0] + yes * a[1] for a in self.agree)
            no, yes = up[i]
            parent = page.parent[i]
            p, q = below[parent][0] * no, below[parent][1] * yes
            below[parent] = (p / (p + q), q / (p + q))
        belief = [(0.0, 0.0)] * count
        belief[0] = (below[0][0], below[0][1] * 1e-9)  # the page itself is not content
        for i in range(1, count):
            p, q = belief[page.parent[i]]
            p, q = p / up[i][0], q / up[i][1]
            no = below[i][0] * (p * self.agree[0][0] + q * self.agree[1][0])
            yes = below[i][1] * (p * self.agree[0][1] + q * self.agree[1][1])
            belief[i] = (no / (no + yes), yes / (no + yes))
        return [b[1] / (b[0] + b[1]) for b in belief]


def extract(model: Model, source: str | None) -> str:
    """The texts of content blocks in page order, joined by one space."""
    if not source:
        return ""
    page = parse(source)
    if all(tag in ("", _LOOSE) for tag in page.tag):  # no block element: all of it is the text
        return " ".join(text for _, text in page.texts)
    likely = model.marginals(page)
    return " ".join(text for block, text in page.texts if likely[block] > 0.5)


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: Counter = Counter()
        for source in batch.column("html").to_pylist():
            page = parse(source or "")
            labels = labels_of(page)
            if labels is None:
                continue
            for i, label in enumerate(labels):
                if i:
                    seen["edge", f"{int(labels[page.parent[i]])}{int(label)}"] += 1
                seen["block", str(int(label))] += 1
                for e in evidence(page, i):
                    seen[e, str(int(label))] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()),
             pa.array(list(seen.values()), pa.int64())], names=["seen", "label", "n"])


def fit(pages: DataFrame, fit_pages: int = FIT_PAGES) -> Model:
    """Count the potentials on at most ``fit_pages`` pages that mark their main text,
    those of the smallest hash of page_id. Without any, the pseudo-counts alone decide."""
    marked = pages.where(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    order = F.xxhash64("page_id")
    # the bound is found on hashes alone, so only about fit_pages whole pages move
    last = marked.select(order.alias("h")).orderBy("h").limit(fit_pages).agg(F.max("h")).first()[0]
    near = marked.where(order <= F.lit(last)) if last is not None else marked
    chosen = near.orderBy(order, "page_id").limit(fit_pages).select("html")
    rows = (chosen.repartition(8).mapInArrow(_count_rows, "seen string, label string, n long")
            .groupBy("seen", "label").agg(F.sum("n").alias("n")).collect())
    count: Counter = Counter()
    for r in rows:
        count[r["seen"], r["label"]] += r["n"]
    for word in _MAIN.split():
        count[f"tag {word}", "1"] += _PSEUDO
    for word in _ASIDE.split():
        count[f"tag {word}", "0"] += _PSEUDO
        count[f"name {word}", "0"] += _PSEUDO
    total = {y: count["block", y] + 2 * _PSEUDO for y in "01"}
    odds = {}
    for seen in {k[0] for k in count} - {"edge", "block"}:
        yes, no = ((count[seen, y] + 0.5) / (total[y] + 1) for y in "10")
        odds[seen] = math.log(yes / no)
    agree = []
    for parent in "01":
        a, b = count["edge", parent + "0"] + _PSEUDO, count["edge", parent + "1"] + _PSEUDO
        if parent == "0":
            a += 4 * _PSEUDO
        else:
            b += 4 * _PSEUDO
        agree.append((a / (a + b), b / (a + b)))
    return Model(odds, (agree[0], agree[1]))


def _text_rows(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(model, s) for s in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])
    return run


def main_texts(pages: DataFrame, model: Model) -> DataFrame:
    """``(page_id, url, text, n_chars)``, a row per row of ``pages``.

    ``text`` is the page's main text: blocks of content with character references decoded
    and white space settled, joined by one space; empty for a null or empty page or one
    without content. Null page_id and url stay null, repeated rows come out each, other
    columns are not read. Nothing is cut, however long.
    """
    given = pages.select(F.col("page_id").cast("long").alias("page_id"),
                         F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return given.mapInArrow(_text_rows(model), "page_id long, url string, text string, n_chars long")
