"""Main text of web pages: flat text blocks, judged by a decision tree."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookledger.llm.html_training import PAGES

# ---------------------------------------------------------------- blocks

#: Elements whose text never counts.
SKIPPED = frozenset(
    "script style noscript template iframe textarea select option button svg math object canvas audio video head title".split()
)
#: Of these the content is no markup; it ends at the end tag only.
RAW = frozenset("script style noscript template iframe textarea title svg math".split())
#: Elements inside a line of text; all others begin and end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark meter nobr q ruby "
    "rb rp rt s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILER_TAGS = frozenset("nav footer aside form menu dialog".split())
ARTICLE_TAGS = frozenset("article main".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
BOILER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion promoted sidebar menu nav navi "
    "navigation navbar topbar toolbar breadcrumb breadcrumbs header masthead footer cookie cookies consent notice notices gdpr "
    "popup modal overlay newsletter subscribe subscription signup login search share sharing social related recommended "
    "comment comments reply replies respond disqus copyright legal disclaimer pagination pager widget skip alert".split()
)
#: Names and tags of page parts that inside an article hold its title.
HEADERS = frozenset(["header", "masthead"])
ARTICLE_NAMES = frozenset("article content main post entry story body text maincontent".split())
COMMENT_NAMES = frozenset("comment comments reply replies respond disqus".split())
#: A class that begins with one of these says how a page is laid out, not what an element is; the others say where it stands.
LAYOUT = frozenset("no not has with without is js".split())
POSITIONS = frozenset("inner outer wrapper wrap container box left right top bottom area section block list item".split())

TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)"
    # A quote opens a value only behind an equals sign; elsewhere it is a character like others.
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)"
    r"(?P<attributes>(?:[^>=]|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>\"'][^\s>]*)?)*+)(?P<end>>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
NAME = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+(?![a-z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


#: What the nearest element that says so makes of a block: (part of) a menu, notice, advert and the like; nothing;
#: named like an article; an article.
BOILER, UNMARKED, NAMED, ARTICLE = -1, 0, 1, 2


@dataclass
class Block:
    """Text without line breaks, and what is known about its place."""

    parts: list[str] = field(default_factory=list)
    link_parts: list[str] = field(default_factory=list)
    mark: int = UNMARKED
    heading: bool = False
    keep: str | None = None
    text: str = ""


@dataclass(frozen=True)
class Place:
    """An open element, with what it inherits. ``closed``: not even an article in it is the page's article."""

    tag: str
    skipped: bool = False
    mark: int = UNMARKED
    closed: bool = False
    heading: bool = False
    keep: str | None = None


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def _says(name: str, words: frozenset[str]) -> bool:
    """Whether a class or id is about one of ``words``: short ones by any part, long ones by what they end in."""
    parts = [p.lower() for p in NAME.findall(name)]
    if not parts or parts[0] in LAYOUT:
        return False
    while len(parts) > 1 and parts[-1] in POSITIONS:
        parts.pop()
    return bool(words & set(parts if len(parts) <= 2 else parts[-1:]))


def _mark(place: Place, tag: str, given: dict[str, str]) -> tuple[int, bool]:
    """Mark and ``closed`` of an element: its own tag, role or name, else what it inherits.

    An article counts inside a form or a part that is only named like a menu, which may wrap a whole page; not
    inside menus, footers and the like, or readers' comments.
    """
    names = [*given.get("class", "").split(), given.get("id", "")]
    role = given.get("role", "").lower()
    about = lambda words: any(_says(n, words) for n in names)
    if place.closed or tag in ("html", "body"):
        return place.mark, place.closed
    if tag in ARTICLE_TAGS or role == "main":
        # An article element may be a reader's comment; its name says so.
        return (BOILER, True) if tag == "article" and about(COMMENT_NAMES) else (ARTICLE, False)
    if (tag in BOILER_TAGS and tag != "form") or role in BOILER_ROLES - {"form"} or about(COMMENT_NAMES):
        return BOILER, True
    if tag == "form" or role == "form" or about(BOILER_NAMES - HEADERS):
        return BOILER, False
    # The header of an article is its title.
    if place.mark != ARTICLE and (tag == "header" or about(HEADERS)):
        return BOILER, False
    if place.mark == UNMARKED and about(ARTICLE_NAMES):
        return NAMED, False
    return place.mark, False


def _enter(place: Place, tag: str, text: str) -> Place:
    given = _attributes(text) if text.strip() else {}
    mark, closed = _mark(place, tag, given)
    hidden = "hidden" in given or given.get("aria-hidden") == "true" or bool(HIDDEN.search(given.get("style", "")))
    return Place(
        tag,
        place.skipped or tag in SKIPPED or hidden,
        mark,
        closed,
        tag in ("h1", "h2", "h3", "h4", "h5", "h6"),
        given.get("data-keep", place.keep),
    )


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order; white space is single and references are decoded.

    Missing end tags, end tags without a start, and pages that break off anywhere are fine.
    """
    out: list[Block] = []
    stack = [Place("")]
    block, link = Block(), False

    def add(text: str) -> None:
        nonlocal block
        if not stack[-1].skipped:
            text = html.unescape(text)
            if not block.parts:
                if not text.strip():
                    return
                p = stack[-1]
                block = Block(mark=p.mark, heading=p.heading, keep=p.keep)
            block.parts.append(text)
            if link:
                block.link_parts.append(text)

    def flush() -> None:
        nonlocal block
        if block.parts:
            block.text = " ".join("".join(block.parts).split())
            if block.text:
                out.append(block)
            block = Block()

    at = 0
    while at < len(page):
        found = TOKEN.search(page, at)
        if found is None:
            add(page[at:])
            break
        if found.start() > at:
            add(page[at : found.start()])
        at = found.end()
        if not found["tag"]:
            continue
        tag = found["tag"].lower()
        if found["close"]:
            if tag == "a":
                link = False
            if tag not in INLINE:
                flush()
                link = False
            if tag not in VOID and any(p.tag == tag for p in stack):
                while stack.pop().tag != tag:
                    pass
                stack = stack or [Place("")]
            continue
        if tag in RAW:
            flush() if tag in ("title", "textarea", "iframe") else None
            end = re.compile(f"</{tag}\\b[^>]*(?:>|\\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "br":
            add(" ") if block.parts else None
            continue
        if tag in INLINE:
            if tag == "a":
                link = True
            elif tag not in VOID and found["attributes"].strip():
                entered = _enter(stack[-1], tag, found["attributes"])
                if entered.skipped:
                    stack.append(entered)
            continue
        flush()
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option", "h1", "h2", "h3", "h4", "h5", "h6") and stack[-1].tag == tag:
            stack.pop()
        if tag == "body":
            # The head ends here, whether or not its end tag is there.
            stack = [p for p in stack if p.tag != "head" and not p.skipped]
        if tag not in VOID and not found["attributes"].endswith("/"):
            stack.append(_enter(stack[-1], tag, found["attributes"]))
    flush()
    return out


FEATURES = (
    "mark", "heading", "words", "link_density", "previous_words", "previous_link_density",
    "next_words", "next_link_density",
)


def features(listed: list[Block]) -> np.ndarray:
    """A row for each block. Beyond the page's ends there are blocks without words."""
    words = np.array([len(b.text.split()) for b in listed], dtype=np.float64)
    linked = np.array([len("".join(b.link_parts).split()) for b in listed], dtype=np.float64)
    density = np.minimum(1.0, linked / np.maximum(1.0, words))
    around = lambda x: (np.concatenate(([0.0], x[:-1])), np.concatenate((x[1:], [0.0])))
    (before, after), (before_density, after_density) = around(words), around(density)
    own = np.array([[b.mark, b.heading] for b in listed], dtype=np.float64).reshape(-1, 2)
    return np.column_stack([own, words, density, before, before_density, after, after_density])


# ---------------------------------------------------------------- the tree


@dataclass(frozen=True)
class Leaf:
    keep: bool


@dataclass(frozen=True)
class Split:
    feature: int
    border: float
    low: Leaf | Split
    high: Leaf | Split


def _impurity(labels: np.ndarray) -> float:
    share = labels.mean() if len(labels) else 0.0
    return 2 * share * (1 - share) * len(labels)


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 5) -> Leaf | Split:
    """A classification tree by Gini impurity; ties take the first feature and the lowest border."""
    best, plain = None, _impurity(labels)
    if depth and 0 < labels.mean() < 1:
        for feature in range(rows.shape[1]):
            values = np.unique(rows[:, feature])
            for border in (values[1:] + values[:-1]) / 2:
                low = rows[:, feature] <= border
                gain = plain - _impurity(labels[low]) - _impurity(labels[~low])
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, feature, float(border), low)
    if best is None:
        return Leaf(bool(labels.mean() >= 0.5))
    _, feature, border, low = best
    return Split(feature, border, grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1))


def judge(tree: Leaf | Split, row: np.ndarray) -> bool:
    while isinstance(tree, Split):
        tree = tree.low if row[tree.feature] <= tree.border else tree.high
    return tree.keep


def trained_tree() -> Leaf | Split:
    """The tree that the labelled table gives; both have a fixed, small size."""
    rows, labels = [], []
    for page in PAGES:
        listed = blocks(page)
        marked = [b.keep is not None for b in listed]
        rows.append(features(listed)[marked])
        labels += [b.keep == "1" for b in listed if b.keep is not None]
    return grow(np.concatenate(rows), np.array(labels))


def main_text(page: str, tree: Leaf | Split) -> str:
    listed = blocks(page)
    if not listed:
        return ""
    return "\n\n".join(b.text for b, row in zip(listed, features(listed), strict=True) if judge(tree, row))


def extract_text(pages: DataFrame, page: str = "html", keys: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keys`` and ``text``, the main text of every row, blocks joined by two line feeds.

    Null and empty pages, and pages without main text, have an empty text. Null keys are
    returned as null; repeated rows give repeated results; an empty table gives no rows; other
    columns are ignored. Pages are read whole, however long, and no row is moved.
    """

    tree = trained_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py() or "", tree) for p in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, type=pa.string())], names=[*keys, "text"]
            )

    rows = pages.select(*keys, F.col(page).cast("string").alias("_page"))
    schema = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes[:-1])
    return rows.mapInArrow(run, f"{schema}, text string")
