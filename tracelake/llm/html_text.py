"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one for each block. Elements that never hold the
article (menus, forms, notices, ...) are left out. Lengths of text are summed over
windows of three lines; where the sum rises from nothing above a threshold the text
surges, where it falls back to nothing it dives, and the lines between are kept. This
decides on every page; markup only weighs the lengths: a line made mostly of links has
none, and where ``<article>`` or ``<main>`` is marked, lines on the unlikely side of the
mark have an eighth. The mark is trusted where it holds the headline or half of the
text that counts; otherwise it is taken for teasers of other articles. Empty lines part
what lies on two sides of a mark, and what lies on two sides of something left out,
unless both sides belong to one body: the same enclosing element, or the trusted mark.
A surge needs 86 characters, or half of the page's largest sum if that is less.

Character references are decoded in each piece of text between two tags by itself.
Null and empty pages have an empty text. Markup that is broken or cut off is
read as far as it goes: an element that is never closed ends with its parent,
one that only its class or style rules out at the next block. Pages are read
whole, in time linear in their length; an empty table gives an empty one. Repeated
rows are treated alike. An input column named like an output column is replaced.
"""

from __future__ import annotations

import html
import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import ship, text_of, with_result

WINDOW = 3
SURGE = 86
# What lies on the unlikely side of a mark counts for one part in so many.
UNLIKELY = 8

# Names of elements, roles and class words.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html li main "
    "menu nav ol optgroup option p pre section select summary table tbody tfoot thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset(
    "head script style nav footer aside form noscript template iframe svg math canvas object "
    "audio video button select textarea dialog menu title noembed noframes".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split()
)
DROPPED_CLASSES = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsense adslot sponsor sponsored promo "
    "promotion cookie cookies consent gdpr notice notices notification popup modal overlay "
    "newsletter subscribe subscription signup sidebar widget widgets related recommended "
    "recommendations share sharing social comment comments commentlist disqus replies respond "
    "breadcrumb breadcrumbs nav navbar navigation menu footer header masthead toolbar pagination "
    "pager login".split()
)
# Of these, the ones that lists of other articles have too.
LISTS = frozenset(
    "comment comments commentlist disqus replies respond related recommended recommendations "
    "sidebar widget widgets".split()
)
# Left out, these end a body; other elements may stand in the middle of one.
BODY_ENDS = frozenset("nav footer header head".split())
CONTAINERS = frozenset(
    "article aside blockquote body center dd details div dl figure li main ol section table td th ul".split()
)
CLASS_EXCEPTIONS = frozenset("has no not with without show hide".split())
NEVER_DROPPED = frozenset("html body main".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/><]*+)(?P<attributes>(?:[^<>\"']|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*?)(?:>|(?=<)|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(
    r"(class|id|role|style|hidden|aria-hidden)\s*+(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?", re.I
)
NO_DISPLAY = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Tag:
    name: str
    starts: bool
    attributes: str
    before: str  # decoded text between the tag before and this one
    end: int = 0  # of a start tag: where the element ends
    closed: bool = False


@dataclass
class Line:
    text: str
    links: int
    in_article: bool
    headline: bool
    body: int  # the start tag of the element it stands in
    gap: bool  # something was left out before it
    parted: bool  # and it ended what was before


def read_tags(page: str) -> list[Tag]:
    """The tags of a page in order, with the text before each; the last is the end."""
    tags, text, at = [], [], 0
    while m := TOKEN.search(page, at):
        text.append(html.unescape(page[at : m.start()]))
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        tags.append(Tag(name, not m["end"], m["attributes"] or "", "".join(text)))
        text = []
        if name in RAW and not m["end"]:
            stop = re.compile(rf"</{re.escape(name)}\b", re.I).search(page, at)
            at = stop.start() if stop else len(page)
    tags.append(Tag("", False, "", "".join([*text, html.unescape(page[at:])])))
    _match(tags)
    return tags


def _match(tags: list[Tag]) -> None:
    """Where each element ends, and whether by its own end tag."""
    open_: list[Tag] = []
    names: Counter[str] = Counter()
    for k, tag in enumerate(tags):
        if tag.starts:
            tag.end = k
            if tag.name not in VOID and not tag.attributes.endswith("/"):
                open_.append(tag)
                names[tag.name] += 1
        elif names[tag.name]:
            while True:
                top = open_.pop()
                names[top.name] -= 1
                top.end = k
                if top.name == tag.name:
                    top.closed = True
                    break
    for tag in open_:
        tag.end = len(tags) - 1


def _ruled_out(tag: Tag, holds_article: bool) -> bool:
    """Whether class, id, role or style say that an element is not the article.

    What holds an article is a frame around it, whatever its class, unless it is
    a list of comments or of other articles.
    """
    if not tag.attributes or tag.name in NEVER_DROPPED:
        return False
    for m in ATTRIBUTE.finditer(tag.attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value.strip() in DROPPED_ROLES:
            return True
        if name == "style" and NO_DISPLAY.search(value):
            return True
        if name in ("class", "id"):
            for word in value.split():
                if holds_article:
                    if word in LISTS:
                        return True
                    continue
                parts = re.split(r"[^a-z0-9]+", word)
                if parts[0] not in CLASS_EXCEPTIONS and not DROPPED_CLASSES.isdisjoint(
                    (parts[0], parts[-1])
                ):
                    return True
    return False


def _ends_body(tag: Tag) -> bool:
    """Whether an element that is left out also ends the text before it."""
    if tag.name in BODY_ENDS:
        return True
    for m in ATTRIBUTE.finditer(tag.attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "role" and value.strip() in DROPPED_ROLES:
            return True
        if name in ("class", "id") and not LISTS.isdisjoint(re.split(r"[^a-z0-9]+", value)):
            return True
    return False


def read_lines(page: str) -> list[Line]:
    """The blocks of a page outside of dropped elements."""
    tags = read_tags(page)
    # how many articles, and how many of them or headlines, begin before each tag
    articles = [0, *itertools.accumulate(t.starts and t.name in ("article", "main") for t in tags)]
    heads = [0, *itertools.accumulate(t.starts and t.name in ("article", "main", "h1") for t in tags)]
    lines: list[Line] = []
    text: list[str] = []
    links = link_depth = 0
    gap = parted = False
    article_ends: list[int] = []
    headline_end = -1
    bodies: list[tuple[int, int]] = []  # the open containers: where each begins and ends

    def end_line() -> None:
        nonlocal links, gap, parted
        line = " ".join("".join(text).split())
        text.clear()
        if line:
            body = bodies[-1][0] if bodies else -1
            lines.append(Line(line, links, bool(article_ends), k <= headline_end, body, gap, parted))
            gap = parted = False
        links = 0

    k = 0
    while k < len(tags):
        tag = tags[k]
        while article_ends and article_ends[-1] < k:
            article_ends.pop()
        while bodies and bodies[-1][1] < k:
            bodies.pop()
        if tag.before:
            text.append(tag.before)
            if link_depth:
                links += len(tag.before)
        if tag.starts:
            by_name = tag.name in DROPPED or tag.name == "header" and not article_ends
            if tag.name == "form" and heads[tag.end] > heads[k + 1]:
                by_name = False  # a form around the whole page
            if by_name or _ruled_out(tag, articles[tag.end] > articles[k + 1]):
                end_line()
                gap = True
                parted |= _ends_body(tag)
                k = _after(tags, k, by_name)
                link_depth = 0
                continue
        if tag.name in BLOCKS or not tag.name:
            end_line()
        elif tag.name in ("br", "td", "th"):
            text.append(" ")
        elif tag.name == "a":
            link_depth = int(tag.starts)
        if tag.starts and tag.name in ("article", "main"):
            article_ends.append(tag.end)
        if tag.starts and tag.name == "h1":
            headline_end = max(headline_end, tag.end)
        if tag.starts and tag.name in CONTAINERS and tag.name not in VOID:
            bodies.append((k, tag.end))
        k += 1
    end_line()
    return lines


def _after(tags: list[Tag], k: int, by_name: bool) -> int:
    """Where reading goes on after a dropped element."""
    tag = tags[k]
    if tag.closed or tag.end == k:
        return tag.end + 1
    stop = tag.end
    for j in range(k + 1, stop):
        other = tags[j]
        if other.name in (("article", "main") if by_name else BLOCKS):
            # the text before it belongs to what is dropped
            other.before = ""
            return j
    tags[stop].before = ""
    return stop


def weighed(lines: list[Line]) -> tuple[list[int], bool]:
    """The length of each line as far as it counts, and whether the mark is trusted."""
    sizes = [len(line.text) if line.links * 2 <= len(line.text) else 0 for line in lines]
    marked = sum(size for size, line in zip(sizes, lines) if line.in_article)
    trusted = 2 * marked >= sum(sizes) or any(line.headline and line.in_article for line in lines)
    if not any(line.in_article for line in lines):
        return [size * UNLIKELY for size in sizes], False
    if trusted:
        # inside the article a list of links is part of it
        return [
            len(line.text) * UNLIKELY if line.in_article else size for size, line in zip(sizes, lines)
        ], True
    return [size * (1 if line.in_article else UNLIKELY) for size, line in zip(sizes, lines)], False


def main_text(page: str) -> str:
    """The article's blocks, joined by empty lines."""
    lines = read_lines(page)
    if not lines:
        return ""
    sizes, trusted = weighed(lines)
    lengths, number = [], []
    before = None
    for k, (line, size) in enumerate(zip(lines, sizes)):
        if before is None:
            empty = 0
        elif line.in_article != before.in_article or not size:
            empty = WINDOW
        elif line.in_article and trusted:
            empty = 0
        elif line.parted or line.gap and line.body != before.body:
            empty = WINDOW
        else:
            empty = 0
        lengths += [0] * empty
        number += [-1] * empty
        if size:
            lengths.append(size)
            number.append(k)
        before = line
    sums = np.convolve(np.array(lengths + [0] * WINDOW), np.ones(WINDOW, dtype=int))
    surge = max(min(SURGE * UNLIKELY, (int(sums.max(initial=0)) + 1) // 2), 1)
    # stretches of windows with text, from surge to dive
    filled = np.flatnonzero(np.diff(np.concatenate([[0], (sums > 0).astype(int), [0]])))
    kept = []
    for begin, dive in filled.reshape(-1, 2):
        if sums[begin:dive].max() >= surge:
            kept += [lines[k].text for k in number[begin:dive] if k >= 0]
    return "\n\n".join(kept)


def extract(pages: DataFrame, page: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(p.as_py() or "") for p in batch], pa.string())

    extracted = F.arrow_udf(run, "string").asNondeterministic()
    found = with_result(pages, F.struct(extracted(text_of(page)).alias("t")), {"t": "text"})
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))
