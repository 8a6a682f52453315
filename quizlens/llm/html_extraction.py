"""Operator 3: main text of web pages as the maximum-scoring subsequence of words and tags.

A page is a sequence of words, which score positive in running text, and tags, which score negative. The scores are log
odds counted on labelled pages: those that mark their own text with an article or main element. The mark itself is no
feature. One linear scan finds the contiguous region of the highest sum, which then grows to the element it lies in, so
tables and lists of the text stay with it. Menus, headers, footers, sidebars, notices, adverts, forms and comments are
known by element, role or class name; what of them lies inside the region is left out of the text.

Pages are independent of each other and read in linear time, however deep or broken they are; the weights are a small
table, fitted on a bounded sample.
"""

from __future__ import annotations

import html as entities
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled pages used for the weights, and characters of one of them.
SAMPLE_PAGES, SAMPLE_CHARS = 1000, 100_000

# HTML elements by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 head header hgroup hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
OUTSIDE = frozenset("aside button datalist dialog fieldset footer form head label legend menu nav optgroup option select".split())
CONTENT = frozenset(["article", "main"])
RAW = frozenset("iframe noscript script style svg template textarea title".split())
# Elements that hold blocks of text side by side, and those that hold the page.
GROUP, PAGE = frozenset("article center div fieldset form header main section".split()), frozenset(["", "html", "body"])
# Words of a class, id or role that name something other than the text.
NOT_TEXT = frozenset(
    "ad ads advert adverts advertisement advertising alert aside banner breadcrumb breadcrumbs byline comment comments commentlist complementary consent "
    "contentinfo cookie cookies copyright dialog disqus donate footer form gdpr hidden login masthead menu modal nav "
    "navbar navigation newsletter notice notices notification overlay pager pagination paywall popup privacy promo promoted "
    "promotion recommended related replies reply respond rail search share sharing sidebar signup skip social sponsor sponsored "
    "subscribe subscription tagcloud teaser toolbar tracking widget".split())
HEAD_NAMES = frozenset(["header", "topbar"])
# Names of what readers write, which is not the text however long it is.
REPLIES = frozenset("comment comments commentlist disqus replies reply respond".split())
# Inside marked text a name counts if all of it does: words like these may stand beside those above ("share-buttons").
STRUCTURE = frozenset(
    "area articles bar block body bottom box button buttons center col column container content entry fixed form group icon icons "
    "inline inner item items label left link links list main mobile module outer panel post posts right row section slot small "
    "stories story text title top unit us wrap wrapper x".split())
# A layout that has or lacks something is not that thing.
LAYOUT_FIRST, LAYOUT_LAST = frozenset("has is with without no not".split()), frozenset("closed off on open opened".split())

TAG = re.compile(r"<(/?)([a-z][^\s/<>]*+)", re.I)
ATTRIBUTES = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
BROKEN = re.compile(r"[^<>]*+>?")
NAMED = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Weights without any labelled page, and the bounds of learned ones.
PRIOR_TEXT, PRIOR_LINK, PRIOR_TAG, LEAST, MOST = 1.0, -0.5, -0.5, 0.02, 5.0
PRIOR_COUNT = 4.0


def _excluded(name: str, attrs: str, in_content: bool) -> str:
    """Why an element holds something other than the text: "" if it does not, "always", or "reply" or "wrapper" for a
    form or a name, which an element around the text may have as well."""
    if name in ("form", "fieldset"):
        return "always" if attrs and HIDDEN.search(attrs) else "wrapper"
    if name in OUTSIDE or name == "header" and not in_content:
        return "always"
    if not attrs or name in ("html", "body") or name in CONTENT and not in_content:
        return ""
    if "hidden" in attrs or "display" in attrs:
        if HIDDEN.search(attrs):
            return "always"
    for value in NAMED.finditer(attrs):
        if name in HEADING and value[0][:2].lower() == "id":
            continue
        for word in (value[1] or value[2] or value[3] or "").split():
            parts = [part.lower() for part in NAME_PART.findall(word)]
            found = [part for part in parts if part in NOT_TEXT or part in HEAD_NAMES and not in_content]
            if not found or parts[0] in LAYOUT_FIRST or len(parts) > 1 and parts[-1] in LAYOUT_LAST:
                continue
            if not in_content or all(part in found or part in STRUCTURE for part in parts):
                return "reply" if REPLIES.intersection(found) else "wrapper"
    return ""


class Tokens:
    """Tags and texts of a page as (place, tag, closing, attributes, text), tag being "" for a text.

    Comments, declarations and elements of RAW give nothing. A tag ends at the first ``>`` outside quotes; where no such
    ``>`` follows, a quote was left open, and the tag ends at the next ``<`` or ``>``. A ``<`` that starts no tag is text.
    """

    def __init__(self, page: str):
        self.page = page
        self.last = page.rfind(">")
        self.quotes: list[int] | None = None
        self.ends: list[int] = []

    def _end(self, at: int) -> int:
        """The place after the tag whose attributes start at ``at``, or -1.

        A tag that ends is read over once. After the first that does not, the ends of all are tabled, from the last to the
        first quote or ``>``, so none is sought twice.
        """
        if self.quotes is None:
            found = ATTRIBUTES.match(self.page, at)
            if found:
                return found.end()
            self.quotes = [m.start() for m in re.finditer("[>\"']", self.page)]
            outside = double = single = -1
            self.ends = [-1] * (len(self.quotes) + 1)
            for i in range(len(self.quotes) - 1, -1, -1):
                what = self.page[self.quotes[i]]
                if what == ">":
                    outside = self.quotes[i] + 1
                elif what == '"':
                    outside, double = double, outside
                else:
                    outside, single = single, outside
                self.ends[i] = outside
        return self.ends[bisect_left(self.quotes, at)]

    def __iter__(self) -> Iterator[tuple[int, str, bool, str, str]]:
        page, at, size = self.page, 0, len(self.page)
        while at < size:
            if page[at] != "<":
                end = page.find("<", at)
                end = size if end < 0 else end
                yield at, "", False, "", page[at:end]
                at = end
                continue
            tag = TAG.match(page, at)
            if tag:
                start, closing, name = tag.end(), bool(tag[1]), tag[2].lower()
                end = self._end(start)
                if end < 0:
                    end = BROKEN.match(page, start).end()
                    if end == size and page[end - 1] != ">":
                        yield at, "", False, "", "<"
                        at += 1
                        continue
                if name in RAW and not closing and not (name == "svg" and page.startswith("/>", end - 2)):
                    close = re.compile(rf"</{name}\s*+>", re.I).search(page, end)
                    at = close.end() if close else size
                    continue
                yield at, name, closing, page[start : end - 1] if page[end - 1] == ">" else page[start:end], ""
                at = end
            elif page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                at = end + 3 if end >= 0 else size
            elif page[at + 1 : at + 2] in ("!", "?", "/") and at < self.last:
                at = page.find(">", at) + 1
            else:
                yield at, "", False, "", "<"
                at += 1


@dataclass
class Element:
    """An element of a page: its parent's number, the items from ``first`` to before ``end``, and what it lies in."""

    name: str
    parent: int
    depth: int
    first: int
    end: int = -1
    out: bool = False          # left out of the text
    content: bool = False      # in marked text
    link: bool = False
    gone: bool = False         # left out whatever it holds
    wrapper: int = -1          # the nearest wrapper around it
    block: int = -1            # the nearest element of BLOCK, itself included


@dataclass
class Parsed:
    """Items (kind, words, text, block, element) of a page in order, its elements (the first stands for the page), and those
    that mark the text.

    A kind says where an item lies: ``=`` marks what is left out, ``+`` the marked text, ``-`` the rest; then the tag,
    or the element a run of words lies in.
    """

    items: list[tuple[str, int, str, int, int]] = field(default_factory=list)
    elements: list[Element] = field(default_factory=list)
    marks: list[int] = field(default_factory=list)


def parse(page: str) -> Parsed:
    """Items and elements of a page.

    Elements left out for their name or as a form are taken in again if they hold an article or main element or, but for
    replies, more than half of the words: they are wrappers of the text.
    """
    kept: frozenset[int] = frozenset()
    while True:
        parsed, wrappers = _parse(page, kept)
        if wrappers <= kept:
            return parsed
        kept |= wrappers


def _parse(page: str, kept: frozenset[int]) -> tuple[Parsed, frozenset[int]]:
    """``kept`` are places of tags that are not left out for a name or as a form, the second result those of which should not be."""
    parsed = Parsed(elements=[Element("", -1, 0, 0)])
    items, elements = parsed.items, parsed.elements
    stack, opened = [0], {"": [0]}      # numbers of the open elements, in all and by name
    wrappers: list[list] = []      # place, wrapper around it, words, whether it holds marked text, whether it holds replies
    block, total = 0, 0

    def close_to(number: int) -> None:
        while True:
            last = stack.pop()
            opened[elements[last].name].pop()
            elements[last].end = len(items)
            if last == number:
                return

    for place, name, closing, attrs, text in Tokens(page):
        here = elements[stack[-1]]
        if not name:
            words = len(text.split())
            if words and not here.gone:
                total += words
                if here.wrapper >= 0:
                    wrappers[here.wrapper][2] += words
            context = "a" if here.link else elements[here.block].name if here.block >= 0 else "body"
            items.append((("=" if here.out else "+" if here.content else "-") + context, words, text, block, stack[-1]))
            continue
        if name in BLOCK:
            block += 1
        side = "=" if here.out else "+" if here.content else "-"
        if closing:
            if opened.get(name):
                close_to(opened[name][-1])
            items.append((f"{side}<{name}>", 0, "", block, stack[-1]))
            continue
        if name in BLOCK and name not in PAGE and name != "head":
            while here.block >= 0 and (elements[here.block].name == "p" or elements[here.block].name in (
                    ("li",) if name == "li" else HEADING)):
                close_to(here.block)
                here = elements[stack[-1]]
        if name == "body" and here.name == "head":
            close_to(stack[-1])
            here = elements[stack[-1]]
        why, around = _excluded(name, attrs, here.content), here.wrapper
        if why in ("wrapper", "reply"):
            if place in kept:
                why = ""
            elif not here.gone and name not in VOID:
                around = len(wrappers)
                wrappers.append([place, here.wrapper, 0, False, why == "reply"])
        out, gone = here.out or bool(why), here.gone or why == "always"
        marks = name in CONTENT and not out
        if name in CONTENT and not gone and here.wrapper >= 0:
            wrappers[here.wrapper][3] = True
        side = "=" if out else "+" if here.content or marks else "-"
        if name == "br":
            items.append((side + "<br>", 0, " ", block, stack[-1]))
            continue
        if name not in VOID:
            number = len(elements)
            elements.append(Element(
                name, stack[-1], here.depth + 1, len(items), -1, out, here.content or marks, here.link or name == "a", gone,
                around, number if name in BLOCK else here.block))
            if marks and not here.content:
                parsed.marks.append(number)
            stack.append(number)
            opened.setdefault(name, []).append(number)
        items.append((f"{side}<{name}>", 0, "", block, stack[-1]))
    close_to(0)
    for _, outer, words, holds, _ in reversed(wrappers):
        if outer >= 0:
            wrappers[outer][2] += words
            wrappers[outer][3] |= holds
    return parsed, frozenset(
        place for place, _, words, holds, reply in wrappers if holds or not reply and 2 * words > total)


class Weights:
    """Scores by kind, without the side mark: whether a page marks its text is not scored."""

    def __init__(self, content: Counter, rest: Counter):
        self.known = {}
        for kind in content.keys() | rest.keys():
            self.known[kind] = self._score(kind, content[kind], rest[kind])

    @staticmethod
    def _score(kind: str, content: float, rest: float) -> float:
        tag = kind.endswith(">")
        prior = PRIOR_TAG if tag else PRIOR_LINK if kind == "a" else PRIOR_TEXT
        odds = math.log((content + PRIOR_COUNT * math.exp(prior)) / (rest + PRIOR_COUNT))
        if tag:
            return max(-MOST, min(-LEAST, odds))
        return max(-MOST, min(MOST, odds))

    def of(self, kind: str) -> float:
        """Items that are left out hardly count, so the region may go past them."""
        if kind[0] == "=":
            return -LEAST
        found = self.known.get(kind[1:])
        return self._score(kind[1:], 0, 0) if found is None else found

    def scores(self, items: list[tuple[str, int, str, int, int]]) -> list[float]:
        """A score for each tag, and for each run of words as often as it has words."""
        known = {kind: self.of(kind) for kind in {item[0] for item in items}}
        return [known[kind] * (1 if kind.endswith(">") else words) for kind, words, *_ in items]


def learn(pages: list[str]) -> Weights:
    """Count words and tags inside and outside the marked text of the labelled pages."""
    content, rest = Counter(), Counter()
    for page in pages:
        parsed = parse(page)
        if parsed.marks:
            for kind, words, *_ in parsed.items:
                if kind[0] != "=" and (words or kind.endswith(">")):
                    (content if kind[0] == "+" else rest)[kind[1:]] += words or 1
    return Weights(content, rest)


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the highest positive sum, the first one among equals; (0, 0) if none."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, region = total, (start, i + 1)
    return region


def _spans(parsed: Parsed, scores: list[float]) -> list[tuple[int, int]]:
    """The best region of a page, grown to the elements that its text lies in, as spans of items in order.

    If the region lies in marked text, at least in part, all marked elements with a run of positive score are the text;
    a page whose scores are nowhere positive has all that it marks. Any other region grows by :func:`_grown`.
    """
    items, elements = parsed.items, parsed.elements
    start, end = best_region(scores)
    text = [i for i in range(start, end) if items[i][1] and items[i][0][0] != "="]
    marks = [(elements[m].first, elements[m].end) for m in parsed.marks]
    if not text:
        return marks
    if any(items[i][0][0] == "+" for i in text):
        return [(a, b) for a, b in marks if best_region(scores[a:b])[1]]
    return _grown(parsed, scores, text[0], text[-1], start, end)


def _grown(parsed: Parsed, scores: list[float], first: int, last: int, start: int, end: int) -> list[tuple[int, int]]:
    """The region (start, end), whose first and last words are the items ``first`` and ``last``, grown.

    It takes the smallest element of GROUP around it, and that one's parent as long as the region's element has most of the
    words there and most of the others are not in links. The page itself is not taken whole: of the elements and words
    that lie in it outside the region, those stay that hold words not in links and are no group, or groups of positive sum.
    """
    items, elements = parsed.items, parsed.elements
    words, linked, total = [0], [0], [0.0]
    for (kind, n, *_), score in zip(items, scores, strict=True):
        n = 0 if kind[0] == "=" else n
        words.append(words[-1] + n)
        linked.append(linked[-1] + (n if kind[1:] == "a" else 0))
        total.append(total[-1] + score)

    def plain(a: int, b: int) -> int:
        return words[b] - words[a] - linked[b] + linked[a]

    one, other = items[first][4], items[last][4]
    while one != other:
        if elements[one].depth >= elements[other].depth:
            one = elements[one].parent
        else:
            other = elements[other].parent
    while elements[one].name not in GROUP and elements[one].name not in PAGE:
        one = elements[one].parent
    while elements[one].name not in PAGE:
        element, parent = elements[one], elements[elements[one].parent]
        own, around = words[element.end] - words[element.first], words[parent.end] - words[parent.first]
        others = plain(parent.first, parent.end) - plain(element.first, element.end)
        if parent.name not in GROUP or 2 * own <= around or 2 * others < around - own:
            return [(element.first, element.end)]
        one = elements[one].parent
    page = {i for i, e in enumerate(elements) if e.name in PAGE}
    spans = [(start, end)]
    for i, e in enumerate(elements):
        if i not in page and e.parent in page and not e.out and (
                e.first < end and start < e.end
                or plain(e.first, e.end) and (e.name not in GROUP or total[e.end] > total[e.first])):
            spans.append((e.first, e.end))
    spans += [(i, i + 1) for i, item in enumerate(items) if item[4] in page and item[1]]
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(b, merged[-1][1])
        else:
            merged.append((a, b))
    return merged


def extract(page: str | None, weights: Weights) -> str:
    """Text of a page: blocks joined by an empty line. Null and empty pages give an empty text."""
    if not page:
        return ""
    parsed = parse(page)
    blocks: dict[int, list[str]] = {}
    for start, end in _spans(parsed, weights.scores(parsed.items)):
        for kind, _, text, block, _ in parsed.items[start:end]:
            if text and kind[0] != "=":
                blocks.setdefault(block, []).append(text)
    joined = (" ".join(entities.unescape("".join(texts)).split()) for texts in blocks.values())
    return "\n\n".join(filter(None, joined))


def labelled_pages(pages: DataFrame) -> DataFrame:
    """A bounded sample of the pages that mark their own text: those with the smallest hashes of url and html.

    Tasks first send hashes only; pages follow once the largest hash of the sample is known.
    """
    key = F.xxhash64("url", "html")
    marked = pages.where(F.col("html").rlike("(?i)<(article|main)[ >]") & (F.length("html") <= SAMPLE_CHARS))
    bound = marked.select(key.alias("key")).orderBy("key").limit(SAMPLE_PAGES).agg(F.max("key")).first()[0]
    return marked.where(key <= F.lit(bound).cast("long")).select("html").limit(SAMPLE_PAGES)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars per page. Repeated rows are answered each; without labelled pages priors score."""
    weights = learn([row["html"] for row in labelled_pages(pages).collect()])     # at most SAMPLE_PAGES rows

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page.as_py(), weights) for page in batch["html"]]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(
        compute, "page_id long, url string, text string, n_chars long")
