"""Main text of web pages, with removal of site templates.

A page is read as a tree of elements, in time linear in its length. Navigation,
forms, scripts and the like are left out by what they are, or where a whole
class or id says so; templates by how they recur: every element's subtree (its
tag, classes, text and children) is hashed, Spark counts each hash per host by
the different main texts around it, and what recurs is deleted from the host's
pages. A box (a div, section or the like) is a template around MIN_PAGES
different main texts. What articles are made of (paragraphs, lists, tables,
figures, quotations, headings) may well recur in some of them, and is a template
only if it is also around half of the host's main texts. Copies of one page
have one main text and count once. The main text is all of the page's outermost
articles and main elements, with what stands beside articles in them, or the
whole page if it has none.

Pages are parsed twice (to count, and to extract). What moves between is a few
hashes a page; (host, hash) counts are made distinct and summed before they
are shuffled, so a host with a third of all pages is no hot key.

Defined results: a null or empty page gives an empty text. A null url is a host
of its own. Repeated pages and ids give repeated rows. Columns other than
page_id, url and html are ignored. A tag that is never closed by ``>`` is text;
a quoted value that never ends ends with its tag. Elements more than DEPTH deep count
as text of the element at that depth.
"""

from __future__ import annotations

import bisect
import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.llm._tables import stored

MIN_PAGES = 5  # different main texts of a host around a subtree
CONTENT_SHARE = 0.5  # of the host's different main texts, for what articles are made of
DEPTH = 512

# Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
LEFT_OUT = frozenset("head nav aside form footer menu dialog button select svg math object audio video canvas".split())
BOXES = frozenset("div section header nav aside footer form menu center".split())
CONTENT = frozenset("p ul ol li dl table figure details address blockquote pre h1 h2 h3 h4 h5 h6".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LIMITS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",)}
# Words that mark what is no main text, in a class or id of such words and PLAIN ones only: "comment-list"
# is marked, "comment-on-the-law" and "related-work" are not.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsored sponsor promo promotion cookie cookies consent notice notices alert popup modal overlay "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs share sharing social comment comments disqus related recommended newsletter subscribe "
    "subscription signup login footer masthead skip pagination pager toolbar widget".split()
)
PLAIN = frozenset(
    "list box wrap wrapper container block section area item items bar panel slot unit group inner outer top bottom left right side site page global main "
    "header content text row col column link links button buttons icon icons posts articles stories js id module component region holder frame message".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_IN_TAG = re.compile(r"""[^>"']*""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[a-z]+")


def _marked(name: str) -> bool:
    """Whether a class or id consists of mark words and plain ones, with a mark word."""
    words = _WORD.findall(name)
    return any(w in MARKS for w in words) and all(w in MARKS or w in PLAIN for w in words)


def _attributes(text: str) -> dict[str, str]:
    return {name.lower(): html.unescape(value.strip("\"'")) for name, value in _ATTRIBUTE.findall(text)} if text.strip(" /") else {}


class _Open:
    __slots__ = ("tag", "attributes", "out", "first_block", "parts", "region")

    def __init__(self, tag, attributes, out, first_block, region):
        self.tag, self.attributes, self.out, self.first_block, self.region = tag, attributes, out, first_block, region
        self.parts: list[str] = []


class Page:
    """The blocks of a page outside what is left out, its articles, and the subtree hashes of its containers."""

    def __init__(self, source: str, templates: frozenset[int] = frozenset()):
        self.blocks: list[str] = []
        self.regions: list[tuple[int, int]] = []
        self.subtrees: list[tuple[int, int, int, bool]] = []  # hash, first and past-the-last block, is it content
        self.templates = templates
        self._text: list[str] = []
        self._stack = [_Open("", {}, False, 0, False)]
        self._open: Counter = Counter()  # open elements by tag
        self._skipped: Counter = Counter()  # those too deep to be pushed
        self._open_regions = 0
        self._read(source)
        while len(self._stack) > 1:
            self._pop()
        self._end_block()

    def _end_block(self) -> None:
        if self._text:
            block = " ".join(html.unescape("".join(self._text)).split())
            if block:
                self.blocks.append(block)
            self._text = []

    def _say(self, text: str) -> None:
        if text:
            top = self._stack[-1]
            top.parts.append(text)
            if not top.out:
                self._text.append(text)

    def _left_out(self, tag: str, attributes: dict, parent: _Open) -> bool:
        if parent.out or tag in LEFT_OUT or (tag == "header" and not self._open_regions):
            return True
        if "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role", "").lower() in ROLES:
            return True
        if tag in ("main", "body", "html"):
            return False
        return any(map(_marked, f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split()))

    def _push(self, tag: str, attribute_text: str) -> None:
        if len(self._stack) > DEPTH:
            self._skipped[tag] += 1
            if tag not in INLINE:
                self._end_block()
            return
        attributes = _attributes(attribute_text)
        if tag not in INLINE:
            self._end_block()
        out = self._left_out(tag, attributes, self._stack[-1])
        if out and tag in INLINE:
            self._text.append(" ")
        region = tag in ("article", "main") or attributes.get("role") in ("main", "article")
        self._stack.append(_Open(tag, attributes, out, len(self.blocks), region))
        self._open[tag] += 1
        self._open_regions += region

    def _pop(self) -> None:
        top = self._stack.pop()
        self._open[top.tag] -= 1
        self._open_regions -= top.region
        if top.tag not in INLINE:
            self._end_block()
        parent = self._stack[-1]
        subtree = xxhash.xxh64_intdigest(f"<{top.tag} {top.attributes.get('class', '')}>{''.join(top.parts)}") & (1 << 62) - 1
        parent.parts.append(f"<{subtree}>")
        if (top.tag in BOXES or top.tag in CONTENT) and any(p.strip() for p in top.parts):
            if subtree in self.templates:
                del self.blocks[top.first_block :]
            self.subtrees.append((subtree, top.first_block, len(self.blocks), top.tag in CONTENT))
        if top.region and not top.out:
            self.regions.append((top.first_block, len(self.blocks)))

    def _close(self, tag: str) -> None:
        if self._skipped[tag]:
            self._skipped[tag] -= 1
            if tag not in INLINE:
                self._end_block()
            return
        if not self._open[tag]:
            return
        for depth in range(len(self._stack) - 1, 0, -1):
            if self._stack[depth].tag == tag:
                for _ in range(len(self._stack) - depth):
                    self._pop()
                return
            if tag in INLINE and self._stack[depth].tag not in INLINE:
                return  # an inline end tag doesn't close blocks

    def _close_before(self, tag: str) -> None:
        """End tags that may be left away before a start tag."""
        if tag in CLOSES_P and self._open["p"]:
            for depth in range(len(self._stack) - 1, 0, -1):
                if self._stack[depth].tag == "p":
                    for _ in range(len(self._stack) - depth):
                        self._pop()
                    break
                if self._stack[depth].tag not in INLINE:
                    break
        for depth in range(len(self._stack) - 1, 0, -1):
            if tag not in SIBLINGS or self._stack[depth].tag in LIMITS[tag]:
                break
            if self._stack[depth].tag in SIBLINGS[tag]:
                for _ in range(len(self._stack) - depth):
                    self._pop()

    def _read(self, source: str) -> None:
        at, quotes = 0, True
        while at < len(source):
            start = source.find("<", at)
            if start < 0:
                self._say(source[at:])
                break
            self._say(source[at:start])
            opening = source[start : start + 9]
            if opening.startswith("<!--") or opening == "<![CDATA[":
                end = source.find("-->" if opening.startswith("<!--") else "]]>", start + (4 if opening.startswith("<!--") else 9))
                if opening == "<![CDATA[":
                    self._say(html.escape(source[start + 9 : end if end >= 0 else len(source)]))
                at = end + 3 if end >= 0 else len(source)
                continue
            if opening.startswith(("<!", "<?")):
                end = source.find(">", start)
                at = end + 1 if end >= 0 else len(source)
                continue
            name = _TAG.match(source, start)
            if name is None:
                self._say("<")
                at = start + 1
                continue
            end = _tag_end(source, name.end()) if quotes else -1
            if end < 0:  # a quoted value without end: from here on quotes mean nothing, so no stretch is read again and again
                quotes = False
                end = source.find(">", name.end())
                if end < 0:
                    self._say(source[start:])
                    break
            closing, tag, attributes = name[1], name[2], source[name.end() : end]
            at = end + 1
            tag = tag.lower()
            if closing:
                if tag == "br":
                    self._say(" ")
                elif tag == "p" and not any(o.tag == "p" for o in self._stack):
                    self._end_block()
                else:
                    self._close(tag)
            elif tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                at = end.end() if end else len(source)
                if tag not in INLINE:
                    self._end_block() if tag not in ("script", "style", "noscript", "template") else None
            elif tag in VOID:
                if tag == "hr":
                    self._close_before(tag)
                    self._end_block()
                elif tag in ("br", "wbr", "img"):
                    self._say(" " if tag == "br" else "")
            else:
                self._close_before(tag)
                self._push(tag, attributes or "")
                if (attributes or "").endswith("/") and tag in ("path", "circle", "rect", "use"):
                    self._pop()

    def main(self) -> list[tuple[int, int]]:
        """Runs of the blocks of the outermost articles and main elements, in page order, or all blocks."""
        runs: list[tuple[int, int]] = []
        for first, end in sorted(self.regions, key=lambda r: (r[0], -r[1])):
            if runs and first < runs[-1][1]:
                runs[-1] = runs[-1][0], max(end, runs[-1][1])
            elif end > first:
                runs.append((first, end))
        return runs or [(0, len(self.blocks))]

    def text(self) -> str:
        return "\n".join(block for first, end in self.main() for block in self.blocks[first:end])


def _tag_end(source: str, at: int) -> int:
    """The place of the ``>`` that ends a tag, outside quoted values; -1 if there is none."""
    while True:
        at = _IN_TAG.match(source, at).end()
        if at >= len(source):
            return -1
        if source[at] == ">":
            return at
        at = source.find(source[at], at + 1) + 1
        if not at:
            return -1


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page: the hash of its main text, its subtree hashes, and those inside the main text (not around it). The last
    bit of a subtree's number says that it is content."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            part = batch.slice(lo, 200)
            mains, all_hashes, inside = [], [], []
            for source in part.column(2).to_pylist():
                page = Page(source or "")
                runs = page.main()
                mains.append(xxhash.xxh64_intdigest(page.text()) & (1 << 63) - 1)
                starts, low, high = [first for first, _ in runs], runs[0][0], runs[-1][1]
                # subtrees around the whole main text aren't in it; of the others those that hold a block of it may be deleted
                around = [x for x in page.subtrees if not (x[1] <= low and high <= x[2] and x[1] < x[2])]
                all_hashes.append(sorted({2 * x[0] + x[3] for x in around}))
                held = [x for x in around if x[2] > x[1] and (k := bisect.bisect_left(starts, x[2])) and runs[k - 1][1] > x[1]]
                inside.append(sorted({2 * x[0] + x[3] for x in held}))
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(mains, pa.int64()), pa.array(all_hashes, kind), pa.array(inside, kind)],
                names=["key", "host", "main", "subtrees", "inside"],
            )


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            part = batch.slice(lo, 200)
            texts = []
            for source, templates in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                texts.append(Page(source or "", frozenset(t >> 1 for t in templates or ())).text())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )


def site_templates(subtrees: DataFrame) -> DataFrame:
    """``(host, subtree)`` found around enough different main texts of a host."""
    different = subtrees.select("host", "main", F.explode("subtrees").alias("subtree")).distinct()
    counts = different.groupBy("host", "subtree").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_PAGES)
    mains = subtrees.select("host", "main").distinct().groupBy("host").agg(F.count("*").alias("mains"))
    is_content = F.col("subtree").bitwiseAND(1) == 1
    return counts.join(mains, "host").where(~is_content | (F.col("n") >= CONTENT_SHARE * F.col("mains"))).select("host", "subtree")


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)``: blocks of the article in page order, one to a line, white space inside a
    block as one space, character references decoded."""
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    keyed = pages.select(F.xxhash64("page_id", "url", "html").alias("key"), host.alias("host"), "page_id", "url", "html")
    seen = stored(keyed.select("key", "host", "html").mapInArrow(_subtrees, "key long, host string, main long, subtrees array<long>, inside array<long>"), "subtrees")
    found = seen.select("key", "host", F.explode("inside").alias("subtree")).join(site_templates(seen), ["host", "subtree"])
    # a page's own subtrees: as many as the page has
    found = stored(found.groupBy("key").agg(F.collect_set("subtree").alias("templates")), "templates")
    joined = keyed.join(found, "key", "left").select("page_id", "url", "html", "templates")
    return joined.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
