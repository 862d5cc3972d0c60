"""Main text of web pages by two-pass block rules.

A page is cut into text blocks. The first pass decides blocks by the page's structure (menus, footers, forms,
adverts and the like are no text), by link density, length, and density of stop words. Blocks too short to tell
stay open, and the second pass gives them the label of the nearest decided neighbours. Where a page
marks its article, both passes run inside it, and blocks outside are none of it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from herdcast.llm.common import columns_of, pick
from herdcast.llm.quality_rules import STOP_WORDS

# Element names of HTML and the usual thresholds of the method.
RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
                   "strong sub sup time tt u var wbr img".split())
DROPPED = frozenset("head nav footer aside menu form select button dialog svg canvas object audio video map".split())
MAIN = frozenset("article main".split())
#: Words in class, id or role that mark parts beside the text.
BESIDE = frozenset("ad ads advert advertisement adverts advertising sidebar cookie cookies consent banner notice popup modal promo "
                   "promotion sponsor sponsored newsletter subscribe social share sharing related breadcrumb breadcrumbs menu nav "
                   "navbar navigation footer contentinfo complementary search comment comments disqus reply replies respond widget "
                   "pagination pager copyright disclaimer login signup toolbar".split())
HEADER = frozenset("header masthead topbar".split())
LINKS, SHORT, LONG = 0.2, 70, 200
#: These go with the list of some ten words a language (running text has about 0.2); a page below LISTED is in none of its languages.
FEW_STOPS, MANY_STOPS, LISTED = 0.08, 0.12, 0.04

_TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_PART = re.compile(r"[a-z]+")
_STOPS = frozenset(STOP_WORDS)


@dataclass
class Block:
    main: int                               # which article or main part; 0 outside
    beside: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _beside(name: str, attributes: str, in_main: bool) -> bool:
    if name in DROPPED or (name == "header" and not in_main):
        return True
    if not attributes.strip():
        return False
    if re.search(r"\bhidden\b(?!\s*=\s*[\"']?false)", re.sub(r"=\s*(\"[^\"]*\"|'[^']*')", "=", attributes)):
        return True
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "")
        if key in ("class", "id", "role"):
            words = set(_PART.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()))
            if name not in ("body", "html") and (words & BESIDE or (not in_main and words & HEADER)):
                return True
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
            return True
        elif key == "aria-hidden" and value.lower() == "true":
            return True
    return False


def blocks_of(page: str) -> list[Block]:
    """Blocks of text in page order. Broken markup is read on: what cannot be a tag is text, what is not closed ends with the page."""
    out: list[Block] = []
    stack: list[tuple[str, bool, int]] = []             # element, beside, main part
    mains, links, breaks = 0, 0, 0
    block = Block(0, False)

    def cut() -> None:
        nonlocal block
        block.text = " ".join("".join(block.parts).split())
        if block.text:
            out.append(block)
        block = Block(stack[-1][2] if stack else 0, bool(stack) and stack[-1][1])

    def say(raw: str) -> None:
        nonlocal breaks
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            if not text.isspace():
                breaks = 0
            block.parts.append(text)
            if links:
                block.linked += len("".join(text.split()))

    at, end = 0, len(page)
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            say(page[at:])
            break
        say(page[at:lt])
        if page.startswith("<!--", lt):
            close = page.find("-->", lt + 4)
            at = end if close < 0 else close + 3
            continue
        follow = page[lt + 1:lt + 2]
        if follow in ("!", "?"):
            close = page.find(">", lt)
            at = end if close < 0 else close + 1
            continue
        closing = follow == "/"
        if not page[lt + 1 + closing:lt + 2 + closing].isalpha():
            say("<")
            at = lt + 1
            continue
        m = _TAG.match(page, lt)
        if m:
            name, attributes, at = m[1].lower(), m[2], m.end()
        else:
            close = page.find(">", lt)
            if close < 0:
                break                                   # cut off inside a tag
            name = re.match(r"</?([a-zA-Z][^\s/>]*)", page[lt:close + 1])[1].lower()
            attributes, at = "", close + 1
        if name in RAW and not closing:
            close = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.IGNORECASE).search(page, at)
            at = close.end() if close else end
            continue
        if name == "a":
            links = 0 if closing else 1
        if name == "br":
            say(" ")
            breaks += 1
            if breaks > 1:
                cut()
            continue
        if name in INLINE:
            if not closing and stack and _beside(name, attributes, True) and not attributes.rstrip().endswith("/"):
                stack.append((name, True, stack[-1][2]))
                cut()
            elif closing and stack and stack[-1][0] == name:
                stack.pop()
                cut()
            continue
        if name in VOID:
            if name == "hr":
                cut()
            continue
        links = 0
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                del stack[depth:]
        elif not attributes.rstrip().endswith("/"):
            main = stack[-1][2] if stack else 0
            beside = (bool(stack) and stack[-1][1]) or _beside(name, attributes, main > 0)
            if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
                stack.pop()                             # these close themselves
                main, beside = (stack[-1][2], stack[-1][1]) if stack else (0, False)
                beside = beside or _beside(name, attributes, main > 0)
            if name in MAIN and not beside and not main:
                mains += 1
                main = mains
            stack.append((name, beside, main))
        cut()
    cut()
    return out


def _stops(words: list[str]) -> int:
    return sum(w.strip(".,;:!?\"'()") in _STOPS for w in words)


def listed(blocks: list[Block]) -> bool:
    """Whether the stop words say anything of a page: they do not in a language that the list lacks."""
    words = [b.text.lower().split() for b in blocks if not b.beside and len(b.text) >= SHORT]
    return sum(map(_stops, words)) >= LISTED * sum(map(len, words))


def first_pass(block: Block, by_stops: bool = True) -> bool | None:
    """Text, no text, or None where it is too short to tell, or of few stop words in an article: there only links and names
    speak against a block."""
    if block.beside:
        return False
    size = len(block.text)
    if block.linked > LINKS * max(1, size):
        return False
    if size < SHORT:
        return None
    if not by_stops:
        return True if size > LONG else None
    words = block.text.lower().split()
    stops = _stops(words) / len(words)
    if stops >= MANY_STOPS or (size > LONG and stops >= FEW_STOPS):
        return True
    return None if stops >= FEW_STOPS or block.main else False


def labels_of(blocks: list[Block]) -> list[bool]:
    """Both passes. An open block gets the label its decided neighbours in the same part have. Where they differ, that of the
    nearer one in an article, and none outside; where there are none or both are as near, an article's block is text."""
    marked = any(b.main and not b.beside for b in blocks)
    by_stops = listed(blocks)
    first = [False if marked and not b.main else first_pass(b, by_stops) for b in blocks]
    n = len(blocks)
    before: list[tuple[int, bool] | None] = [None] * n                 # how far, label
    after: list[tuple[int, bool] | None] = [None] * n
    for order, seen in ((range(n), before), (range(n - 1, -1, -1), after)):
        part, last, far = None, None, 0
        for i in order:
            if blocks[i].beside:
                continue                                # an advert inside says nothing of what is around it
            if blocks[i].main != part:
                part, last = blocks[i].main, None
            far += 1
            seen[i] = None if last is None else (far, last)
            if first[i] is not None:
                last, far = first[i], 0
    out = []
    for i in range(n):
        if first[i] is not None:
            out.append(first[i])
            continue
        near = sorted(x for x in (before[i], after[i]) if x is not None)
        if not near:
            out.append(blocks[i].main > 0)
        elif blocks[i].main and len(near) == 2 and near[0][0] == near[1][0]:
            out.append(near[0][1] or near[1][1])
        else:
            out.append(near[0][1] if blocks[i].main else all(x for _, x in near))
    return out


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    return "\n".join(b.text for b, keep in zip(blocks, labels_of(blocks), strict=True) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars per row.

    A null or empty page has an empty text, as has one whose blocks are all beside the text. Equal rows give
    equal texts; null ids and urls are kept. Other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, urls, pages_ in columns_of(batches, ("page_id", "url", "html")):
            texts = [main_text(p) for p in pages_]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pick(pages, "page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
