"""Main text of web pages by the distribution of text over lines.

Markup is stripped into lines (one per block element). Each line weighs as many characters as it
holds outside links; lines of menus, forms, notices, comments and the like weigh nothing, but a name
never takes away the part that holds most of a page's text. Weights are summed over sliding windows; a line of a declared main part has SURGE added to its sum, which
takes nothing from the lines outside. Everything between the first surge of the sums and the last dive is kept. The surge limit
is a fixed number of characters, less on pages of few words, so no long block can raise it.

Defined cases: a NULL or empty page, or one without text, gives the empty text. Unclosed and
mismatched tags close at the end of what encloses them. Repeated rows are extracted row by row;
NULL ids and addresses pass through; other columns are ignored. An empty table gives no rows; a
very long page is read in one pass.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from usageledger.llm.common import small_batches

# Lines on either side that a window takes in.
REACH = 2
# Characters in a window that make a surge; on pages of few words this share of the heaviest window.
SURGE = 80
LEAST_SHARE = 0.2

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|svg|math|iframe|object|xmp)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td "
    "tfoot th thead title tr ul button".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIPPED = frozenset("head nav footer aside form menu dialog button select fieldset title".split())
_MAIN_TAGS = frozenset(("article", "main"))
_MAIN_NAMES = frozenset(("main", "article", "articlebody"))
_JUNK_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners sponsor sponsored promo promotion nav navbar navigation "
    "menu menubar breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr notice notices notification popup modal overlay "
    "newsletter subscribe subscription signup login comment comments commentlist disqus respond reply replies share sharing social "
    "related recommended widget widgets toolbar pagination pager copyright complementary contentinfo search form".split()
)
# Reader comments stay out however long they are.
_COMMENT_NAMES = frozenset("comments commentlist comment-list comments-area disqus disqus_thread respond replies".split())
# Of closed elements only these are tracked; everything else is inline or cannot hold blocks wrongly.
_NESTING = _BLOCKS - _VOID - frozenset(("p", "li", "dd", "dt", "option"))


def _names(attrs: str) -> tuple[set[str], set[str]]:
    """The whole names of an element, and the words they consist of."""
    if "=" not in attrs:
        return set(), set()
    found = " ".join(a or b or c for a, b, c in _NAMES.findall(attrs)).lower()
    return set(found.split()), set(_WORD.findall(found))


def lines_of(page: str) -> list[tuple[str, int, bool, bool]]:
    """(text, characters in links, in the main part, in a skipped part) of each line with text.

    A name of furniture only marks its element. The mark does not count where the element holds
    most of the page's text or all of its declared main part, as a wrapper does whose name merely
    speaks of a sidebar; reader comments never count as the page's text.
    """
    out: list[tuple[str, int, bool, bool, tuple[int, ...]]] = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, bool, tuple[int, ...]]] = []
    main = skipped = False
    marks: tuple[int, ...] = ()
    comments: set[int] = set()
    made = in_link = 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append((text, min(len(text), len(" ".join(html.unescape("".join(linked)).split()))), main, skipped, marks))
        parts.clear()
        linked.clear()

    def take(text: str) -> None:
        parts.append(text)
        if in_link:
            linked.append(text)

    at = 0
    for found in _TOKEN.finditer(page):
        if found.start() > at:
            take(page[at : found.start()])
        at = found.end()
        tag = found["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "a":
            in_link = 0 if found["close"] else 1
        elif tag == "br":
            take(" ")
        names, words = (set(), set()) if found["close"] else _names(found["attrs"])
        if tag not in _BLOCKS:
            # Inline elements break no line; a marked one hides its text like a block would.
            if tag in _VOID or tag == "a" or not (found["close"] or words & _JUNK_NAMES):
                continue
            if found["close"]:
                if any(entry[0] == tag for entry in stack):
                    flush()
                    while stack:
                        name, main, skipped, marks = stack.pop()
                        if name == tag:
                            break
                continue
        flush()
        if tag in _VOID:
            continue
        if found["close"]:
            if any(entry[0] == tag for entry in stack):
                while stack:
                    name, main, skipped, marks = stack.pop()
                    if name == tag:
                        break
            continue
        if found["attrs"].rstrip().endswith("/"):
            continue
        marked = tag not in ("html", "body", "article", "main") and bool(words & _JUNK_NAMES)
        if tag in _NESTING or tag not in _BLOCKS or marked:
            stack.append((tag, main, skipped, marks))
            main = main or ((tag in _MAIN_TAGS or bool((names | words) & _MAIN_NAMES)) and not skipped)
            skipped = skipped or tag in _SKIPPED or (tag == "header" and not main)
            if marked:
                marks = (*marks, made)
                if names & _COMMENT_NAMES:
                    comments.add(made)
                made += 1
    if at < len(page):
        take(page[at:])
    flush()
    return _settled(out, made, comments)


def _settled(
    lines: list[tuple[str, int, bool, bool, tuple[int, ...]]], made: int, comments: set[int]
) -> list[tuple[str, int, bool, bool]]:
    """The lines, with the marks that count as skipped parts."""
    weight, mains = [0] * made, [0] * made
    total = declared = 0
    for text, links, main, skipped, marks in lines:
        if skipped or not comments.isdisjoint(marks):
            continue
        total += max(1, len(text) - links)
        declared += main
        for m in marks:
            weight[m] += max(1, len(text) - links)
            mains[m] += main
    counts = {m for m in range(made) if m in comments or mains[m] < declared or (not mains[m] and 2 * weight[m] <= total)}
    return [(text, links, main, skipped or not counts.isdisjoint(marks)) for text, links, main, skipped, marks in lines]


def main_text(page: str) -> str:
    lines = lines_of(page)
    if not lines:
        return ""
    weights = np.array([0 if junk else max(1, len(t) - k) for t, k, _, junk in lines], dtype=np.int64)
    if not weights.any():
        return ""
    declared = np.array([main for _, _, main, _ in lines])
    total = np.concatenate([[0], np.cumsum(weights)])
    n = len(weights)
    low, high = np.maximum(np.arange(n) - REACH, 0), np.minimum(np.arange(n) + REACH + 1, n)
    sums = total[high] - total[low]
    # Surge: the window sum reaches the limit; dive: it falls below and stays there.
    limit = max(1, min(SURGE, LEAST_SHARE * sums.max()))
    dense = np.flatnonzero((sums + SURGE * declared >= limit) & (weights > 0))
    keep = weights > 0
    keep[: dense[0]] = keep[dense[-1] + 1 :] = False
    return "\n".join(line[0] for line, kept in zip(lines, keep, strict=True) if kept)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    small_batches(pages.sparkSession)
    narrow = pages.select(pages[page_id].alias("page_id"), pages[url].alias("url"), pages[page].alias("html"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [main_text(h or "") for h in part.column(2).to_pylist()]
            counts = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), counts], ["page_id", "url", "text", "n_chars"])

    kinds = narrow.schema
    return narrow.mapInArrow(run, f"page_id {kinds['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
