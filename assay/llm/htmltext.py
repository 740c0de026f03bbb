"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one for each block of text.  What the markup
itself names as menu, header, footer, notice, advert, form, script or reader
comment is left out, as are all lines outside the article on pages that mark
it.  A line counts with its text outside links, a heading of a marked article
with all its text.  The lengths are then summed over sliding windows of lines:
the text surges where a window's sum rises to the threshold and dives where it
falls to 0.  All lines with text between the first surge and the last dive are
kept, in a marked article the lines of links between them, too.  Of several
marked articles those are kept that hold a fifth of the text of the longest:
others are teasers.

Markup is read from left to right once: a tag ends at the next ``>`` outside
quotes, where a quote opens a value only behind ``=``.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.llm.staging import ship

WINDOW = 3
#: What a window must hold for a surge, without a marked article.
SURGE_CHARS = 60
#: Share of the longest article's text that another one must have.
TEASER = 0.2

BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol
optgroup option p pre search section summary table tbody td tfoot th thead title tr ul""".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no page text at all; up to their end tag nothing is markup.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
DROPPED = frozenset("""head nav header footer aside form button select datalist label fieldset dialog menu search
noscript template svg math canvas object audio video applet""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Names in class, id or role of what is not the article; a hyphenated one counts if all its words do, or only say where and how.
NAMED = frozenset("""ad ads adbox advert advertisement advertising adsense sponsor sponsored promo promotion
nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside widget toolbar topbar masthead banner
header footer contentinfo complementary pagination pager related share sharing social
cookie cookies consent gdpr notice alert popup modal overlay dialog newsletter subscribe subscription signup login search
comment comments commentlist commentform commentarea respond disqus discussion replies adslot adunit adbanner adcontainer""".split())
#: Of them, those that also hold for an article, and for articles inside.
NO_ARTICLE = frozenset("""ad ads adbox advert advertisement advertising adsense adslot adunit adbanner adcontainer
comment comments commentlist commentform commentarea""".split())
#: Words beside them in a hyphenated name.
PLACES = frozenset("""list area slot left right site wrap wrapper container box block section zone unit item items inner outer
top bottom primary secondary global thread form panel group bar 1 2 3""".split())
ROOTS = frozenset(["html", "body", "main"])
#: A start tag that ends an open element of one of these names, up to a border.
ENDS = {"p": BLOCKS, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
        "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "tr": frozenset(["tr"]), "option": frozenset(["option"])}

_START = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"""=\s*(["'])|>""")
_NAME = re.compile(r"""(?:\A|[\s"'/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)|(?=[\s/]|\Z))""", re.I)
_INK = re.compile(r"\w")


@dataclass
class Line:
    text: str
    length: int       # outside links


#: How an open element is dropped: an article or main inside what only a name
#: drops stays, and so does a heading in the header of an article.
KEPT, NAMED_ONLY, HEADER, GONE = 0, 1, 2, 3


def _drops(tag: str, attributes: str) -> int:
    if tag in DROPPED:
        return HEADER if tag == "header" else GONE
    if tag in ROOTS:
        return KEPT
    drops = KEPT
    for key, value in _NAME.findall(attributes):
        key = key.lower()
        if key == "hidden" or key == "aria-hidden" and "true" in value.lower():
            return GONE
        if key in ("class", "id", "role"):
            for words in (x.replace("_", "-").split("-") for x in value.strip("\"'").lower().split()):
                known = NAMED.intersection(words)
                if known and len(known) + len(PLACES.intersection(words)) >= len(set(words)):
                    if not NO_ARTICLE.isdisjoint(known):
                        return GONE
                    if tag != "article":
                        drops = NAMED_ONLY
    return drops


def tags(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """``start, end, name, closes, attributes`` of the tags from left to right;
    comments and declarations have no name.  The reader may send a place to go
    on from.  A tag that never ends is text; from then on quotes are not heeded,
    so that no part of a page is searched twice."""
    at, quotes = 0, True
    while (m := _START.search(page, at)) is not None:
        start, at, name = m.start(), m.end(), ""
        if m[0] == "<!--":
            end = page.find("-->", start + 2)
            at = len(page) if end < 0 else end + 3
        elif m[0] in ("<!", "<?"):
            end = page.find(">", at)
            at = len(page) if end < 0 else end + 1
        else:
            name, end = m[0].strip("</").lower(), -1
            place = at
            while quotes:
                stop = _STOP.search(page, place)
                if stop is None or stop[1] is None:
                    end = stop.start() if stop else -1
                    break
                place = page.find(stop[1], stop.end()) + 1
                if not place:
                    break
            if end < 0:
                quotes, end = False, page.find(">", at)
            if end < 0:
                return
            attributes, at = page[at:end], end + 1
            sent = yield start, at, name, m[0][1] == "/", attributes
            at = at if sent is None else sent
            continue
        yield start, at, "", False, ""


def lines(page: str) -> tuple[list[Line], bool]:
    """Blocks of text in page order, without what the markup drops, and whether
    the page marks its article."""
    out: list[tuple[str, int, int, int, bool]] = []     # text, characters outside links, dropped, article (0: none), heading
    stack: list[tuple[str, int, int]] = []              # open elements: name, dropped, article
    text: list[str] = []
    linked, free = 0, False                             # linked characters, and whether there is text beside them
    open_now: Counter[str] = Counter()                  # of the stack, so that it is not searched in vain
    dropped, article, articles, headings = KEPT, 0, 0, 0

    def flush() -> None:
        nonlocal linked, free
        if text:
            if joined := " ".join("".join(text).split()):
                out.append((joined, max(1, len(joined) - linked) if free else 0, dropped, article, headings > 0))
            text.clear()
        linked, free = 0, False

    def close(k: int) -> None:
        nonlocal dropped, article, headings
        open_now.subtract(name for name, _, _ in stack[k:])
        headings -= sum(name in HEADINGS for name, _, _ in stack[k:])
        del stack[k:]
        _, dropped, article = stack[-1] if stack else ("", KEPT, 0)

    def add(piece: str) -> None:
        nonlocal linked, free
        piece = references.unescape(piece)
        text.append(piece)
        if open_now["a"]:
            linked += len(piece)
        elif not free:
            free = _INK.search(piece) is not None

    at, scan, sent = 0, tags(page), None
    while True:
        try:
            start, end, name, closes, attributes = scan.send(sent)
        except StopIteration:
            break
        sent = None
        if start > at:
            add(page[at:start])
        at = end
        if not name:
            continue
        if closes:
            if name in BLOCKS:
                flush()
            if open_now[name] > 0:
                k = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name)
                if any(x[0] in BLOCKS for x in stack[k:]):
                    flush()
                close(k)
            continue
        if name in RAW:
            over = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = over.start() if over else len(page)
            if over and (to := page.find(">", at)) >= 0:
                at = to + 1
            sent = at
            continue
        if name in BLOCKS:
            flush()
            ended = [x for x, by in ENDS.items() if name in by]
            k = len(stack) - 1
            while k >= 0 and any(open_now[x] > 0 for x in ended):
                if stack[k][0] in ended:
                    close(k)
                elif stack[k][0] in BLOCKS:
                    break
                k -= 1
        if name == "br":
            add(" ")
        if name in EMPTY or attributes.endswith("/") and name not in BLOCKS:
            continue
        drops = _drops(name, attributes)
        if drops == HEADER and not article:
            drops = GONE
        if drops > dropped and name not in BLOCKS:
            flush()
        if name in ("article", "main") and dropped == NAMED_ONLY and not open_now["article"]:
            dropped = KEPT
        if name in HEADINGS and dropped == HEADER:
            dropped = KEPT
        dropped = max(dropped, drops)
        if name in ("article", "main") and not dropped and not article:
            articles += 1
            article = articles
        headings += name in HEADINGS
        stack.append((name, dropped, article))
        open_now[name] += 1
    if at < len(page):
        add(page[at:])
    flush()
    size: Counter[int] = Counter()
    for t, _, d, a, _ in out:
        if a and not d:
            size[a] += len(t)
    if not size:
        return [Line(t, x) for t, x, d, _, _ in out if not d], False
    whole = {a for a, n in size.items() if n >= TEASER * max(size.values())}
    return [Line(t, len(t) if heading else x) for t, x, d, a, heading in out if not d and a in whole], True


def stretches(length: list[int], threshold: int, window: int = WINDOW) -> Iterator[tuple[int, int]]:
    """Lines ``[surge, dive)`` of each stretch of text."""
    n, start = len(length), None
    for i in range(n):
        if start is None and length[i] and sum(length[i:i + window]) >= threshold:
            start = i
        if start is not None and not sum(length[i:i + window]):
            yield start, i
            start = None
    if start is not None:
        yield start, n


def main_text(page: str | None) -> str:
    """The main text: blocks joined by an empty line; empty if there is none."""
    found, marked = lines(page or "")
    length = [x.length for x in found]
    if marked and not any(length):
        return "\n\n".join(x.text for x in found)          # an article of links
    runs = list(stretches(length, 1 if marked else SURGE_CHARS)) or list(stretches(length, 1))
    if not runs:
        return ""
    last = max(i for i in range(runs[-1][1]) if length[i])
    return "\n\n".join(x.text for x in found[runs[0][0]:last + 1] if x.length or marked)


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` without ``html``, with its main text.

    Map-only.  Null and empty html have an empty text; rows are judged one by
    one, so repeated rows get the same.  A column named like the output is
    left out, the others stay.
    """
    ship(pages.sparkSession)
    others = [f for f in pages.schema.fields if f.name not in (html, text)]
    schema = T.StructType([*others, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                made = pa.array([main_text(x.as_py()) for x in part.column(len(others))], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[:len(others)], made], names=schema.names)

    return pages.select(*[F.col(f"`{f.name}`") for f in others], F.col(f"`{html}`")).mapInArrow(run, schema)
