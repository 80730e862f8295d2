"""HTML extraction: nearest-URL page differencing, with marked structure as the judge of what it must not delete.

A page becomes lines, one per block, white space collapsed and character references decoded. The lines of every page
are compared with the nearest other pages of its host, the ones before and after it in order of URL path (pages that
mark their article and pages that do not have an order each): lines are aligned by longest common subsequence,
and shared lines are deleted. Markup judges the rest: lines inside a marked article are exempt (articles hold passages
that other pages have too); menus, headers, footers, sidebars, notices, adverts, forms and comments (by element, or by
class, id or role) that the comparison left go, as they may be drawn anew for every page; so does what it left outside
of a marked article. A page without a marked article keeps all other lines that it does not share.

Pages of a host with the same lines are compared as one, at the place of the first of them, and get the same text. Only
hashes of lines are sent between pages.

The alignment is bounded: equal heads and tails are matched first, few matches are chained one by one, and many (long
runs of equal lines) are aligned by bit vectors, in halves where the vectors of all lines would not fit.

Defined cases: null html is an empty page; null or relative urls form one host of their own; a host with a
single page, or with copies of one page only, has nothing to compare with and keeps its lines; repeated rows
are pages of their own, but a page is not compared with one whose lines are all the same (a copy shares
everything); two pages without marks lose equal lines of their articles too, as no mark tells them apart from a menu;
unclosed elements end with the page; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import html as html_lib
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, written
from .url_reputation import url_host, url_path

#: Fixed lists of the markup that decides a line.
RAW = {"script", "style", "noscript", "template", "textarea", "svg", "math", "iframe", "object", "select", "title", "xmp"}
CHROME = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button"}
ARTICLE = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "legend", "li",
    "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
CHROME_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu|breadcrumbs?|header|footer|side-?bar|aside|cookies?|consent|"
    r"notice|popup|modal|newsletter|subscribe|signup|login|share|social|comments?|replies|reply|related|recommended|widget|toolbar|"
    r"pagination|pager|skip|copyright|legal|disclaimer)(?:$|[\s_-])", re.IGNORECASE)
ARTICLE_NAME = re.compile(r"(?:^|[\s_-])(?:article(?:-?(?:body|content|text))?|post-?(?:body|content|text)|entry-?content|main-?content|story-?body)(?:$|\s)", re.IGNORECASE)
_CHROME_ROLE = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.DOTALL)
_ATTR = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
KEEP, OPEN, CHROME_LINE = "+", "?", "-"


def _zone(name: str, attrs: str) -> str | None:
    """What an element says about its lines: chrome, article or nothing."""
    if name in CHROME:
        return "chrome"
    if name in ARTICLE:
        return "article"
    if not attrs or name in ("html", "body"):
        return None
    values = {m[1].lower(): html_lib.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attrs)}
    role = values.get("role", "").strip().lower()
    if role in _CHROME_ROLE or "hidden" in attrs.lower().split() or values.get("aria-hidden", "").lower() == "true":
        return "chrome"
    named = [values.get("class", ""), values.get("id", "")]
    if any(map(ARTICLE_NAME.search, named)) or role in ("main", "article"):
        return "article"
    return "chrome" if any(map(CHROME_NAME.search, named)) else None


def page_lines(html: str) -> list[tuple[str, str]]:
    """(kind, text) of every line of a page. KEEP: in a marked article; CHROME_LINE: in what is no article by its markup;
    OPEN: markup does not say."""
    lines: list[tuple[str, str]] = []
    words: list[str] = []
    stack: list[tuple[str, str | None]] = []
    state = [None]  # the zone in force, per open element
    open_names: Counter = Counter()

    def flush() -> None:
        text = " ".join(html_lib.unescape("".join(words)).split())
        words.clear()
        if text:
            lines.append(({"article": KEEP, "chrome": CHROME_LINE}.get(state[-1], OPEN), text))

    at, n = 0, len(html)
    while at < n:
        m = _TAG.search(html, at)
        if m is None:
            words.append(html[at:])
            break
        words.append(html[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if name in RAW and not closing:
            if not m[3].rstrip().endswith("/") or name in ("script", "style"):
                end = re.compile(rf"</{re.escape(name)}\s*(?:>|\Z)", re.IGNORECASE).search(html, at)
                at = end.end() if end else n
            continue
        if name == "br":
            words.append(" ")
            continue
        if name in VOID and name != "hr":
            continue
        if closing:
            if open_names[name]:  # else a stray tag: no search through what is open
                at_open = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name)
                open_names.subtract(x for x, _ in stack[at_open:])
                if name in BLOCK or any(zone for _, zone in stack[at_open:]):
                    flush()
                del stack[at_open:], state[at_open + 1:]
            elif name in BLOCK:
                flush()
            continue
        zone = _zone(name, m[3])
        if name in BLOCK or zone:
            flush()
        if name in VOID or m[3].rstrip().endswith("/"):
            continue
        if name == "p" and any(x == "p" for x, _ in stack[-1:]):  # a paragraph ends the one before
            stack.pop()
            state.pop()
            open_names["p"] -= 1
        inherited = state[-1]
        stack.append((name, zone))
        open_names[name] += 1
        state.append(inherited if zone is None or inherited == "chrome" else zone)
    flush()
    return lines


FEW_MATCHES = 1 << 20  # pairs of equal lines that are chained one by one
ROOM = 1 << 28  # bits of vectors held at a time


def _chained(mine: list[int], other: list[int]) -> set[int]:
    """Positions of ``mine`` in a longest common subsequence, by increasing positions of matches, shortest ends first."""
    at = defaultdict(list)
    for j, line in enumerate(other):
        at[line].append(j)
    ends: list[int] = []
    links: list[tuple[int, object]] = []
    for i, line in enumerate(mine):
        for j in reversed(at.get(line, ())):
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            ends[k:k + 1], links[k:k + 1] = [j], [link]
    found, link = set(), links[-1] if links else None
    while link:
        found.add(link[0])
        link = link[1]
    return found


def _vectors(mine: list[int], other: list[int]) -> Iterator[int]:
    """After each line of ``mine``: a number whose bit j is 0 where the common subsequence with other[:j + 1] is longer
    than with other[:j]."""
    at = defaultdict(list)
    for j, line in enumerate(other):
        at[line].append(j)
    many = {x: sum(1 << j for j in js) for x, js in at.items() if len(js) >= 64}
    full = v = (1 << len(other)) - 1
    for line in mine:
        u = v & (many[line] if line in many else sum(1 << j for j in at.get(line, ())))
        v = ((v + u) | (v - u)) & full
        yield v


def _lengths(mine: list[int], other: list[int]) -> np.ndarray:
    """Length of the common subsequence of ``mine`` with every head of ``other``."""
    v = (1 << len(other)) - 1
    for v in _vectors(mine, other):
        pass
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(other) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(other)]
    return np.r_[0, np.cumsum(bits == 0)]


def _by_vectors(mine: list[int], other: list[int]) -> set[int]:
    if len(mine) > 1 and len(mine) * len(other) > ROOM:  # the best cut of ``other`` for two halves of ``mine``
        half = len(mine) // 2
        cut = int((_lengths(mine[:half], other) + _lengths(mine[half:][::-1], other[::-1])[::-1]).argmax())
        return _by_vectors(mine[:half], other[:cut]) | {half + i for i in _by_vectors(mine[half:], other[cut:])}
    rows, found, mask = list(_vectors(mine, other)), set(), (1 << len(other)) - 1
    full = mask
    for i in range(len(rows) - 1, -1, -1):
        here = ~rows[i] & mask
        if not here:
            break
        before = ~(rows[i - 1] if i else full) & mask
        if here.bit_count() > before.bit_count():  # longer by this line, matched where the last step is
            found.add(i)
            mask = (1 << (here.bit_length() - 1)) - 1
    return found


def shared_lines(mine: list, other: list) -> set[int]:
    """Positions of ``mine`` in a longest common subsequence with ``other``."""
    head = 0
    while head < min(len(mine), len(other)) and mine[head] == other[head]:
        head += 1
    tail = 0
    while tail < min(len(mine), len(other)) - head and mine[-1 - tail] == other[-1 - tail]:
        tail += 1
    both = set(mine[head:len(mine) - tail]) & set(other[head:len(other) - tail])
    kept = [i for i in range(head, len(mine) - tail) if mine[i] in both]
    a, b = [mine[i] for i in kept], [x for x in other[head:len(other) - tail] if x in both]
    times = Counter(b)
    middle = _chained(a, b) if sum(times[x] for x in a) <= FEW_MATCHES else _by_vectors(a, b)
    return {*range(head), *range(len(mine) - tail, len(mine)), *(kept[i] for i in middle)}


def _parsed(html: Column) -> Column:
    """struct(marked, lines, hashes): has the page a marked article, the lines (kind and text, one a row) and a 64-bit
    hash of each text. Texts that markup takes out anyway are empty."""
    @F.pandas_udf("marked boolean, lines string, hashes array<long>")
    def run(pages: pd.Series) -> pd.DataFrame:
        rows = []
        for page in pages:
            lines = page_lines(page)
            marked = any(kind == KEEP for kind, _ in lines)
            hashes = [int.from_bytes(blake2b(t.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True) for _, t in lines]
            rows.append((marked, "\n".join(kind + (t if kind == KEEP or kind == OPEN and not marked else "") for kind, t in lines), hashes))
        return pd.DataFrame(rows, columns=["marked", "lines", "hashes"])

    return run(F.coalesce(html, F.lit("")))


_POSITIONS = T.ArrayType(T.IntegerType())


@F.pandas_udf(T.StructType([T.StructField("mine", _POSITIONS), T.StructField("theirs", _POSITIONS)]))
def _shared(mine: pd.Series, theirs: pd.Series) -> pd.DataFrame:
    """Positions of the lines that two pages share, in each of them."""
    rows = [(sorted(shared_lines(list(a), list(b))), sorted(shared_lines(list(b), list(a)))) for a, b in zip(mine, theirs, strict=True)]
    return pd.DataFrame(rows, columns=["mine", "theirs"])


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("by_difference", T.IntegerType()),
                              T.StructField("by_markup", T.IntegerType())]))
def _text(lines: pd.Series, shared: pd.Series) -> pd.DataFrame:
    out = []
    for page, gone in zip(lines, shared, strict=True):
        gone = set() if gone is None else set(gone)
        kinds = page.split("\n") if page else []
        marked = any(x[0] == KEEP for x in kinds)
        deleted = sum(x[0] != KEEP and i in gone for i, x in enumerate(kinds))
        left = [x for i, x in enumerate(kinds) if x[0] == KEEP or i not in gone]
        text = [x[1:] for x in left if x[0] == KEEP or x[0] == OPEN and not marked]
        out.append(("\n\n".join(text), deleted, len(left) - len(text)))
    return pd.DataFrame(out, columns=["text", "by_difference", "by_markup"])


def _in_order(pages: DataFrame) -> DataFrame:
    """Add ``_rank``: the row's place (0, 1, ...) in order of host, path, page and lines. The sorted rows are
    written; a row's partition and place in it follow from its id, and the partitions' sizes (one row per
    partition) are summed up."""
    ordered = written(pages.orderBy("host", "path", "page_id", "same").withColumn("_m", F.monotonically_increasing_id()), "url-order")
    part = F.shiftright("_m", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    place = F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.withColumn("_part", part).join(F.broadcast(shift), "_part").select("host", "same", "hashes", (F.col("_shift") + place).alias("_rank"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every row of ``pages`` (page_id, url, html), and how many lines outside of a marked article
    the comparison deleted (by_difference) and how many of the others markup (by_markup). Pages are parsed twice, for their hashes
    and for their text, instead of keeping all lines in between."""
    parsed = small_batches(pages).select("page_id", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), _parsed(F.col("html")).alias("p"))
    # pages with and without a marked article are neighbours of their own kind
    parsed = parsed.select("page_id", "url", F.concat_ws(" ", "host", F.col("p.marked").cast("string")).alias("host"), "path", "p.lines", "p.hashes",
                           F.xxhash64("p.hashes").alias("same"))
    # copies take one place in the order: a neighbour is a page to compare with
    firsts = (parsed.where(F.size("hashes") > 0).groupBy("host", "same")
              .agg(F.min(F.struct("path", "page_id")).alias("_first"), F.first("hashes").alias("hashes")))
    ranked = _in_order(firsts.select("host", "same", "hashes", "_first.*"))
    after = ranked.select(F.col("host").alias("_h"), F.col("same").alias("_other"), F.col("hashes").alias("_theirs"), (F.col("_rank") - 1).alias("_rank"))
    both = ranked.join(after, "_rank").where("host = _h").select("host", "same", "_other", _shared(F.col("hashes"), F.col("_theirs")).alias("_s"))
    each = both.select("host", F.explode(F.array(F.struct("same", F.col("_s.mine").alias("gone")),
                                                 F.struct(F.col("_other").alias("same"), F.col("_s.theirs").alias("gone")))).alias("_x"))
    gone = each.select("host", "_x.*").groupBy("host", "same").agg(F.flatten(F.collect_list("gone")).alias("gone"))  # two neighbours at most
    every = parsed.select("page_id", "url", "host", "same", "lines").join(gone, ["host", "same"], "left")
    return every.select("page_id", "url", _text(F.col("lines"), F.col("gone")).alias("t")).select("page_id", "url", "t.*")
