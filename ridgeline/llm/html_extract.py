"""Main text of a page by its line-block distribution.

The markup is stripped to lines, one for each block of the page.  A line weighs
as many code points as its text has outside links; lines of menus, headers,
footers, adverts, forms, comments and the like weigh nothing, and where a page
marks its article, so do all lines outside it.  Class and id words name such a block
only as a whole; they drop no heading or paragraph of a marked article, and an
article in a block of such a name is kept unless it is a comment or the page has
more text elsewhere.  The weights are summed over a
sliding window of lines.  The sum surges where a text begins and dives to nothing
where it ends; the lines between a surge and its dive are a region.  On pages
without a marked article the regions whose peak reaches a bound (the heaviest if
none does) show the container that holds the text; all its lines outside dropped
blocks are kept, whatever their length or share of links, with the rest of those
regions.  Marked ones keep every region.
"""

from __future__ import annotations

import heapq
import html
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
PEAK = 80
LINKED = 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style|aria-label)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""",
                    re.I)
_RAW = {"script", "style", "template", "noscript", "textarea", "title", "iframe", "svg", "math", "object", "canvas",
        "audio", "video", "xmp", "noembed", "noframes", "datalist"}
_GONE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "fieldset", "head", "label"}
_VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "area", "base", "col", "embed", "source", "track", "param"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
           "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
           "tt", "u", "var", "wbr", "img", "br"}
_MAIN = {"article", "main"}
#: Elements that their own kind, or the end of a block around them, closes.
_SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                 "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog",
          "menu", "menubar", "toolbar", "tablist", "tooltip", "status"}
#: Names of blocks that are not part of an article.  A class or id names such a block
#: if it has one of these words and none but these and the ``_AROUND`` ones.
_JUNK = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertisements", "advertising", "adsense", "adbox",
         "banner", "breadcrumb", "breadcrumbs", "consent", "cookie", "cookies", "footer", "form", "gdpr", "header",
         "login", "masthead", "menu", "menus", "modal", "nav", "navbar", "navigation", "newsletter", "pager",
         "pagination", "popup", "promo", "promoted", "promotion", "share", "sharing", "sidebar", "signup", "sponsor",
         "sponsored", "sponsors", "subscribe", "subscription", "toolbar", "topbar"}
_COMMENT = {"comment", "comments", "disqus"}
_AROUND = {"area", "bar", "block", "bottom", "box", "buttons", "contact", "container", "div", "first", "global", "group",
           "holder", "id", "inner", "item", "left", "links", "list", "main", "mobile", "notice", "page", "panel",
           "primary", "right", "search", "secondary", "section", "site", "slot", "social", "sub", "thread", "top",
           "unit", "wrap", "wrapper"}
_AROUND_COMMENT = _AROUND | {"article", "body", "entry", "form", "post", "reader", "readers", "reply", "respond", "text",
                             "user", "users"}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Elements that can be the container of a text.
_CONTAINERS = {"html", "body", "div", "section", "center", "td"}
_TEXT = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
#: What drops an element, the later the firmer: a block's name around an article, a block's name, the rest.
_AROUND_ARTICLE, _NAMED, _GONE_FOR_GOOD = 1, 2, 3


def _is_gone(attributes: str) -> bool:
    """Hidden, or of a role that is not part of an article."""
    for name, *values in _NAMES.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name == "role" and value.lower() in _ROLES:
            return True
    return False


def _named(attributes: str, names: set[str], around: set[str]) -> bool:
    """Whether a whole class or the id is one of ``names``, alone or with words ``around`` it."""
    for name, *values in _NAMES.findall(attributes):
        if name.lower() in ("class", "id"):
            for token in "".join(values).split():
                words = {w.lower() for w in _WORD.findall(token)}
                if words & names and words <= names | around:
                    return True
    return False


def page_lines(page: str) -> tuple[list[tuple[str, int, bool, int, int]], list[int]]:
    """(text, code points outside links, inside a marked article, what drops it or 0, container) of each block,
    and the container around each container, -1 around the page (0).

    Character references are decoded, white space becomes single spaces.  A dropped
    block also leaves ``WINDOW`` empty lines, so that the text around it parts.
    """
    lines: list[tuple[str, int, bool, int, int]] = []
    around = [-1]
    parts: list[str] = []
    linked = 0
    stack: list[tuple[str, int, bool, bool, int]] = []  # element, dropped, marked, link (with its ancestors), container
    at, lower = 0, None

    def state():
        return stack[-1][1:] if stack else (0, False, False, 0)

    def flush():
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                dropped, marked, _, inside = state()
                lines.append((text, max(0, len(text) - linked), marked, dropped, inside))
            parts, linked = [], 0

    def add(raw: str):
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if state()[2]:
                linked += len(" ".join(text.split()))

    def close(depth: int):
        """Closes the elements from ``depth`` on."""
        if any(s[0] not in _INLINE for s in stack[depth:]):
            flush()
        was = state()[0]
        del stack[depth:]
        if was and not state()[0]:
            lines.extend([("", 0, False, _GONE_FOR_GOOD, 0)] * WINDOW)

    while True:
        found = _TOKEN.search(page, at)
        if found is None:
            add(page[at:])
            break
        add(page[at:found.start()])
        at = found.end()
        slash, name, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not name:
            continue
        name = name.lower()
        if name == "br":
            parts.append(" ")
        elif slash:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if depth is not None and (name not in _INLINE or all(s[0] in _INLINE for s in stack[depth:])):
                close(depth)
            elif name not in _INLINE:
                flush()
        elif name in _RAW:
            if not attributes.endswith("/"):
                lower = page.lower() if lower is None else lower
                if len(lower) != len(page):      # lower-casing changed the length: search without it
                    end = re.compile(f"</{name}", re.I).search(page, at)
                    stop = end.start() if end else -1
                else:
                    stop = lower.find(f"</{name}", at)
                stop = len(page) if stop < 0 else stop
                gone = page.find(">", stop)
                at = len(page) if gone < 0 else gone + 1
        elif name in _VOID:
            if name not in _INLINE:
                flush()
        else:
            if name not in _INLINE:
                flush()
                ends = _SELF_CLOSING.get(name)
                if ends:
                    depth = len(stack)
                    for k in range(len(stack) - 1, -1, -1):
                        if stack[k][0] in ends:
                            depth = k
                            break
                        if stack[k][0] not in _INLINE and stack[k][0] not in ("p",):
                            break
                    close(depth)
                elif any(s[0] == "p" for s in stack[-4:]):     # a block ends an open paragraph
                    depth = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == "p")
                    if all(s[0] in _INLINE or s[0] == "p" for s in stack[depth:]):
                        close(depth)
            if not attributes.endswith("/") or name not in _INLINE:
                dropped, marked, link, inside = state()
                if name in _CONTAINERS:
                    around.append(inside)
                    inside = len(around) - 1
                own = attributes if name not in ("html", "body") else ""
                text = marked and name in _TEXT         # no name drops a heading or paragraph of an article
                comment = bool(own) and not text and _named(own, _COMMENT, _AROUND_COMMENT)
                whole = name == "main" or "role=\"main\"" in attributes
                main = whole or (name in _MAIN and not comment)
                if main:
                    # a name does not drop the article that it is around, unless the page has its text elsewhere
                    dropped = (0 if whole else _AROUND_ARTICLE) if dropped == _NAMED else dropped
                elif name in _GONE or comment or (own and _is_gone(own)):
                    dropped = _GONE_FOR_GOOD
                elif own and not text and _named(own, _JUNK, _AROUND):
                    dropped = max(dropped, _NAMED)
                stack.append((name, dropped, marked or main, link or name == "a", inside))
    flush()
    return lines, around


def _holder(containers: list[int], around: list[int]) -> int:
    """The innermost container that holds all of ``containers``; a container's number is above the one's around it."""
    left = {*containers}
    queue = [-c for c in left]                      # the highest number first
    heapq.heapify(queue)
    while len(left) > 1:
        last = -heapq.heappop(queue)
        left.remove(last)
        if around[last] not in left:
            left.add(around[last])
            heapq.heappush(queue, -around[last])
    return left.pop()


def _inside(holder: int, around: list[int]) -> list[bool]:
    """Whether each container is ``holder`` or inside it."""
    out: list[bool] = []
    for k, outer in enumerate(around):
        out.append(k == holder or (outer >= 0 and out[outer]))
    return out


def _container_lines(lines, around: list[int], found: list[tuple[int, int, float]], weights: np.ndarray) -> set[int]:
    """The lines of the container that the regions' long lines (all their lines if none is long) show."""
    within = [k for a, b, _ in found for k in range(a, b) if weights[k] > 0]
    holder = _holder([lines[k][4] for k in within if weights[k] >= PEAK] or [lines[k][4] for k in within], around)
    kept = [k for k, (text, _, _, dropped, _) in enumerate(lines) if text and not dropped]
    count = [0] * len(around)
    for k in kept:
        count[lines[k][4]] += 1
    for c in range(len(around) - 1, 0, -1):
        count[around[c]] += count[c]
    while holder and count[holder] == 1:            # around a single line only
        holder = around[holder]
    inside = _inside(holder, around)
    return {k for k in kept if inside[lines[k][4]]}


def regions(weights: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, float]]:
    """(first line, end, peak of the window sums) between each surge and its dive."""
    if not len(weights):
        return []
    total = np.concatenate([[0.0], np.cumsum(weights)])
    upto = np.minimum(np.arange(len(weights)) + window, len(weights))
    sums = total[upto] - total[:-1]
    live = np.concatenate([[False], sums > 0, [False]])
    surge = np.flatnonzero(~live[:-1] & live[1:])
    dive = np.flatnonzero(live[:-1] & ~live[1:])
    return [(int(a), int(b), float(sums[a:b].max())) for a, b in zip(surge, dive, strict=True)]


def main_text(page: str | None) -> str:
    """The blocks of the main text, joined by newlines; empty if there are none."""
    lines, around = page_lines(page or "")
    marked = any(m and not dropped and text for text, _, m, dropped, _ in lines)
    if not marked:
        named = sum(len(text) for text, _, m, dropped, _ in lines if m and dropped == _AROUND_ARTICLE)
        if named > sum(own for _, own, _, dropped, _ in lines if not dropped):
            marked = True
            lines = [(text, own, m, 0 if m and dropped == _AROUND_ARTICLE else dropped, inside)
                     for text, own, m, dropped, inside in lines]
    weights = np.array([0 if dropped or (marked and not m) else
                        (len(text) if marked or own >= (1 - LINKED) * len(text) else 0)
                        for text, own, m, dropped, _ in lines], dtype=float)
    found = regions(weights)
    if not marked and found:
        bound = min(PEAK, max(p for _, _, p in found))
        found = [r for r in found if r[2] >= bound]
    kept = {k for a, b, _ in found for k in range(a, b) if weights[k] > 0}
    if not marked and found:
        kept |= _container_lines(lines, around, found, weights)
    return "\n".join(lines[k][0] for k in sorted(kept))


def _texts(pages: pd.Series) -> pd.Series:
    return pages.map(main_text)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages`` (page_id, url, html, ...).

    Null or empty html, and pages without any text, give an empty text.  Ids may
    repeat or be null; other columns are ignored; an empty table gives an empty
    result.
    """
    texts = F.pandas_udf(_texts, "string")
    rows = pages.select("page_id", "url", texts(F.coalesce(F.col("html").cast("string"), F.lit(""))).alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))
