"""Main text of web pages by the distribution of text over lines.

Markup is stripped to lines, one for each block element, in page order. A line weighs as many
characters as it has outside of links; lines inside elements that never hold main text (menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles, comments) weigh nothing, and lines inside an
<article> or <main> weigh `INSIDE` times as much. Weights are summed over windows of `WINDOW` lines, and
no window reaches over the border of such an element. The text surges where the sum leaves zero and dives
where it falls back to zero; between a surge and its dive all lines that are not boilerplate are text,
however short. Of several such stretches the one with the highest sum counts, with those that reach `PEAK`
of it and those between such stretches of the same element; if it lies in an <article>, all stretches of
that article count. So articles that are teasers or comments do not outweigh a story outside of them. One or two
lines that are all links stay between lines of a chosen stretch; more of them are a list of links.

A form, or an element whose name is marked, that holds most of the page's text outside of links is a wrapper
around the page and no boilerplate; one of comments or adverts stays what it is. A name that
merely says something (`has-sidebar`, `comments-open`) marks nothing.

Results: null and empty pages give an empty text, and so do pages without any. Broken markup is read
as far as it goes: unclosed elements end with their parent, a tag that is cut off is dropped.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import slices, text_column

WINDOW = 4
PEAK = 0.3
INSIDE = 2

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(?P<end>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z|(?=<))",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([A-Za-z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_SPACE = re.compile(r"\s+")

_RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = set(
    """address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary
    table tbody td tfoot th thead tr ul""".split()
)
_CLOSES_P = _BLOCK - {"html", "body", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option"}
_NEVER = set("aside button datalist dialog footer form head input label menu nav noscript object select svg template audio video canvas map".split())
_MARKED = set(
    """ad ads adsense advert adverts advertisement advertising alert banner breadcrumb breadcrumbs byline comment comments consent
    cookie cookies disqus dropdown footer gdpr hidden login masthead menu menubar modal nav navbar navigation newsletter
    notice notices notification overlay pager pagination popup promo promotion recommended related replies reply respond
    search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget""".split()
)
#: Articles in or with these are other people's or other pages' text, unless the name only says that there are some.
_FOREIGN = set("ad ads advert adverts advertisement comment comments disqus promo recommended related replies reply respond sponsored".split())
_SAYING = {"has", "with", "without", "no"}
_SAYS = set("has with without no open closed status enabled disabled allow show hide count".split())
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}


def _boilerplate(name: str, attrs: str, inside: bool) -> int:
    """0 for an element that may hold text, 1 for one that is a wrapper if it holds most of it, else 2."""
    if name == "form":
        return 1
    if name in _NEVER or name == "header" and not inside:
        return 2
    if not attrs or name in ("html", "body", "main", "article"):
        return 0
    found = 0
    for match in _ATTRIBUTE.finditer(attrs):
        key, value = match[1].lower(), next((g for g in match.groups()[1:] if g is not None), "")
        if key in ("class", "id"):
            for token in value.split():
                words = [w.lower() for w in _WORD.findall(token)]
                if words and words[0] not in _SAYING and not _MARKED.isdisjoint(words):
                    foreign = not _FOREIGN.isdisjoint(words)
                    found = max(found, 0 if foreign and not _SAYS.isdisjoint(words) else 2 if foreign else 1)
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value.lower() in _ROLES:
            return 2
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return 2
    return found


def _foreign(attrs: str) -> bool:
    for match in _ATTRIBUTE.finditer(attrs):
        if match[1].lower() in ("class", "id"):
            for token in next((g for g in match.groups()[1:] if g is not None), "").split():
                words = {w.lower() for w in _WORD.findall(token)}
                if words & _FOREIGN and not words & _SAYS:
                    return True
    return False


def lines(page: str) -> list[tuple[str, int, int]]:
    """(text, weight, element) of each block of a page that has any text. The element is the innermost
    <article> or <main> around it: 0 if there is none, n for the n-th if that is a <main>, -n if an <article>."""
    wrappers: set[int] = set()
    while True:
        out, within, total = _lines(page, wrappers)
        more = {at for at, weight in within.items() if 2 * weight > total}
        if not more:
            return out
        wrappers |= more


def _lines(page: str, wrappers: set[int]) -> tuple[list[tuple[str, int, int]], dict[int, int], int]:
    """The lines, if the elements that begin at `wrappers` are no boilerplate; the weight of the text in each
    outermost element that may be a wrapper, by its place; and the weight of all text that is seen."""
    out: list[tuple[str, int, int]] = []
    parts: list[str] = []
    weight = seen = total = 0
    within: dict[int, int] = {}
    stack: list[tuple[str, bool, int, bool, int]] = []  # name, boilerplate, element, in or with a foreign name, wrapper
    dropped, inside, links = False, 0, 0

    def close() -> None:
        nonlocal weight
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip() if parts else ""
        if text:
            out.append((text, weight, inside))
        parts.clear()
        weight = 0

    def add(text: str) -> None:
        nonlocal weight, total
        size = 0 if links else len(text.strip())
        if text and not dropped:
            parts.append(text)
            weight += size
            total += size
        elif size and stack[-1][4] >= 0:
            within[stack[-1][4]] = within.get(stack[-1][4], 0) + size
            total += size

    at = 0
    while True:
        match = _TAG.search(page, at)
        if not match:
            add(page[at:])
            break
        add(page[at : match.start()])
        place, at = match.start(), max(match.end(), match.start() + 1)
        if match["name"] is None:
            continue
        name = match["name"].lower()
        if name in _BLOCK:
            close()
        elif name == "br":
            parts.append(" ")
        if match["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    links -= sum(n == "a" for n, *_ in stack[k:])
                    del stack[k:]
                    break
            else:
                continue
        else:
            if name in _RAW:
                end = re.compile(rf"</{name}\b[^>]*>?", re.IGNORECASE).search(page, at)
                at = end.end() if end else len(page)
                continue
            if name in _VOID or match["attrs"].endswith("/"):
                continue
            if name in _CLOSES_P:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p":
                        links -= sum(n == "a" for n, *_ in stack[k:])
                        del stack[k:]
                        break
                    if stack[k][0] in _BLOCK:
                        break
            above = stack[-1] if stack else ("", False, 0, False, -1)
            foreign = above[3] or name not in ("html", "body", "main") and bool(match["attrs"]) and _foreign(match["attrs"])
            # Text counts for the outermost dropped element, if that may be a wrapper; for none below any other.
            kind = 0 if place in wrappers else _boilerplate(name, match["attrs"], above[2] != 0)
            wrapper = above[4] if kind < 2 else -1
            if name in ("article", "main"):
                # An article counts even where a wrapper around it is named like boilerplate, but not among comments.
                drop = foreign or above[1] and any(n in _NEVER for n, d, *_ in stack if d)
                seen += 1
                stack.append((name, drop, above[2] if drop else -seen if name == "article" else seen, foreign, wrapper if drop and not foreign else -1))
            else:
                if kind == 1 and not above[1]:
                    wrapper = place
                stack.append((name, above[1] or kind > 0, above[2], foreign, wrapper))
            links += name == "a"
        dropped, inside = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
    close()
    return out, within, total


def main_text(page: str) -> str:
    found = lines(page)
    if not found:
        return ""
    element = np.array([e for _, _, e in found])
    weights = np.array([w for _, w, _ in found]) * np.where(element != 0, INSIDE, 1)
    if not weights.any():  # all text is in links: that of an article still counts
        weights = (element != 0).astype(np.int64)
    # WINDOW empty lines at each border of an element: no window reaches over it, and the text dives there.
    at = np.arange(len(found)) + WINDOW * np.concatenate([[0], np.cumsum(element[1:] != element[:-1])])
    spread = np.zeros(at[-1] + 1, np.int64)
    spread[at] = weights
    sums = np.convolve(spread, np.ones(WINDOW, np.int64))  # windows that begin before and end behind each line
    busy = np.concatenate([[False], sums > 0, [False]])
    surges, dives = np.flatnonzero(busy[1:] & ~busy[:-1]), np.flatnonzero(busy[:-1] & ~busy[1:])
    if not len(surges):
        return ""
    peaks = np.array([sums[a:b].max() for a, b in zip(surges, dives, strict=True)])
    owner = element[np.searchsorted(at, surges)]  # the text surges at a line that weighs something
    chosen = np.zeros(len(peaks), bool)
    for e in np.unique(owner):
        own = np.flatnonzero(owner == e)
        high = own[peaks[own] >= PEAK * peaks.max()]
        if len(high):
            chosen[own[(own >= high[0]) & (own <= high[-1])]] = True
    best = owner[peaks.argmax()]
    if best < 0:
        chosen[owner == best] = True
    kept = np.zeros(len(sums), bool)
    for a, b in zip(surges[chosen], dives[chosen], strict=True):
        kept[a:b] = True
    # Window k holds the lines k - WINDOW + 1 to k. A heading inside an article may be a link.
    stays = [bool(w or e) and bool(kept[k : k + WINDOW].any()) for (_, w, e), k in zip(found, at, strict=True)]
    for k, (_, w, e) in enumerate(found):
        if not (w or e):
            # Up to two lines in links between lines that stay; elsewhere links are lists of other pages.
            before = next((j for j in range(k - 1, max(k - 3, -1), -1) if found[j][1] or found[j][2]), None)
            after = next((j for j in range(k + 1, min(k + 3, len(found))) if found[j][1] or found[j][2]), None)
            if before is not None and after is not None and after - before <= 3:
                stays[k] = stays[before] and stays[after] and found[before][2] == found[after][2] == 0
    return "\n\n".join(text for (text, _, _), stay in zip(found, stays, strict=True) if stay)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = pa.array([main_text(page) for page in batch.column("text").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), texts], ["page_id", "url", "text"])

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), text_column(html_col).alias("text"))
    schema = rows.schema
    return rows.mapInArrow(run, schema)
