"""Main text of web pages by the distribution of text over line blocks."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import over_batches, slices

#: Lines of a window, and the characters that a window must have where the text surges.
WINDOW, SURGE = 3, 60

_DECLARED = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)", re.S)
_NAME = re.compile(r"</?([a-z][^\s/>\"'<=]*)", re.I)
_STOP = re.compile(r">|=\s*([\"'])")
_NAMES = re.compile(r"\b(?:class|id|role|aria-label|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Elements that never hold main text, elements that do not break a line, elements without content.
ASIDE = frozenset("nav header footer aside form menu button select dialog fieldset head".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr svg math template noscript".split()
)
#: Elements whose content is no markup and runs to their end tag or, without one, to the end of the page.
RAW = {n: re.compile(rf"</{n}(?=[\s/>])[^>]*(?:>|$)", re.I) for n in "script style textarea title iframe".split()}
#: Elements of which no text is shown, or only in place of them; without an end tag they are empty.
HIDDEN = frozenset("svg object template noscript".split())
#: Elements in which tags break no line and a slash at the end closes any element; tags of a page that end
#: them, unless within one of the elements that may hold such tags.
FOREIGN = frozenset(("svg", "math"))
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
    "ol p pre ruby s small span strike strong sub sup table tt u ul var".split()
)
HOLDING = frozenset("foreignobject desc mi mo mn ms mtext annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset(("article", "main"))
#: Words in class, id or role that mark menus, notices, adverts, forms and reader comments.
_MARKS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adverti[sz]ement|sponsor\w*|promo\w*|banner|cookie\w*|consent|gdpr|notice|notices|alert|"
    r"comment|comments|commentlist|respond|disqus|sidebar|side|widget\w*|nav|navbar|navigation|menu|breadcrumb\w*|footer|"
    r"share|sharing|social|related|recommend\w*|newsletter|subscribe|subscription|signup|login|search|popup|modal|overlay|"
    r"pagination|pager|toolbar|skip|contentinfo|complementary|form)(?:$|[\s_-])",
    re.I,
)
#: The same for the top of a page; within an article they mark its own heading.
_TOP = re.compile(r"(?:^|[\s_-])(?:header|masthead|topbar)(?:$|[\s_-])", re.I)


def tokens(page: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, name, attributes) of the tags of a page; comments and declarations have no name. A quoted value hides
    what it encloses. Where a quoted tag does not end, from there on tags end at the next >, quotes or not, so a page is read once;
    a tag without any > is text. After each tag, the caller may send the place to go on from."""
    at, quoted = 0, True
    while (start := page.find("<", at)) >= 0:
        if page.startswith(("<!", "<?"), start):
            end = _DECLARED.match(page, start).end()
            at = (yield start, end, "", "") or end
            continue
        name = _NAME.match(page, start)
        if not name:
            at = start + 1
            continue
        end = name.end()
        while quoted and (stop := _STOP.search(page, end)):
            if stop[0] == ">":
                end = stop.end()
                break
            close = page.find(stop[1], stop.end())
            if close < 0:
                quoted = False
                break
            end = close + 1
        else:
            quoted = False
        if not quoted:
            end = page.find(">", name.end()) + 1
            if not end:
                return
        at = (yield start, end, name[1], page[name.end() : end - 1]) or end


def lines(page: str, marked: bool = True) -> list[tuple[str, int, bool, bool]]:
    """The lines of a page without markup: text, characters within links, whether boilerplate markup holds the line (by
    elements, and by class, id and role if `marked`), and whether an article or main element does. A block element starts and ends a line; references are decoded."""
    out: list[tuple[str, int, bool, bool]] = []
    parts: list[str] = []
    linked = 0
    stack: list[tuple[str, bool, bool]] = []  # open elements: name, boilerplate, main
    opened: Counter[str] = Counter()  # how many are open of each name
    aside_at: list[int] = []  # where boilerplate is open in the stack,
    foreign_at: list[int] = []  # and elements that are foreign or hold what is not
    aside = main = links = hidden = foreign = 0
    last: dict[str, int] = {}  # where the last end tag of a hidden element starts

    def flush() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            out.append((text, linked, aside > 0, main > 0))
        parts.clear()
        linked = 0

    def close(upto: int) -> None:
        nonlocal aside, main, links, hidden, foreign
        for name, is_aside, is_main in stack[upto:]:
            opened[name] -= 1
            aside -= is_aside
            main -= is_main
            links -= name == "a"
            hidden -= name in HIDDEN
            foreign -= name in FOREIGN
        del stack[upto:]
        for places in (aside_at, foreign_at):
            while places and places[-1] >= upto:
                places.pop()

    def add(start: int, end: int) -> None:
        nonlocal linked
        if end > start and not hidden:
            parts.append(page[start:end])
            linked += (end - start) if links else 0

    at = 0
    found = tokens(page)
    onward = None
    while True:
        try:
            start, end, name, attrs = found.send(onward)
        except StopIteration:
            break
        onward = None
        add(at, start)
        at = end
        if not name:
            continue
        name, ends = name.lower(), page.startswith("</", start)
        if foreign and not ends and name in BREAKOUT:
            while foreign and stack[foreign_at[-1]][0] not in HOLDING:
                close(foreign_at[-1])
        if not ends and name in RAW and attrs[:1] in ("", "/", *" \t\n\f\r"):
            if foreign and attrs.endswith("/"):
                continue
            if name in ("title", "textarea", "iframe") and not hidden and not foreign:
                flush()
            over = RAW[name].search(page, at)
            at = onward = over.end() if over else len(page)
            continue
        if name not in INLINE and not hidden and not foreign:
            flush()
        if ends:
            if opened[name]:
                close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
            continue
        if name in VOID or attrs.endswith("/"):
            continue
        if name in HIDDEN:
            if name not in last:
                last[name] = max((e.start() for e in re.finditer(rf"</{name}\s*>", page, re.I)), default=-1)
            if last[name] < at:
                continue
        if name == "body":
            close(0)  # a head that is not closed ends here
        marks = " ".join(a or b or c for a, b, c in _NAMES.findall(attrs)) if "=" in attrs else ""
        is_main = name in MAIN or marks == "main"
        is_aside = name in ASIDE and not (name == "header" and main)
        if marked and marks and name != "body":
            is_aside |= bool(_MARKS.search(marks)) or bool(not main and _TOP.search(marks))
        if is_main and not is_aside and aside and not main and not hidden:
            close(aside_at[0])  # a menu that is not closed ends where the article starts
        if name in ("p", "li") and stack and stack[-1][0] == name:
            close(len(stack) - 1)
        if is_aside:
            aside_at.append(len(stack))
        if name in FOREIGN or name in HOLDING:
            foreign_at.append(len(stack))
        stack.append((name, is_aside, is_main and not is_aside))
        opened[name] += 1
        aside += is_aside
        main += is_main and not is_aside
        links += name == "a"
        hidden += name in HIDDEN
        foreign += name in FOREIGN
    add(at, len(page))
    flush()
    return out


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """Text between the first surge and the last dive of the distribution, without what markup says is boilerplate.

    Boilerplate lines are left out beforehand, so no text ends at them. A line weighs its characters outside links, or all
    within an article or main element; where such elements hold more than half of the weight, lines outside of them weigh
    nothing. Weights are summed over sliding windows, which decide where text surges and where it dives (see `between`).
    All lines in between stay, links too, except those that weigh nothing because they stand outside of the article. If classes
    mark the whole page as boilerplate, they are not heeded.
    """
    rows = lines(page or "")
    if rows and all(aside for _, _, aside, _ in rows):
        rows = lines(page or "", marked=False)
    rows = [(text, len(text) if main else max(len(text) - linked, 0), main) for text, linked, aside, main in rows if not aside]
    texts = [text for text, _, _ in rows]
    weight = np.array([w for _, w, _ in rows], np.int64)
    main = np.array([m for _, _, m in rows], bool)
    stays = np.ones(len(rows), bool)
    if 2 * weight[main].sum() > weight.sum():
        weight[~main], stays = 0, main
    start, end = between(weight, main, window, surge)
    return " ".join(texts[i] for i in range(start, end) if stays[i])


def between(weight: np.ndarray, main: np.ndarray, window: int, surge: int) -> tuple[int, int]:
    """The lines from the first surge to the dive after the last one. The window of a line starts with it; beyond the last line
    there is no weight. Text surges at a line of weight whose window reaches `surge`, or the most that any window has,
    and at every line of an article that has weight. It dives at a line whose whole window has none."""
    if not weight.any():
        return 0, 0
    ahead = np.convolve(weight, np.ones(window, np.int64))[window - 1 :]
    surges = np.flatnonzero((weight > 0) & (main | (ahead >= min(surge, int(ahead.max())))))
    if not len(surges):
        return 0, 0
    dives = np.flatnonzero(ahead == 0)
    dives = dives[dives > surges[-1]]
    return int(surges[0]), int(dives[0]) if len(dives) else len(weight)


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text and n_chars. A missing or empty page has an empty text; whole pages are read, pages
    without closing tags too. Rows are extracted one by one, other columns are ignored."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(page) for page in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select("page_id", "url", "html")
    kinds = dict(rows.dtypes)
    return over_batches(rows, work, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
