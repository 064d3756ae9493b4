"""Main text of web pages by line-block distribution (operator 10).

A page becomes lines: one for each block element's own text, with mark-up,
scripts, styles and hidden parts stripped. The lengths of the lines' texts
(links count against them) are summed over a sliding window; the sum surges
where the main text begins and dives where it ends, and every line between the
two points is kept, short ones too; where it surges again, so are those of the
next run. Lines in headers, footers, menus, side bars, forms, notices, adverts
and comments are left out before. Where the page marks regions by ``article`` or
``main``, these are its main text, all of them and whole.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from menulake.llm.common import text_of

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)

#: Elements whose content is not text of the page; it ends at their own end tag only.
RAW = frozenset(("script", "style", "noscript", "template", "iframe", "object", "svg", "math", "canvas", "textarea", "select", "title", "xmp", "noembed", "noframes"))
_RAW_END = {n: re.compile(rf"</{n}\b[^>]*>", re.I) for n in RAW}
#: Elements around the main text, never part of it.
ASIDE = frozenset(("nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "head", "fieldset", "label", "audio", "video", "map"))
MAIN = frozenset(("article", "main"))
#: Words in class, id or role that mark such parts.
NOTICE = re.compile(r"(?:^|[\s_-])(?:ad|ads|adv|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|promotion|cookie|cookies|consent|gdpr|notice|notices|popup|modal|overlay|newsletter|subscribe|signup|login|nav|navbar|navigation|menu|menubar|breadcrumb|breadcrumbs|toolbar|sidebar|widget|footer|masthead|copyright|legal|share|sharing|social|related|recommended|comment|comments|commentlist|respond|reply|replies|disqus|pagination|pager|search|complementary|contentinfo|skip|hidden|toc|tags)(?=$|[\s_-])", re.I)
#: Classes that tell what a block has beside its text; they don't make it a notice.
HAS = re.compile(r"(?<![^\s])(?:[^\s]*[_-])?(?:has|have|with|without|no|hide|show)[_-][^\s]*", re.I)
#: Comments may be longer than the text that they are about.
REPLY = re.compile(r"(?:^|[\s_-])(?:comment|comments|commentlist|respond|reply|replies|disqus)(?=$|[\s_-])", re.I)
BLOCK = frozenset(("address", "article", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "hr", "html", "li", "main", "ol", "p", "pre", "section", "summary", "table", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr", "frame", "keygen"))
#: An open element of the left kind ends where one of the right kind begins.
ENDED_BY = {"p": BLOCK | ASIDE, "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr", "tbody", "tfoot", "thead")), "td": frozenset(("td", "th", "tr", "tbody", "tfoot")), "th": frozenset(("td", "th", "tr", "tbody", "tfoot")), "option": frozenset(("option",))}


class Line:
    __slots__ = ("aside", "linked", "notices", "region", "text")

    def __init__(self, text: str, linked: int, aside: bool, region: int, notices: tuple[int, ...]):
        self.text, self.linked, self.aside, self.region, self.notices = text, linked, aside, region, notices

    @property
    def weight(self) -> int:
        return 0 if self.aside else max(0, len(self.text) - 2 * self.linked)


def lines(page: str, surge: int = 80) -> list[Line]:
    """The lines of a page; ``region`` numbers the outermost main element, 0 is outside of any.

    A class makes no notice of a block that holds most of the page's text; of
    comments only if the text beside them doesn't reach ``surge``.
    """
    out: list[Line] = []
    open_: list[tuple[str, bool, int, tuple[int, ...]]] = []  # name, aside, region, notices by class
    replies: list[bool] = []  # of each notice
    opened: Counter[str] = Counter()
    text: list[str] = []
    linked, regions, at, n, links = 0, 0, 0, len(page), 0

    def state() -> tuple[bool, int, tuple[int, ...]]:
        return open_[-1][1:] if open_ else (False, 0, ())

    def end_line() -> None:
        nonlocal linked
        t = " ".join("".join(text).split())
        if t:
            out.append(Line(t, linked, *state()))
        text.clear()
        linked = 0

    def put(s: str) -> None:
        nonlocal linked
        if s:
            s = entities.unescape(s)
            text.append(s)
            if links:
                linked += len(s)

    def close(k: int) -> None:
        nonlocal links
        for x, *_ in open_[k:]:
            opened[x] -= 1
            links -= x == "a"
        del open_[k:]

    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            put(page[at:])
            break
        put(page[at:m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            if m[1]:
                put(m[1])
            continue
        breaks = name in BLOCK or name in ASIDE
        if m[2]:
            k = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == name), -1) if opened[name] else -1
            if breaks:
                end_line()
            if k >= 0 and (breaks or all(x[0] not in BLOCK and x[0] not in ASIDE for x in open_[k:])):
                close(k)
            continue
        if name == "br":
            text.append(" ")
            continue
        if name in RAW:
            if not m[4].rstrip().endswith("/") or name in ("script", "style", "title", "textarea"):
                e = _RAW_END[name].search(page, at)
                at = e.end() if e else n
            text.append(" " if name in ("select", "textarea") else "")
            continue
        if breaks:
            end_line()
            for k in range(len(open_) - 1, -1, -1) if any(opened[x] for x in ENDED_BY) else ():
                x = open_[k][0]
                if name in ENDED_BY.get(x, ()):
                    close(k)
                    break
                if x in ASIDE or x in MAIN or x in ("table", "ul", "ol", "dl", "div", "section", "td", "th", "blockquote"):
                    break
        if name in VOID or m[4].rstrip().endswith("/"):
            continue
        aside, region, notices = state()
        if name in MAIN and not aside and not region:
            regions += 1
            region = regions
        if not aside:
            aside = name in ASIDE and not (name == "header" and region) or name not in ("html", "body") and bool(m[4].strip()) and _hidden(m[4])
            if not aside and name not in MAIN and name not in ("html", "body") and m[4].strip() and (marks := _notice(m[4])):
                replies.append(any(map(REPLY.search, marks)))
                notices = (*notices, len(replies) - 1)
        open_.append((name, aside, region, notices))
        opened[name] += 1
        links += name == "a"
    end_line()
    if replies:
        held, total = [0] * len(replies), 0
        for x in out:
            total += x.weight
            for i in x.notices:
                held[i] += x.weight
        void = {i for i, w in enumerate(held) if 2 * w > total and not (replies[i] and total - w >= surge)}
        for x in out:
            x.aside = x.aside or not void.issuperset(x.notices)
    return out


def _hidden(attrs: str) -> bool:
    for k, a, b, c in _ATTR.findall(attrs):
        k, v = k.lower(), a or b or c
        if k == "hidden" or k == "aria-hidden" and v.lower() == "true" or k == "style" and re.search(r"display\s*:\s*none", v, re.I):
            return True
    return False


def _notice(attrs: str) -> list[str]:
    """The class, id and role that mark a notice."""
    marks = [HAS.sub(" ", a or b or c) for k, a, b, c in _ATTR.findall(attrs) if k.lower() in ("class", "id", "role")]
    return [v for v in marks if NOTICE.search(v)]


def main_text(page: str | None, window: int = 3, surge: int = 80) -> str:
    """The lines of the marked regions, or else those between the surges and the dives of the window sums.

    ``window`` lines are summed; a run begins where the sum reaches ``surge``
    characters and ends where it falls to a line without text. Every run is
    kept; a page that never surges keeps its heaviest window.
    """
    own = [x for x in lines(page or "", surge) if not x.aside]
    if any(x.region for x in own):
        return "\n".join(x.text for x in own if x.region)
    weight = [x.weight for x in own]
    if not any(weight):
        return ""
    sums = [sum(weight[i:i + window]) for i in range(len(weight))]
    # runs of lines whose window holds text, begun by a surge
    runs, k = [], 0
    least = min(surge, max(sums))
    while k < len(sums):
        if sums[k] < least or not weight[k]:
            k += 1
            continue
        a = k
        while a and weight[a - 1]:
            a -= 1
        b = k
        while b < len(sums) and sums[b]:
            b += 1
        runs.append((a, b))
        k = b
    if least < surge:
        runs = [max(runs, key=lambda r: sum(weight[r[0]:r[1]]))]
    return "\n".join(x.text for a, b in runs for x in own[a:b])


def _texts(window: int, surge: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            step = 500
            for k in range(0, b.num_rows, step):
                c = b.slice(k, step)
                texts = [main_text(x.as_py(), window, surge) for x in c.column(2)]
                yield pa.RecordBatch.from_arrays([c.column(0), c.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
    return run


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", window: int = 3, surge: int = 80) -> DataFrame:
    """``page_id, url, text, n_chars`` (code points) of every page.

    A null page counts as empty and gives the empty text; ids and urls may be
    null; repeated rows each get a row; other columns are ignored.
    """
    d = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), text_of(pages[html_col]).alias("html"))
    return d.mapInArrow(_texts(window, surge), "page_id long, url string, text string, n_chars long")
