"""Main text of web pages by line-block distribution (operator 8).

Markup is stripped: scripts, styles and comments go whole, block elements break lines, everything else leaves its text. Each line has
a length; lines in elements that announce themselves as menus, headers, footers, sidebars, notices, adverts, forms or reader
comments have length 0, and where a page marks its main text (``article``, ``main``), so have lines outside it, unless there is more text
outside than inside: then the marked block is a teaser or the like, and the page counts as one without marks.

Lengths are summed over windows of WINDOW consecutive lines. A surge point is a line with text where the window's sum rises over a threshold; the dive point
after it is where a whole window is empty. Text lines between them are kept. With marked main text the threshold is one
character, since what remains is main text; without, it is THRESHOLD, and lines that are mostly links have length 0 too.

Pages are independent: nothing is shuffled.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionvol.llm import kernels as K
from sessionvol.llm.rows import ship

WINDOW = 3
THRESHOLD = 80

#: Fixed values of HTML: elements whose content is no text, that break lines, that have no content.
HIDDEN = {"script", "style", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "textarea", "select", "title", "head", "audio", "video"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main",
    "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that are never main text; header only outside it.
ASIDE = {"nav", "footer", "aside", "form", "menu", "button", "dialog", "search"}
MAIN = {"article", "main"}
#: Words of class, id or role that mark such a block.
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|promotion|banner|nav|navbar|navigation|menu|breadcrumb|breadcrumbs"
    r"|sidebar|side[_-]?(?:bar|nav|menu|panel|col|column)|aside|footer|masthead|cookie|cookies|consent|notice|popup|modal|newsletter|subscribe|signup|login|share|sharing|social"
    r"|related[_-](?:posts|articles|links|stories|content|items|reading|topics|pages)|recommended|comment|comments|disqus|reply|replies|respond|discussion|complementary|contentinfo|search|toolbar|pagination|pager|skip)(?:$|[\s_-])"
)
#: Such words that mark a block only if they are a whole class, id or role: "side-by-side" and "related-work" are text.
MARKED_ALONE = {"side", "related"}
_TOKEN = re.compile(r"<(?:!--(.*?)(?:--!?>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[!?/][^>]*>)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_SPACE = re.compile(r"\s+")
_RAW_END = {x: re.compile(rf"</{x}\s*>", re.I) for x in ("script", "style", "textarea", "title", "noscript", "iframe", "template")}


def _aside(name: str, attributes: str, in_main: bool) -> bool:
    if name in ASIDE or (name == "header" and not in_main):
        return True
    if not attributes or name in ("html", "body"):
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        value, key = "".join(values).lower(), key.lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (
            key in ("class", "id", "role") and (MARKED.search(value) or not MARKED_ALONE.isdisjoint(value.split()))
        ):
            return True
    return False


def lines(page: str) -> tuple[list[tuple[str, int, int]], bool]:
    """Lines as (text, length for the distribution, characters in links), and whether most text is in marked main text."""
    out: list[tuple[str, int, int, bool]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, opens an aside, opens main text
    asides = mains = links = linked = 0
    at, end, marked = 0, len(page), False

    def close():
        nonlocal linked
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            out.append((text, 0 if asides else len(text), linked, mains > 0))
        parts.clear()
        linked = 0

    while at < end:
        m = _TOKEN.search(page, at)
        text = page[at : m.start() if m else end]
        if text and not asides:
            parts.append(text)
            if links:
                linked += len(text)
        if not m:
            break
        at = m.end()
        closing, name = m[2], m[3]
        if not name:
            continue
        name = name.lower()
        if name in HIDDEN and name in _RAW_END and not closing:
            found = _RAW_END[name].search(page, at)
            at = found.end() if found else end
            continue
        if name in BLOCKS or name == "br":
            if name == "br":
                parts.append(" ")
            else:
                close()
        if closing:
            if name == "a":
                links = max(0, links - 1)
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    for _, aside, main in stack[k:]:
                        asides -= aside
                        mains -= main
                    del stack[k:]
                    break
        elif name == "a":
            links += 1
        elif name not in VOID and not m[4].rstrip().endswith("/") and name != "p":
            aside = name in HIDDEN - {"head"} or _aside(name, m[4], mains > 0)
            main = not asides and not aside and (name in MAIN or 'role="main"' in m[4])
            marked |= main
            asides, mains = asides + aside, mains + main
            if aside or main or name in BLOCKS:
                stack.append((name, aside, main))
    close()
    plain = [(t, 0 if 2 * k > n else n, k) for t, n, k, main in out]
    inside = sum(n for _, n, _, main in out if main)
    outside = sum(n for (_, n, _), (*_, main) in zip(plain, out) if not main)
    if marked and inside >= outside:
        return [(t, n if main else 0, k) for t, n, k, main in out], True
    return plain, False


def main_text(page: str, window: int = WINDOW, threshold: int = THRESHOLD) -> str:
    found, marked = lines(page)
    lengths = [n for _, n, _ in found]
    least = 1 if marked else threshold
    sums = [sum(lengths[i : i + window]) for i in range(len(lengths))]
    kept, inside = [], False
    for i, total in enumerate(sums):
        if not inside and lengths[i] and total >= least:
            inside = True  # surge
        elif inside and total == 0:
            inside = False  # dive
        if inside and lengths[i]:
            kept.append(found[i][0])
    return "\n\n".join(kept)


def _extract(window: int, threshold: int):
    def run(batches):
        for batch in batches:
            texts = [main_text(h or "", window, threshold) for h in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return K.lean(run)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", window: int = WINDOW, threshold: int = THRESHOLD
) -> DataFrame:
    """Per page: page_id, url, text (blocks in page order, an empty line between), n_chars.

    White space in a block is one space; character references are decoded. A NULL or empty page, and one without main text, has the text ''.
    """
    ship(pages.sparkSession)
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").alias("html")
    )
    return rows.mapInArrow(_extract(window, threshold), "page_id long, url string, text string, n_chars long")
