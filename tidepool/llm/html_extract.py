"""Operator 10: main text of web pages by tag-path ratios.

A page is read into blocks (text between block-level tags), each with its tag path from
the root, inline tags left out.  Per path: characters outside links and punctuation marks
per block.  The two ratios are smoothed over neighbouring blocks in page order and fused
(product); paths whose fused mean is above a threshold are content.  The content node is
the lowest container above all of them, or the ``article`` or ``main`` elements if those
hold most of their text.  All blocks below it are the result, short ones and links too.
Only where no element but the page itself holds all content, paths that are mostly links
go, headings aside, if they lie before the first content block or after the last.

Elements that are page furniture by their tag, role, class or id (menus, headers and
footers, side bars, notices, adverts, forms, reader comments) weigh nothing.  A class or id
marks furniture only if the elements that carry it hold a minor part of the page's text:
half at most if a hint is a part of the name (``sidebar-right`` may be a layout), three
quarters at most if it is the whole name.

Defined results: a null or empty html, or a page without content, gives an empty text;
pages of any length are read whole, unclosed tags included; repeated rows give repeated
rows; an empty table gives an empty table; ids may be null; only the named columns are
read, so further columns may have any name.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

RAW = "script style template noscript textarea title iframe annotation annotation-xml xmp noembed noframes".split()
# Dropped whole where they are closed before the next of their kind; else they end with their parent, as any element.
SOFT = "svg object select button".split()
VOID = set("br hr img input meta link area base col embed param source track wbr".split())
BLOCK = set("""html head body p div section article main header footer nav aside ul ol li dl dt dd menu table caption
thead tbody tfoot tr td th blockquote pre figure figcaption form fieldset legend h1 h2 h3 h4 h5 h6 hr address details
summary dialog center hgroup search""".split())
FURNITURE = set("head nav footer aside menu dialog search".split()) | set(SOFT)
FORMS = set("form fieldset".split())       # furniture, unless the page stands in one
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
HINT = re.compile(r"""(?:^|[\s_-])(?<!\bhas[_-])(?<!\bwith[_-])(?<!\bno[_-])(?<!\bby[_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alerts?|popup|modal|newsletter|
subscribe|subscription|nav|navbar|navigation|menu|breadcrumbs?|sidebar|side(?![_-]by[_-])|widget|footer|masthead|topbar|toolbar|site-?header|
page-?header|comments?|commentlist|comment-\w+|reply|replies|respond|responses|disqus|related|recommended|share|sharing|social|pagination|pager|
login|signup|search)(?=$|[\s_-])""".replace("\n", ""), re.I)
READERS = re.compile(r"(?:user-?|reader-?|the-?)?comments?(?:[_-]?(?:list|section|area|body|content|wrap|wrapper|thread|block|box|container))?|"
                     r"commentlist|replies|responses|respond|disqus(?:_thread)?", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|style\s*=\s*(?:"[^"]*|'[^']*)display\s*:\s*none""", re.I)
QUOTED = re.compile(r"""(?<!\bstyle=)(?:"[^"]*"|'[^']*')""", re.I)
COPYRIGHT = re.compile(r"(?:copyright\b|©|\(c\))(?=.*(?:\d{4}|rights reserved)).{0,200}", re.I)
# Elements that are parts of a text and never the node that holds it.
PARTS = set("""p ul ol li dl dt dd menu table caption thead tbody tfoot tr td th blockquote pre xmp figure figcaption legend
h1 h2 h3 h4 h5 h6 hr address summary hgroup""".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
PAGE = ("#", "html", "body")
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"})}
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<svg(?=[\s/])(?:[^>\"']|\"[^\"]*\"|'[^']*')*?/>|<(?P<soft>" + "|".join(SOFT) + r")(?=[\s/>])[^>]*>(?:(?!<(?P=soft)[\s/>]).)*?</(?P=soft)\s*>"
                 r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*?>(?P<inside>.*?)(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*>"
                 r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)>", re.S | re.I)
ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PUNCTUATION = re.compile(r"[.,;:!?、。，…]")
SMOOTH = np.array([1, 2, 4, 2, 1]) / 10


def _name(step: str) -> str:
    return step.split(".")[0]


def _element(tag: str, attrs: str, stack: list, nth: int) -> tuple[str, bool, tuple]:
    """The path step of a start tag, whether its tag or role is page furniture or it is hidden, and the names
    that hint at it; a form hints by itself (as the ``nth`` element)."""
    named = {k.lower(): a or b or c for k, a, b, c in ATTR.findall(attrs)} if "=" in attrs else {}
    furniture = tag in FURNITURE or named.get("role", "").lower() in ROLES
    if tag not in ("html", "body") and ("hidden" in attrs.lower() or "none" in attrs.lower()):
        furniture |= bool(HIDDEN.search(QUOTED.sub("", attrs)))
    if tag == "header":      # of the page, unless an article has its own
        furniture |= not any(_name(step) in ("article", "main") for step, _, _ in stack)
    hints = ()
    if tag not in ("html", "body", "article", "main"):
        hints = tuple(x for k in ("class", "id") for x in named.get(k, "").split() if HINT.search(x))
        hints += (f"<{tag} {nth}>",) if tag in FORMS else ()
    return tag + ("." + named["class"] if named.get("class") else ""), furniture, hints


def blocks(page: str) -> list[tuple[tuple, bool, tuple, str, int]]:
    """(path, furniture by tag or role, hinting names of each element above, text, characters in links) of each
    block with text, in page order."""
    out, stack, pieces = [], [], []       # stack: (step, furniture from here down, hints from here up)
    links = at = 0
    in_link = False

    def flush():
        nonlocal pieces, links
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                out.append((("#", *(s for s, _, _ in stack)), *(stack[-1][1:] if stack else (False, ())), text, min(links, len(text))))
        pieces, links = [], 0

    def close(tags: set, stop: set = frozenset()) -> None:
        for i in range(len(stack) - 1, -1, -1):
            name = _name(stack[i][0])
            if name in tags:
                del stack[i:]
                return
            if name in stop:
                return

    def push(tag: str, attrs: str) -> None:
        step, furniture, hints = _element(tag, attrs, stack, at)
        _, within, above = stack[-1] if stack else ("", False, ())
        stack.append((step, furniture or within, (*above, hints) if hints else above))

    for m in TAG.finditer(page):
        if m.start() > at:
            piece = page[at:m.start()]
            pieces.append(piece)
            links += len(piece) if in_link else 0
        at = m.end()
        tag = (m["tag"] or "").lower()
        if m["raw"] and m["raw"].lower() == "xmp":      # shown as it is
            flush()
            push("xmp", "")
            pieces.append(html.escape(m["inside"]))
            flush()
            stack.pop()
        if not tag:
            continue
        if tag == "a":
            in_link = not m["end"]
        elif tag == "br":
            pieces.append(" ")
        elif tag in BLOCK or tag in SOFT:
            flush()
            in_link = False
            if m["end"]:
                close({tag})
            elif tag not in VOID:
                if tag in SOFT:
                    close({tag})
                elif stack and _name(stack[-1][0]) == "p":
                    stack.pop()
                if tag in CLOSES:
                    close(*CLOSES[tag])
                push(tag, m["attrs"] or "")
    if at < len(page):
        pieces.append(page[at:])
    flush()
    return out


def _usable(found: list) -> list[bool]:
    """For each block whether no element above it is page furniture."""
    held, total = defaultdict(int), 0
    for _, furniture, hints, text, link in found:
        if not furniture:
            total += len(text) - link
            for name in {x for names in hints for x in names}:
                held[name] += len(text) - link
    whole = {name: name[0] == "<" or bool(HINT.fullmatch(name) or READERS.fullmatch(name)) for name in held}
    layout = {name for name, n in held.items() if n > (0.75 if whole[name] else 0.5) * total}
    readers = {name for name in held if READERS.fullmatch(name)}
    # reader comments go at any size, if anything else of some length is left
    others = sum(len(text) - link for _, furniture, hints, text, link in found
                 if not furniture and not any(x in readers or whole[x] and x not in layout for names in hints for x in names))
    if others >= 80:
        layout -= readers

    def marked(names: tuple) -> bool:
        return any(whole[x] and x not in layout for x in names) or not any(x in layout for x in names)

    return [not furniture and not any(map(marked, hints)) for _, furniture, hints, _, _ in found]


def main_text(page: str, threshold: float = 0.25) -> str:
    found = blocks(page)
    usable = _usable(found)
    if not any(usable):
        return ""
    plain = np.array([len(text) - link if ok else 0 for (*_, text, link), ok in zip(found, usable)], float)
    marks = np.array([len(PUNCTUATION.findall(text)) if ok else 0 for (*_, text, _), ok in zip(found, usable)], float)
    paths = defaultdict(list)
    for i, (path, *_) in enumerate(found):
        if usable[i]:
            paths[path].append(i)
    text_ratio, mark_ratio = np.zeros(len(found)), np.zeros(len(found))
    for at in paths.values():
        text_ratio[at], mark_ratio[at] = plain[at].mean(), marks[at].mean()
    smooth = lambda x: np.convolve(np.pad(x, 2, mode="edge"), SMOOTH, "valid")
    fused = smooth(text_ratio) * (1 + smooth(mark_ratio))
    limit = threshold * np.average(fused, weights=plain) if plain.any() else 0
    content = [path for path, at in paths.items() if fused[at].mean() >= limit]
    mass = defaultdict(float)
    for path in content:
        for depth in range(1, len(path) + 1):
            mass[path[:depth]] += plain[paths[path]].sum()
    if not mass:
        return ""
    nodes = set()
    named = [p for p in mass if _name(p[-1]) in ("article", "main")]
    if named:       # the outermost of the kind that holds most text
        node = min(named, key=lambda p: (-mass[p], len(p)))
        nodes = {p for p in named if len(p) == len(node) and _name(p[-1]) == _name(node[-1])}
    if 2 * sum(mass[p] for p in nodes) <= mass["#",]:
        node = content[0][:next((i for i, steps in enumerate(zip(*content)) if len(set(steps)) > 1), min(map(len, content)))]
        while _name(node[-1]) in PARTS:
            node = node[:-1]
        nodes = {node}
    menus, first, last = set(), 0, len(found)
    if any(_name(n[-1]) in PAGE for n in nodes):
        menus = {path for path, at in paths.items() if _name(path[-1]) not in HEADINGS
                 and 2 * sum(found[i][4] for i in at) > sum(len(found[i][3]) for i in at)}
        first, last = min(paths[p][0] for p in content), max(paths[p][-1] for p in content)
    kept = [text for i, (path, _, _, text, _) in enumerate(found)
            if usable[i] and any(path[:len(n)] == n for n in nodes) and (first <= i <= last or path not in menus)]
    while kept and COPYRIGHT.fullmatch(kept[-1]):
        kept.pop()
    return "\n".join(kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages = batch.column(batch.num_columns - 1)
        texts = pa.array((main_text((p.as_py() or b"").decode("utf-8", "replace")) for p in pages), pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], [*batch.schema.names[:-1], "text"])


def extract(pages: DataFrame, keep: list, html_col: str = "html") -> DataFrame:
    """The columns ``keep`` of every page with its main text, column ``text``."""
    rows = pages.select(*keep, F.col(f"`{html_col}`").cast("binary").alias("html"))
    return rows.mapInArrow(_extract, StructType([*rows.schema.fields[:-1], StructField("text", StringType())]))


def extract_digest(pages: DataFrame) -> DataFrame:
    return extract(pages, ["page_id", "url"]).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
