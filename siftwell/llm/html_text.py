"""Main text of web pages by tag-path ratios.

A page is read as blocks of text, each under the path of block tags from the
root. Per path, text length and punctuation are summed over the page and
divided by the path's blocks; both series are smoothed over the paths in page
order and fused. Paths above a share of the page's spread are content, beneath
the element that holds them; an article element with such a path is content as a
whole. Elsewhere a list or table counts as one block, so short items and cells
stand or fall together, and a heading goes with the block after it.
What is marked as menu, header, footer, aside, notice, advert, form, comment or
code never enters. A page is handled alone, so there is no shuffle.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import shared

_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_TAG_ENDS = re.compile(r"[>\"']")
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?。，、；：！？¿¡…]")

# fixed values: elements of HTML by what they hold
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_NEVER = {
    "head", "nav", "header", "footer", "aside", "form", "button", "select", "option", "datalist", "fieldset", "dialog", "menu", "noscript", "template",
    "svg", "math", "canvas", "object", "audio", "video", "script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp", "label",
}
_BLOCK = {
    "html", "body", "article", "main", "section", "div", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "blockquote", "pre",
    "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "figure", "figcaption", "address", "hr", "details", "summary", "center", "hgroup",
} | _NEVER
_CLOSES_P = _BLOCK - {"html", "body", "td", "th", "tr", "thead", "tbody", "tfoot", "caption", "head", "option", "label", "button", "select", "script", "style", "template", "noscript", "svg", "math", "title", "textarea"}
_SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
_CONTENT = {"article", "main"}
#: Words in class, id or role that mark what is not the article.
_MARKS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies", "consent",
    "gdpr", "notice", "notification", "alert", "modal", "popup", "overlay", "newsletter", "subscribe", "subscription", "paywall", "signup", "login", "menu", "nav", "navbar",
    "navigation", "breadcrumb", "breadcrumbs", "pagination", "pager", "header", "masthead", "footer", "sidebar", "aside", "complementary", "contentinfo", "widget", "related",
    "recommended", "recommendations", "share", "sharing", "social", "comment", "comments", "disqus", "replies", "respond", "toolbar", "search", "skip", "hidden", "legal", "copyright",
    "disclaimer",
}
_SMOOTH = np.array([0.25, 0.5, 0.25])
_SHARE = 0.5  #: of the spread of the fused ratios
#: Elements that hold a part of an article.
_HOLDERS = {"div", "section", "ul", "ol", "dl", "table", "details", "figure", "span"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_HOLD_ITEMS = {"table", "ul", "ol", "dl"}
_ITEMS = _HOLD_ITEMS | {"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "li", "dt", "dd"}


#: A class that starts so says that something is missing, or is about the whole.
_ABOUT = {"no", "not", "without", "has", "have", "with"}


#: Marks that a part of an article may bear in a name of its own, like ``Legal history`` or ``share-prices``.
_DOUBTFUL = {"legal", "notice", "notification", "alert", "search", "social", "share", "skip", "hidden", "copyright", "disclaimer", "header"}
#: Words that say how an element is laid out, not what it holds.
_LAYOUT = {
    "area", "bar", "block", "bottom", "box", "button", "buttons", "col", "container", "content", "form", "icon", "icons", "inline", "inner", "item", "items", "js", "large", "left",
    "lg", "link", "links", "list", "md", "outer", "panel", "post", "posts", "right", "row", "section", "sm", "slot", "small", "sticky", "stories", "thread", "top", "unit", "wrap", "wrapper",
}


def _marked(tag: str, attributes: str, inside: bool) -> bool:
    """Whether class or role holds a word of _MARKS, or id is one.

    ``inside`` an article, only elements that hold others count, headers aside,
    and only a name that is nothing but marks and words of layout; with a
    doubtful mark, all names of the element must be so.
    """
    if inside and tag not in _HOLDERS:
        return False
    for m in _NAMED.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "id":
            if value.lower() in _MARKS and not (inside and value.lower() in _DOUBTFUL):
                return True
            continue
        names = [[w for w in re.split(r"[^a-z]+", name) if w] for name in re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower().split()]
        names = [words for words in names if words]
        if not inside:
            if any(words[0] not in _ABOUT and _MARKS.intersection(words) for words in names):
                return True
            continue
        plain = [all(w in _MARKS or w in _LAYOUT for w in words) for words in names]
        marks = [_MARKS.intersection(words) - {"header"} if p else set() for words, p in zip(names, plain, strict=True)]
        if any(x - _DOUBTFUL for x in marks) or (any(marks) and all(plain)):
            return True
    return False


def _unseen(attributes: str) -> bool:
    return bool(re.search(r"(?:^|\s)hidden(?:\s|$|=)|aria-hidden\s*=\s*.?true|display\s*:\s*none", attributes))


class Paths:
    """The tag paths of a page, each its parent and one more tag, in the order in which they came up.

    All that a path takes from its ancestors is set down with it, so a deep path costs no more than a short one.
    """

    def __init__(self) -> None:
        self.known: dict[tuple[int, str], int] = {}
        self.parent, self.tag = [-1], [""]
        self.article = [-1]  #: the innermost article or main element, itself included
        self.items = [-1]  #: the list or table whose items end the path
        self.unit = [0]  #: the path that a block's ratio is taken under

    def below(self, parent: int, tag: str) -> int:
        at = self.known.get((parent, tag))
        if at is None:
            at = self.known[parent, tag] = len(self.tag)
            self.parent.append(parent)
            self.tag.append(tag)
            self.article.append(at if tag in _CONTENT else self.article[parent])
            held = self.items[parent] if tag in _ITEMS else -1
            self.items.append(at if held < 0 and tag in _HOLD_ITEMS else held)
            self.unit.append(self.items[at] if self.items[at] >= 0 else at)
        return at


class _Open:
    """The open elements, with what is asked about them kept by name."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.paths: list[int] = [0]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []  # places of block elements
        self.left_out = -1  # place of the outermost element that is left out

    def last(self, tag: str) -> int:
        found = self.places.get(tag)
        return found[-1] if found else -1

    def push(self, tag: str, path: int, left_out: bool) -> None:
        at = len(self.names)
        self.names.append(tag)
        self.paths.append(path)
        self.places.setdefault(tag, []).append(at)
        if tag in _BLOCK:
            self.blocks.append(at)
        if left_out and self.left_out < 0:
            self.left_out = at

    def pop(self) -> None:
        tag = self.names.pop()
        self.paths.pop()
        at = len(self.names)
        if tag:
            self.places[tag].pop()
        if self.blocks and self.blocks[-1] == at:
            self.blocks.pop()
        if self.left_out == at:
            self.left_out = -1

    def block_above(self, at: int) -> bool:
        return bool(self.blocks) and self.blocks[-1] >= at


def _tag_end(page: str, at: int, aware: bool) -> int:
    """Where the tag that starts before ``at`` ends, past its ``>``; -1 if nowhere. ``aware``: not in a quoted value."""
    if not aware:
        return page.find(">", at) + 1 or -1
    while m := _TAG_ENDS.search(page, at):
        if m[0] == ">":
            return m.end()
        close = page.find(m[0], m.end())
        if close < 0:
            return -1
        at = close + 1
    return -1


def blocks(page: str, marks: bool = True) -> tuple[list[tuple[int, str, int]], Paths]:
    """(path, text, characters of it in links) in page order, and the paths. ``marks``: whether marked elements are left out.

    Time is in proportion to the page, however deep or broken it is. After a
    quoted value that never ends, any ``>`` ends a tag.
    """
    out: list[tuple[int, str, int]] = []
    paths, stack = Paths(), _Open()
    parts: list[str] = []
    links = 0

    def end_block() -> None:
        nonlocal links
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((stack.paths[-1], text, links))
            parts.clear()
        links = 0

    def add(text: str) -> None:
        nonlocal links
        if text and stack.left_out < 0:
            text = html.unescape(text)
            parts.append(text)
            if stack.last("a") >= 0:
                links += len(" ".join(text.split()))

    def pop_to(i: int) -> None:
        if stack.block_above(i):
            end_block()
        while len(stack.names) > i:
            stack.pop()

    tags: dict[str, tuple[list[int], list[int]]] = {}

    def closes(tag: str, at: int) -> bool:
        """Whether more elements of the name end after ``at`` than begin."""
        if tag not in tags:
            found = [(m.start(), bool(m[1])) for m in re.finditer(rf"<(/?){re.escape(tag)}(?=[\s/>])", page, re.I)] if tag else []
            tags[tag] = [i for i, end in found if not end], [i for i, end in found if end]
        begin, end = (len(x) - bisect.bisect_left(x, at) for x in tags[tag])
        return end > begin

    def in_article() -> bool:
        return stack.last("article") >= 0 or stack.last("main") >= 0

    seen = False  # an article or main element
    at, start, n, aware = 0, 0, len(page), True  # text since ``start`` is not added yet
    while at < n:
        at = page.find("<", at)
        if at < 0:
            break
        if page.startswith("<!--", at):
            add(page[start:at])
            start = at = page.find("-->", at) + 3 if page.find("-->", at) >= 0 else n
            continue
        if page.startswith(("<!", "<?"), at):
            add(page[start:at])
            start = at = page.find(">", at) + 1 or n
            continue
        m = _TAG.match(page, at)
        if not m:
            at += 1
            continue
        end = _tag_end(page, m.end(), aware)
        if end < 0 and aware:
            aware = False
            end = _tag_end(page, m.end(), aware)
        if end < 0:  # no tag ends any more: the last one is cut off
            add(page[start:at])
            start = n
            break
        add(page[start:at])
        tag, attributes, closing = m[1].lower(), page[m.end() : end - 1], page[at + 1] == "/"
        start = at = end
        if closing:
            found = stack.last(tag)
            if found >= 0 and (tag in _BLOCK or not stack.block_above(found)):
                pop_to(found)
            elif found >= 0:  # an inline element closed across blocks
                stack.names[found] = ""
                stack.places[tag].pop()
            elif tag == "p":
                end_block()
            continue
        if tag in _VOID:
            if tag == "br":
                add(" ")
            elif tag == "hr":
                end_block()
            continue
        if tag in _CONTENT:
            if stack.left_out >= 0 and not (seen and closes(stack.names[stack.left_out], at)):  # a menu or the like that was never closed, or a frame of the whole
                pop_to(stack.left_out)
            seen = seen or stack.left_out < 0
        left_out = stack.left_out >= 0
        if tag in _CLOSES_P and not left_out and stack.last("p") >= 0:
            pop_to(stack.last("p"))
        if tag in _SIBLINGS:
            same, stop = (max(stack.last(x) for x in names) for names in _SIBLINGS[tag])
            if same > stop:
                pop_to(same)
        if tag in _BLOCK:
            end_block()
        if tag in _RAW:  # no markup inside
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            start = at = close.end() if close else n
            continue
        if attributes.rstrip().endswith("/") and tag not in _BLOCK:
            continue
        never = tag in _NEVER and not (tag == "header" and in_article() and not left_out)
        unwanted = never or (tag not in _CONTENT | {"html", "body"} and (_unseen(attributes) or (marks and _marked(tag, attributes, in_article()))))
        stack.push(tag, paths.below(stack.paths[-1], tag) if tag in _BLOCK else stack.paths[-1], unwanted)
    add(page[start:])
    end_block()
    return out, paths


def content_blocks(found: list[tuple[int, str, int]], paths: Paths) -> list[bool]:
    """Which blocks stay: those of paths whose fused ratio of length and punctuation is high, and their headings."""
    units = [paths.unit[p] for p, _, _ in found]
    order = list(dict.fromkeys(units))
    at = {p: i for i, p in enumerate(order)}
    length, marks, count, linked = (np.zeros(len(order)) for _ in range(4))
    before = None
    for (p, text, links), unit in zip(found, units, strict=True):
        i = at[unit]
        length[i] += len(text)
        marks[i] += len(_PUNCTUATION.findall(text))
        count[i] += p == unit or unit != before
        linked[i] += links
        before = unit
    prose = 1 - np.minimum(linked / np.maximum(length, 1), 1)
    article = [paths.article[p] for p in order]
    telling = np.where([x >= 0 for x in article], 1.0, prose)  # links in an article are its own
    ratios = [np.convolve(np.pad(x / count * telling, 1, mode="edge"), _SMOOTH, "valid") for x in (length, marks + 1)]
    fused = np.sqrt(ratios[0] * ratios[1])
    rich = fused >= _SHARE * max(float(fused.std()), float(fused.max()) / 4)
    good = rich & (telling > 0.4)
    if not good.any():
        return [False] * len(found)
    # the element that holds the best path; article elements, or else main ones, where there are any
    names = {paths.tag[x] for x in article if x >= 0}
    inside, kind = bool(names), "article" if "article" in names else "main"
    if inside:
        held = set()
        for i, x in enumerate(article):
            while good[i] and x >= 0 and x not in held:
                held.add(x)
                x = paths.article[paths.parent[x]]
    else:
        best = order[int(np.argmax(np.where(good, length * prose, -1)))]
        held = {paths.parent[best] if best and paths.tag[best] not in ("div", "body", "section") else best}
    # all of an article whose paths are rich is content, however short its lines are
    whole = [False] * len(paths.tag)
    for p in range(1, len(paths.tag)):
        whole[p] = (p in held and paths.tag[p] == kind) or whole[paths.parent[p]]
    within = [False] * len(paths.tag)
    for p in range(len(paths.tag)):  # parents come before what is below them
        within[p] = p in held or (p > 0 and within[paths.parent[p]])
    keep = [whole[p] or (bool(good[at[u]]) and (within[u] or not inside)) for (p, _, _), u in zip(found, units, strict=True)]
    heading = [paths.tag[u] in _HEADINGS and not whole[u] for u in units]
    # from the end: a heading goes with what comes after it; a page of headings alone is its own text
    after, alone = False, not any(k and not h for k, h in zip(keep, heading, strict=True))
    for j in range(len(keep) - 1, -1, -1):
        if not heading[j]:
            after = keep[j]
        elif not alone:
            keep[j] = after and (within[units[j]] or keep[j])
    return keep


def _kept(found: list[tuple[int, str, int]], paths: Paths) -> str:
    return " ".join(text for (_, text, _), k in zip(found, content_blocks(found, paths), strict=True) if k) if found else ""


def main_text(page: str | None) -> str:
    found, paths = blocks(page or "")
    text = _kept(found, paths)
    if page and not any(paths.article[p] >= 0 for p, _, _ in found) and _NAMED.search(page):
        # without an article, a marked element that holds nearly all of the text is the text
        whole = _kept(*blocks(page, False))
        if len(text) < 0.2 * len(whole):
            return whole
    return text


def extract(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the column ``out``: the main text of ``html_col``.

    Every row stays. Null and empty pages, and pages without text, give an empty
    text; a page without tags is one block. White space in a block is one space,
    blocks are joined by one. A column named like ``out`` is replaced.
    """
    names = [c for c in pages.columns if c != out]
    shared.small_batches(pages.sparkSession)
    frame = pages.select(*[f"`{c}`" for c in names])
    k = names.index(html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                texts = [main_text(x.as_py()) for x in part.column(k)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*names, out])

    return frame.mapInArrow(shared.tidy(run), shared.widened(frame, f"{out} string"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(shared.table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.selectExpr("page_id", "url", "text", "cast(length(text) AS long) AS n_chars")
