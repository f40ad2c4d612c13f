"""Main text of web pages by tag-path ratios.

Every text node has a path, the tags from the root down to it. For each path of a page the text length and the number of punctuation
marks are summed and divided by the path's node count; the two ratios are smoothed over paths in page order, fused by their
product, and a threshold on the fused ratio selects the content paths. A page's
content is what lies below the containers of the selected paths, so that a short paragraph or heading beside long ones stays.
Paths through ``article`` or ``main`` weigh more, up to ``BODY_WEIGHT`` times as much if these hold all of the text. Subtrees that markup itself declares to be something else (navigation,
footers, forms, adverts, comments ...) have paths of their own, marked with an asterisk; these are content only if their ratios clearly
say so: ``CLEAR`` times the best of the other paths, with more text than all of them and ``CLEAR_TEXT`` characters. What isn't shown or isn't text is left out.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from secdata.llm.text import pieces

# Element names of HTML by role, and words in class, id and role attributes.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
NO_CONTENT = {"audio", "button", "canvas", "embed", "head", "iframe", "map", "math", "object", "option", "select", "svg", "template", "textarea", "video"}
SIDE_TAGS = {"aside", "dialog", "footer", "form", "menu", "nav", "noscript"}
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th", "tbody"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
SCOPE = {"ul", "ol", "dl", "table", "div", "article", "section", "main", "body", "blockquote", "td", "th"}
SIDE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disclaimer", "disqus", "footer", "gdpr", "login", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "overlay", "pagination", "pager", "popup", "promo", "promotion", "recommended", "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "subscription", "teaser", "toolbar", "widget", "widgets"}
SIDE_ROLES = {"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation", "search", "toolbar"}
BODY = {"article", "main"}
LEAST, BLUR, BODY_WEIGHT, CLEAR, CLEAR_TEXT = 0.2, 0.1, 3.0, 2.0, 400
SHOWN, SIDE, OUT = 0, 1, 2
#: Paths name the outermost elements of deeper nesting.
DEEPEST = 256

_OPEN = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*+))")
_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+>""")  # no part can be given back, so one pass decides
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
_SPLIT = re.compile(r"[^a-z]+")  # parts of a class name
_PUNCTUATION = re.compile(r"[.,;:!?…、。，！？]")


def _declared(tag: str, attributes: str, inside_body: bool) -> int:
    """What the markup says of an element: SHOWN, SIDE (shown, but something else than main content) or OUT (not shown, or no text)."""
    if tag in NO_CONTENT:
        return OUT
    said = SIDE if tag in SIDE_TAGS or tag == "header" and not inside_body else SHOWN
    if not attributes or tag in {"html", "body"}:
        return said
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return OUT
        if tag in BODY:
            continue
        if name == "role" and value.strip() in SIDE_ROLES:
            said = SIDE
        if name in {"class", "id"}:  # whole names: each part of one must be a word for something else
            for one in value.split():
                words = set(filter(None, _SPLIT.split(one)))
                if words and words <= (SIDE_WORDS if inside_body else SIDE_WORDS | {"header"}):
                    said = SIDE
    return said


def blocks(page: str) -> Iterator[tuple[tuple[str, ...], tuple[int, ...], str]]:
    """(path, numbers of its elements, raw text) of the blocks of a page. The tags of elements declared to be something else, and of what is in them, end with an asterisk in paths.

    A block ends where an element that isn't inline begins or ends, and at ``br``. A block's path is that of its first text.
    """
    stack: list[tuple[str, int, int]] = []  # (tag, SHOWN, SIDE or OUT, number)
    number = 0
    path: list[tuple[tuple[str, ...], tuple[int, ...]] | None] = [None, None]  # of what is shown, and of what is declared to be something else inside of the same block
    text: list[list[str]] = [[], []]
    at, size = 0, len(page)
    opened: Counter[str] = Counter()
    quotes = True  # until a tag is found that ends only if its quotes are ignored

    def flush():
        made = [(*(p or ((), ())), "".join(t)) for p, t in zip(path, text, strict=True) if t]
        path[:], text[:] = [None, None], [[], []]
        return made

    def cut(depth):
        opened.subtract(e[0] for e in stack[depth:])
        del stack[depth:]

    while at < size:
        found = _OPEN.search(page, at)
        end = found.start() if found else size
        if end > at and not (stack and stack[-1][1] == OUT):
            piece = page[at:end]
            which = int(bool(stack) and stack[-1][1] == SIDE)
            if path[which] is None and piece.strip():
                held = [(f"{t}*" if x else t, n) for t, x, n in stack[:DEEPEST] if t not in INLINE or x]
                path[which] = tuple(t for t, _ in held), tuple(n for _, n in held)
            text[which].append(piece)
        if not found:
            break
        closing, tag = found.group(1), found.group(2)
        if not tag:  # a comment, or a declaration
            comment = found.group().endswith("--")
            at = page.find("-->" if comment else ">", found.end())
            at = size if at < 0 else at + (3 if comment else 1)
            continue
        rest = _REST.match(page, found.end()) if quotes else None
        if rest is None:
            quotes = False
            at = page.find(">", found.end()) + 1
            if not at:  # no tag ends any more
                break
            attributes = page[found.end() : at - 1]
        else:
            at, attributes = rest.end(), rest.group()[:-1]
        tag = tag.lower()
        if tag not in INLINE:
            yield from flush()
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None) if opened[tag] else None
            if depth is not None and (tag not in INLINE or all(e[0] in INLINE for e in stack[depth:])):
                cut(depth)
            continue
        if tag in VOID:
            continue
        if tag in RAW and not attributes.endswith("/"):
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = close.end() if close else size
            continue
        if tag not in INLINE:  # a new block ends an open paragraph, with the inline elements in it
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    cut(i)
                    break
                if stack[i][0] not in INLINE:
                    break
            ends = CLOSES.get(tag)
            if ends:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in ends:
                        cut(i)
                        break
                    if stack[i][0] in SCOPE:
                        break
        if attributes.endswith("/") and tag not in INLINE:
            continue
        above = stack[-1][1] if stack else SHOWN
        number += 1
        stack.append((tag, above if above == OUT else max(above, _declared(tag, attributes, opened["article"] + opened["main"] > 0)), number))
        opened[tag] += 1
    yield from flush()


def _smooth(values: list[float]) -> list[float]:
    """Each value with a part of its neighbours', a part so small that a neighbour of content doesn't pass for content itself."""
    n = len(values)
    return [(1 - 2 * BLUR) * values[i] + BLUR * (values[max(0, i - 1)] + values[min(n - 1, i + 1)]) for i in range(n)]


def main_text(page: str | None) -> str:
    """The content blocks of a page, one a line; empty if there are none."""
    nodes = []
    for path, numbers, raw in blocks(page or ""):
        text = " ".join(entities.unescape(raw).split())
        if text:
            nodes.append((path, numbers, text))
    ratio: dict[tuple[str, ...], float] = {}
    best = shown = 0.0
    for side in (False, True):
        paths: dict[tuple[str, ...], list[int]] = {}
        for path, _, text in nodes:
            if any(t[-1] == "*" for t in path) == side:
                s = paths.setdefault(path, [0, 0, 0])
                s[0] += len(text)
                s[1] += len(_PUNCTUATION.findall(text))
                s[2] += 1
        if not paths:
            continue
        length = _smooth([s[0] / s[2] for s in paths.values()])
        marks = _smooth([s[1] / s[2] for s in paths.values()])
        size = sum(s[0] for s in paths.values())
        body = {path for path in paths if any(t.rstrip("*") in BODY for t in path)}
        weight = 1 + (BODY_WEIGHT - 1) * sum(paths[path][0] for path in body) / size
        fused = {path: a * (1 + b) * (weight if path in body else 1.0) for path, a, b in zip(paths, length, marks, strict=True)}
        if side and (max(fused.values()) < CLEAR * best or size <= shown or size < CLEAR_TEXT):
            continue
        best, shown = max(fused.values()), size
        ratio |= fused
    picked = {path for path, f in ratio.items() if f >= LEAST * best}
    roots = {numbers[-2] for path, numbers, _ in nodes if path in picked and len(path) > 1}
    sided = any(t[-1] == "*" for path in picked for t in path)

    def kept(path: tuple[str, ...], numbers: tuple[int, ...]) -> bool:
        """Picked, or below the container of a picked block; below the body, only what stands in it directly."""
        if path in picked:
            return True
        if not sided and any(t[-1] == "*" for t in path):
            return False
        return any(n in roots and (t not in ("html", "body") or i >= len(path) - 2) for i, (t, n) in enumerate(zip(path, numbers, strict=True)))

    return "\n".join(text for path, numbers, text in nodes if kept(path, numbers))


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """All rows and columns of ``pages`` but the markup, plus the main text (a column of that name is replaced). Null and empty markup gives an empty text.

    Pages of any length are read whole, in time that grows with their length also where tags or quotes never end; an empty table gives an empty result.
    """
    kept = [f for f in pages.schema.fields if f.name not in (html_col, out_col)]
    pages = pages.select(*[f.name for f in kept], html_col)

    def run(batches):
        for piece in pieces(batches, html_col):
            texts = [main_text(x) for x in piece.column(html_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*piece.columns[: len(kept)], pa.array(texts, pa.string())], names=[*piece.schema.names[: len(kept)], out_col])

    return pages.mapInArrow(run, T.StructType([*kept, T.StructField(out_col, T.StringType())]))
