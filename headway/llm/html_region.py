"""Main text of web pages by a maximum-scoring subsequence.

A page is a row of tokens: words score by the elements they stand in, tags cost (next to
nothing inside an element that is declared the page's article). One scan finds the contiguous region of the largest total; in it, words inside elements that
labelled pages show to be never content (menus, adverts, forms, comments, ...) are left
out. All scores are log odds counted on the labelled pages below.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Element names by what they do to the text.
UNREAD = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "head", "title", "textarea", "select", "option", "button"}
INLINE = set("a abbr b bdi bdo big cite code data dfn em font i ins del kbd label mark q s samp small span strike strong sub sup time tt u var wbr img picture source input".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg")
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + r")\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/<>]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^<>]*(?:>|\Z)",
    re.S | re.I,
)
HINT = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
# Labelled pages: what stands between <!--+--> and <!----> marks is content.
LABELLED = [
    """<html><body><header class="header masthead"><a href="/">w w w</a> w w w w</header><nav class="menu navbar"><ul><li><a>w</a></li>
    <li><a>w w</a></li><li><a>w</a></li></ul></nav><main><article><!--+--><h1>w w w w</h1><p>w w w w w w w w w w w w <b>w w</b> w</p><p>w w w w
    w w w w <a>w w</a> w w w w</p><ul><li>w w w w</li><li>w w w w w</li></ul><p>w w w w w w w w w w w</p><!----><aside class="related">
    <h3>w w</h3><p>w w w w w w</p><ul><li><a>w w</a></li></ul></aside></article></main><footer class="footer"><p>w w w w w</p></footer></body></html>""",
    """<body><div class="cookie notice consent banner">w w w w w w w <button>w</button></div><div id="nav" role="navigation" class="nav navigation"><ul><li><a>w w w w w w</a></li></ul></div>
    <div class="ad ads advert advertisement">w w w w w w w</div><div class="content post"><!--+--><h1>w w w</h1><p>w w w w w w w w w w w w w w w</p><!---->
    <div class="ad sponsor promo">w w w w w w</div><!--+--><p>w w w w w w w w w w w</p><blockquote>w w w w w w</blockquote><pre>w w w</pre><!----></div>
    <div class="share social"><a>w w w</a><a>w w w</a></div><div class="sidebar widget"><p>w w w w w w</p><ul><li><a>w w</a></li></ul></div>
    <section id="comments" class="comments comment-list"><div class="comment"><p>w w w w w w w</p></div><div class="comment reply"><p>w w w w w</p></div>
    <form class="respond"><label>w</label><p>w w</p></form></section><div id="footer">w w w w <a>w</a></div></body>""",
    """<body><div role="banner" id="header">w w w</div><ol class="breadcrumb breadcrumbs"><li><a>w w w</a></li><li><a>w w w</a></li></ol><article><!--+--><h1>w w w w w</h1>
    <h2>w w</h2><p>w w w w w w w w w w w w w w</p><figure><figcaption>w w w w</figcaption></figure><table><tr><td>w w</td><td>w w</td></tr></table>
    <p>w w w w w w w w w w w w</p><!----></article><form class="newsletter subscribe signup"><p>w w w w w w</p></form><div class="popup modal alert">w w w w</div>
    <aside role="complementary" class="aside"><p>w w w w w w w</p></aside><dialog role="dialog">w w w w w w w</dialog><footer role="contentinfo"><p>w w w w w w w</p></footer></body>""",
]
# Elements whose class speaks of the whole page, and the start of classes that say what a
# page is about or has, as in "category-social" and "has-sidebar".
WHOLE = ("html", "body", "main")
ABOUT = ("category-", "tag-", "has-", "no-")
# Elements, and words of a class, whose header holds a title.
TITLED = {"article", "main", "section", ".post", ".entry", ".article", ".section"}
# Odds below which an element is never content; words in it cost next to nothing, so that a
# region reaches over it.
NEVER = -2.0
BRIDGE = -0.01


def hints(name: str, rest: str) -> tuple[str, ...]:
    """What an element says of its words: its name and the words of class, id and role."""
    kind = "h" if re.fullmatch(r"h[1-6]", name) else name
    found = [kind]
    if name in WHOLE:
        return (kind,)
    for value in HINT.findall(rest):
        for word in value.lower().strip("\"'").split():
            if not word.startswith(ABOUT):
                found += ["." + w for w in re.split(r"[^a-z]+", word) if w]
    return tuple(found)


def tokens(page: str):
    """(kind, value, open) in page order: ``text`` with the hints of the open elements,
    ``tag`` with its name, ``mark`` for labels. Unclosed and crossed elements are closed
    with the first enclosing element that ends."""
    stack: list[tuple[str, tuple[str, ...]]] = []
    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            yield "text", page[at : m.start()], stack
        at = m.end()
        if m[0] in ("<!--+-->", "<!---->"):
            yield "mark", m[0], stack
        name = (m["name"] or "").lower()
        if not name:
            continue
        yield "tag", name, stack
        if m["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
                if name in INLINE and stack[k][0] not in INLINE:
                    break  # an inline end tag closes no block
            continue
        if name not in INLINE:
            while stack and (stack[-1][0] in INLINE or stack[-1][0] == "p" or name == stack[-1][0] in ("li", "td", "tr", "dt", "dd", "option")):
                if stack[-1][0] in INLINE and not any(n == "p" for n, _ in stack):
                    break
                stack.pop()
        if name not in VOID and not m["rest"].endswith("/"):
            stack.append((name, hints(name, m["rest"])))
    if at < len(page):
        yield "text", page[at:], stack


@lru_cache(maxsize=1)
def weights() -> tuple[dict[str, float], dict[str, float]]:
    """(score of a word for each hint, cost of each tag): log odds of content."""
    inside, outside, tag_in, tag_out = Counter(), Counter(), Counter(), Counter()
    for page in LABELLED:
        content = False
        for kind, value, stack in tokens(page):
            if kind == "mark":
                content = value == "<!--+-->"
            elif kind == "tag":
                (tag_in if content else tag_out)[value] += 1
            else:
                n = len(value.split())
                for h in {h for _, found in stack for h in found}:
                    (inside if content else outside)[h] += n
    # Half a word on both sides, so that one mention in either leaves the odds finite.
    words = {h: math.log((inside[h] + 0.5) / (outside[h] + 0.5)) for h in inside | outside}
    tags = {t: min(-0.1, 0.3 * math.log((tag_in[t] + 0.5) / (tag_out[t] + 0.5))) for t in tag_in | tag_out}
    return words, tags


# Elements whose words belong to the page frame wherever they stand.
NEUTRAL = ("html", "body", "div", "section", "a", "li", "ul", "ol", "span", "main", "article", "p", "h", "b", ".content", ".post")


def scored(stack: list[tuple[str, tuple[str, ...]]]) -> float:
    """Score of one word in the open elements."""
    known, _ = weights()
    total, titled = 1.0, False
    for name, found in stack:
        titled |= not TITLED.isdisjoint(found)
        if name in UNREAD:
            return BRIDGE
        for h in found:
            if h in NEUTRAL or titled and h in ("header", ".header"):  # the header of an article holds its title
                continue
            if known.get(h, 0.0) < NEVER:
                return BRIDGE
    for _, found in stack[-1:]:
        total += 0.2 * known.get(found[0], 0.0)
    return max(total, 0.2)


def main_text(page: str | None) -> str:
    """Blocks of the best region, joined by an empty line; empty if there is none."""
    _, costs = weights()
    row: list[tuple[float, str, int]] = []  # score, text, block
    block = 0
    for kind, value, stack in tokens(page or ""):
        if kind == "tag":
            if value not in INLINE:
                block += value != "br"
            inside = any(name in ("article", "main") for name, _ in stack)
            row.append((BRIDGE if inside else costs.get(value, -0.1), " " if value == "br" else "", block))
        elif kind == "text":
            plain = html.unescape(value)
            n = len(plain.split())
            each = scored(stack) if n else 0.0
            row.append((each * n, plain if each != BRIDGE or not n else "", block))
    best, total, start, span = 0.0, 0.0, 0, (0, 0)
    for k, (score, _, _) in enumerate(row):
        if total <= 0:
            total, start = 0.0, k
        total += score
        if total > best:
            best, span = total, (start, k + 1)
    blocks: dict[int, list[str]] = {}
    for _, text, b in row[span[0] : span[1]]:
        blocks.setdefault(b, []).append(text)
    joined = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n\n".join(t for t in joined if t)


def extracted(page: Column) -> Column:
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p) for p in pages.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")(page)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Every row of ``pages`` with ``text``, the main text of its page.

    A null or empty page, and one without a word outside menus and the like, has the text
    ''. Pages are read whole and one by one; a tag cut off at the end is no text. An input
    column named ``text`` is replaced.
    """
    return pages.withColumn("text", extracted(F.col(html_col)))
