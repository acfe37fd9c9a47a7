"""Main text of HTML pages by tag-path ratios.

Every text node has a root-to-leaf tag path (tag names with their classes).  Per path and page the
text length and the punctuation are averaged over its nodes; the two ratios are smoothed along the
page with a Gaussian window, multiplied, and paths whose mean fused score passes a threshold (the
smaller of the scores' standard deviation and a tenth of their maximum), and whose own ratios come to a tenth of it, are content paths.  The
content root is the lowest common ancestor of all content nodes that is no inline element or paragraph,
or the outermost article or main element round it.  Below it those blocks are kept that hold a content node or share their path
with one that does, or whose path has punctuation, headings, and what stands between the first and the last of them: other
blocks before and after are cut by their paths' ratios.  Blocks in boilerplate elements (menus, headers, footers, asides, forms, scripts,
adverts, notices, reader comments: by tag, class or id) and blocks whose path is mostly links are dropped in any case.
A class or id counts for little round the article: what holds most of its text stays (see ``boilerplate``).

Pages are independent, so the work is one Arrow-batched map without a shuffle; a page is parsed
whole, in one pass over its tags.

Defined results: null or empty html gives an empty text; a page without content nodes gives an
empty text; unclosed and stray tags are tolerated; repeated rows and ids each give a row.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<![^>]*>|<\?[^>]*>",
                 re.S)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
SPACE = re.compile(r"\s+")
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？؟¿¡]")
# Fixed element lists.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var br wbr img "
                   "math mi mo mn ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle".split())
CHROME = frozenset("head nav header footer aside form button select dialog menu".split())
CHROME_NAMES = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo sidebar "
                         "menu nav navbar navigation breadcrumb breadcrumbs footer header masthead cookie cookies "
                         "consent notice popup modal newsletter subscribe comment comments disqus share sharing "
                         "social related widget toolbar pagination".split())
HEADER_NAMES = frozenset(("header", "masthead"))
OWN_NAMES = frozenset("article post entry story".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main "
                     "nav ol p pre section table ul".split())
SAME = {"li": "li", "tr": "tr", "td": "td", "th": "th", "dt": "dt", "dd": "dd", "option": "option"}
NO_ROOT = INLINE | {"p"}
WINDOW = [math.exp(-(i * i) / 2.0) for i in range(-2, 3)]
LINK_SHARE = 0.6
OWN_SHARE = 0.1               # of the threshold, which a path's own ratios must reach


class Node:
    """An open element: its tag, path, number, block's path, and whether it is boilerplate, in a link, in an article."""
    __slots__ = ("tag", "path", "at", "chrome", "link", "base", "within")

    def __init__(self, tag, path, at, chrome, link, base, within):
        self.tag, self.path, self.at, self.chrome, self.link, self.base, self.within = tag, path, at, chrome, link, base, within


def text_nodes(page: str) -> tuple[list[tuple], list[tuple]]:
    """The page's text nodes and elements.

    Nodes, in page order: (text, path, element, block, in a link, in a boilerplate tag, path without inline
    elements).  Elements, each after its parent: (parent, tag, 1 if some and 2 if all of its names are boilerplate).
    """
    out, elements, at, block = [], [(0, "", 0)], 0, 0
    stack, opened, paths = [Node("", 0, 0, False, False, 0, False)], defaultdict(int), {}
    size = len(page)

    def text(upto):
        if upto > at:
            top = stack[-1]
            out.append((html_lib.unescape(page[at:upto]), top.path, top.at, block, top.link, top.chrome, top.base))

    def close(i):
        for node in stack[i:]:
            opened[node.tag] -= 1
        del stack[i:]

    while m := TAG.search(page, at):
        name = (m.group(2) or "").lower()
        text(m.start())
        at = m.end()
        if not name:
            continue
        if name not in INLINE:
            block += 1
        if m.group(1):                                     # an end tag closes down to its start tag
            if opened[name]:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == name))
            continue
        if name == "br":
            top = stack[-1]
            out.append((" ", top.path, top.at, block, top.link, top.chrome, top.base))
            continue
        if name in VOID or m.group(3).endswith("/"):
            continue
        if name in RAW:
            # what follows is not markup; without an end tag the element runs to the page's end
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        closes = "p" if name in CLOSES_P else SAME.get(name)
        if closes and opened[closes]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == closes:
                    close(i)
                    break
                if stack[i].tag in ("ul", "ol", "table", "dl") and closes != "p":
                    break
        up = stack[-1]
        names = [w for g in NAMES.findall(m.group(3)) for w in re.split(r"[\s_-]+", (g[0] or g[1] or g[2]).lower()) if w]
        chrome = up.chrome or (name in CHROME and not (name == "header" and up.within))
        named = CHROME_NAMES.intersection(names)
        if up.within or name in HEADINGS or not OWN_NAMES.isdisjoint(names):
            named -= HEADER_NAMES                           # the article's own header
        elements.append((up.at, name, 0 if not named or name in ("html", "body") else 2 if named.issuperset(names) else 1))
        label = name + "".join("." + w for w in names[:3])
        path = paths.setdefault((up.path, label), len(paths) + 1)
        base = up.base if name in INLINE else paths.setdefault((up.base, label), len(paths) + 1)
        stack.append(Node(name, path, len(elements) - 1, chrome, up.link or name == "a", base,
                          up.within or name in ("article", "main")))
        opened[name] += 1
    text(size)
    return out, elements


def below(elements: list[tuple], marked: Callable[[int], bool]) -> list[bool]:
    """Whether each element or one round it is marked."""
    out = []
    for e, (parent, _, _) in enumerate(elements):
        out.append(marked(e) or (e > 0 and out[parent]))
    return out


def summed(elements: list[tuple], own: list[float]) -> list[float]:
    """Every element's own value and that of all elements in it."""
    out = list(own)
    for e in range(len(out) - 1, 0, -1):
        out[elements[e][0]] += out[e]
    return out


def boilerplate(nodes: list[tuple], elements: list[tuple]) -> list[bool]:
    """Whether each element is boilerplate by its names or is in one that is.

    Spared is what holds more than half of the article's text outside links, if an article or main element is
    in it or if it has other names too; if nothing of that text would be left, all that hold some of it.  The
    article's text is that in articles of the main element, or else in main, or in articles, or all.
    """
    if not any(kind for _, _, kind in elements):
        return [False] * len(elements)
    article, main = ([tag == t and not kind for _, tag, kind in elements] for t in ("article", "main"))
    in_article, in_main = below(elements, article.__getitem__), below(elements, main.__getitem__)
    every = [0.0] * len(elements)
    for t, _, e, _, link, chrome, _ in nodes:
        if not chrome and not link:
            every[e] += len(t.strip())
    for part in ([a and m for a, m in zip(in_article, in_main)], in_main, in_article, [True] * len(elements)):
        own = [n if p else 0.0 for n, p in zip(every, part)]
        if any(own):
            break
    holds = summed(elements, own)
    whole = summed(elements, [float(a or m) for a, m in zip(article, main)])
    able = [holds[e] > 0 and (kind == 1 or whole[e] > 0) for e, (_, _, kind) in enumerate(elements)]

    def dropped(least):
        return below(elements, lambda e: elements[e][2] > 0 and elements[e][1] not in ("article", "main") and
                     not (able[e] and holds[e] > least))

    out = dropped(holds[0] / 2)
    if holds[0] and not any(n and not d for n, d in zip(own, out)):
        out = dropped(0)
    return out


def main_text(page: str | None) -> str:
    nodes, elements = text_nodes(page or "")
    named = boilerplate(nodes, elements)
    live = [n for n in nodes if not n[5] and not named[n[2]]]
    if not any(n[0].strip() for n in live):
        return ""
    chars, points, count, linked, held = (defaultdict(float) for _ in range(5))
    for t, path, _, _, link, _, base in live:
        n = len(t.strip())
        if n:
            chars[path] += n
            points[path] += len(PUNCTUATION.findall(t))
            count[path] += 1
            # a link in running prose has a path of its own, so the share is that of its block's path
            held[base] += n
            linked[base] += n * link
    seq = [n for n in live if n[0].strip()]
    length = [chars[n[1]] / count[n[1]] for n in seq]
    points_ratio = [points[n[1]] / count[n[1]] for n in seq]

    def smooth(x):
        out = []
        for i in range(len(x)):
            total = weight = 0.0
            for k, w in enumerate(WINDOW, i - 2):
                if 0 <= k < len(x):
                    total, weight = total + w * x[k], weight + w
            out.append(total / weight)
        return out

    fused = [a * (0.1 + b) for a, b in zip(smooth(length), smooth(points_ratio))]
    mean = sum(fused) / len(fused)
    bound = min(math.sqrt(sum((f - mean) ** 2 for f in fused) / len(fused)), max(fused) / 10)
    by_path = defaultdict(list)
    for n, f in zip(seq, fused):
        by_path[n[1]].append(f)
    linky = {p for p in held if linked[p] > LINK_SHARE * held[p]}
    # smoothing lends a lone node its neighbours' score, so the path's own ratios count too
    plain = {p: chars[p] / count[p] * (0.1 + points[p] / count[p]) for p in by_path}
    content = {p for p, f in by_path.items() if sum(f) / len(f) >= bound and plain[p] >= OWN_SHARE * bound}
    # The lowest common ancestor of the content nodes, out of inline elements and paragraphs, and the article round it.
    own = [0.0] * len(elements)
    for n in seq:
        if n[1] in content and n[6] not in linky:
            own[n[2]] += 1
    if not any(own):
        return ""
    total = summed(elements, own)
    root = max(e for e, n in enumerate(total) if n == total[0])
    while elements[root][1] in NO_ROOT:
        root = elements[root][0]
    e = root
    while e:
        if elements[e][1] in ("article", "main"):
            root = e
        e = elements[e][0]
    inside = below(elements, root.__eq__)
    titled = below(elements, lambda e: elements[e][1] in HEADINGS)
    alike = {n[6] for n in seq if (n[1] in content or points[n[1]]) and n[6] not in linky and inside[n[2]]}
    blocks, last = [], None                      # (texts, of a content path, heading)
    for t, _, e, block, _, _, base in live:
        if base in linky or not inside[e]:
            continue
        if block != last:
            blocks.append(([], [], []))
            last = block
        for kind, value in zip(blocks[-1], (t, base in alike, titled[e])):
            kind.append(value)
    blocks = [(SPACE.sub(" ", "".join(t)).strip(), any(c), any(h)) for t, c, h in blocks]
    scored = [i for i, (t, c, _) in enumerate(blocks) if t and c]
    return " ".join(t for i, (t, _, h) in enumerate(blocks) if t and (h or scored[0] <= i <= scored[-1]))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """id, url, text and n_chars (code points) of every page."""
    src = pages.select(id_col, url_col, html_col)
    schema = src.drop(html_col).schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[id_col, url_col, "text", "n_chars"])

    return src.mapInArrow(run, schema)
