"""Main text of web pages by consensus of the pages of a host.

Every page's containers are scored by the text that stands directly in them and
in their paragraphs; a container's generalised path is its tags and classes from
the root, numbers left out. A page votes for the paths of its best containers.
The votes are summed per host in Spark, and each page is extracted again at the
first of its host's winning paths that it has; a page without any of them falls
back to its own best container.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import bounded_batches, materialize, read_table, slices

#: Paths that a page votes for, and paths of a host that are tried in turn.
VOTES, WINNERS = 2, 3
#: Running text beside a winning path that is still taken for the same article, in multiples of the path's own.
BESIDE = 3

# Element names, from the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noframes xmp svg math template".split())
BLOCK = frozenset((
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul").split())
ENDS_P = BLOCK - {"body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend"}
#: What an opening tag ends, and the elements that such an end does not leave.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
        "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
        "body": ({"head"}, {"html"})}
#: Elements that hold no running text.
SHORT = frozenset("li dt td th h1 h2 h3 h4 h5 h6 address".split())
CONTAINERS = frozenset("article body center dd div html main section td table".split())
# Elements, class words and roles that hold no article text.
OUTSIDE = frozenset("nav footer aside form button select menu dialog object audio video canvas head".split())
OUTSIDE_WORDS = frozenset((
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar side menu nav "
    "navbar navigation breadcrumb breadcrumbs footer header masthead notice notices cookie cookies consent gdpr popup "
    "modal overlay newsletter subscribe subscription signup share sharing social related recommended recommendations "
    "comment comments commentlist disqus respond replies reply login search pagination pager copyright legal "
    "disclaimer widget widgets toolbar hidden alert").split())
#: Those that also name the layout or the subject of a page: what bears them may hold the article.
LAYOUT_WORDS = frozenset((
    "banner sidebar side header masthead notice notices share sharing social related copyright legal disclaimer widget "
    "widgets toolbar promo promotion").split())
#: Words of class names that tell what stands beside an element, not what it is.
SAYING = frozenset("with has no without".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
#: How surely an element is outside the article: by a word inside a longer name, by its whole name, in any case.
MAYBE, LIKELY, SURELY = 1, 2, 3
#: Shares of a page's running text with which an element is not outside: with any mark of the layout that is no whole
#: name, or with a title or an article inside; and with any mark of the layout.
MOST, NEARLY_ALL = 0.5, 0.9
#: Elements that an article is in, and those of which an open one ends where such an element begins.
TITLED = frozenset("main article h1".split())
LEFT_OPEN = {"main": frozenset("nav aside footer menu button select".split()), "article": frozenset(["nav"]), "h1": frozenset(["nav"])}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"
    r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)|([^\s=\"'/]+)")
_WORD = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    """An element: its generalised path, parent, how surely it is outside the article, and its order of opening."""

    __slots__ = ("tag", "path", "parent", "outside", "order", "close")

    def __init__(self, tag, path, parent, outside, order):
        self.tag, self.path, self.parent, self.outside, self.order, self.close = tag, path, parent, outside, order, None


def _classes(raw: str) -> tuple[str, int]:
    """The generalised class part of a path, and how surely the attributes say that it is no article text."""
    if not raw or raw.isspace():
        return "", 0
    held = {}
    for m in _ATTRIBUTE.finditer(raw):
        held.setdefault((m[1] or m[3]).lower(), html.unescape((m[2] or "").strip("\"'")))
    names = held.get("class", "").lower().split()
    outside = 0
    if ("hidden" in held or held.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(held.get("style", ""))
            or held.get("role", "").lower() in OUTSIDE_ROLES):
        outside = SURELY
    for name in (*names, held.get("id", "").lower()):
        words = _WORD.findall(name)
        said = OUTSIDE_WORDS.intersection(words)
        if said and SAYING.isdisjoint(words):
            outside = max(outside, SURELY if said - LAYOUT_WORDS else LIKELY if len(words) == 1 else MAYBE)
    general = sorted({re.sub(r"\d+", "", n).strip("-_") for n in names} - {""})
    return "".join(f".{n}" for n in general), outside


def _holding(nodes: list[Node], blocks) -> set[int]:
    """The marked elements that hold the article after all, by its running text."""
    running = [(holder.order, len(text), marked) for holder, text, linked, marked in blocks
               if holder.tag not in SHORT and 2 * linked < len(text) and all(n.outside < SURELY for n in marked)]
    total = sum(size for _, size, _ in running)
    below: dict[int, int] = {}
    for _, size, marked in running:
        for n in marked:
            below[n.order] = below.get(n.order, 0) + size
    out = set()
    for k, size in below.items():
        node, share = nodes[k], size / total
        titled = any(n.tag in TITLED for n in nodes[k + 1 : node.close])
        if share > (MOST if node.outside == MAYBE or titled else NEARLY_ALL):
            out.add(k)
    return out


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str, int]]]:
    """The elements of a page and its blocks (element, text, characters of it inside links), in page order."""
    root = Node("", "", None, False, 0)
    nodes, blocks = [root], []
    stack = [root]
    text: list[str] = []
    links = linked = 0

    def flush():
        nonlocal linked
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            if joined:
                holder = next(n for n in reversed(stack) if n.tag in BLOCK or n is root)
                blocks.append((holder, joined, linked, [n for n in stack if n.outside]))
            text.clear()
        linked = 0

    def pop(to):
        """Closes the elements above and including position ``to``."""
        nonlocal links
        for n in stack[to:]:
            n.close = len(nodes)
            links -= n.tag == "a"
        del stack[to:]

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.match(page, at)
        if m is None:  # a tag with an open quote: the rest is markup
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            piece = m[0]
            if piece[0] != "<" or piece == "<":
                text.append(piece)
                linked += len(piece) if links else 0
            elif piece.startswith("<![CDATA["):
                text.append(piece[9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "p" and all(n.tag != "p" for n in stack):
                flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    if tag in BLOCK or any(n.tag in BLOCK for n in stack[k:]):
                        flush()
                    pop(k)
                    break
                if stack[k].tag in ("table", "article", "main", "body") and tag not in BLOCK:
                    break  # an inline end tag does not close what it does not stand in
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            if not m[0].endswith("/>"):
                at = end.end() if end else size
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCK:
            flush()
            if tag in ENDS_P:
                k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p"), 0)
                if k and not any(n.tag in ("td", "th", "table", "button") for n in stack[k:]):
                    pop(k)
        if tag in LEFT_OPEN:
            k = next((i for i in range(1, len(stack)) if stack[i].tag in LEFT_OPEN[tag]), 0)
            if k:
                flush()
                pop(k)
        if tag in ENDS:
            ended, held = ENDS[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ended:
                    flush()
                    pop(k)
                elif stack[k].tag in held:
                    break
        if tag in VOID or m[0].endswith("/>") and tag not in BLOCK:
            continue
        parent = stack[-1]
        classes, outside = _classes(m[3])
        if tag in ("body", "html", "article", "main"):
            outside = 0
        elif tag in OUTSIDE:
            outside = max(outside, MAYBE if tag == "form" else LIKELY if tag == "aside" else SURELY)
        elif tag == "header" and not any(n.tag in ("article", "main") for n in stack):
            outside = max(outside, LIKELY)
        node = Node(tag, f"{parent.path}>{tag}{classes}", parent, outside, len(nodes))
        nodes.append(node)
        stack.append(node)
        links += tag == "a"
    flush()
    pop(1)
    root.close = len(nodes)
    holding = _holding(nodes, blocks)
    return nodes, [b for b in blocks if all(n.order in holding for n in b[3])]


def scores(blocks) -> list[tuple[float, Node]]:
    """Containers with text, best first: a block counts fully for the nearest container, half for the next one up.

    Text inside links counts against a container, headings and lists count less
    than running text, and an ``article`` or ``main`` element counts double.
    """
    found: dict[int, list] = {}
    for holder, text, linked, _ in blocks:
        value = max(len(text) - 2 * linked, 0) + 1.0
        if holder.tag in SHORT:
            value /= 4
        node, share = holder, 1.0
        while node is not None and share > 0.1:
            if node.tag in CONTAINERS or node.parent is None:
                found.setdefault(id(node), [0.0, node])[0] += value * share
                share /= 2
            node = node.parent
    ranked = [(v * (2 if n.tag in ("article", "main") else 1), n) for v, n in found.values()]
    return sorted(ranked, key=lambda x: (-x[0], x[1].order))


def whole(node: Node, blocks) -> Node:
    """The container that holds all of an article of which ``node`` is the best part.

    It climbs while the next container up has running text beside the node (a
    block, not marked as outside, most of it not in links), past containers
    that hold nothing but the node, and not above ``article`` and ``main``.
    """
    def beside(up, some):
        return any(up.order <= k < up.close and not node.order <= k < node.close for k in some)

    every = [h.order for h, *_ in blocks]
    running = [h.order for h, text, linked, _ in blocks if h.tag not in SHORT and 2 * linked < len(text)]
    up = node
    while up.tag not in ("article", "main") and up.parent is not None:
        up = up.parent
        if up.tag not in CONTAINERS and up.parent is not None:
            continue
        if beside(up, running):
            node = up
        elif beside(up, every):
            break
    return node


def votes(page: str | None) -> list[tuple[str, float]]:
    """(path, share of the page's best score) of a page's best containers; the best one votes for its whole article."""
    blocks = parse(page)[1] if page else []
    ranked = scores(blocks)
    out: dict[str, float] = {whole(ranked[0][1], blocks).path: 1.0} if ranked else {}
    for value, node in ranked:
        if len(out) == VOTES:
            break
        if node.path not in out:
            out[node.path] = value / ranked[0][0]
    return list(out.items())


def main_text(page: str | None, paths: list[str]) -> tuple[str, str | None]:
    """The text below all elements on the first path of ``paths`` that has text, and that path.

    Where the page has running text beside them in the container that holds the
    whole article, at most ``BESIDE`` times theirs, that is taken too. Blocks are joined by an empty line. A
    page without any of the paths is extracted at its own best container, or the
    one that holds the whole article; null and pages without text give "".
    """
    if not page:
        return "", None
    blocks = parse(page)[1]
    ranked = scores(blocks)
    if not ranked:
        return "", None
    have = {n.path for _, n in ranked}
    chosen = next((path for path in paths if path in have), None) or whole(ranked[0][1], blocks).path
    nodes = [n for _, n in ranked if n.path == chosen]
    spans = sorted((n.order, n.close) for n in nodes)
    starts = [a for a, _ in spans]  # elements of one path are not inside each other

    def held(holder):
        k = bisect_right(starts, holder.order)
        return k and holder.order < spans[k - 1][1]

    up = whole(nodes[0], blocks)
    running = [(h, len(text)) for h, text, linked, _ in blocks if h.tag not in SHORT and 2 * linked < len(text)]
    more = sum(n for h, n in running if up.order <= h.order < up.close and not held(h))
    if more > BESIDE * sum(n for h, n in running if held(h)):
        up = nodes[0]
    inside = [text for holder, text, *_ in blocks if held(holder) or up.order <= holder.order < up.close]
    return "\n\n".join(inside), chosen


def host(url: Column) -> Column:
    """The lower-cased host of a url; a url without one, and null, count as the host ""."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def winning_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, paths): the up to ``WINNERS`` paths of every host with the most votes, best first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(h, p, v) for _, part in slices(batch) for h, page in zip(*part, strict=True) for p, v in votes(page)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                              pa.array([r[1] for r in rows], pa.string()),
                                              pa.array([r[2] for r in rows], pa.float64())], ["host", "path", "vote"])

    cast = pages.select(host(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).mapInArrow(
        run, "host string, path string, vote double")
    # sums of rounded votes do not depend on the order of the rows
    total = cast.groupBy("host", "path").agg(F.sum(F.round(1000 * F.col("vote")).cast("bigint")).alias("votes"))
    rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), "path"))
    best = total.withColumn("k", rank).filter(F.col("k") <= WINNERS)
    return best.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "path"))),
                                                lambda x: x["path"]).alias("paths"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, path): one row per row of ``pages``, from the whole html.

    Null and empty html, and pages without text, give "" and path null. Null
    urls form a host of their own; null ids and repeated rows are kept; other
    columns are not read; an empty table gives an empty result.
    """
    bounded_batches(pages)
    id_type = pages.schema[id_col].dataType.simpleString()
    paths = materialize(winning_paths(pages, url_col, html_col).withColumnRenamed("host", "of"), "winning-paths")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    joined = rows.join(paths, host(F.col("url")) == paths["of"], "left").select("id", "url", "html", "paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(page, ways or []) for _, (_, _, pages, paths) in slices(batch)
                     for page, ways in zip(pages, paths, strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.string())], ["id", "url", "text", "path"])

    return joined.mapInArrow(run, f"id {id_type}, url string, text string, path string")


def op1_html(spark, sf_dir: str) -> DataFrame:
    out = extract(read_table(spark, sf_dir, "pages"))
    return out.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("bigint").alias("n_chars"),
                      "path")
