"""Main text of pages by wrapper induction: pages of one host are aligned, what is constant is template.

1. *Tree.*  A page is parsed into elements, and siblings of one label (tag and class words) are folded into one node,
   so that lists and paragraphs are one repeated slot and a tree has as many nodes as the page has kinds of places.
2. *Alignment.*  Pages of a host with the same kinds of containers are one group.  Its reference is the tree with the
   least hash.  Every distinct tree is aligned with the reference by simple tree matching: roots that agree match, and
   ordered child lists match by dynamic programming on the matches below them.
3. *Wrapper.*  Per reference node: how many distinct trees have it, in how many its text equals the reference's, how much
   text it has and how much of that in links.  A node that is equal in most trees is template, any other a slot.  Exact
   copies of a page are one tree, so a page that is stored a thousand times does not make its own text a template.
4. *Extraction.*  A page is aligned with its group's wrapper again.  An explicit container (``article``, ``main``, ``role=main``,
   ``itemprop=articleBody``) is the article, and all of it is slots: near copies of an article must not make its paragraphs
   template.  Without one, it is the deepest node that holds most of the slots' text outside links.  Left out are template
   nodes, elements that are no article text by their tag, role or class words, and what is hidden.

Only trees (hashes, a few bytes a node) are shuffled for the wrapper; the pages' text meets the wrappers in one join on
host and kind of containers, which Spark broadcasts while the wrappers are small and splits at hot hosts when not.

Blocks: text of block elements, white space turned into one space, ``br`` too; blocks are joined by a line feed in page
order.  Character references are decoded, unfinished ones as browsers do; unclosed and stray tags are repaired.

Defined cases: a null or empty page has an empty text; a page without host is in a group of its host-less like; equal rows
give equal rows; a host with one page has no template; markup without any element is one text; further columns are
ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep_table, pick

# A node is template if it is equal in this share of the distinct trees that have it, in MIN_TREES at least.
CONSTANT = 0.6
MIN_TREES = 3
# The main container is entered as long as one child holds this share of the text outside links.
MAJORITY = 0.7
# A slot with more than this share of its text in links is a list of links.
LINKED = 0.5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp", "template", "svg", "math")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr br".split()
)
# what a start tag closes if it is open in the same block
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
DROPPED_TAGS = frozenset("head nav aside footer form button select input dialog menu object canvas audio video map datalist".split() + list(RAW))
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner nav navbar navigation menu "
    "menus breadcrumb breadcrumbs masthead footer sidebar sidenav aside widget widgets related recommended recommendations share sharing "
    "social cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login comment comments "
    "commentlist disqus respond reply replies pagination pager paging skip hidden toolbar teaser teasers".split()
)
# class words that say that an element has such a part, not that it is one
ABOUT_PARTS = frozenset("with has no without".split())
# a header is the page's unless it is inside an explicit container
HEADERS = frozenset("header topbar".split())
# browsers nest no deeper either; what comes below goes beside
DEEPEST = 512
GROUP_TAGS = ("article", "main", "nav", "aside", "header", "footer", "section", "form", "table")
HOST = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)"

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>?", re.DOTALL)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE) for tag in RAW}
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
PLACE = re.compile(r"[A-Za-z]+\d{1,2}(?!\d)")


class Element:
    __slots__ = ("tag", "label", "children", "dropped", "container", "inline")

    def __init__(self, tag: str, attributes: str):
        self.tag, self.children = tag, []  # elements and texts
        self.inline = tag in INLINE
        named = {}
        if attributes and not attributes.isspace():
            for m in ATTRIBUTE.finditer(attributes):
                named.setdefault(m[1].lower(), entities.unescape((m[2] or "").strip("\"'")))
        words = {w.lower() for key in ("class", "id") for w in WORD.findall(named.get(key, ""))}
        role = named.get("role", "").lower()
        style = named.get("style", "").replace(" ", "").lower()
        if tag in DROPPED_TAGS or role in DROPPED_ROLES or "hidden" in named or named.get("aria-hidden") == "true" or "display:none" in style:
            self.dropped = "tag"
        elif tag in ("html", "body") or words & ABOUT_PARTS:
            self.dropped = None
        elif words & DROPPED_WORDS:
            self.dropped = "word"
        else:
            self.dropped = "header" if tag == "header" or words & HEADERS else None
        article = tag == "article" or role == "article" or named.get("itemprop", "").lower() == "articlebody"
        self.container = 2 if article else 1 if tag == "main" or role == "main" else 0
        # numbers of up to two digits tell places of a layout, longer ones tell pages
        places = {w.lower() for w in PLACE.findall(named.get("class", ""))}
        self.label = xxhash.xxh32_intdigest(" ".join((tag, *sorted(words | places))))


def parse(text: str) -> Element:
    """The page as elements and texts.  Linear in the page: end tags that close nothing are told by counts, and depth is bounded."""
    root = Element("html", "")
    stack, open_tags, at, end = [root], {}, 0, len(text)

    def close(n: int) -> None:
        while len(stack) > n:
            open_tags[stack.pop().tag] -= 1

    def say(piece: str) -> None:
        if piece:
            stack[-1].children.append(entities.unescape(piece) if "&" in piece else piece)

    while at < end:
        m = TOKEN.search(text, at)
        if not m:
            say(text[at:])
            break
        say(text[at : m.start()])
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                say(m[0][9:].removesuffix("]]>"))
            continue
        if m[1]:
            if tag in ("html", "body"):
                continue
            if open_tags.get(tag):
                k = len(stack) - 1
                while stack[k].tag != tag:
                    k -= 1
                close(k)
            elif tag == "p":
                stack[-1].children.append(Element("p", ""))
            continue
        if tag == "html" or (tag == "body" and open_tags.get("body")):
            continue
        if tag not in INLINE and open_tags.get("p"):
            # a block ends an open paragraph, and what stands open inside it
            k = len(stack) - 1
            while stack[k].tag != "p" and (stack[k].inline or stack[k].tag == "p"):
                k -= 1
            if stack[k].tag == "p":
                close(k)
        if tag in CLOSES and any(open_tags.get(t) for t in CLOSES[tag]):
            k, lowest = len(stack) - 1, None
            while k > 0 and (stack[k].inline or stack[k].tag in CLOSES[tag]):
                if not stack[k].inline:
                    lowest = k
                k -= 1
            if lowest:
                close(lowest)
        if tag == "body" or (open_tags.get("head") and tag in ("article", "main", "nav", "div", "p", "header", "section", "h1")):
            close(1)
        element = Element(tag, m[3])
        if element.container:  # a form around a whole article is a way to build pages
            for outer in stack:
                outer.dropped = None if outer.tag == "form" else outer.dropped
        stack[-1].children.append(element)
        if tag in RAW:
            m = RAW_END[tag].search(text, at)
            at = m.end() if m else end
        elif tag not in VOID and len(stack) < DEEPEST:
            stack.append(element)
            open_tags[tag] = open_tags.get(tag, 0) + 1
    return root


def clean(text: str) -> str:
    return " ".join(text.split())


class Node:
    """Elements of one label under one place, folded."""

    __slots__ = ("label", "children", "order", "chars", "linked", "said", "dropped", "container", "number")

    def __init__(self, label: int):
        self.label, self.children, self.order = label, {}, []
        self.chars = self.linked = self.number = 0
        self.said = xxhash.xxh64()
        self.dropped, self.container = None, 0


def folded(root: Element) -> tuple[Node, dict[int, Node]]:
    """The folded tree in order of first places, and the node of each element by ``id``.  Inline elements are part of their block."""
    top = Node(root.label)
    of = {id(root): top}
    work = [(root, top, False)]
    while work:
        element, node, linked = work.pop()
        for child in element.children:
            if isinstance(child, str):
                said = clean(child)
                if said:
                    node.said.update(said.encode("utf-8", "surrogatepass"))
                    node.chars += len(said)
                    node.linked += len(said) * linked
                continue
            if child.inline and not child.dropped and not child.container:
                of[id(child)] = node
                work.append((child, node, linked or child.tag == "a"))
                continue
            own = node.children.get(child.label)
            if own is None:
                own = node.children[child.label] = Node(child.label)
                node.order.append(own)
                own.dropped, own.container = child.dropped, child.container
            of[id(child)] = own
            work.append((child, own, linked or child.tag == "a"))
    return top, of


def preorder(top: Node) -> list[tuple[int, Node]]:
    out, work = [], [(0, top)]
    while work:
        depth, node = work.pop()
        node.number = len(out)
        out.append((depth, node))
        work.extend((depth + 1, child) for child in reversed(node.order))
    return out


TREE = [("depth", "<i4"), ("label", "<u4"), ("chars", "<i4"), ("linked", "<i4"), ("said", "<u8")]


def packed(nodes: list[tuple[int, Node]]) -> bytes:
    """24 bytes a node in preorder, texts as hashes."""
    import numpy as np

    return np.array([(d, n.label, n.chars, n.linked, n.said.intdigest() if n.chars else 0) for d, n in nodes], dtype=TREE).tobytes()


def unpacked(tree: bytes):
    import numpy as np

    return np.frombuffer(tree, dtype=TREE)


def child_lists(depths: list[int]) -> list[list[int]]:
    out, path = [[] for _ in depths], []
    for i, d in enumerate(depths):
        del path[d:]
        if path:
            out[path[-1]].append(i)
        path.append(i)
    return out


def heaviest(places: list[int], weights: list[int]) -> list[int]:
    """Indexes of the increasing subsequence of distinct ``places`` with the greatest weight; by a tree of prefix maxima."""
    most: list[tuple[int, int]] = [(0, -1)] * (max(places, default=0) + 2)
    before = []
    for n, (place, weight) in enumerate(zip(places, weights)):
        best, k = (0, -1), place
        while k > 0:
            best = max(best, most[k])
            k -= k & -k
        before.append(best[1])
        k = place + 1
        while k < len(most):
            most[k] = max(most[k], (best[0] + weight, n))
            k += k & -k
    n, out = -1, []
    k = len(most) - 1
    best = (0, -1)
    while k > 0:
        best = max(best, most[k])
        k -= k & -k
    n = best[1]
    while n >= 0:
        out.append(n)
        n = before[n]
    return out[::-1]


def aligned(a, b) -> dict[int, int]:
    """Simple tree matching of packed trees: nodes of ``a`` -> nodes of ``b`` in the match with the most nodes.

    Labels are distinct among siblings, so a pair of children is given by its label and ordered children lists match in
    their heaviest increasing sequence.
    """
    la, lb = a["label"].tolist(), b["label"].tolist()
    ca, cb = child_lists(a["depth"].tolist()), child_lists(b["depth"].tolist())
    pairs = [(0, 0)] if la and lb and la[0] == lb[0] else []
    common: list[list[tuple[int, int, int]]] = []
    for i, j in pairs:  # grows: pairs of nodes with equal labels below such a pair
        at = {lb[y]: (y, p) for p, y in enumerate(cb[j])}
        common.append([(x, *at[la[x]]) for x in ca[i] if la[x] in at])
        pairs.extend((x, y) for x, y, _ in common[-1])
    size: dict[int, int] = {}  # by node of a, which is in one pair at most
    taken: dict[int, list[tuple[int, int]]] = {}
    for (i, _), own in zip(reversed(pairs), reversed(common)):
        chosen = heaviest([p for _, _, p in own], [size[x] for x, _, _ in own])
        taken[i] = [own[n][:2] for n in chosen]
        size[i] = 1 + sum(size[x] for x, _ in taken[i])
    out, work = {}, pairs[:1]
    while work:
        i, j = work.pop()
        out[i] = j
        work.extend(taken[i])
    return out


def group_columns(url: Column, html: Column) -> dict[str, Column]:
    """Host, and which containers a page has, as bits."""
    low = F.lower(F.coalesce(html, F.lit("")))
    bits = [F.when(F.contains(low, F.lit(f"<{tag}")), F.lit(1 << i)).otherwise(F.lit(0)) for i, tag in enumerate(GROUP_TAGS)]
    return {"host": F.coalesce(F.regexp_extract(F.lower(url), HOST, 1), F.lit("")), "kind": sum(bits[1:], bits[0])}


def page_trees(pages: DataFrame) -> DataFrame:
    """(host, kind, tree): the distinct folded trees of each group."""

    def work(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            trees = [packed(preorder(folded(parse(text or ""))[0])) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(trees, pa.binary())], ["host", "kind", "tree"])

    return pages.select("host", "kind", "html").mapInArrow(work, "host string, kind int, tree binary").distinct()


def wrappers(trees: DataFrame) -> DataFrame:
    """(host, kind, reference, template): the reference tree of a group, and a byte a node: 1 template, 2 links, 0 text.

    Counts by node are summed within a batch of pages first, so that a hot host sends a few rows a task.
    """
    least = F.min_by("tree", F.struct(F.xxhash64("tree"), "tree")).alias("reference")
    reference = keep_table(trees.groupBy("host", "kind").agg(least), "references")
    both = trees.join(reference, ["host", "kind"])

    def work(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            sums: dict[tuple, list[int]] = {}
            for row in batch.to_pylist():
                tree, ref = unpacked(row["tree"]), unpacked(row["reference"])
                said, other = tree["said"].tolist(), ref["said"].tolist()
                chars, linked = tree["chars"].tolist(), tree["linked"].tolist()
                for i, j in aligned(tree, ref).items():
                    own = sums.setdefault((row["host"], row["kind"], j), [0, 0, 0, 0])
                    own[0] += 1
                    own[1] += said[i] == other[j]
                    own[2] += chars[i]
                    own[3] += linked[i]
            keys, values = list(sums), list(sums.values())
            columns = [*(zip(*keys) if keys else ((), (), ())), *(zip(*values) if values else ((), (), (), ()))]
            kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["host", "kind", "node", "n", "equal", "chars", "linked"])

    counts = both.select("host", "kind", "tree", "reference").mapInArrow(
        work, "host string, kind int, node int, n bigint, equal bigint, chars bigint, linked bigint"
    )
    total = counts.groupBy("host", "kind", "node").agg(*(F.sum(c).alias(c) for c in ("n", "equal", "chars", "linked")))
    constant = (F.col("n") >= MIN_TREES) & (F.col("equal") >= CONSTANT * F.col("n")) & (F.col("chars") > 0)
    verdict = F.when(constant, "1").when(F.col("linked") > LINKED * F.col("chars"), "2").otherwise("0")
    # one entry for each node of one page's tree; the reference has every node itself
    flags = total.groupBy("host", "kind").agg(F.array_sort(F.collect_list(F.struct("node", verdict.alias("v")))).alias("flags"))
    text = F.array_join(F.transform("flags", lambda f: f["v"]), "")
    return reference.join(flags, ["host", "kind"]).select("host", "kind", "reference", text.alias("template"))


def main_nodes(nodes: list[tuple[int, Node]], flags: dict[int, str]) -> set[int]:
    """Numbers of the folded nodes that are the article's containers: articles, else ``main``, else where the text is.

    Containers inside something that is no article text by its class words count only where there are no others.
    """
    for wanted in (2, 1):
        above: list[Node] = []
        plain, marked = set(), set()
        for depth, node in nodes:
            del above[depth:]
            path = [x.dropped for x in above] + [node.dropped]
            if node.container == wanted and "tag" not in path and not any(x.container == wanted for x in above):
                if "word" not in path:
                    plain.add(node.number)
                elif not node.dropped:
                    marked.add(node.number)
            above.append(node)
        if plain or marked:
            return plain or marked
    # no explicit container: down to where the slots' text is
    weight = [0] * len(nodes)
    for depth, node in reversed(nodes):
        own = 0 if node.dropped or flags.get(node.number, "0") != "0" else node.chars - node.linked
        weight[node.number] = 0 if node.dropped else own + sum(weight[c.number] for c in node.order)
    at = nodes[0][1]
    while heavy := [c for c in at.order if c.order and weight[c.number] > MAJORITY * weight[at.number]]:
        at = heavy[0]
    return {at.number}


def main_text(text: str | None, reference: bytes | None = None, template: str | None = None) -> str:
    """Blocks of a page's article, joined by line feeds."""
    if not text:
        return ""
    root = parse(text)
    top, of = folded(root)
    nodes = preorder(top)
    flags = {}
    if reference:
        tree, ref = unpacked(packed(nodes)), unpacked(reference)
        for i, j in aligned(tree, ref).items():
            # template says the same on this page too; a list of links need not
            flags[i] = "0" if template[j] == "1" and tree["said"][i] != ref["said"][j] else template[j]
    mains = main_nodes(nodes, flags)
    explicit = any(node.container for _, node in nodes if node.number in mains)
    blocks, current = [], []

    def flush():
        said = clean("".join(current))
        if said:
            blocks.append(said)
        current.clear()

    # (element, is inside the article, step): texts and elements in page order without recursion
    work: list[tuple] = [(root, False)]
    while work:
        item, inside = work.pop()
        if item is None:
            flush()
            continue
        if isinstance(item, str):
            if inside:
                current.append(item)
            continue
        number = of[id(item)].number if id(item) in of else None
        starts = not inside and number in mains and not item.inline
        now = inside or starts
        if now and item.dropped and not starts and not (explicit and item.dropped == "header"):
            current.append(" ")
            continue
        if not now and item.dropped == "tag":
            continue
        if now and not item.inline and not explicit and flags.get(number, "0") != "0" and (flags[number] == "1" or linked_only(item)):
            flush()
            # template, or a list of links: only what is not folded into this node may be content
            work.append((None, now))
            work.extend((child, now) for child in reversed(item.children) if not isinstance(child, str) and not child.inline)
            continue
        if item.tag == "br":
            current.append(" ")
            continue
        if item.inline:
            work.extend((child, now) for child in reversed(item.children))
            continue
        flush()
        work.append((None, now))
        work.extend((child, now) for child in reversed(item.children))
    flush()
    return "\n".join(blocks)


def linked_only(element: Element) -> bool:
    """Whether an element's own text is in links for the greater part."""
    work, chars, linked = [(element, False)], 0, 0
    while work:
        item, link = work.pop()
        for child in item.children:
            if isinstance(child, str):
                n = len(clean(child))
                chars, linked = chars + n, linked + n * link
            elif child.inline:
                work.append((child, link or child.tag == "a"))
    return chars > 0 and linked > LINKED * chars


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text.  Runs jobs: trees and wrappers are stored once."""
    rows = pick(pages, page_id=id_col, url=url_col, html=html_col)
    grouped = rows.withColumns(group_columns(F.col("url"), F.col("html")))
    trees = keep_table(page_trees(grouped), "trees")
    wrapped = keep_table(wrappers(trees), "wrappers")

    def work(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            given = zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([main_text(*g) for g in given], pa.string())], ["page_id", "url", "text"])

    both = grouped.join(wrapped, ["host", "kind"], "left").select("page_id", "url", "html", "reference", "template")
    kind = rows.schema[0].dataType.simpleString()
    return both.mapInArrow(work, f"page_id {kind}, url string, text string")
