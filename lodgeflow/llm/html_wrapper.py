"""Main text of web pages by wrapper induction.

The pages of a host are told apart by layout: which tags and classes occur below
which. The pages of a layout are aligned with one of them, the reference page,
which has most of the nodes that nearly all of them have, by simple tree matching:
two nodes match if their tag and class agree, and the children of matched nodes,
however many, are aligned in order so that most nodes match; where siblings have
the same tag and class, equal ones are paired first. For each node of the
reference the votes of all pages of the layout are counted. Template are the nodes
whose text is constant, and the lists of links that nearly all pages have at the
same place, whatever their labels. Other nodes are slots and hold content. Nodes
inside an article are slots even where a host repeats them, as the markup itself
says what they are. Where the template would be most of a page, its pages are
versions of one another rather than different pages, and it is not used.

Within the slots, tags that never hold main text are left out, and so are elements
that a class, role or id names a menu, sidebar, advert, notice or the like, as far
as the tree agrees: a name counts as a whole word ("sidebar", "reader-comments",
"sidebar-left", but not "has-sidebar" or "related-work"), never for a paragraph or
heading, never round an article, and on pages without one never for an element
that holds most of the page's text. The same holds for forms.

A wrapper is a reference tree and the numbers of its template nodes. It is
learned from all distinct page trees of the layout, or of the host for layouts
with fewer than ``MIN_PAGES``; equal trees vote once, so copies of a page don't
turn its text into template. Trees hold hashes, not texts, and only counts by
host, layout and node are gathered.

Defined cases: a null, empty or textless html gives the empty text; a page
without a host belongs to the host ""; a host with fewer than ``MIN_PAGES``
distinct trees has no template nodes; repeated rows come back repeated; an empty
table gives an empty table; unclosed and stray tags are mended as browsers do it
for the block elements, and anything else that opens with "<" is text. Elements
nested deeper than ``MAX_DEPTH`` hand their text to the last one above that
depth. Very long pages are parsed whole, one at a time. Other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections import OrderedDict
from html import unescape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from lodgeflow.llm.common import landed, per_row

#: Distinct trees a layout or host needs, and the share of them that must agree, for a template node.
MIN_PAGES = 3
CONSTANT = 0.9
MAX_DEPTH = 100
#: Links that make a list of links a menu, the share of its text they hold, and the share of a page that is too much for a template.
LINKS, LINKED, MOST = 3, 0.9, 0.8
#: Wrappers up to so many bytes are sent to all tasks; beyond, pages are joined with them.
SENT_BYTES = 32 << 20
#: Nodes of unpacked reference trees that a task keeps.
KEPT_NODES = 200_000
#: Cells of an alignment's table held at a time; larger child lists are halved until they fit.
CELLS = 1 << 20
#: Cells up to which a table is worked out in lists, as arrays only pay beyond.
FEW_CELLS = 256

# The block elements, those that never hold main text, and words of class names that say so.
BLOCKS = frozenset(
    "html body head article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
    "caption blockquote pre figure figcaption address details summary fieldset center header footer nav aside form "
    "menu dialog hr title noscript template iframe object svg canvas select button textarea label option".split()
)
DROPPED = frozenset(
    "head nav header footer aside menu dialog title noscript template iframe object svg canvas select button "
    "textarea option".split()
)
RAW = frozenset("script style textarea title iframe noscript template svg".split())
VOID = frozenset("hr br img input meta link area base col embed source track wbr param".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo menu nav navbar navigation breadcrumb "
    "breadcrumbs sidebar aside header masthead footer notice cookie cookies consent popup modal newsletter subscribe "
    "comment comments share sharing social related".split()
)
# What may follow such a word in a name, as it only tells the place or the kind of box, and what turns its meaning round.
HOLDERS = frozenset(
    "left right top bottom inner outer wrapper wrap container box area block list item items link links bar buttons "
    "button slot unit section widget panel column col form".split()
)
NEGATIONS = frozenset("has with no without is not".split())
_ARTICLE = frozenset(("article", "main"))
_UNNAMED = frozenset("html body article main p h1 h2 h3 h4 h5 h6".split())

# What a new element closes when it is still open and nothing of its scope lies between.
_CLOSES = {
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"},
    "tbody": {"thead", "tbody", "tr", "td", "th", "p"}, "tfoot": {"thead", "tbody", "tr", "td", "th", "p"},
}
_P = frozenset(("p",))

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][A-Za-z0-9]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_CLASS = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[a-z0-9]+")


def named(names: str) -> bool:
    """Whether one of the names of an element says that it holds no main text."""
    for token in names.lower().split():
        words = _WORDS.findall(token)
        if not words or words[0] in NEGATIONS:
            continue
        if words[-1] in NAMES or words[0] in NAMES and HOLDERS.issuperset(words[1:]):
            return True
    return False


class Node:
    """An element, or with the signature "#" a run of text between block boundaries.

    ``never`` marks tags, ``maybe`` names and forms that hold no main text.
    """

    __slots__ = ("sign", "nodes", "text", "never", "maybe", "article", "linked")

    def __init__(self, sign: str, never: bool, article: bool, text: str = "", maybe: bool = False, linked: bool = False):
        self.sign, self.never, self.article, self.text = sign, never, article, text
        self.maybe, self.linked = maybe, linked
        self.nodes: list[Node] = []


def parsed(html: str) -> Node:
    """The tree of a page's block elements and texts."""
    root = Node("", False, False)
    stack: list[tuple[str, Node, bool]] = [("", root, False)]
    run: list[str] = []
    at = links = 0  # links: characters of the run inside links
    link = False

    def flush() -> None:
        nonlocal links
        if run:
            raw = "".join(run)
            text = " ".join(unescape(raw).split())
            if text:
                _, node, article = stack[-1]
                node.nodes.append(Node("#", False, article, text, linked=links >= LINKED * len(raw.strip())))
            run.clear()
            links = 0

    size = len(html)
    while at < size:
        m = _TAG.search(html, at)
        if not m:
            run.append(html[at:])
            links += link * (size - at)
            break
        if m.start() > at:
            run.append(html[at : m.start()])
            links += link * (m.start() - at)
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if name == "a":
            link = not m[1]
        if m[1]:
            if name in BLOCKS:
                if run:
                    flush()
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
            continue
        if name in RAW:
            if name in BLOCKS:
                flush()
            close = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at)
            at = close.end() if close else size
            continue
        if name not in BLOCKS:
            if name == "br":
                run.append(" ")
            continue
        if run:
            flush()
        closes = _CLOSES.get(name, _P)
        while len(stack) > 1 and stack[-1][0] in closes:
            stack.pop()
        if name in VOID:
            continue
        _, parent, article = stack[-1]
        names, sign = "", name
        if m[3]:
            found = [(k.lower(), a or b or c) for k, a, b, c in _CLASS.findall(m[3])]
            names = " ".join(v for _, v in found)
            sign += "".join(f".{v}" for k, v in found if k == "class")
        article = article or name in _ARTICLE
        if len(stack) <= MAX_DEPTH:
            maybe = name == "form" or bool(names) and name not in _UNNAMED and named(names)
            node = Node(sign, name in DROPPED, article, maybe=maybe)
            parent.nodes.append(node)
            parent = node
        stack.append((name, parent, article))
    flush()
    return root


def blocks(root: Node, template: set[int]) -> list[str]:
    """The texts of a tree outside ``template`` (ids of nodes) and outside what tags and names leave out."""
    chars: dict[int, int] = {}
    holds: dict[int, bool] = {}
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.never or id(node) in template:
            continue
        order.append(node)
        stack += node.nodes
    for node in reversed(order):
        below = [n for n in node.nodes if id(n) in chars]
        chars[id(node)] = len(node.text) + sum(chars[id(n)] for n in below)
        holds[id(node)] = any(n.article and not node.article or holds[id(n)] for n in below)
    articles, total = holds[id(root)], chars[id(root)]
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if id(node) not in chars:
            continue
        if node.maybe and not holds[id(node)] and (articles or 2 * chars[id(node)] <= total):
            continue
        if node.text:
            out.append(node.text)
        stack += node.nodes[::-1]
    return out


class Shape:
    """A tree for alignment: texts are hashes."""

    __slots__ = (
        "sign", "hash", "nodes", "number", "article", "node", "size", "shared", "key", "kind", "links", "chars", "linked",
    )

    def __init__(self, sign, number, article, node=None):
        self.sign, self.number, self.article, self.node = sign, number, article, node
        self.hash, self.nodes = 0, []
        self.links = self.chars = self.linked = 0

    @property
    def menu(self) -> bool:
        """A list of links, whatever they say."""
        return self.links >= LINKS and self.linked >= LINKED * self.chars


def shaped(root: Node) -> Shape:
    """The shape of a tree, numbered from above; text comes in through hashes only."""
    numbers = iter(range(1 << 60))

    def build(node: Node) -> Shape:
        shape = Shape(node.sign, next(numbers), node.article, node)
        shape.chars = len(node.text)
        if node.article:  # slots all the way down, which are no template
            texts = _texts(node)
            shape.hash, shape.chars = xxh64_intdigest("\x00".join([node.sign, *texts])), sum(map(len, texts))
        else:
            shape.nodes = [build(child) for child in node.nodes]
            shape.hash = xxh64_intdigest("\x00".join([node.sign, node.text, *(str(s.hash) for s in shape.nodes)]))
            shape.links = int(node.linked) + sum(s.links for s in shape.nodes)
            shape.linked = node.linked * len(node.text) + sum(s.linked for s in shape.nodes)
            shape.chars += sum(s.chars for s in shape.nodes)
        return shape

    return build(root)


def _texts(node: Node) -> list[str]:
    out, stack = [], [node]
    while stack:
        node = stack.pop()
        if node.text:
            out.append(node.text)
        stack += node.nodes[::-1]
    return out


def packed(shape: Shape) -> list:
    return [shape.sign, shape.hash, int(shape.article), [packed(s) for s in shape.nodes], shape.links, shape.linked, shape.chars]


def unpacked(data: list) -> Shape:
    numbers = iter(range(1 << 60))

    def build(data: list) -> Shape:
        shape = Shape(data[0], next(numbers), bool(data[2]))
        shape.hash, shape.nodes = data[1], [build(d) for d in data[3]]
        if len(data) > 4:
            shape.links, shape.linked, shape.chars = data[4:]
        return shape

    return build(data)


def aligned(a: Shape, b: Shape) -> list[tuple[Shape, Shape]]:
    """The pairs of a largest matching of two trees: simple tree matching.

    Where siblings have the same sign, signs don't tell which is which: the pairs
    of their list count by equal nodes first and by matched nodes second.
    """
    return _Matching(a, b).pairs(a, b) if a.sign == b.sign else []


class _Matching:
    """Weights of pairs of subtrees, each worked out once for all subtrees that differ only in texts that the other lacks."""

    def __init__(self, a: Shape, b: Shape):
        self.keys: dict[tuple, int] = {}
        self.named: dict[tuple, int] = {}
        self.known: dict[tuple, tuple[int, int]] = {}
        both = self.hashes(a) & self.hashes(b)
        self.mark(a, both)
        self.mark(b, both)

    @staticmethod
    def hashes(root: Shape) -> set[int]:
        out, stack = set(), [root]
        while stack:
            node = stack.pop()
            out.add(node.hash)
            stack += node.nodes
        return out

    def mark(self, node: Shape, both: set[int]) -> None:
        for child in node.nodes:
            self.mark(child, both)
        own, keys = (node.hash,) if node.hash in both else (), self.keys
        if not node.nodes:
            kind = (node.sign,)
            node.size, node.shared = 1, frozenset(own)
            node.key = keys.setdefault(own or kind, len(keys))
            node.kind = keys.setdefault(kind, len(keys))
            return
        node.size = 1 + sum([c.size for c in node.nodes])
        node.shared = frozenset(own).union(*[c.shared for c in node.nodes if c.shared])
        node.key = keys.setdefault(own or (node.sign, *[c.key for c in node.nodes]), len(keys))
        node.kind = keys.setdefault((node.sign, *[c.kind for c in node.nodes]), len(keys))

    def key(self, node: Shape, common: frozenset) -> int:
        """The number of a subtree in which only the texts of ``common`` hashes count."""
        common = common and common & node.shared
        if not common:
            return node.kind
        if (node.key, common) not in self.named:
            key = (node.hash,) if node.hash in common else (node.sign, *(self.key(c, common) for c in node.nodes))
            self.named[node.key, common] = self.keys.setdefault(key, len(self.keys))
        return self.named[node.key, common]

    def weight(self, x: Shape, y: Shape) -> tuple[int, int]:
        """(equal nodes, matched nodes) of the best matching of two nodes of one sign."""
        if x.hash == y.hash:
            return x.size, x.size
        common = x.shared & y.shared
        pair = self.key(x, common), self.key(y, common)
        if pair not in self.known:
            equal, size = 0, 1
            for c, d in self.children(x.nodes, y.nodes):
                e, n = self.weight(c, d)
                equal, size = equal + e, size + n
            self.known[pair] = equal, size
        return self.known[pair]

    def pairs(self, a: Shape, b: Shape) -> list[tuple[Shape, Shape]]:
        out, stack = [], [(a, b)]
        while stack:
            x, y = stack.pop()
            out.append((x, y))
            stack += zip(x.nodes, y.nodes) if x.hash == y.hash else self.children(x.nodes, y.nodes)
        return out

    def children(self, xs: list[Shape], ys: list[Shape]) -> list[tuple[Shape, Shape]]:
        """The best pairs of two lists of siblings, in order."""
        if not xs or not ys:
            return []
        if len(xs) == len(ys) == 1:
            return [(xs[0], ys[0])] if xs[0].sign == ys[0].sign else []
        # Equal ends belong to a best alignment.
        front, most = 0, min(len(xs), len(ys))
        while front < most and xs[front].hash == ys[front].hash:
            front += 1
        back = 0
        while back < most - front and xs[-1 - back].hash == ys[-1 - back].hash:
            back += 1
        out = list(zip(xs[:front], ys[:front]))
        tail = list(zip(xs[len(xs) - back :], ys[len(ys) - back :]))
        repeated = any(len({c.sign for c in part}) < len(part) for part in (xs, ys))
        xs, ys = xs[front : len(xs) - back], ys[front : len(ys) - back]
        if xs and ys:
            out += self.between(xs, ys, repeated)
        return out + tail

    def between(self, xs: list[Shape], ys: list[Shape], repeated: bool) -> list[tuple[Shape, Shape]]:
        groups: dict[int, list[int]] = {}
        for j, y in enumerate(ys):
            groups.setdefault(y.key, []).append(j)
        firsts = [(ys[g[0]], k) for k, g in enumerate(groups.values())]
        if len(xs) * len(ys) <= FEW_CELLS:
            return self.few(xs, ys, firsts, {k: n for n, k in enumerate(groups)}, repeated)
        place = np.empty(len(ys), np.int64)
        for k, g in enumerate(groups.values()):
            place[g] = k
        rows: dict[int, np.ndarray] = {}

        def row(x: Shape) -> np.ndarray:
            """The weights of a node with each of ``ys``; zero where the signs differ."""
            if x.key not in rows:
                worth = np.zeros(len(firsts), np.int64)
                for y, k in firsts:
                    if x.sign == y.sign:
                        equal, size = self.weight(x, y)
                        worth[k] = (equal << 31) + size if repeated else size
                rows[x.key] = worth
            return rows[x.key][place]

        out: list[tuple[Shape, Shape]] = []
        parts = [(0, len(xs), 0, len(ys))]
        while parts:
            a, b, c, d = parts.pop()
            if a == b or c == d:
                continue
            if b - a > 1 and (b - a) * (d - c) > CELLS:  # in halves, so that a table never gets large
                middle = (a + b) // 2
                down = up = np.zeros(d - c + 1, np.int64)
                for i in range(a, middle):
                    down = _step(down, row(xs[i])[c:d])
                for i in range(b - 1, middle - 1, -1):
                    up = _step(up, row(xs[i])[c:d][::-1])
                cut = c + int(np.argmax(down + up[::-1]))
                parts += [(middle, b, cut, d), (a, middle, c, cut)]
                continue
            best = [np.zeros(d - c + 1, np.int64)]
            for i in range(a, b):
                best.append(_step(best[-1], row(xs[i])[c:d]))
            i, j, found = b - a, d - c, []
            while i and j:
                if best[i][j] == best[i - 1][j]:
                    i -= 1
                elif best[i][j] == best[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    found.append((xs[a + i], ys[c + j]))
            out += found[::-1]
        return out


    def few(self, xs, ys, firsts, group: dict[int, int], repeated: bool) -> list[tuple[Shape, Shape]]:
        """The pairs of ``between`` for short lists: the same table, cell by cell."""
        place = [group[y.key] for y in ys]
        rows: dict[int, list[int]] = {}
        best = [[0] * (len(ys) + 1)]
        for x in xs:
            if x.key not in rows:
                worth = [0] * len(firsts)
                for y, k in firsts:
                    if x.sign == y.sign:
                        equal, size = self.weight(x, y)
                        worth[k] = (equal << 31) + size if repeated else size
                rows[x.key] = worth
            worth, above, last = rows[x.key], best[-1], 0
            row = [0]
            for j, k in enumerate(place):
                most = above[j + 1]
                if last > most:
                    most = last
                if worth[k] and above[j] + worth[k] > most:
                    most = above[j] + worth[k]
                row.append(most)
                last = most
            best.append(row)
        i, j, out = len(xs), len(ys), []
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append((xs[i], ys[j]))
        return out[::-1]


def _step(above: np.ndarray, worth: np.ndarray) -> np.ndarray:
    """The next row of an alignment's table."""
    row = above.copy()
    np.maximum(row[1:], np.where(worth > 0, above[:-1] + worth, 0), out=row[1:])
    return np.maximum.accumulate(row)


def _text_of(html: bytes | None) -> str:
    return (html or b"").decode("utf-8", "replace")


def tree_of(html: bytes | None) -> dict:
    """The layout of a page, and its shape as JSON."""
    root = parsed(_text_of(html))
    return {"layout": layout_of(root), "tree": json.dumps(packed(shaped(root)), separators=(",", ":"))}


class _References:
    """Unpacked reference trees, the latest ones up to a number of nodes."""

    def __init__(self):
        self.known: OrderedDict[str, tuple[Shape, int]] = OrderedDict()
        self.nodes = 0

    def get(self, tree: str) -> Shape:
        if tree in self.known:
            self.known.move_to_end(tree)
            return self.known[tree][0]
        size = tree.count("[")
        self.known[tree] = unpacked(json.loads(tree)), size
        self.nodes += size
        while self.nodes > KEPT_NODES and len(self.known) > 1:
            self.nodes -= self.known.popitem(last=False)[1][1]
        return self.known[tree][0]


_references = _References()


def votes(reference: str, tree: str) -> list[int]:
    """The nodes of the reference that are matched with the same text, and as negative numbers its menus matched with menus."""
    out = []
    for a, b in aligned(_references.get(reference), unpacked(json.loads(tree))):
        if not a.article and a.hash == b.hash:
            out.append(a.number)
        if a.menu and b.menu:
            out.append(~a.number)
    return out


def covered(reference: str, template: list[int]) -> float:
    """The share of the reference's text that a template takes."""
    fixed, taken = set(template), 0
    root = unpacked(json.loads(reference))
    stack = [root]
    while stack:
        node = stack.pop()
        if node.number in fixed or ~node.number in fixed:
            taken += node.chars
        else:
            stack += node.nodes
    return taken / max(1, root.chars)


def extracted(html: bytes | None, reference: str | None, template: list[int] | None) -> str:
    """The blocks of the slots of a page, one to a line."""
    root = parsed(_text_of(html))
    return "\n".join(blocks(root, _template(root, reference, template)))


def _template(root: Node, reference: str | None, template: list[int] | None) -> set[int]:
    """The ids of a tree's nodes that a wrapper knows as template."""
    if reference is None or not template:
        return set()
    fixed = set(template)
    return {
        id(b.node)
        for a, b in aligned(_references.get(reference), shaped(root))
        if a.number in fixed and a.hash == b.hash or ~a.number in fixed and b.menu
    }


def layout_of(root: Node) -> str:
    """The layout of a page: which signs occur below which, however often, articles apart."""
    paths, stack = set(), [("", root)]
    while stack:
        above, node = stack.pop()
        path = f"{above}/{node.sign}"
        if node.sign != "#":
            paths.add(path)
        if not node.article:
            stack += ((path, n) for n in node.nodes)
    return f"{xxh64_intdigest(chr(0).join(sorted(paths))):016x}"


def hashes_of(tree: str) -> list[str]:
    """The different nodes of a tree outside articles."""
    out, stack = set(), [unpacked(json.loads(tree))]
    while stack:
        node = stack.pop()
        if not node.article:
            out.add(f"{node.hash:x}")
        stack += node.nodes
    return sorted(out)


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, layout, reference, template) of the layouts of (page_id, host, html) rows."""
    found = per_row(tree_of, "struct<layout:string, tree:string>")(F.col("html").cast("binary")).alias("found")
    trees = landed(pages.select("page_id", "host", found).select("page_id", "host", "found.*"), "trees")
    distinct = trees.groupBy("host", "layout", F.xxhash64("tree").alias("h")).agg(
        F.min("page_id").alias("page_id"), F.first("tree").alias("tree")
    )
    distinct = landed(distinct, "distinct-trees")
    # Groupings have keys of their own: their rows are then dealt anew for the join,
    # and a large host's part of it can be split.
    layouts = distinct.groupBy(F.struct("host", "layout").alias("of")).agg(F.count(F.lit(1)).alias("n"))
    layouts = landed(layouts.select("of.*", "n"), "layouts")
    # Layouts of too few trees share a wrapper, learned from all trees of the host; its layout is "".
    hosts = layouts.groupBy(F.struct("host").alias("of")).agg(F.sum("n").alias("n"), F.min("n").alias("least"))
    hosts = hosts.where((F.col("n") >= MIN_PAGES) & (F.col("least") < MIN_PAGES)).select("of.host", "n")
    columns = ["host", "layout", "n", "page_id", "h", "tree"]
    members = distinct.join(layouts.where(F.col("n") >= MIN_PAGES), ["host", "layout"]).select(columns).unionByName(
        distinct.join(hosts, "host").withColumn("layout", F.lit("")).select(columns)
    )
    # Template nodes are among the nodes that so many trees have; the reference is the tree with most of these.
    often = (
        members.select("host", "layout", "n", F.explode(per_row(hashes_of, "array<string>")("tree")).alias("hash"))
        .groupBy(F.struct("host", "layout", "n", "hash").alias("of"))
        .agg(F.count(F.lit(1)).alias("held"))
        .where(F.col("held") >= CONSTANT * F.col("of.n"))
        .groupBy(F.struct("of.host", "of.layout").alias("of"))
        .agg(F.collect_list("of.hash").alias("often"))
        .select("of.*", "often")
    )
    held = per_row(lambda tree, often: len(set(often).intersection(hashes_of(tree))), "int")
    reference = (
        members.join(landed(often, "often"), ["host", "layout"])
        .withColumn("held", held("tree", "often"))
        .groupBy(F.struct("host", "layout", "n").alias("of"))
        .agg(F.min(F.struct(-F.col("held"), F.col("page_id").isNull(), "page_id", "h", "tree"))["tree"].alias("reference"))
        .select("of.*", "reference")
    )
    reference = landed(reference, "references")
    voted = per_row(votes, "array<int>")("reference", "tree")
    counts = (
        members.drop("n").join(reference, ["host", "layout"])
        .select("host", "layout", "n", F.explode(voted).alias("node"))
        .groupBy(F.struct("host", "layout", "n", "node").alias("of"))
        .agg(F.count(F.lit(1)).alias("same"))
        .select("of.*", "same")
        .where(F.col("same") >= CONSTANT * F.col("n"))
    )
    template = counts.groupBy("host", "layout").agg(F.collect_list("node").alias("template"))
    trusted = per_row(covered, "double")("reference", "template") <= MOST
    learned = landed(reference.drop("n").join(template, ["host", "layout"]).where(trusted), "wrappers")
    by = F.when(F.col("n") >= MIN_PAGES, F.col("layout")).otherwise("")
    return layouts.withColumn("by", by).drop("n").join(
        learned.withColumnRenamed("layout", "by"), ["host", "by"]
    ).select("host", "layout", "reference", "template")


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for every row of (page_id, url, html)."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    pages = pages.select("page_id", "url", F.coalesce(host, F.lit("")).alias("host"), "html")
    html = F.col("html").cast("binary")
    known = landed(wrappers(pages), "known-wrappers")
    (size,) = known.agg(F.sum(F.length("reference") + 8 * F.size("template") + 200)).first()
    if (size or 0) > SENT_BYTES:
        layout = per_row(tree_of, "struct<layout:string, tree:string>")(html)["layout"]
        joined = pages.withColumn("layout", layout).join(known, ["host", "layout"], "left")
        return joined.select("page_id", "url", per_row(extracted, "string")(html, "reference", "template").alias("text"))
    by_layout = {(r.host, r.layout): (r.reference, r.template) for r in known.collect()}
    sent = pages.sparkSession.sparkContext.broadcast(by_layout)

    def text_of(page: bytes | None, host: str) -> str:
        root = parsed(_text_of(page))
        return "\n".join(blocks(root, _template(root, *sent.value.get((host, layout_of(root)), (None, None)))))

    return pages.select("page_id", "url", per_row(text_of, "string")(html, "host").alias("text"))
