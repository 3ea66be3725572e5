"""Main text of web pages by wrapper induction.

The pages of a host are aligned with one of them by simple tree matching (Yang, 1991). Over all
pages, a node of that reference page either holds the same text nearly everywhere, so it is
template, or it is a slot whose text varies. All slots of a page give its main text, or those
in its <article> and <main> elements, with the headline before them, if these hold most of them;
elements that announce themselves as something else (menus, forms, ...) are left out. A class name
announces nothing on a host where the elements that bear it hold most of the varying text, nor on
a heading, and inside an article only if it says nothing else.

Subtrees of equal shape match as a whole, and of two lists of children only what lies between
their equal ends is aligned, in memory that grows with the lists.

Each html of a host counts once, and what may be a copy of the reference only if many different ones
are. Only sums per host and reference node are gathered. The wrappers of hosts with a thousandth of
all pages, a thousand hosts at most, are broadcast; so no hot host is shuffled, and pages of
other hosts are joined to theirs.
"""

import re
import sys
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ohlcraft.llm.common import stage

#: Pages of about so many characters serve as references.
REFERENCE_CHARS = 4000
#: Hosts with this share of all pages are broadcast, if the reference isn't longer than that.
HOT_SHARE, HOT_CHARS = 0.001, 1 << 16
#: Trees are walked recursively; elements may be nested that deep.
DEPTH = 1_000_000
#: A node is template if it is the same on this share of the pages beside the reference that have it:
#: half of the host's pages or more, or so many.
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.9, 9
#: Inside an article, so many pages must be the same: two articles may end alike.
ARTICLE_PAGES = 3
#: Shapes of subtrees and alignments of them that a reference page keeps.
KEPT_SHAPES = 20_000
#: Cells of an alignment that are held at once.
CELLS = 1 << 20
#: A page that shares so much of its text with the reference may be a copy of it.
COPY_SHARE = 0.9

# HTML's elements by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter q s samp small "
    "span strike strong sub sup time tt u var wbr".split())
BOILERPLATE = frozenset(
    "head nav header footer aside form script style noscript template iframe svg button select option textarea menu "
    "dialog object embed canvas audio video map noembed noframes title".split())
# an opening tag closes these
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}}
BLOCKS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr main menu nav ol p pre section table ul".split())
NAMES = re.compile(
    r"ads?|adverts?|advertisement|advertising|banner|sidebar|menu|nav|navbar|navigation|footer|header|masthead|"
    r"breadcrumbs?|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|subscription|"
    r"social|share|sharing|related|recommended|recommendations|promo|promoted|sponsored?|sponsor|comments?|disqus|replies|"
    r"widget|toolbar|login|signin|signup|search|pagination|pager|copyright|contentinfo|complementary|dialog|skip")
# of these, what the parts of an article may be, too
OF_ARTICLES = re.compile(
    r"header|masthead|footer|notices?|alert|modal|overlay|search|copyright|contentinfo|complementary|dialog|skip")
# says nothing about what an element holds
PLAIN = re.compile(
    r"box|blocks?|lists?|links?|buttons?|bar|area|inner|outer|wrap|wrapper|container|section|panel|items?|icons?|posts?|"
    r"articles?|stories|top|bottom|left|right")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
WHOLE = re.compile(r"content|article|main|post|entry|story|body|page|wrapper|container|has|with|no")

_TAG = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)
_ENDS = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}


class Node:
    """An element; ``parts`` are its texts and child elements in order, ``names`` the words of its
    class, id or role that announce something else than main text."""

    __slots__ = ("tag", "parts", "children", "skipped", "names", "number", "own", "shape", "shapes", "said")

    def __init__(self, tag: str, skipped: bool, names: frozenset[str] = frozenset()) -> None:
        self.tag, self.skipped, self.names = tag, skipped, names
        self.parts: list = []
        self.children: list[Node] = []
        self.said: str | None = None

    def text(self) -> str:
        """The texts directly inside, and those of inline children."""
        if self.said is None:
            self.said = " ".join(unescape("".join(self._own())).split())
        return self.said

    def _own(self) -> Iterator[str]:
        for part in self.parts:
            if isinstance(part, str):
                yield part
            elif part.skipped or part.names:
                yield " "
            elif part.tag in INLINE:
                yield from part._own() if part.tag != "br" else " "
            else:
                yield " "


def _announced(tag: str, marks: str, inside: bool) -> tuple[bool, frozenset[str]]:
    """Is the element no main text by its tag or hidden, and the words that say so by name.
    Headers inside an article are main text, and names there must say nothing else."""
    if tag in BOILERPLATE:
        return not (tag == "header" and inside), frozenset()
    if not marks or tag in ("html", "body", "main", "article"):
        return False, frozenset()
    words: set[str] = set()
    for found in _ATTRIBUTE.finditer(marks):
        key, value = found[1].lower(), found[2] or found[3] or found[4] or ""
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _HIDDEN.search(value):
            return True, frozenset()
        if key in ("class", "id", "role") and tag not in HEADINGS:
            for name in value.lower().split():
                parts = [w for w in re.split(r"[-_:]+", name) if w]
                said = {w for w in parts if NAMES.fullmatch(w)}
                if inside:
                    if not any(map(OF_ARTICLES.fullmatch, said)) and all(w in said or PLAIN.fullmatch(w) for w in parts):
                        words |= said
                elif not any(map(WHOLE.fullmatch, parts)):
                    words |= said
    return False, frozenset(words)


def parse(html: str) -> Node:
    """The tree of a page; its nodes have numbers in page order."""
    root = Node("html", False)
    stack, at, inside = [root], 0, 0
    while True:
        found = _TAG.search(html, at)
        if html_end := found is None:
            rest = html[at:]
        else:
            rest = html[at:found.start()]
        if rest:
            stack[-1].parts.append(rest)
        if html_end:
            break
        at, name = found.end(), (found[2] or "").lower()
        if not name or name == "html":
            continue
        if found[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == name:
                    for node in stack[depth:]:
                        inside -= node.tag in ("article", "main")
                    del stack[depth:]
                    break
                if name in INLINE and stack[depth].tag not in INLINE:
                    break  # a stray end of an inline element closes no block
            continue
        closed = CLOSES.get(name)
        if closed or name in BLOCKS:
            for depth in range(len(stack) - 1, 0, -1):
                tag = stack[depth].tag
                if tag in closed if closed else tag == "p":
                    del stack[depth:]
                    break
                if tag not in INLINE and tag != "p" and not (closed and tag in ("tbody", "thead", "tfoot", "td", "th")):
                    break
        announced, words = _announced(name, found[3], inside > 0)
        node = Node(name, stack[-1].skipped or announced, words)
        stack[-1].parts.append(node)
        stack[-1].children.append(node)
        if name in RAW:
            end = _ENDS[name].search(html, at)
            at = end.end() if end else len(html)
            node.skipped = True
        elif name not in VOID and not found[3].endswith("/"):
            stack.append(node)
            inside += name in ("article", "main")
    number(root)
    return root


def number(root: Node) -> list[Node]:
    """Numbers the elements that aren't inline, in page order."""
    found, left = [], [root]
    while left:
        node = left.pop()
        node.number = len(found)
        found.append(node)
        node.children = [child for child in _blocks(node)]
        left.extend(reversed(node.children))
    return found


def _blocks(node: Node) -> Iterator[Node]:
    """Child elements that aren't inline, those inside inline ones included."""
    for child in node.parts:
        if not isinstance(child, str):
            if child.tag in INLINE and not child.skipped and not child.names:
                yield from _blocks(child)
            else:
                yield child


def nodes(root: Node) -> list[Node]:
    found, left = [], [root]
    while left:
        node = left.pop()
        found.append(node)
        left.extend(reversed(node.children))
    return found


def name_masses(page: Node, constant: set[int]) -> dict[str, int]:
    """By name, the text in elements that bear it, apart from nodes whose id is in ``constant``;
    under "" all such text. No names count if an <article> or <main> outside them holds some."""
    found: dict[str, int] = {"": 0}
    marked = False
    left = [(page, page.names, False)]
    while left:
        node, names, inside = left.pop()
        if node.skipped:
            continue
        inside = inside or node.tag in ("article", "main")
        size = 0 if id(node) in constant else len(node.text())
        if size:
            marked = marked or inside and not names
            for name in ("", *names):
                found[name] = found.get(name, 0) + size
        left.extend((child, names | child.names, inside) for child in node.children)
    return {"": found[""]} if marked else found


def void_names(masses: dict[str, int]) -> set[str]:
    """The names that hold most of the text."""
    return {name for name, size in masses.items() if name and 2 * size > masses[""]}


def skip_named(page: Node, void: set[str]) -> None:
    """Skips the elements that are announced by other names, and what is in them."""
    left = [(page, False)]
    while left:
        node, skipped = left.pop()
        node.skipped = node.skipped or skipped or bool(node.names - void)
        left.extend((child, node.skipped) for child in node.children)


class Shapes:
    """Numbers of the shapes of subtrees: of tags and children, not texts; and how well two match."""

    def __init__(self) -> None:
        self._numbers: dict[tuple, int] = {}
        self._sizes: list[int] = []
        self._matched: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}

    def __len__(self) -> int:
        return len(self._numbers) + len(self._matched)

    def mark(self, root: Node) -> None:
        """Sets the shapes of all nodes of a tree."""
        for node in reversed(nodes(root)):
            parts = () if node.skipped else tuple([child.shape for child in node.children])
            node.shape = self._numbers.setdefault((node.tag, node.skipped, parts), len(self._numbers))
            if node.shape == len(self._sizes):
                self._sizes.append(1 + sum([self._sizes[shape] for shape in parts]))

    def score(self, a: Node, b: Node) -> int:
        """How many nodes of two subtrees match."""
        if a.shape == b.shape:
            return self._sizes[a.shape]
        if (a.tag, a.skipped) != (b.tag, b.skipped):
            return 0
        if a.skipped or not a.children or not b.children:
            return 1
        return self.matched(a, b)[0]

    def matched(self, a: Node, b: Node) -> tuple[int, list[tuple[int, int]]]:
        """The score of two subtrees whose roots match, and the places of the children that do."""
        if a.skipped:
            return 1, []
        place = a.shape, b.shape
        if place not in self._matched:
            x, y = a.children, b.children
            first, last = 0, 0
            least = min(len(x), len(y))
            while first < least and x[first].shape == y[first].shape:
                first += 1
            while last < least - first and x[-1 - last].shape == y[-1 - last].shape:
                last += 1
            pairs = [(i, i) for i in range(first)]
            middle = self._aligned(x[first:len(x) - last], y[first:len(y) - last])
            pairs += [(first + i, first + j) for i, j in middle]
            pairs += [(len(x) - n, len(y) - n) for n in range(last, 0, -1)]
            self._matched[place] = 1 + sum([self.score(x[i], y[j]) for i, j in pairs]), pairs
        return self._matched[place]

    def _aligned(self, x: list[Node], y: list[Node]) -> list[tuple[int, int]]:
        """Places of two lists that match in order with the largest sum of scores."""
        if not x or not y:
            return []
        kinds_x, kinds_y = {n.shape: n for n in x}, {n.shape: n for n in y}
        of_x, of_y = list(kinds_x), list(kinds_y)
        scores = np.array([[self.score(kinds_x[i], kinds_y[j]) for j in of_y] for i in of_x], np.int64)
        at = {shape: j for j, shape in enumerate(of_y)}
        columns = np.array([at[n.shape] for n in y])
        rows = {shape: scores[i][columns] for i, shape in enumerate(of_x)}
        return _best_pairs([rows[n.shape] for n in x], len(y))


def _ahead(rows: list[np.ndarray], m: int) -> np.ndarray:
    """The best sums of all rows with the first 0 to m columns."""
    best = np.zeros(m + 1, np.int64)
    for row in rows:
        best[1:] = np.maximum.accumulate(np.maximum(best[1:], best[:-1] + row))
    return best


def _best_pairs(rows: list[np.ndarray], m: int, at: int = 0, left: int = 0) -> list[tuple[int, int]]:
    """The pairs of row and column, both rising, of the largest sum (Hirschberg, 1975): halves
    the rows where the table is large, so that memory grows with its sides."""
    n = len(rows)
    if not n or not m:
        return []
    if n > 1 and n * m > CELLS:
        half = n // 2
        total = _ahead(rows[:half], m) + _ahead([row[::-1] for row in rows[:half - 1:-1]], m)[::-1]
        cut = int(np.argmax(total))
        return _best_pairs([row[:cut] for row in rows[:half]], cut, at, left) + _best_pairs(
            [row[cut:] for row in rows[half:]], m - cut, at + half, left + cut)
    table = np.zeros((n + 1, m + 1), np.int64)
    for i, row in enumerate(rows):
        table[i + 1, 1:] = np.maximum.accumulate(np.maximum(table[i, 1:], table[i, :-1] + row))
    found, i, j = [], n, m
    while i and j:
        if table[i, j] == table[i - 1, j]:
            i -= 1
        elif table[i, j] == table[i, j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            found.append((at + i, left + j))
    return found[::-1]


def match(left: Node, right: Node) -> dict[int, Node]:
    """Simple tree matching: the numbers of left's nodes with their counterparts in right, as many
    as possible, in order and below matched parents. Skipped subtrees match as a whole."""
    shapes = getattr(left, "shapes", None)
    if shapes is None or len(shapes) > KEPT_SHAPES:  # a reference meets many pages
        shapes = left.shapes = Shapes()
        shapes.mark(left)
    shapes.mark(right)
    found: dict[int, Node] = {}
    left_over = [(left, right)] if shapes.score(left, right) else []
    while left_over:
        a, b = left_over.pop()
        found[a.number] = b
        if a.skipped:
            continue
        if a.shape == b.shape:
            left_over.extend(zip(a.children, b.children))
        elif a.children and b.children:
            left_over.extend((a.children[i], b.children[j]) for i, j in shapes.matched(a, b)[1])
    return found


def main_elements(page: Node, template: set[int]) -> list[Node]:
    """The outermost <article> and <main> elements and the headlines before them, if the former
    hold most of the text that isn't template; or else the whole page."""
    all_nodes = nodes(page)
    total = {}
    for node in reversed(all_nodes):
        own = 0 if node.skipped or id(node) in template else len(node.text())
        total[node.number] = own + sum([total[c.number] for c in node.children])
    marked, headlines, left = [], [], [page]
    while left:
        node = left.pop()
        if node.tag in ("article", "main") and not node.skipped:
            marked.append(node)
            continue
        if node.tag == "h1" and not marked and not node.skipped and id(node) not in template:
            headlines.append(node)
        left.extend(reversed(node.children))
    marked = [node for node in marked if total[node.number]]
    if marked and sum(total[n.number] for n in marked) > 0.6 * total[page.number]:
        return headlines + marked
    return [page]


def compared(reference: Node, page: Node) -> tuple[list[int], list[int], float, dict[str, int]]:
    """The reference nodes with a text (and the root) that have a counterpart, those of them
    with the same text, the share of the page's text in the latter, and the name masses of
    the rest."""
    seen, same, common, constant = [], [], 0, set()
    for n, node in match(reference, page).items():
        if node.skipped:
            continue
        text = reference.own[n].text()
        if text or not n:
            seen.append(n)
        if text and text == node.text():
            same.append(n)
            common += len(text)
            constant.add(id(node))
    whole = sum(len(x.text()) for x in nodes(page) if not x.skipped)
    return seen, same, common / whole if whole else 1.0, name_masses(page, constant)


def indexed(html: str) -> Node:
    """A page's tree; its root knows all nodes by number."""
    root = parse(html)
    root.own = {node.number: node for node in nodes(root)}
    return root


class Wrapper:
    """What the sums of a host say about its reference page."""

    def __init__(self, html: str, sums: list[tuple[int, str, int, int, int, int]]) -> None:
        """sums: reference node, "", pages that have it, pages with the same text, and both
        numbers of likely copies of the reference; or -1, a name and its mass."""
        self.reference = indexed(html)
        self.template = {}
        masses = {s[1]: s[2] for s in sums if s[0] < 0}
        self.void = void_names(masses) if masses else None
        sums = [(s[0], *s[2:]) for s in sums if s[0] >= 0]
        evidence = next((s[1:] for s in sums if s[0] == 0), (0, 0, 0, 0))
        copies = evidence[2] >= TEMPLATE_PAGES  # so many different ones aren't copies
        least = max(1, min(TEMPLATE_PAGES, (evidence[0] + copies * evidence[2]) / 2))
        inside = inside_articles(self.reference)
        for n, pages, same, more, more_same in sums:
            if copies:
                pages, same = pages + more, same + more_same
            if pages >= (max(least, ARTICLE_PAGES) if n in inside else least) and same and same >= TEMPLATE_SHARE * pages:
                self.template[n] = self.reference.own[n].text()

    def text(self, page: Node) -> str:
        matched = match(self.reference, page)
        template = {
            id(matched[n]) for n, text in self.template.items() if n in matched and matched[n].text() == text}
        skip_named(page, void_names(name_masses(page, set())) if self.void is None else self.void)
        return _joined(main_elements(page, template), template) or _joined(main_elements(page, set()), set())


def inside_articles(page: Node) -> set[int]:
    """Numbers of the nodes in an <article> or <main>."""
    found, left = set(), [(page, False)]
    while left:
        node, inside = left.pop()
        inside = inside or node.tag in ("article", "main")
        if inside:
            found.add(node.number)
        left.extend((child, inside) for child in node.children)
    return found


def _joined(elements: list[Node], template: set[int]) -> str:
    return "\n".join(block for node in elements for block in blocks(node, template))


def blocks(node: Node, template: set[int] = frozenset()) -> Iterator[str]:
    """The block texts in page order. Text before, between and after child blocks is a block."""
    pieces: list[str] = []

    def flushed() -> Iterator[str]:
        text = " ".join(unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            yield text

    left: list = [iter(node.parts)]
    hidden = [id(node) in template]
    while left:
        part = next(left[-1], None)
        if part is None:
            left.pop()
            if hidden.pop() is not None:
                yield from flushed()
        elif isinstance(part, str):
            if not next(h for h in reversed(hidden) if h is not None):
                pieces.append(part)
        elif part.tag == "br" or part.skipped and part.tag in INLINE:
            pieces.append(" ")
        elif part.tag in INLINE:
            left.append(iter(part.parts))
            hidden.append(None)  # as the block around it
        else:
            yield from flushed()
            if not part.skipped:
                left.append(iter(part.parts))
                hidden.append(id(part) in template)


def _host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url.cast("string"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def _with_hosts(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """Pages joined to their hosts' rows. The hot ones, at most 1 / HOT_SHARE of bounded size,
    are broadcast; the others hold no large share of the pages each."""
    hot, cold = hosts.where("hot").drop("hot"), hosts.where("NOT hot").drop("hot")
    rest = pages.join(F.broadcast(hot.select("host")), "host", "left_anti")
    return pages.join(F.broadcast(hot), "host").unionByName(rest.join(cold, "host"))


def references(pages: DataFrame) -> DataFrame:
    """host, reference, hot: of each host the page nearest to REFERENCE_CHARS."""
    distance = F.struct(F.abs(F.length("html") - REFERENCE_CHARS).alias("off"), "html")
    hosts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.min(distance).alias("best"))
    all_pages = F.lit(pages.count())
    return hosts.select(
        "host", F.col("best.html").alias("reference"),
        ((F.col("n") >= HOT_SHARE * all_pages) & (F.length("best.html") <= HOT_CHARS)).alias("hot"))


def induce(pages: DataFrame) -> DataFrame:
    """host, reference, hot, sums: the wrappers of rows (host, html), from all pages."""
    hosts = stage(references(pages), "references")
    kind = "host string, digest binary, seen binary, same binary, copy boolean, masses map<string, long>"

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sys.setrecursionlimit(DEPTH)
        trees: dict[str, Node] = {}
        done: set = set()
        for batch in batches:
            rows = []
            for host, html, reference in zip(*(c.to_pylist() for c in batch.columns)):
                digest = xxhash.xxh3_128_digest(html)
                if (host, digest) in done or html == reference:
                    continue
                if len(done) > 100_000:
                    done.clear()
                done.add((host, digest))
                if host not in trees:
                    if len(trees) > 2000:
                        trees.clear()
                    trees[host] = indexed(reference)
                seen, same, share, masses = compared(trees[host], parse(html))
                rows.append((host, digest, np.array(seen, "<i4").tobytes(), np.array(same, "<i4").tobytes(), share, list(masses.items())))
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([
                pa.array(columns[0], pa.string()), *(pa.array(columns[i], pa.binary()) for i in (1, 2, 3)),
                pa.array([share >= COPY_SHARE for share in columns[4]], pa.bool_()),
                pa.array(columns[5], pa.map_(pa.string(), pa.int64()))],
                names=["host", "digest", "seen", "same", "copy", "masses"])

    aligned = _with_hosts(pages, hosts).select("host", "html", "reference").mapInArrow(align, kind)
    once = aligned.groupBy("host", "digest").agg(*(F.first(c).alias(c) for c in ("seen", "same", "copy", "masses"))).drop("digest")
    names = ["pages", "same", "copies", "copies_same"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[tuple[str, int, str], list[int]] = {}
            for host, seen, same, copy, masses in zip(*(c.to_pylist() for c in batch.columns)):
                for at, raw in ((2 * copy, seen), (2 * copy + 1, same)):
                    for n in np.frombuffer(raw, "<i4").tolist():
                        sums.setdefault((host, n, ""), [0, 0, 0, 0])[at] += 1
                for name, size in masses:
                    sums.setdefault((host, -1, name), [0, 0, 0, 0])[0] += size
            yield pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in sums], pa.string()), pa.array([k[1] for k in sums], pa.int32()),
                pa.array([k[2] for k in sums], pa.string()),
                *(pa.array([v[i] for v in sums.values()], pa.int64()) for i in range(4))], names=["host", "node", "name", *names])

    rows = once.mapInArrow(count, "host string, node int, name string, " + ", ".join(f"{c} long" for c in names))
    summed = rows.groupBy("host", "node", "name").agg(*(F.sum(c).alias(c) for c in names))
    # a reference's nodes: bounded by its length
    listed = summed.groupBy("host").agg(F.collect_list(F.struct("node", "name", *names)).alias("sums"))
    return stage(hosts.join(listed, "host", "left"), "wrappers")


def main_texts(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """page_id, url, text, n_chars for each row of ``pages``.

    Null or empty html, or a page without main text: the empty string. Pages with a null url or
    one without a host share a wrapper. Repeated rows and null ids give a row each. An empty
    table gives no rows. Other columns are not read.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"), _host(F.col(url_col)).alias("host"))
    wrappers = induce(rows.select("host", "html"))
    kind = T.StructType([
        rows.schema["page_id"], rows.schema["url"], T.StructField("text", T.StringType()),
        T.StructField("n_chars", T.LongType())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sys.setrecursionlimit(DEPTH)
        known: dict[str, Wrapper] = {}
        for batch in batches:
            hosts, htmls, refs = (batch.column(n).to_pylist() for n in ("host", "html", "reference"))
            texts = []
            for i, (host, html, reference) in enumerate(zip(hosts, htmls, refs)):
                if host not in known:
                    if len(known) > 2000:
                        known.clear()
                    known[host] = Wrapper(reference, [tuple(s.values()) for s in batch.column("sums")[i].as_py() or ()])
                texts.append(known[host].text(parse(html)))
            yield pa.RecordBatch.from_arrays([
                batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                pa.array(list(map(len, texts)), pa.int64())], names=kind.names)

    return _with_hosts(rows, wrappers).select(
        "page_id", "url", "host", "html", "reference", "sums").mapInArrow(extract, kind)
