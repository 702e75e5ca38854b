"""Main text of web pages by wrapper induction.

The pages of a host come from one template. Their DOM trees are aligned by simple tree
matching: each page is merged into the wrapper of its host, a tree whose nodes remember how
often pages have them and with which contents. Nodes with constant content are template,
nodes whose content varies are slots of content. Elements that are never part of an article
(menus, forms, scripts, ...) are known by tag, role or class and left out whatever they hold. A class alone does not
remove what is around an article, or most of what varies on the page.

The nodes of a wrapper come from all pages of the host. Pages of one shape add the same nodes,
so each different shape is merged once: up to about ``GROUP`` of them by a task, into wrappers
that are merged with each other in turn. All pages are then placed on the wrapper wherever they
are, and what they have there is added up over the cluster; parts that it has in no such place
are told apart by their path below it. So a text depends on the pages of the host only, not on
how they are dealt out.

Elements more than ``DEPTH`` deep are no nodes: their blocks of text are, in page order, in the
last one that is. Lists of more than ``LONG`` pairs of children are aligned in one pass.
"""

from __future__ import annotations

import marshal
import re
from collections import Counter
from collections.abc import Callable, Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from txvigil.llm.common import beside, stored
from txvigil.llm.urls import split_url

# So many shapes, or wrappers, are merged at once.
GROUP = 128
# So many hosts' wrappers are sent to every executor, and kept decoded by a task.
HOSTS, KEPT = 10_000, 256
# A node is template when at least so many different pages have it, nearly all alike. Inside
# an article a block must be far more constant, for copied articles repeat blocks too.
TEMPLATE_PAGES, TEMPLATE_SHARE = 4, 0.9
ARTICLE_PAGES, ARTICLE_SHARE = 16, 0.95
DEPTH = 200
# Bytes of equal values are equal in this version of marshal, which has no references.
_PLAIN = 2
# The pass looks for the slot of a run among so many following ones.
LONG, NEAR = 1 << 16, 64

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[(?P<cdata>.*?)\]\]>"
    r"|<(?P<raw>script|style|textarea|title)\b"
    r"(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</(?P=raw)\s*>|\Z)"
    # These end with their own tag if that closes itself, or if there is no other end.
    r"|<(?P<whole>template|noscript|svg|iframe|select|math|object)\b"
    r"(?:\"[^\"]*\"|'[^']*'|[^'\">])*(?:(?<=/)>|(?<!/)>.*?</(?P=whole)\s*>)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

BLOCKS = frozenset(
    "html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot caption tr td th "
    "blockquote pre section article main header footer nav aside form fieldset figure "
    "figcaption address details summary hgroup center dialog search".split()
)
_VOID = frozenset("br hr img input meta link wbr area base col embed source track param".split())
# What an opening tag closes when it is still open, up to the nearest of the second set.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
}
_NEVER = frozenset("nav aside footer form button dialog search head".split())
_ROLES = frozenset(
    "navigation banner complementary contentinfo search dialog alert menu menubar form".split()
)
_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice notices alert sidebar side menu menus nav navbar navigation "
    "breadcrumb breadcrumbs share sharing social related recommended comment comments reply replies "
    "respond disqus footer header masthead newsletter subscribe subscription popup modal overlay "
    "widget pagination pager toolbar skip login signup search form hidden".split()
)
# Words that only say where such a part is.
_PLACES = frozenset("site top bottom left right primary secondary area container wrapper box bar".split())
_CONTENT = frozenset(["article", "main"])
# Without an article, an element named by a class is kept if it holds more of the text than this.
MOST = 0.5


class Node:
    """An element of blocks, or a block of text (``text`` not None) with the tag around it.

    ``never`` says by what an element is known as no part of an article, see ``_never``.
    """

    __slots__ = ("tag", "never", "children", "text", "slot", "hashed")

    def __init__(self, tag: str, never: str = "", text: str | None = None):
        self.tag, self.never, self.text = tag, never, text
        self.children: list[Node] = []
        self.slot: Slot | None = None
        self.hashed: int | None = None

    def content(self) -> str:
        """All text below."""
        if self.text is not None:
            return self.text
        return "\n".join(c.content() for c in self.children)

    def key(self) -> int:
        """Hash of the content, the same in every process."""
        if self.hashed is None:
            self.hashed = _hash(self.content())
        return self.hashed


class Slot:
    """A node of the wrapper: how many pages have it, and the contents they have there."""

    __slots__ = ("tag", "key", "pages", "contents", "children")

    def __init__(self, tag: str, key: int = 0):
        self.tag, self.key, self.pages = tag, key, 0
        self.contents: Counter[int] = Counter()
        self.children: list[Slot] = []

    def constant(self, content: int, pages: int, share: float) -> bool:
        """Whether nearly all pages that have the slot have this content in it."""
        return self.pages >= pages and self.contents[content] >= share * self.pages

    def number(self) -> None:
        """Gives all below a key made of the way to it."""
        for i, child in enumerate(self.children):
            child.key = _hash(f"{self.key}/{i}")
            child.number()


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _named(value: str) -> set[str]:
    """The words of those classes that name a part of the page as a whole: not "no-sidebar"."""
    named: set[str] = set()
    for token in value.split():
        words = {w for w in re.split(r"[^a-z0-9]+", token) if w}
        if words & _WORDS and words <= _WORDS | _PLACES:
            named |= words & _WORDS
    return named


def _never(tag: str, attributes: str, inside: list[Node]) -> str:
    """"known" by tag, role or style, "named" by class or id only, or empty."""
    if tag in _NEVER:
        return "known"
    if tag == "header" and not any(n.tag in _CONTENT for n in inside):
        return "known"
    if not attributes.strip() or tag in ("html", "body") or tag in _CONTENT:
        return ""
    named = ""
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id") and (words := _named(value)):
            # The words name a part of the page; "header" within an article may be its title.
            if not (words <= {"header"} and any(n.tag in _CONTENT for n in inside)):
                named = "named"
        if name == "role" and value in _ROLES:
            return "known"
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return "known"
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return "known"
    return named


def parse(html: str) -> Node:
    """The page's blocks as a tree. Inline markup is part of the text of its block."""
    root = Node("#page")
    stack, text = [root], []

    def flush() -> None:
        joined = " ".join(unescape("".join(text)).split())
        text.clear()
        if joined:
            top = stack[-1]
            never = top.never if len(stack) > DEPTH else ""
            stack[min(len(stack), DEPTH) - 1].children.append(Node(top.tag, never, joined))

    def close(tags: set[str], until: set[str]) -> None:
        for at in range(len(stack) - 1, 0, -1):
            if stack[at].tag in until:
                return
            if stack[at].tag in tags:
                del stack[at:]
                return

    end = 0
    for found in _TOKEN.finditer(html):
        text.append(html[end : found.start()])
        end = found.end()
        if found["cdata"] is not None:
            text.append(found["cdata"])
            continue
        tag = found["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in ("br", "hr", "wbr"):
            if tag == "hr":
                flush()
            elif tag == "br":
                text.append(" ")
            continue
        if tag in _VOID or (tag not in BLOCKS and tag != "head"):
            continue
        flush()
        if found["close"]:
            if any(n.tag == tag for n in stack[1:]):
                while stack.pop().tag != tag:
                    pass
            continue
        if tag in ("html", "body"):
            close({"head"}, set())
        close({"p"}, BLOCKS - {"p"})
        if tag in _CLOSES:
            close(*_CLOSES[tag])
        if tag[0] == "h" and tag[1:].isdigit():
            close({"h1", "h2", "h3", "h4", "h5", "h6"}, BLOCKS - {"h1", "h2", "h3", "h4", "h5", "h6"})
        node = Node(tag, _never(tag, found["attributes"], stack))
        if len(stack) < DEPTH:
            stack[-1].children.append(node)
        elif len(stack) > DEPTH and node.never != "known":
            # Its text is no longer below the elements around it.
            node.never = stack[-1].never or node.never
        stack.append(node)
    text.append(html[end:])
    flush()
    return root


def matching(node: Node | Slot, slot: Slot) -> int:
    """Nodes that a simple tree matching of the page's node and the wrapper's pairs up."""
    if node.tag != slot.tag:
        return 0
    runs, slots = _runs(node), slot.children
    if len(runs) * len(slots) > LONG:
        found = zip(runs, _nearest(runs, slots), strict=True)
        return 1 + sum([matching(run[0], slots[at]) for run, at in found if at is not None])
    return 1 + _table(runs, slots)[-1][-1]


def _runs(node: Node | Slot) -> list[list]:
    """Children, with neighbours of one tag taken together: the repeats of one slot.

    Those of a slot are slots already.
    """
    if isinstance(node, Slot):
        return [[child] for child in node.children]
    runs: list[list[Node]] = []
    for child in node.children:
        if runs and runs[-1][0].tag == child.tag:
            runs[-1].append(child)
        else:
            runs.append([child])
    return runs


def _table(runs: list[list[Node]], slots: list[Slot]) -> list[list[int]]:
    best = [[0] * (len(slots) + 1) for _ in range(len(runs) + 1)]
    for i, run in enumerate(runs, 1):
        for j, slot in enumerate(slots, 1):
            same = best[i - 1][j - 1] + (matching(run[0], slot) if run[0].tag == slot.tag else 0)
            best[i][j] = max(best[i - 1][j], best[i][j - 1], same)
    return best


def _nearest(runs: list[list[Node]], slots: list[Slot]) -> list[int | None]:
    """A slot of the same tag for each run: from both ends, then the next one that is near."""
    found: list[int | None] = [None] * len(runs)
    start, end = 0, 0
    shorter = min(len(runs), len(slots))
    while start < shorter and runs[start][0].tag == slots[start].tag:
        found[start] = start
        start += 1
    while end < shorter - start and runs[-1 - end][0].tag == slots[-1 - end].tag:
        found[-1 - end] = len(slots) - 1 - end
        end += 1
    free = start
    for i in range(start, len(runs) - end):
        for j in range(free, min(free + NEAR, len(slots) - end)):
            if runs[i][0].tag == slots[j].tag:
                found[i], free = j, j + 1
                break
    return found


def _places(node: Node | Slot, slot: Slot) -> Iterator[tuple[int, list[Node], Slot | None]]:
    """Runs below the node with their slots, or the place where a new one would be; backwards."""
    runs, slots = _runs(node), slot.children
    i, j = len(runs), len(slots)
    if i * j > LONG:
        for run, at in zip(reversed(runs), reversed(_nearest(runs, slots)), strict=True):
            j = j if at is None else at
            yield j, run, None if at is None else slots[at]
        return
    best = _table(runs, slots)
    while i:
        if j and best[i][j] == best[i][j - 1]:
            j -= 1
        elif best[i][j] == best[i - 1][j]:
            yield j, runs[i - 1], None
            i -= 1
        else:
            yield j - 1, runs[i - 1], slots[j - 1]
            i, j = i - 1, j - 1


def merge(node: Node | Slot, slot: Slot) -> None:
    """Aligns a node of a page, or of another wrapper, with the wrapper's and adds the parts below that are new there."""
    # From the last to the first, so places stay right.
    for at, run, target in list(_places(node, slot)):
        if target is None:
            target = Slot(run[0].tag)
            slot.children.insert(at, target)
        for child in run:
            if child.children:
                merge(child, target)


def place(node: Node, slot: Slot) -> Iterator[tuple[Slot, list[Node]]]:
    """Aligns a page's node with the numbered wrapper's, which stays as it is."""
    node.slot = slot
    new: Counter[tuple[int, str]] = Counter()
    for at, run, target in _places(node, slot):
        if target is None:
            where = at, run[0].tag
            target = Slot(run[0].tag, _hash(f"{slot.key}+{at}:{run[0].tag}:{new[where]}"))
            new[where] += 1
        yield target, run
        for child in run:
            child.slot = target
            if child.text is None and child.children:
                yield from place(child, target)


def count(page: Node, wrapper: Slot, into: Counter[tuple[int, int | None]]) -> None:
    """Adds what the page has in each slot; without a content, that it has the slot at all."""
    for slot, run in place(page, wrapper):
        into[slot.key, None] += 1
        into.update({(slot.key, child.key()) for child in run})


def settle(page: Node, wrapper: Slot, constants: dict[int, tuple[int, dict[int, int]]]) -> None:
    """Places a page and tells its slots how many pages have them, and with which contents."""
    for slot, _ in place(page, wrapper):
        if slot.key in constants:
            slot.pages, contents = constants[slot.key]
            slot.contents = Counter(contents)


def wrapper_of(pages: list[Node] | list[Slot]) -> Slot:
    wrapper = Slot("#page")
    for page in pages:
        merge(page, wrapper)
    wrapper.number()
    return wrapper


def induce(pages: list[Node]) -> None:
    """Aligns the pages of one host with each other; pages with the same content count once."""
    different = list({page.key(): page for page in reversed(pages)}.values())[::-1]
    wrapper = wrapper_of(different)
    counts: Counter[tuple[int, int | None]] = Counter()
    for page in different:
        count(page, wrapper, counts)
    constants: dict[int, tuple[int, dict[int, int]]] = {}
    for (slot, content), n in counts.items():
        if content is not None:
            constants.setdefault(slot, (counts[slot, None], {}))[1][content] = n
    for page in pages:
        settle(page, wrapper, constants)


def packed_tree(node: Node) -> tuple:
    """What alignment needs of a page: tags and hashed contents."""
    below = None if node.text is not None else [packed_tree(c) for c in node.children]
    return node.tag, node.key(), below


def unpacked_tree(packed: tuple) -> Node:
    tag, key, below = packed
    node = Node(tag, text="" if below is None else None)
    node.hashed = key
    node.children = [unpacked_tree(c) for c in below or ()]
    return node


def shape(node: Node) -> tuple:
    """What a wrapper takes from a page: tags, and in a run of one tag what differs."""
    below: list[tuple] = []
    for run in _runs(node):
        below.extend(dict.fromkeys(shape(child) for child in run))
    return node.tag, tuple(below)


def unpacked_shape(packed: tuple) -> Node:
    node = Node(packed[0])
    node.children = [unpacked_shape(c) for c in packed[1]]
    return node


def packed_slots(slot: Slot) -> tuple:
    return slot.tag, [packed_slots(c) for c in slot.children]


def unpacked_slots(packed: tuple) -> Slot:
    slot = Slot(packed[0])
    slot.children = [unpacked_slots(c) for c in packed[1]]
    return slot


class Wrappers:
    """Decoded wrappers of the hosts met last; ``of`` must not be kept over another call."""

    def __init__(self):
        self.known: dict[str, tuple[Slot, dict]] = {}

    def of(self, host: str, packed: pa.Scalar, constants: pa.Scalar | None = None) -> tuple[Slot, dict]:
        if host not in self.known:
            if len(self.known) >= KEPT:
                del self.known[next(iter(self.known))]
            wrapper = unpacked_slots(marshal.loads(packed.as_py()))
            wrapper.number()
            found: dict[int, tuple[int, dict[int, int]]] = {}
            for row in (constants.as_py() if constants is not None else None) or ():
                found.setdefault(row["slot"], (row["pages"], {}))[1][row["content"]] = row["n"]
            self.known[host] = wrapper, found
        return self.known[host]


def main_text(page: Node) -> str:
    """The blocks of the article, or of the page where no element is marked as one."""
    found = list(_articles(page, False)) or list(_articles(page, True))
    blocks: list[str] = []
    for root in found or [page]:
        # What a class removes is kept if there is nothing, or not as much, besides.
        share = 1.0 if found else MOST
        _collect(root, bool(found), share * _varying(root, bool(found)), blocks)
    return "\n".join(blocks)


def _articles(node: Node, named: bool) -> Iterator[Node]:
    """Elements marked as articles; those in elements that a class names only if asked for."""
    for child in node.children:
        if child.never == "known" or (child.never and not named):
            continue
        if child.tag in _CONTENT and child.text is None:
            inner = list(_articles(child, named)) if child.tag == "main" else []
            yield from inner or [child]
        else:
            yield from _articles(child, named)


def _left_out(node: Node, article: bool) -> bool:
    pages, share = (ARTICLE_PAGES, ARTICLE_SHARE) if article else (TEMPLATE_PAGES, TEMPLATE_SHARE)
    return node.never == "known" or bool(node.slot and node.slot.constant(node.key(), pages, share))


def _varying(node: Node, article: bool) -> int:
    """Characters below that are neither template nor in elements known by more than a class."""
    if node.text is not None:
        return len(node.text)
    return sum(_varying(c, article) for c in node.children if not _left_out(c, article))


def _collect(node: Node, article: bool, most: float, blocks: list[str]) -> None:
    for child in node.children:
        if _left_out(child, article):
            continue
        if child.never and not _holds(_varying(child, article), article, most):
            continue
        if child.text is None:
            _collect(child, article, most, blocks)
        else:
            blocks.append(child.text)


def _holds(size: int, article: bool, most: float) -> bool:
    return size >= most if article else size > most


def induced(shapes: DataFrame, group: int = GROUP) -> DataFrame:
    """(host, wrapper) of hosts from the packed shapes of all their pages.

    Which shapes are merged with each other depends on their hashes and on how many a host has.
    """

    def merging(unpacked: Callable[[tuple], Node | Slot]) -> Callable:
        def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                found = []
                for several in part.column(2):
                    found.append(packed_slots(wrapper_of([unpacked(marshal.loads(one.as_py())) for one in several])))
                packed = pa.array([marshal.dumps(wrapper, _PLAIN) for wrapper in found], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), packed], names=["host", "part", "wrapper"]
                )

        return work

    shapes = stored(shapes.distinct())
    sizes = shapes.groupBy("host").agg(F.ceil(F.count("*") / group).alias("parts"))
    part = F.pmod(F.xxhash64("shape"), F.col("parts")).alias("part")
    rows = shapes.join(beside(stored(sizes), HOSTS), "host").select("host", part, F.col("shape").alias("wrapper"))
    unpacked: Callable[[tuple], Node | Slot] = unpacked_shape
    while True:
        several = rows.groupBy("host", "part").agg(F.sort_array(F.collect_list("wrapper")))
        rows = stored(several.mapInArrow(merging(unpacked), "host string, part long, wrapper binary"))
        if rows.filter("part > 0").isEmpty():
            return rows.drop("part")
        rows = rows.withColumn("part", F.floor(F.col("part") / group))
        unpacked = unpacked_slots


def extracted(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    A null or empty page has an empty text. Pages without host are treated as one host's.
    Repeated rows come out as often as they come in. A page that is alone on its host has
    nothing to be aligned with; the known elements are all that is left out of it.
    """
    rows = split_url(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")))
    rows = rows.drop("path")
    out = T._parse_datatype_string("page_id long, url string, text string, n_chars long")
    out = T.StructType([pages.schema[page_id], *out.fields[1:]])
    out.fields[0].name = out.names[0] = "page_id"
    schema = to_arrow_schema(out)

    def parsed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            trees = [parse(html.as_py() or "") for html in part.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([tree.key() for tree in trees], pa.int64()),
                    pa.array([marshal.dumps(packed_tree(tree)) for tree in trees], pa.binary()),
                    pa.array([marshal.dumps(shape(tree), _PLAIN) for tree in trees], pa.binary()),
                ],
                names=["host", "content", "tree", "shape"],
            )

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrappers = Wrappers()
        for part in parts:
            counts: dict[str, Counter] = {}
            for host, tree, packed in zip(*part.columns, strict=True):
                host = host.as_py()
                wrapper, _ = wrappers.of(host, packed)
                count(unpacked_tree(marshal.loads(tree.as_py())), wrapper, counts.setdefault(host, Counter()))
            flat = [(h, *key, n) for h, own in counts.items() for key, n in own.items()]
            kinds = pa.string(), pa.int64(), pa.int64(), pa.int64()
            columns = zip(*flat, strict=True) if flat else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                names=["host", "slot", "content", "n"],
            )

    def texts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrappers = Wrappers()
        for part in parts:
            found = []
            for host, html, packed, constants in zip(*(part.column(i) for i in range(2, 6)), strict=True):
                tree = parse(html.as_py() or "")
                settle(tree, *wrappers.of(host.as_py(), packed, constants))
                found.append(main_text(tree))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).cast(schema.field(0).type),
                    part.column(1),
                    pa.array(found, pa.string()),
                    pa.array([len(text) for text in found], pa.int64()),
                ],
                schema=schema,
            )

    # Pages of a host with the same content count once.
    kinds = "host string, content long, tree binary, shape binary"
    trees = rows.select("host", "html").mapInArrow(parsed, kinds)
    page = F.min(F.struct("tree", "shape")).alias("page")
    trees = stored(trees.groupBy("host", "content").agg(page).select("host", "page.*"), free=True)
    wrappers = induced(trees.select("host", "shape"))

    counts = trees.join(beside(wrappers, HOSTS), "host").select("host", "tree", "wrapper")
    counts = counts.mapInArrow(counted, "host string, slot long, content long, n long")
    counts = stored(counts.groupBy("host", "slot", "content").agg(F.sum("n").alias("n")), free=True)
    least, share = min(TEMPLATE_PAGES, ARTICLE_PAGES), min(TEMPLATE_SHARE, ARTICLE_SHARE)
    whole = counts.filter(F.col("content").isNull() & (F.col("n") >= least))
    whole = whole.select("host", "slot", F.col("n").alias("pages"))
    constants = counts.filter(F.col("content").isNotNull() & (F.col("n") >= share * least))
    constants = constants.join(whole, ["host", "slot"]).filter(F.col("n") >= share * F.col("pages"))
    constants = constants.groupBy("host").agg(
        F.collect_list(F.struct("slot", "content", "n", "pages")).alias("constants")
    )
    known = beside(stored(wrappers.join(constants, "host", "left")), HOSTS)
    rows = rows.join(known, "host", "left")
    return rows.select("page_id", "url", "host", "html", "wrapper", "constants").mapInArrow(texts, out)
