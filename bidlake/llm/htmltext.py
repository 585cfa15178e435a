"""Main text of web pages by wrapper induction.

Pages of a host share a layout.  The trees of all its pages are folded into
one template by simple tree matching: children of matched nodes are aligned in
order so that the matched part is largest, and runs of like siblings count as
one repeated node.  Every task folds the pages it reads; partial templates of
a host are then folded into each other.

Every page is aligned with its host's template, and what stands at each node
is counted over all pages in Spark.  A text that stands at a node on a stated
share of the pages that have it is constant: it belongs to the template.
What varies fills slots.  The wrapper decides for each node of the template
from these counts: the main region is where most of the varying text stands;
nodes beside it whose text is nearly all links are menus; where article or
main elements hold at least half of the varying text, what stands outside of
them is no article (on pages that have text in one).  Elements that hold no article text by the
meaning of HTML (scripts, forms, navigation, footers, ...) go.  Class and id
names only break ties: they drop a node that the counts say nothing about,
and none that holds the main region of ``least_pages`` pages or more.

The text of a page is what its slots hold, read through the wrapper.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlake.llm.common import looked_up, stored
from bidlake.llm.urlfilter import split_url

# Element kinds of HTML, and names by which pages mark their furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
               "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
SCOPES = frozenset("table ul ol dl body html article section div select".split())
FURNITURE_TAGS = frozenset("aside audio button canvas dialog form footer head iframe input menu nav noscript object script select style svg template textarea title video".split())
FURNITURE_NAMES = frozenset(
    "ad ads adbox advert adverts advertisement advertising alert aside banner breadcrumb breadcrumbs comment commentlist comments consent cookie cookies disqus "
    "dialog discussion feedback footer form gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification outbrain pagination paywall popup promo promoted "
    "promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe taboola tags toolbar topbar "
    "announcement complementary contentinfo subnav topnav".split())
FURNITURE_ENDS = tuple("comments sidebar navbar menu footer breadcrumb breadcrumbs cookie cookies newsletter advert adverts advertisement".split())
FURNITURE_STARTS = tuple("advert breadcrumb comments cookie navbar newsletter sidebar".split())
LAYOUT_NAMES = frozenset("has no with without".split())  # "with-sidebar" names what stands inside
MAIN_TAGS = frozenset(("article", "main"))

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I | re.S)
_NAME = re.compile(r"[a-z]+")


@dataclass(frozen=True)
class ExtractSettings:
    """A text is constant if it stands at a node on ``constant_share`` of the different pages that have the node, and on
    ``least_pages`` at least.  A menu has ``menu_links`` links a page and ``menu_share`` of its text in links.  Partial
    templates are folded in ``parts`` groups a host, then into one."""
    constant_share: float = 0.6
    least_pages: int = 3
    menu_links: float = 3.0
    menu_share: float = 0.9
    parts: int = 16


@dataclass
class Node:
    tag: str
    mark: str = ""
    children: list = field(default_factory=list)  # nodes and texts in page order


def parse(html: str) -> Node:
    """A lenient tree of any depth: unclosed elements end with their parent, stray ends are skipped."""
    root = Node("#page")
    stack, place = [root], 0
    open_tags: Counter[str] = Counter()
    while place < len(html):
        m = _TOKEN.search(html, place)
        end = m.start() if m else len(html)
        if end > place:
            stack[-1].children.append(entities.unescape(html[place:end]))
        if not m:
            break
        place = m.end()
        closing, tag, attributes = (m.group(1), m.group(2), m.group(3)) if m.group(2) else (m.group(4), m.group(5), m.group(6))
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            while open_tags[tag]:
                ended = stack.pop()
                open_tags[ended.tag] -= 1
                if ended.tag == tag:
                    break
            continue
        if tag in CLOSES_P:
            _close(stack, ("p",), open_tags)
        if tag in SAME_CLOSES:
            _close(stack, SAME_CLOSES[tag], open_tags)
        mark = ""
        if attributes and "=" in attributes:
            mark = " ".join(f"{x.group(1)[0]}:{(x.group(2) or x.group(3) or x.group(4) or '').strip()}" for x in _ATTRIBUTE.finditer(attributes)).lower()
        node = Node(tag, mark)
        stack[-1].children.append(node)
        if tag in RAW:
            ending = re.compile(rf"</{tag}[^>]*(?:>|\Z)", re.I).search(html, place)
            place = ending.end() if ending else len(html)
        elif tag not in VOID and not attributes.endswith("/"):
            stack.append(node)
            open_tags[tag] += 1
    return root


def _close(stack: list[Node], tags: tuple[str, ...], open_tags: Counter[str]) -> None:
    """End the open element of one of the tags, and all inside it, within the nearest container."""
    if not any(open_tags[t] for t in tags):
        return
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            open_tags.subtract(node.tag for node in stack[i:])
            del stack[i:]
            return
        if stack[i].tag in SCOPES:
            return


def named_furniture(mark: str) -> bool:
    """Whether a class, id or role names page furniture; a name like "with-sidebar" says what stands inside."""
    for part in mark.split():
        names = _NAME.findall(part.split(":", 1)[-1])
        if LAYOUT_NAMES.isdisjoint(names) and any(n in FURNITURE_NAMES or n.endswith(FURNITURE_ENDS) or n.startswith(FURNITURE_STARTS) for n in names):
            return True
    return False


def text_key(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) * 4096 + len(text) % 4096


@dataclass
class Shape:
    """A block element with runs of like siblings merged, and its child shapes."""
    sign: str
    children: list["Shape"] = field(default_factory=list)


@dataclass
class Block:
    """A text with its shape, the characters of it in links, and its links."""
    text: str
    shape: Shape
    linked: int
    links: int


_DIGITS = re.compile(r"\d+")


class PageBlocks:
    """All text blocks of a page in order, and the page's shape."""

    def __init__(self, root: Node):
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = self.links = 0
        self.shape = Shape("#page")
        self._walk(root)
        self._flush(self.shape)

    def _flush(self, shape: Shape) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append(Block(text, shape, self.linked, self.links))
            self.parts.clear()
        self.linked = self.links = 0

    def _walk(self, root: Node) -> None:
        """Depth first with the open elements as a list: children left, shape, in a link, last shape, tag if a block."""
        stack: list[list] = [[iter(root.children), self.shape, False, None, None]]
        while stack:
            left, shape, link, last, block = stack[-1]
            child = next(left, None)
            if child is None:
                stack.pop()
                if block is not None:
                    self._flush(shape)
                    if block in ("td", "th"):
                        self.parts.append(" ")
            elif isinstance(child, str):
                self.parts.append(child)
                self.linked += len("".join(child.split())) if link else 0
            elif child.tag in INLINE and not (child.mark and named_furniture(child.mark)):
                if child.tag == "br":
                    self.parts.append(" ")
                self.links += child.tag == "a"
                stack.append([iter(child.children), shape, link or child.tag == "a", None, None])
            else:
                self._flush(shape)
                sign = _DIGITS.sub("#", f"{child.tag} {child.mark}") if child.mark else child.tag
                if last is None or last.sign != sign:
                    last = stack[-1][3] = Shape(sign)
                    shape.children.append(last)
                stack.append([iter(child.children), last, link or child.tag == "a", None, child.tag])


@dataclass
class Template:
    """A node of a host's template: pages it was folded from, and what the wrapper decides about it."""
    sign: str
    pages: int = 0
    children: list["Template"] = field(default_factory=list)
    number: int = 0
    kept: int = 1          # 0: dropped, 2: kept on pages without text in an article
    constant: frozenset = frozenset()

    @property
    def tag(self) -> str:
        return self.sign.partition(" ")[0]

    @property
    def mark(self) -> str:
        return self.sign.partition(" ")[2]

    @property
    def is_main(self) -> bool:
        return self.tag in MAIN_TAGS or not {"r:main", "r:article"}.isdisjoint(self.mark.split())

    def nodes(self) -> list["Template"]:
        """All nodes in depth-first order, numbered."""
        found, stack = [], [self]
        while stack:
            node = stack.pop()
            node.number = len(found)
            found.append(node)
            stack.extend(reversed(node.children))
        return found


def matched(template: list[Template], shapes: list[Shape], known: dict[tuple[int, int], int]) -> list[tuple[int, int]]:
    """Simple tree matching of two child lists: the order-preserving pairs whose matched parts are largest."""
    if [t.sign for t in template] == [s.sign for s in shapes]:
        return [(i, i) for i in range(len(shapes))]
    weight = {}
    best = [[0] * (len(shapes) + 1) for _ in range(len(template) + 1)]
    for i, t in enumerate(template):
        for j, s in enumerate(shapes):
            w = weight[i, j] = tree_match(t, s, known)
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + w)
    pairs, i, j = [], len(template), len(shapes)
    while i and j:
        if weight[i - 1, j - 1] and best[i][j] == best[i - 1][j - 1] + weight[i - 1, j - 1]:
            i, j = i - 1, j - 1
            pairs.append((i, j))
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return pairs[::-1]


def tree_match(template: Template, shape: Shape, known: dict[tuple[int, int], int]) -> int:
    """Number of matched nodes of two trees whose roots have the same sign; 0 if they differ.

    ``known`` keeps the numbers of one alignment's pairs of nodes, so deep
    pages are matched once and not again at each level.
    """
    if template.sign != shape.sign:
        return 0
    stack = [(template, shape)]
    while stack:
        t, s = stack[-1]
        if (id(t), id(s)) in known:
            stack.pop()
            continue
        missing = [(x, y) for x in t.children for y in s.children if x.sign == y.sign and (id(x), id(y)) not in known]
        if missing:
            stack.extend(missing)
            continue
        row = [0] * (len(s.children) + 1)
        for child in t.children:
            above, row = row, [0]
            for j, other in enumerate(s.children):
                row.append(max(above[j + 1], row[j], above[j] + known.get((id(child), id(other)), 0)))
        known[id(t), id(s)] = row[-1] + 1
        stack.pop()
    return known[id(template), id(shape)]


def fold(template: Template, other: Shape | Template) -> None:
    """Add a page's shape, or another template, to the template; what has no partner becomes a new node in its place."""
    known: dict[tuple[int, int], int] = {}
    stack = [(template, other)]
    while stack:
        node, shape = stack.pop()
        node.pages += shape.pages if isinstance(shape, Template) else 1
        partner = {j: node.children[i] for i, j in matched(node.children, shape.children, known)}
        place = 0
        for j, child in enumerate(shape.children):
            own = partner.get(j)
            if own is None:
                own = Template(child.sign)
                node.children.insert(place, own)
            place = next(k for k, x in enumerate(node.children) if x is own) + 1
            stack.append((own, child))


def written(template: Template) -> str:
    """The template as JSON: per node in depth-first order its sign, pages, decision, constants and number of children."""
    return json.dumps([[n.sign, n.pages, n.kept, sorted(n.constant), len(n.children)] for n in template.nodes()])


def read_template(text: str) -> Template:
    root = Template("")
    left = [(root, 1)]
    for sign, pages, kept, constant, children in json.loads(text):
        parent, more = left.pop()
        node = Template(sign, pages, kept=kept, constant=frozenset(constant))
        parent.children.append(node)
        if more > 1:
            left.append((parent, more - 1))
        if children:
            left.append((node, children))
    root.children[0].nodes()
    return root.children[0]


def folded(htmls: list[str]) -> Template:
    template = Template("#page")
    for html in htmls:
        fold(template, PageBlocks(parse(html)).shape)
    return template


def aligned(template: Template, page: Shape) -> dict[int, Template]:
    """The template's node for each shape of the page that has one."""
    known: dict[tuple[int, int], int] = {}
    found, stack = {}, [(template, page)]
    while stack:
        node, shape = stack.pop()
        found[id(shape)] = node
        stack.extend((node.children[i], shape.children[j]) for i, j in matched(node.children, shape.children, known))
    return found


def seen_texts(template: Template, html: str) -> tuple[int, set[int], list[tuple[int, int, int, int, int]]]:
    """Of a page: a hash of all its texts, the numbers of its nodes, and per block node, key, characters, linked ones, links."""
    page = PageBlocks(parse(html))
    at = aligned(template, page.shape)
    print_ = 0
    rows = []
    for b in page.blocks:
        key = text_key(b.text)
        print_ = (print_ * 1_000_003 + key) & 0x7FFFFFFFFFFFFFFF
        if id(b.shape) in at:
            rows.append((at[id(b.shape)].number, key, len("".join(b.text.split())), b.linked, b.links))
    return print_, {n.number for n in at.values()}, rows


def decide(template: Template, constant: dict[int, list[int]], slots: dict[int, tuple[int, int, int]], settings: ExtractSettings) -> None:
    """Set what the wrapper keeps, from the constant texts per node and the sums (characters, linked ones, links) of the others."""
    nodes = template.nodes()
    last = [n.number for n in nodes]
    sums = [[0, 0, 0] for _ in nodes]
    own = [0] * len(nodes)
    for n in reversed(nodes):
        n.constant = frozenset(constant.get(n.number, ()))
        mine = slots.get(n.number, (0, 0, 0))
        own[n.number] = mine[0] - mine[1]
        sums[n.number] = [x + sum(sums[c.number][k] for c in n.children) for k, x in enumerate(mine)]
        if n.children:
            last[n.number] = last[n.children[-1].number]
        if n.tag in FURNITURE_TAGS:
            sums[n.number] = [0, 0, 0]
    text = [chars - linked for chars, linked, _ in sums]
    region, path = template, {template.number}
    while region.children:  # down to where the text spreads over several nodes
        best = max(region.children, key=lambda c: text[c.number])
        if not text[best.number] or 2 * text[best.number] < text[region.number] or 2 * own[best.number] >= text[best.number]:
            break
        region = best
        path.add(region.number)
    within, end = 0, -1
    for n in nodes:
        if n.number > end and n.is_main:  # outermost articles
            within, end = within + text[n.number], last[n.number]
    article_alone = end >= 0 and 2 * within >= text[0] > 0
    stack = [(template, False, False)]
    while stack:
        n, inside, dropped = stack.pop()
        inside = inside or n.is_main
        below = region.number < n.number <= last[region.number]
        menu = [not inside and not below and links >= settings.menu_links * max(n.pages, 1) and linked >= settings.menu_share * chars > 0
                for chars, linked, links in (sums[n.number], slots.get(n.number, (0, 0, 0)))]  # of all inside, of its own texts
        if not dropped and (n.number not in path or template.pages < settings.least_pages):  # few pages are no evidence against a name
            tie = bool(n.mark) and not n.is_main and (named_furniture(n.mark) or (not inside and "header" in _NAME.findall(n.mark)))
            dropped = n.tag in FURNITURE_TAGS or (n.tag == "header" and not inside) or tie or (menu[0] and n.number not in path)
        n.kept = 0 if dropped or menu[1] else 1 if inside or not article_alone else 2
        stack.extend((c, inside, dropped) for c in n.children)


def wrapper(htmls: list[str], settings: ExtractSettings) -> Template:
    """The wrapper of one host's pages, in memory; ``wrappers`` does the same for all hosts."""
    template = read_template(written(folded(htmls)))
    texts: dict[tuple[int, int], dict[int, list[int]]] = {}
    present: dict[int, set[int]] = {}
    for html in htmls:
        print_, numbers, rows = seen_texts(template, html)
        for number in numbers:
            present.setdefault(number, set()).add(print_)
        page: dict[tuple[int, int], list[int]] = {}
        for number, key, *counts in rows:
            page[number, key] = [a + b for a, b in zip(page.get((number, key), (0, 0, 0)), counts)]
        for at, counts in page.items():
            texts.setdefault(at, {})[print_] = counts
    constant: dict[int, list[int]] = {}
    slots: dict[int, tuple[int, int, int]] = {}
    for (number, key), pages in texts.items():
        if len(pages) >= settings.least_pages and len(pages) >= settings.constant_share * len(present[number]):
            constant.setdefault(number, []).append(key)
        else:
            slots[number] = tuple(a + sum(c[k] for c in pages.values()) for k, a in enumerate(slots.get(number, (0, 0, 0))))
    decide(template, constant, slots, settings)
    return template


def main_text(html: str | None, template: Template | None) -> str:
    """What the wrapper keeps of a page, joined by blank lines; without a wrapper every text is kept."""
    page = PageBlocks(parse(html or ""))
    at = aligned(template, page.shape) if template is not None else {}
    slots = []
    for b in page.blocks:
        node = at.get(id(b.shape))
        if node is None or text_key(b.text) not in node.constant:
            slots.append((b.text, 1 if node is None else node.kept))
    least = 1 if any(kept == 1 for _, kept in slots) else 2
    return "\n\n".join(text for text, kept in slots if 0 < kept <= least)


HELD_NODES = 200_000  # template nodes that a task holds before it sends them on


def templates(pages: DataFrame, settings: ExtractSettings = ExtractSettings()) -> DataFrame:
    """host and template, folded from all pages (host, html)."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Template] = {}
        nodes, part = 0, TaskContext.get().partitionId() % settings.parts

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([part] * len(held), pa.int32()), pa.array([written(t) for t in held.values()], pa.string())],
                                              names=["host", "part", "template"])

        for batch in batches:
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html")):
                before = held.setdefault(host, Template("#page"))
                shape = PageBlocks(parse(html.as_py())).shape
                fold(before, shape)
                nodes += 1 + len(shape.children)
                if nodes > HELD_NODES:
                    yield sent()
                    held, nodes = {}, 0
        if held:
            yield sent()

    def together(frame: pd.DataFrame) -> pd.DataFrame:
        template = Template("#page")
        for text in sorted(frame["template"]):
            fold(template, read_template(text))
        return pd.DataFrame({"host": frame["host"].iloc[:1], "template": [written(template)]})

    sent = pages.select("host", "html").mapInArrow(partial, "host string, part int, template string")
    parts = sent.groupBy("host", "part").applyInPandas(together, "host string, template string")
    return parts.groupBy("host").applyInPandas(together, "host string, template string")


class Known:
    """Templates read from their texts, a bounded number at a time."""

    def __init__(self):
        self.templates: dict[str, Template] = {}

    def __call__(self, text: str) -> Template:
        if text not in self.templates:
            if len(self.templates) >= 500:
                self.templates.clear()
            self.templates[text] = read_template(text)
        return self.templates[text]


_SEEN = pa.schema([("host", pa.string()), ("node", pa.int32()), ("key", pa.int64()), ("print", pa.int64()), ("chars", pa.int64()), ("linked", pa.int64()), ("links", pa.int64())])


def wrappers(pages: DataFrame, made: DataFrame, settings: ExtractSettings = ExtractSettings()) -> DataFrame:
    """host and template with its decisions, from what stands at each node of the templates (host, template) over all pages."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known()
        for batch in batches:
            rows: list[tuple] = []
            for host, html, text in zip(batch.column("host").to_pylist(), batch.column("html"), batch.column("template").to_pylist()):
                print_, numbers, texts = seen_texts(known(text), html.as_py())
                rows.extend((host, n, None, print_, 0, 0, 0) for n in numbers)
                rows.extend((host, n, key, print_, *counts) for n, key, *counts in texts)
                if len(rows) > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SEEN)], schema=_SEEN)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SEEN)], schema=_SEEN)

    seen = looked_up(pages.select("host", "html"), made, "host").mapInArrow(align, "host string, node int, key long, print long, chars long, linked long, links long")
    # different pages count once, however often they stand
    counts = ("chars", "linked", "links")
    different = seen.groupBy("host", "node", "key", "print").agg(*[F.sum(c).alias(c) for c in counts])
    texts = stored(different.groupBy("host", "node", "key").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in counts]))
    present = texts.where("key is null").select("host", "node", F.col("n").alias("present"))
    judged = texts.where("key is not null").join(present, ["host", "node"]).withColumn(
        "constant", (F.col("n") >= settings.least_pages) & (F.col("n") >= settings.constant_share * F.col("present")))
    # per host as many rows as its template has nodes and constants
    constant = judged.where("constant").groupBy("host").agg(F.collect_list(F.struct("node", "key")).alias("constants"))
    slots = judged.where("not constant").groupBy("host", "node").agg(*[F.sum(c).alias(c) for c in counts]).groupBy("host").agg(F.collect_list(F.struct("node", *counts)).alias("slots"))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, constants, sums in zip(*(batch.column(c).to_pylist() for c in ("template", "constants", "slots"))):
                template = read_template(text)
                at: dict[int, list[int]] = {}
                for c in constants or ():
                    at.setdefault(c["node"], []).append(c["key"])
                decide(template, at, {x["node"]: (x["chars"], x["linked"], x["links"]) for x in sums or ()}, settings)
                out.append(written(template))
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(out, pa.string())], names=["host", "template"])

    whole = made.join(constant, "host", "left").join(slots, "host", "left").select("host", "template", "constants", "slots")
    return whole.mapInArrow(settle, "host string, template string")


def extract(pages: DataFrame, settings: ExtractSettings = ExtractSettings()) -> DataFrame:
    """page_id, url, text, n_chars of every row.

    Null html counts as empty; a page without text gives an empty string.  A
    null or malformed url belongs to the empty host.  Hosts with fewer than
    ``least_pages`` different pages have no constants.  Repeated rows come back
    each; an empty table gives an empty result; other columns are not read.
    Templates and wrappers are stored first, so Spark knows their size; pages
    of a host that holds many are joined where they lie.
    """
    keyed = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), split_url(F.col("url"))[0].alias("host"))
    made = stored(templates(keyed, settings))
    settled = stored(wrappers(keyed, made, settings))
    joined = looked_up(keyed, settled, "host").select("page_id", "url", "html", "template")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known()
        for batch in batches:
            texts = [main_text(html.as_py(), known(written_)) for html, written_ in zip(batch.column("html"), batch.column("template").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return joined.mapInArrow(read, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
