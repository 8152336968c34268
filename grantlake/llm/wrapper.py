"""Main text of web pages by wrapper induction.

Nodes of a page are compared with those of all other pages of its host in three ways: with the nodes at the same path of
tags on all pages of the host, with those on the pages of the same layout (the set of paths that have text), and, by
simple tree matching, with the node that they are aligned with on the host's model page (a page of its commonest layout
that has text).  Two trees match if their roots have the same tag, and the best order-keeping pairing of their children
is added up.  Spark counts how many different pages have such a node and how many of them have the same text there,
whatever that text is.  The template is of two kinds.  Texts that are constant on most of at least ``LEAST_PAGES`` pages
are fixed.  A slot whose texts nearly all come back on other pages (``RECURRING``) rotates through a stock of texts, as
menus and adverts do, and is template whatever stands in it.  What varies is content.  A page then loses what it shares
with the template, and what markup itself declares to be no article (menus, forms, adverts, ...), and keeps the text of
the rest.  With ``declared=False`` the names of tags and classes tell nothing and the template alone decides.

Runs of paragraphs vary in number from page to page, so the alignment is of blocks: the tree that is matched has the
page's sections, lists and headings, and a run of text blocks inside a section is one node, whose text is compared.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from grantlake.llm.shared import cut

LEAST_PAGES = 4
CONSTANT = 0.5
#: Share of the pages whose text at a slot stands on another page too, from which the slot rotates; and pages to tell it.
RECURRING, ROTATING_PAGES = 0.85, 16
MOST_HOSTS = 100_000
MODEL_BYTES = 32 << 20
MOST_PARSED = 512
VOTES = 20_000
#: Slots that aren't of one layout: paths of a whole host, and nodes of its model page.
HOST_WIDE, MODEL = 0, 1
#: Modulus and base of the hashes of runs of text blocks.
PRIME, BASE = (1 << 61) - 1, 0x1C6EF372FE94F82B

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that end an open paragraph and stand on lines of their own.
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li "
    "main menu nav ol p pre section summary table tbody td tfoot th thead tr ul br".split()
)
#: Elements that hold no article text.
ASIDE = frozenset(
    "head script style noscript template nav header footer aside form button select option input textarea iframe object embed svg canvas audio video map menu dialog label".split()
)
HEADED = frozenset("article main section".split())
#: Words of class, id and role that mark parts which are no article text.
MARKED = frozenset(
    "ad ads advert adverts advertisement advertisements banner sponsor sponsored promo promotion popup modal cookie cookies consent newsletter subscribe subscription "
    "sidebar nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar comment comments disqus login signup pagination pager disclaimer complementary contentinfo".split()
)
#: Words that mark such parts on the page, but may well name a part of an article: inside of one the template decides.
WEAK = frozenset("notice notices alert alerts side menu header reply replies respond discussion share sharing social related recommended widget search toc copyright legal hidden".split())
KEPT = frozenset("article content main body post entry story text page".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|([^\s=/>\"']+)")
SPACE = re.compile(r"[ \t\n\r\f\v ]+")


@dataclass
class Node:
    """An element with its child elements and its blocks of text, in page order."""

    tag: str
    aside: bool
    weak: bool = False  # marked by a word that means nothing inside an article
    parts: list = field(default_factory=list)  # Node or str

    @property
    def sections(self) -> list[Node]:
        """The children that take part in the alignment; paragraphs are text inside their section."""
        return [p for p in self.parts if isinstance(p, Node) and p.tag not in ("p", "br")]


def _marks(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether tag or attributes declare that the element is no article text, and whether they do so by a weak word alone."""
    if tag in ASIDE:
        return True, False
    weak = False
    for name, a, b, c, bare in ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        name, value = (name or bare).lower(), (a or b or c).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True, False
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, False
        if name in ("class", "id", "role") and tag not in ("html", "body", "article", "main"):
            marks = set(re.split(r"[^a-z]+", value))
            if marks & MARKED or name == "role" and marks & WEAK:
                return True, False
            weak |= bool(marks & WEAK) and not (marks & KEPT and marks & WEAK <= {"side", "header"})
    return False, weak


def parse(page: str) -> Node:
    """The tree of sections of a page; text stays in its nearest block element, inline markup goes.

    Unclosed elements end with the element that they stand in; a paragraph ends where the next block begins.
    """
    root = Node("root", False)
    stack, text = [root], []
    standing: Counter[str] = Counter()  # open elements by tag
    endless: set[str] = set()  # raw elements that no end tag follows any more

    def flush() -> None:
        if text:
            block = SPACE.sub(" ", "".join(text)).strip()
            if block:
                stack[-1].parts.append(block)
            text.clear()

    raw = None
    for m in TOKEN.finditer(page):
        tag = m[2]
        if raw:
            if tag and m[1] and tag.lower() == raw:
                raw = None
            continue
        if not tag:
            token = m[0]
            if token[0] != "<" or token == "<":
                text.append(entities.unescape(token) if "&" in token else token)
            continue
        tag = tag.lower()
        if not m[1]:
            if tag in RAW:
                if tag not in endless:
                    raw = tag if re.compile(rf"</{tag}\s*>", re.I).search(page, m.end()) else None
                    endless |= set() if raw else {tag}
                continue
            aside, weak = _marks(tag, m[3])
            if tag in BLOCK or aside or weak:
                flush()
                if tag in BLOCK and stack[-1].tag == "p" and tag != "br":
                    standing[stack.pop().tag] -= 1
                if tag in ("li", "dt", "dd", "tr", "td", "th", "option") and stack[-1].tag == tag:
                    standing[stack.pop().tag] -= 1
                if tag == "br" or tag in VOID or m[3].endswith("/"):
                    continue
                node = Node(tag, aside, weak)
                stack[-1].parts.append(node)
                stack.append(node)
                standing[tag] += 1
        elif standing[tag]:
            flush()
            while (ended := stack.pop().tag) != tag:
                standing[ended] -= 1
            standing[tag] -= 1
        elif tag in BLOCK:
            flush()
    flush()
    return root


class Tree:
    """The nodes of a page that take part in the alignment, in page order, with the places of parents and children."""

    def __init__(self, root: Node):
        self.nodes: list[Node] = []
        self.parents: list[int] = []
        todo = [(root, -1)]
        while todo:
            node, parent = todo.pop()
            todo += [(child, len(self.nodes)) for child in reversed(node.sections)]
            self.nodes.append(node), self.parents.append(parent)
        self.children: list[list[int]] = [[] for _ in self.nodes]
        for at, parent in enumerate(self.parents[1:], 1):
            self.children[parent].append(at)


class Shapes:
    """Numbers of the shapes of trees, with sizes and pairs of the largest matches of two shapes, kept over many pages."""

    def __init__(self):
        self.known: dict[tuple[str, tuple[int, ...]], int] = {}
        self.shapes: list[tuple[str, tuple[int, ...]]] = []
        self.counts: list[int] = []
        self.sizes: dict[tuple[int, int], int] = {}
        self.places: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def of(self, tree: Tree) -> list[int]:
        """The shape of each node of a tree."""
        out = [0] * len(tree.nodes)
        for at in range(len(out) - 1, -1, -1):  # children come after their parents
            parts = tuple([out[c] for c in tree.children[at]])
            key = tree.nodes[at].tag, parts
            if key not in self.known:
                self.known[key] = len(self.shapes)
                self.shapes.append(key)
                self.counts.append(1 + sum([self.counts[c] for c in parts]))
            out[at] = self.known[key]
        return out

    def _told(self, x: int, y: int) -> int | None:
        """Size of the match if nothing has to be worked out."""
        if x == y:
            return self.counts[x]
        return 0 if self.shapes[x][0] != self.shapes[y][0] else self.sizes.get((x, y))

    def size(self, x: int, y: int) -> int:
        """Size of the largest match of two shapes: the roots and the best pairing of their children."""
        todo = [] if self._told(x, y) is not None else [(x, y)]
        while todo:
            a, b = todo[-1]
            one, other = self.shapes[a][1], self.shapes[b][1]
            open_ = [(c, d) for c in set(one) for d in set(other) if self._told(c, d) is None]
            if open_:
                todo += open_
            else:
                self.sizes[a, b] = 1 + int(self.row(one, other)[-1])
                todo.pop()
        return self._told(x, y)

    def row(self, one: tuple[int, ...], other: tuple[int, ...]) -> np.ndarray:
        """The largest match of one list with each head of the other."""
        out = np.zeros(len(other) + 1, np.int64)
        if not one or not other:
            return out
        kinds, of = np.unique(np.array(other), return_inverse=True)
        for x in one:
            sizes = np.array([self._told(x, y) for y in kinds.tolist()])[of]
            out[1:] = np.maximum(out[1:], out[:-1] + sizes)
            out = np.maximum.accumulate(out)
        return out

    def paired(self, x: int, y: int) -> list[tuple[int, int]]:
        """The places of the children that a largest match pairs; divided in halves, so memory is linear in both lists."""
        if (x, y) in self.places:
            return self.places[x, y]
        self.size(x, y)
        one, other = self.shapes[x][1], self.shapes[y][1]
        out, todo = [], [(0, len(one), 0, len(other))]
        while todo:
            a, b, c, d = todo.pop()
            while a < b and c < d and one[a] == other[c]:  # no match is larger than that of equal ones
                out.append((a, c))
                a, c = a + 1, c + 1
            while a < b and c < d and one[b - 1] == other[d - 1]:
                b, d = b - 1, d - 1
                out.append((b, d))
            if a == b or c == d:
                continue
            if b - a == 1:
                sizes = [self._told(one[a], k) for k in other[c:d]]
                if max(sizes):
                    out.append((a, c + sizes.index(max(sizes))))
                continue
            middle = (a + b) // 2
            both = self.row(one[a:middle], other[c:d]) + self.row(one[middle:b][::-1], other[c:d][::-1])[::-1]
            at = c + int(both.argmax())
            todo += [(a, middle, c, at), (middle, b, at, d)]
        self.places[x, y] = out = sorted(out)
        return out


def match(shapes: Shapes, a: Tree, b: Tree) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: the size of the largest match and the places of its pairs of nodes."""
    of_a, of_b = shapes.of(a), shapes.of(b)
    size = shapes.size(of_a[0], of_b[0])
    pairs, todo = [], [(0, 0)] if size else []
    while todo:
        i, j = todo.pop()
        pairs.append((i, j))
        if a.children[i] and b.children[j]:
            todo += [(a.children[i][k], b.children[j][m]) for k, m in reversed(shapes.paired(of_a[i], of_b[j]))]
    return size, pairs


def digests(root: Node) -> dict[int, tuple[int, int]]:
    """id() of each node that has text -> (number of text blocks, hash of the run of blocks)."""
    order, todo = [], [root]
    while todo:
        order.append(todo.pop())
        todo += [p for p in order[-1].parts if isinstance(p, Node)]
    out: dict[int, tuple[int, int]] = {}
    for node in reversed(order):
        n, value = 0, 0
        for part in node.parts:
            more, own = (1, xxh3_64_intdigest(part.encode("utf-8", "replace"))) if isinstance(part, str) else out.get(id(part), (0, 0))
            if more:
                n, value = n + more, (value * (BASE if more == 1 else pow(BASE, more, PRIME)) + own) % PRIME
        if n:
            out[id(node)] = n, value
    return out


def _blocks(starts: list[Node], template: set[int], declared: bool) -> Iterator[str]:
    """Text blocks under the nodes, outside of the template and of what is declared to be no article."""
    todo: list = [(start, False) for start in starts[::-1]]
    while todo:
        part, inside = todo.pop()
        if isinstance(part, str):
            yield part
        elif id(part) not in template and not (declared and (part.aside or part.weak and not inside)):
            inside = inside or part.tag in ("article", "main")
            todo += [(p, inside) for p in reversed(part.parts)]


def _articles(root: Node) -> list[Node]:
    """The outermost article and main elements, in page order."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.tag in ("article", "main") and not node.aside:
            out.append(node)
        elif not (node.aside or node.weak):
            todo += [p for p in reversed(node.parts) if isinstance(p, Node)]
    return out


def main_text(root: Node, template: set[int], declared: bool = True) -> str:
    """Text blocks of a page outside of template nodes (by id()) and of parts that are no article, joined by spaces.

    If the page has article or main elements with text, only these count.
    """
    articles = _articles(root) if declared else []
    return " ".join(_blocks(articles, template, declared)) or " ".join(_blocks([root], template, declared))


HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"


def _signed(text: str) -> int:
    return xxh3_64_intdigest(text.encode()) - (1 << 63)


@dataclass
class Outline:
    """A page as the alignment sees it: its layout, None if no article can stand in it, and its sections that have text."""

    layout: int | None
    tree: Tree
    found: list[tuple[int, int, int]]  # place in the tree, hash of the path, hash of the text


def _outline(root: Node, declared: bool = True) -> Outline:
    tree, texts = Tree(root), digests(root)
    paths: list[int] = []
    read: list[bool] = []
    inside: list[bool] = []  # of an article
    found = []
    for at, (node, parent) in enumerate(zip(tree.nodes, tree.parents)):
        paths.append(_signed(f"{paths[parent] if parent >= 0 else ''}/{node.tag}"))
        inside.append(node.tag in ("article", "main") or parent >= 0 and inside[parent])
        read.append(not (declared and (node.aside or node.weak and not inside[-1])) and (parent < 0 or read[parent]))
        if read[-1] and parent >= 0 and id(node) in texts:
            found.append((at, paths[-1], texts[id(node)][1]))
    return Outline(_signed(repr(sorted({p for _, p, _ in found}))) if found else None, tree, found)


class Models:
    """Parsed model pages and matches of a task; forgotten when they are more than ``MOST_PARSED`` hosts or 50 times as many shapes."""

    def __init__(self):
        self.parsed: dict[str, Tree] = {}
        self.shapes = Shapes()

    def get(self, host: str, page: str) -> Tree:
        if len(self.parsed) >= MOST_PARSED and host not in self.parsed:
            self.parsed.clear()
        if len(self.shapes.shapes) + len(self.shapes.sizes) > 50 * MOST_PARSED:
            self.shapes = Shapes()
        if host not in self.parsed:
            self.parsed[host] = Tree(parse(page))
        return self.parsed[host]


def _slots(models: Models, host: str, of: str, outline: Outline) -> list[tuple[int, int, int, int]]:
    """(place in the tree, scope, slot, hash of the text) of each section of a page that has text."""
    if outline.layout is None:
        return []
    out = [(at, scope, _signed(f"{scope} {path}"), text) for at, path, text in outline.found for scope in (HOST_WIDE, outline.layout)]
    texts = {at: text for at, _, text in outline.found}
    _, pairs = match(models.shapes, models.get(host, of), outline.tree)
    return out + [(j, MODEL, i, texts[j]) for i, j in pairs if j in texts]


def _layouts(batches, declared: bool) -> Iterator[pa.RecordBatch]:
    """(host, page, page_id, layout) of the pages (host, html, page, page_id) that have text."""
    for batch in batches:
        found = [_outline(parse(page.as_py()), declared).layout for page in batch.column(1)]
        out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(found, pa.int64())], ["host", "page", "page_id", "layout"])
        yield out.filter(out.column(3).is_valid())


def _align(batches, model_of, declared: bool) -> Iterator[pa.RecordBatch]:
    """(host, scope, slot, text, page, texts): the slots of each page with each of their texts, and once with none.

    ``texts`` is how many different texts the page has at the slot.
    """
    models, names = Models(), ["host", "scope", "slot", "text", "page", "texts"]
    types = [pa.string(), *[pa.int64()] * 5]
    rows = lambda out: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 6, types)], names)
    for batch in batches:
        out: list[tuple] = []
        for i, of in enumerate(model_of(batch)):
            host, page, key = (batch.column(k)[i].as_py() for k in range(3))
            if len(out) >= VOTES:  # the votes of a batch of pages are more than its rows
                yield rows(out)
                out = []
            if of is not None:
                found = _slots(models, host, of, _outline(parse(page), declared))
                votes = {(scope, slot, text) for _, scope, slot, text in found}
                texts = Counter((scope, slot) for scope, slot, _ in votes)
                out += [(host, *vote, key, 0) for vote in votes] + [(host, scope, slot, None, key, n) for (scope, slot), n in texts.items()]
        yield rows(out)


def _read(batches, template_of, declared: bool) -> Iterator[pa.RecordBatch]:
    """Main text of pages (host, html, page, page_id, url, ...), without what they share with their host's template.

    ``template_of`` gives the model of each page of a batch, and a function from its layout to its template: pairs of
    slot and text, the text None for a slot that is template whatever stands in it.  An article or main element is never
    such a slot: articles that come back are copies.
    """
    models = Models()
    for batch in batches:
        out = []
        for i, (of, template_by) in enumerate(template_of(batch)):
            host, page = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            root, template = parse(page), set()
            if of is not None:
                outline = _outline(root, declared)
                known = template_by(outline.layout)
                nodes = outline.tree.nodes
                for at, _, slot, text in _slots(models, host, of, outline):
                    if (slot, text) in known or (slot, None) in known and nodes[at].tag not in ("article", "main"):
                        template.add(id(nodes[at]))
            out.append(main_text(root, template, declared) or main_text(root, set(), declared))  # a page that is all template is its own content
        yield pa.RecordBatch.from_arrays([batch.column(3), batch.column(4), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, least_pages: int = LEAST_PAGES, constant: float = CONSTANT, model_bytes: int = MODEL_BYTES, declared: bool = True) -> DataFrame:
    """One row per page row: page_id, url, main text and its length in code points.

    A null or empty page has the empty text.  Pages without a host in their url form a host of their own; a host with
    fewer than ``least_pages`` different pages that have text has no template, and the declared parts alone are left out.
    Repeated rows are read each, but count as one page of the host.  Columns other than page_id, url and html are left out.

    Pages aren't shuffled while the model pages of all hosts are at most ``model_bytes``, and their templates too, which is
    measured first; beyond that, pages meet their host's model in a join, whose hot hosts Spark may split.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    ).withColumn("host", F.coalesce(F.lower(F.regexp_extract("url", HOST, 1)), F.lit("")))
    rows = rows.select("host", "html", F.xxhash64("html").alias("page"), "page_id", "url")
    # one row per host, in the shared folder: its model page, the smallest of the commonest layout
    layouts = rows.select("host", "html", "page", "page_id").mapInArrow(lambda b: _layouts(b, declared), "host string, page long, page_id long, layout long")
    smallest = F.struct(F.col("page_id").isNull(), "page_id", "page")
    layouts = layouts.groupBy("host", "layout").agg(F.count_distinct("page").alias("n"), F.min_by("page", smallest).alias("page"))
    first = layouts.groupBy("host").agg(F.max_by("page", F.struct("n", "layout")).alias("page"), F.sum("n").alias("n")).where(F.col("n") >= least_pages)
    first = cut(first.select("host", "page"))
    few = first.count() <= MOST_HOSTS
    chosen = rows.join(F.broadcast(first) if few else first, ["host", "page"], "left_semi")
    models = cut(chosen.groupBy("host").agg(F.min("html").alias("model")))
    size = models.agg(F.sum(F.octet_length("model") + F.octet_length("host"))).first()[0] or 0
    vote, text = "host string, scope long, slot long, text long, page long, texts long", "page_id long, url string, text string, n_chars long"
    held = None
    if few and size <= model_bytes:  # the models go to the tasks, the pages stay where they are
        held = pages.sparkSession.sparkContext.broadcast({r.host: r.model for r in models.collect()})
        votes = rows.mapInArrow(lambda b: _align(b, lambda batch: [held.value.get(h) for h in batch.column(0).to_pylist()], declared), vote)
    else:
        votes = rows.join(models, "host").select("host", "html", "page", "model").mapInArrow(lambda b: _align(b, lambda batch: batch.column(3).to_pylist(), declared), vote)
    slot = ["host", "scope", "slot"]
    counts = cut(votes.groupBy(*slot, "text").agg(F.count_distinct("page").alias("n"), F.max("texts").alias("texts")).where("n > 1"))
    every = counts.where("text IS NULL").select(*slot, F.col("n").alias("of"), F.col("texts").alias("at_once"))
    again = counts.where("text IS NOT NULL").groupBy(*slot).agg(F.sum("n").alias("again")).join(every, slot)
    rotating = again.where((F.col("of") >= ROTATING_PAGES) & (F.col("at_once") == 1) & (F.col("again") >= F.col("of") * RECURRING)).select(*slot, F.lit(None).cast("long").alias("text"))
    fixed = counts.where(F.col("text").isNotNull() & (F.col("n") >= least_pages)).join(every, slot).where(F.col("n") >= F.col("of") * constant).select(*slot, "text")
    fixed = fixed.unionByName(rotating)
    if held:
        fixed = cut(fixed)
        if (fixed.agg(F.sum(F.octet_length("host") + F.lit(128))).first()[0] or 0) <= model_bytes:
            of: dict[tuple[str, int], set[tuple[int, int]]] = {}
            for r in fixed.toLocalIterator():
                of.setdefault((r.host, r.scope if r.scope not in (HOST_WIDE, MODEL) else HOST_WIDE), set()).add((r.slot, r.text))
            fixed_at = pages.sparkSession.sparkContext.broadcast(of)

            def known(batch):
                for h in batch.column(0).to_pylist():
                    wide = fixed_at.value.get((h, HOST_WIDE), set())
                    yield held.value.get(h), lambda layout, h=h, wide=wide: wide | fixed_at.value.get((h, layout), set())

            return rows.mapInArrow(lambda b: _read(b, known, declared), text)

    listed = F.collect_list(F.struct("slot", "text"))
    wide = models.join(fixed.where(F.col("scope").isin(HOST_WIDE, MODEL)).groupBy("host").agg(listed.alias("wide")), "host", "left")
    own = fixed.where(~F.col("scope").isin(HOST_WIDE, MODEL)).groupBy("host", F.col("scope").alias("layout")).agg(listed.alias("own"))

    def laid_out(batches):
        for batch in batches:
            yield batch.append_column("layout", pa.array([_outline(parse(page), declared).layout for page in batch.column(1).to_pylist()], pa.int64()))

    full = rows.mapInArrow(laid_out, "host string, html string, page long, page_id long, url string, layout long").join(wide, "host", "left").join(own, ["host", "layout"], "left")

    def joined(batch):
        for of, *lists in zip(*(batch.column(i).to_pylist() for i in (5, 6, 7))):
            both = {(x["slot"], x["text"]) for a in lists for x in a or []}
            yield of, lambda layout, both=both: both

    return full.select("host", "html", "page", "page_id", "url", "model", "wide", "own").mapInArrow(lambda b: _read(b, joined, declared), text)
