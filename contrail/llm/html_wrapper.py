"""Operator 7, HTML extraction by wrapper induction.

Each page is parsed to an element tree; runs of equal siblings fold into one
node, so a tree has the size of the page's layout, not of its text.  Pages of one
host and one layout (the same folded tree) are joined node by node: a node holds
whether its text was the same on all pages seen, and which of its lines all of them
have, so a constant sibling shows beside varying ones that share its node (rows of
a list or table are judged together).  That joining has no order.  The layouts of a
host are then aligned by simple tree matching and merged into one wrapper, in the
order of their signatures and in steps of fixed parts, so the result does not depend
on how pages lie in partitions, and a host with a third of all pages costs each task
one small tree for each layout.

A page is then aligned with the tree of its own layout, if that has ``MIN_PAGES``
different pages, else with its host's wrapper.  Nodes of the roles menu,
header, footer, sidebar, notice, advert, form, script, style and reader comment
are template, whatever they hold (but for an article's title in the article's own
header); so are nodes whose text was constant on ``MIN_PAGES`` different pages, and
inside a marked article the lines that all pages have.  The varying slots are the
content; where a host's marked articles hold most of it over all its pages, they
alone, as a whole, on each of its pages that has one.

Defined cases: null or empty html gives an empty text; a null url is a host of
its own name ''; unclosed and crossed tags end where their parents end; nesting
beyond ``MAX_DEPTH`` shares that depth's node, but a role below it still counts;
repeated rows are extracted as rows; an empty table gives an empty result; other
columns are ignored.  Parsing takes time in proportion to the page.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import materialise

MIN_PAGES = 3
MAX_DEPTH = 60
#: Parts in which the trees of one layout are joined before they become one.
PARTS = 64
#: Layouts that a task gathers before it passes them on.
HELD = 5000
#: Digits of a layout's name by which the layouts of a host are merged in parts, step by step.
STEPS = (3, 1, 0)

# Element names of the HTML standard by their role here (fixed values).
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset("head script style nav header footer aside form button select textarea input iframe noscript template svg menu dialog title object canvas noembed noframes".split())
#: What an element's start closes, if open since the nearest of the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Words in class, id and role that mark a template node.
NOISE = frozenset("ad ads advert adverts advertisement banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs header footer sidebar aside widget cookie cookies consent notice notices alert popup modal newsletter subscribe share sharing social related recommended comment comments reply replies disqus form search login signup complementary contentinfo".split())
MAIN = frozenset(("article", "main"))
#: Rows of a list or table: judged together, as a constant row among varying ones is content.
ROWS = frozenset("li dt dd tr td th option".split())

_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([A-Za-z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*+)>|(/?)([A-Za-z][^\s/>]*)([^>]*)>)""", re.S)
_MARK = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[-_]+")
#: Elements that the words say nothing about: a class of theirs speaks of the whole page or text.
WHOLE = frozenset("html body main article h1".split())
_ENDS: dict[str, re.Pattern] = {}


def _noisy(attributes: str) -> bool:
    for _, a, b, c in _MARK.findall(attributes):
        # whole tokens ("comments", "cookie-notice"), not words inside them ("has-sidebar", "comments-open")
        if any(all(w in NOISE for w in _PARTS.split(token)) for token in (a or b or c).lower().split()):
            return True
    return False


class _Open:
    """The open elements, with the places of each name and of the blocks."""

    def __init__(self):
        self.names: list[str] = ["#"]
        self.nodes: list[int] = [0]
        self.roles: list[str] = [""]  # why an element's text is template: "", "header" (of an article) or "noise"
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, name: str, node: int, role: str) -> None:
        self.places.setdefault(name, []).append(len(self.names))
        if name in BLOCKS:
            self.blocks.append(len(self.names))
        self.names.append(name)
        self.nodes.append(node)
        self.roles.append(role)

    def last(self, name: str) -> int:
        """The place of the innermost open element of a name; 0 for none."""
        return self.places[name][-1] if self.places.get(name) else 0

    def cut(self, place: int) -> None:
        """Close the element at ``place`` and all inside it."""
        while len(self.names) > place:
            name = self.names.pop()
            self.nodes.pop()
            self.roles.pop()
            self.places[name].pop()
            if name in BLOCKS:
                self.blocks.pop()

    def block_inside(self, place: int) -> bool:
        return bool(self.blocks) and self.blocks[-1] > place


class Page:
    """Elements (label, parent) and texts (element, block, text, under a role) of a page."""

    def __init__(self, source: str):
        self.labels, self.parents, self.noise = ["#"], [-1], [False]
        self.texts: list[tuple[int, int, str, bool]] = []
        opened, block, at = _Open(), 0, 0
        last = source.rfind(">") + 1  # behind it no tag ends: what begins like a comment there goes, the rest is text
        if m := re.compile("<[!?]").search(source, last):
            source = source[:m.start()]
        while at < len(source):
            m = _TAG.search(source, at, last)
            end = m.start() if m else len(source)
            if end > at:
                self.texts.append((opened.nodes[-1], block, source[at:end], opened.roles[-1] != ""))
            if not m:
                break
            at = m.end()
            close, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if not name:
                continue
            name = name.lower()
            if close:
                if k := opened.last(name):
                    if name in BLOCKS or not opened.block_inside(k):
                        opened.cut(k)
                    block += name in BLOCKS
                elif name == "p":
                    block += 1
                continue
            if name in CLOSES:
                ends, scope = CLOSES[name]
                k = max(opened.last(t) for t in ends)
                if k > max(opened.last(t) for t in scope):
                    opened.cut(k)
            if name in BLOCKS:
                block += 1
                if (k := opened.last("p")) and not (opened.blocks[-1] > k):
                    opened.cut(k)
            if name in VOID:
                if name == "br":
                    self.texts.append((opened.nodes[-1], block, " ", opened.roles[-1] != ""))
                continue
            noisy = name in DROPPED or (name not in WHOLE and bool(attributes) and _noisy(attributes))
            role = opened.roles[-1]
            if noisy and role != "noise":
                inside = max(opened.last(t) for t in MAIN) > 0
                role = "header" if name == "header" and inside and not (attributes and _noisy(attributes)) else "noise"
            elif name == "h1" and role == "header":
                role = ""  # the title of an article, in the article's own header
            if len(opened.nodes) <= MAX_DEPTH:
                self.labels.append(name + "!" * (role != ""))
                self.parents.append(opened.nodes[-1])
                self.noise.append(role != "")
                node = len(self.labels) - 1
            else:
                node = opened.nodes[-1]
            opened.push(name, node, role)
            if name in RAW and not attributes.endswith("/"):
                if name not in _ENDS:
                    _ENDS[name] = re.compile(rf"</{name}\s*(?:>|\Z)", re.I)
                e = _ENDS[name].search(source, at)
                at = e.start() if e else len(source)
        self._fold()

    def _fold(self) -> None:
        """Folded tree: consecutive siblings of one label are one node."""
        n = len(self.labels)
        last: list[list[int]] = [[]]  # children of a folded node
        self.fold, self.fold_label = [0] * n, ["#"]
        self.in_row = [False] * n
        for i in range(1, n):
            up = self.fold[self.parents[i]]
            self.in_row[i] = self.in_row[self.parents[i]] or self.labels[i].rstrip("!") in ROWS
            kids = last[up]
            # equal siblings anywhere in a row share the node; the row ends at another label
            if kids and self.fold_label[kids[-1]] == self.labels[i]:
                self.fold[i] = kids[-1]
            else:
                self.fold[i] = len(self.fold_label)
                self.fold_label.append(self.labels[i])
                last.append([])
                kids.append(self.fold[i])
        self.children = last

    def line_marks(self) -> dict[int, int]:
        """A mark of the whole text of each block."""
        blocks: dict[int, list[str]] = {}
        for _, block, t, _ in self.texts:
            blocks.setdefault(block, []).append(t)
        return {block: crc32(" ".join("".join(parts).split()).encode("utf-8", "replace")) for block, parts in blocks.items()}

    def tree(self) -> list:
        """[label, children, page marks, text mark, line marks, characters] of the
        folded tree; the text mark is of the node's own texts, the line marks are of
        the distinct lines that they stand in, the characters are of its texts under no role."""
        own: dict[int, list[str]] = {}
        lines: dict[int, set[int]] = {}
        marks = self.line_marks()
        chars = [0] * len(self.fold_label)
        for e, block, t, role in self.texts:
            if t := t.strip():
                if not role:
                    chars[self.fold[e]] += len("".join(t.split()))
                own.setdefault(self.fold[e], []).append(t)
                if not self.in_row[e]:
                    lines.setdefault(self.fold[e], set()).add(marks[block])
        page = crc32("\n".join(t for k in sorted(own) for t in own[k]).encode("utf-8", "replace"))
        nodes = [[label, [], [page], crc32("\n".join(own.get(i, [])).encode("utf-8", "replace")), sorted(lines.get(i, ())), chars[i]] for i, label in enumerate(self.fold_label)]
        for i, kids in enumerate(self.children):
            nodes[i][1] = [nodes[k] for k in kids]
        return nodes[0]


def _signature(node: list) -> str:
    return node[0] + ("(" + ",".join(_signature(c) for c in node[1]) + ")" if node[1] else "")


def match(a: list, b: list, memo: dict) -> int:
    """Simple tree matching: the largest number of node pairs of two trees
    that keeps parents and the order of siblings."""
    if a[0] != b[0]:
        return 0
    key = (id(a), id(b))
    if key not in memo:
        memo[key] = 1 + _rows(a, b, memo)[len(a[1])][len(b[1])]
    return memo[key]


def _rows(a: list, b: list, memo: dict) -> list[list[int]]:
    rows = [[0] * (len(b[1]) + 1)]
    for x in a[1]:
        row = [0]
        for j, y in enumerate(b[1]):
            row.append(max(row[j], rows[-1][j + 1], rows[-1][j] + match(x, y, memo)))
        rows.append(row)
    return rows


def aligned(a: list, b: list, memo: dict) -> list[tuple[int, int]]:
    """The matched children of two nodes that match, in order."""
    rows, pairs = _rows(a, b, memo), []
    i, j = len(a[1]), len(b[1])
    while i and j:
        if rows[i][j] == rows[i - 1][j]:
            i -= 1
        elif rows[i][j] == rows[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return pairs[::-1]


def merge(a: list, b: list, memo: dict) -> list:
    """One wrapper for two: matched nodes join, others stand in order."""
    kids, i, j = [], 0, 0
    for x, y in [*aligned(a, b, memo), (len(a[1]), len(b[1]))]:
        kids += a[1][i:x] + b[1][j:y]
        if x < len(a[1]):
            kids.append(merge(a[1][x], b[1][y], memo))
        i, j = x + 1, y + 1
    marks = sorted({*a[2], *b[2]})[:MIN_PAGES]
    return [a[0], kids, marks, a[3] if a[3] == b[3] else None, a[4] if a[4] == b[4] else sorted({*a[4]} & {*b[4]}), a[5] + b[5]]


def merged(trees: list[list]) -> list:
    out = trees[0]
    for t in trees[1:]:
        out = merge(out, t, {})
    return out


def slots_of(page: Page, wrapper: list | None) -> list[Slot]:
    """For each text of a page what the host's wrapper says about it."""
    tree = page.tree()
    index = {}
    todo = [(tree, 0)]
    while todo:
        node, i = todo.pop()
        index[id(node)] = i
        todo += zip(node[1], page.children[i])
    memo: dict = {}
    inside_at, constant_at = [False] * len(page.fold_label), [False] * len(page.fold_label)
    known: list[frozenset[int]] = [frozenset()] * len(page.fold_label)  # lines of a node that all pages have
    todo = [(tree, wrapper, False)]
    while todo:
        node, other, inside = todo.pop()
        i = index[id(node)]
        inside_at[i] = inside = inside or node[0] in MAIN
        seen = other is not None and len(other[2]) >= MIN_PAGES
        constant_at[i] = seen and other[3] is not None
        if seen:
            known[i] = frozenset(other[4])
        pairs = dict(aligned(node, other, memo)) if other is not None else {}
        todo += [(c, other[1][pairs[k]] if k in pairs else None, inside) for k, c in enumerate(node[1])]
    marks = page.line_marks()
    rows = []
    for e, block, _, role in page.texts:
        i = page.fold[e]
        same = not page.in_row[e] and marks[block] in known[i]
        rows.append(Slot(role, inside_at[i], same if inside_at[i] else constant_at[i] or same))
    return rows


class Slot(NamedTuple):
    """What the wrapper says about one text of a page."""
    role: bool  # under a menu, header, ...
    inside: bool  # in a marked article
    constant: bool  # the same on all pages


def by_articles(wrapper: list) -> bool:
    """Whether a host's marked articles hold most of what varies on its pages (of
    all text, if nothing does)."""
    held = [[0, 0], [0, 0]]
    todo = [(wrapper, False)]
    while todo:
        node, inside = todo.pop()
        inside = inside or node[0] in MAIN
        held[len(node[2]) >= MIN_PAGES and node[3] is not None][inside] += node[5]
        todo += [(c, inside) for c in node[1]]
    outside, within = held[0] if any(held[0]) else held[1]
    return within > outside


def extract(page: Page, slots: list[Slot], articles: bool) -> str:
    """The content; of marked articles alone, if ``articles`` and the page has one."""
    articles = articles and any(s.inside and not s.role for s in slots)
    blocks: dict[int, list[str]] = {}
    for (_, block, text, _), slot in zip(page.texts, slots):
        if not (slot.role or slot.constant or (articles and not slot.inside)):
            blocks.setdefault(block, []).append(html.unescape(text))
    lines = (" ".join("".join(parts).split()) for _, parts in sorted(blocks.items()))
    return "\n".join(x for x in lines if x)


def overlaid(a: list, b: list) -> list:
    """Two trees of one layout as one; in any order the same."""
    marks = sorted({*a[2], *b[2]})[:MIN_PAGES]
    return [a[0], [overlaid(x, y) for x, y in zip(a[1], b[1])], marks, a[3] if a[3] == b[3] else None, a[4] if a[4] == b[4] else sorted({*a[4]} & {*b[4]}), a[5] + b[5]]


def signature(tree: list) -> str:
    """The name of a layout."""
    return hashlib.md5(_signature(tree).encode("utf-8", "replace")).hexdigest()


_LAYOUT = "host string, layout string, wrapper string"


def _table(rows) -> pa.RecordBatch:
    hosts, layouts, trees = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(layouts, pa.string()), pa.array([json.dumps(t) for t in trees], pa.string())], names=["host", "layout", "wrapper"])


def _layouts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One tree per host and layout of a task, passed on when ``HELD`` are there."""
    found: dict[tuple[str, str], list] = {}
    for b in it:
        for host, source in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
            tree = Page(source).tree()
            key = host, signature(tree)
            found[key] = overlaid(found[key], tree) if key in found else tree
            if len(found) >= HELD:
                yield _table([(*k, t) for k, t in found.items()])
                found.clear()
    yield _table([(*k, t) for k, t in found.items()])


def _one_layout(table: pa.Table) -> pa.Table:
    out = None
    for text in table.column("wrapper"):
        tree = json.loads(text.as_py())
        out = tree if out is None else overlaid(out, tree)
    return pa.Table.from_batches([_table([(table.column("host")[0].as_py(), table.column("layout")[0].as_py(), out)])])


def _aligned_layouts(table: pa.Table) -> pa.Table:
    """The trees of a host, merged in the order of their names."""
    rows = sorted(zip(table.column("layout").to_pylist(), table.column("wrapper").to_pylist()))
    out = merged([json.loads(t) for _, t in rows])
    return pa.Table.from_batches([_table([(table.column("host")[0].as_py(), rows[0][0], out)])])


def _named(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages with the name of their layout."""
    for b in it:
        names = [signature(Page(source).tree()) for source in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string())], names=[*b.schema.names, "layout"])


def _decided(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hosts' wrappers with whether the host goes by its articles."""
    for b in it:
        marked = [by_articles(json.loads(t)) for t in b.column("wrapper").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("host"), b.column("wrapper"), pa.array(marked, pa.bool_())], names=["host", "wrapper", "marked"])


def _read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages with their wrapper -> their content."""
    known: dict[str, list] = {}
    for b in it:
        texts = []
        for source, wrapper, marked in zip(b.column("html").to_pylist(), b.column("wrapper").to_pylist(), b.column("marked").to_pylist()):
            if wrapper not in known:
                if len(known) > 1000:
                    known.clear()
                known[wrapper] = json.loads(wrapper) if wrapper else None
            page = Page(source)
            texts.append(extract(page, slots_of(page, known[wrapper]), bool(marked)))
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"), host.alias("host"))
    trees = src.select("host", "html").mapInArrow(_layouts, _LAYOUT)
    # a common layout comes from every task: its trees are joined in parts first
    trees = trees.groupBy("host", "layout", F.pmod(F.xxhash64("wrapper"), F.lit(PARTS))).applyInArrow(_one_layout, _LAYOUT)
    layouts = materialise(trees.groupBy("host", "layout").applyInArrow(_one_layout, _LAYOUT))
    trees = layouts
    for digits in STEPS:  # layouts of a host, merged in parts that their names give
        trees = trees.groupBy("host", F.substring("layout", 1, digits)).applyInArrow(_aligned_layouts, _LAYOUT) if digits else trees.groupBy("host").applyInArrow(_aligned_layouts, _LAYOUT)
    wrappers = materialise(trees.select("host", "wrapper").mapInArrow(_decided, "host string, wrapper string, marked boolean"))
    # a tree begins with its label and children and holds its pages' marks third
    several = F.size(F.from_json(F.get_json_object("wrapper", "$[2]"), "array<long>")) >= MIN_PAGES
    own = layouts.where(several).select("host", "layout", F.col("wrapper").alias("own"))
    named = src.mapInArrow(_named, "page_id long, url string, html string, host string, layout string").join(own, ["host", "layout"], "left").join(wrappers, "host", "left")
    return named.select("page_id", "url", "html", F.coalesce("own", "wrapper").alias("wrapper"), "marked").mapInArrow(_read, "page_id long, url string, text string, n_chars long")
