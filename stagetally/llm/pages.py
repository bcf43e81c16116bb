"""Main text of web pages by wrapper induction over the pages of a host."""

from __future__ import annotations

import html as entities
import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_batches, stored

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_RAW = {"script", "style", "textarea", "title", "xmp", "noscript", "iframe", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
#: An opening tag closes what is open of these, up to the nearest of the second set.
_CLOSES = {t: ({"p"}, {"button", "td", "th", "caption", "object"}) for t in _BLOCK - {"html", "body", "tbody", "thead", "tfoot", "tr", "caption", "legend"}}
_CLOSES |= {
    "li": ({"li", "p"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd", "p"}, {"dl"}),
    "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}),
    "td": ({"td", "th", "p"}, {"table", "tr"}),
    "th": ({"td", "th", "p"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "p"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tr", "td", "th", "p"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
#: Elements that never hold an article's text.
_DROPPED = set(
    "head script style noscript template iframe object svg math canvas nav aside footer form button select option textarea "
    "input label dialog menu audio video map".split()
)
#: Words in class, id or role that mark what surrounds an article.
_MARKS = set(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion breadcrumb breadcrumbs footer "
    "masthead complementary contentinfo comment comments commentlist disqus respond replies reply cookie cookies consent gdpr notice "
    "notices popup modal newsletter subscribe subscription signup login pagination pager".split()
)
#: Words that mark it too, but are also given to frames around a whole page ("page with-sidebar").
_LOOSE_MARKS = set(
    "banner navigation nav navbar menu sidebar alert overlay share sharing social related recommended recommendations toolbar "
    "widget widgets skip search hidden".split()
)
#: What the closing tag of an inline element does not reach beyond.
_WALLS = {"td", "th", "table", "article", "body"}
#: Elements that may hold a page's parts; the path of those with most of the text is a page's layout.
_FRAMES = {"html", "body", "main", "article", "section", "div", "center", "form", "table", "tbody", "tr", "td"}
#: Of lists of links, those with shorter links than this on average are menus.
_LINK_CHARS = 25


class Node:
    """An element, or a piece of text (``tag`` is then empty)."""

    __slots__ = ("tag", "attributes", "children", "text")

    def __init__(self, tag: str, attributes: str = "", text: str = ""):
        self.tag, self.attributes, self.children, self.text = tag, attributes, [], text

    def attribute(self, name: str) -> str:
        for key, value in _ATTRIBUTE.findall(self.attributes):
            if key.lower() == name:
                return entities.unescape(value.strip("\"'"))
        return ""


class _Open:
    """The open elements, and where in them each tag is, so that no tag has to look through all of them."""

    def __init__(self, root: Node):
        self.nodes, self.at = [root], {}

    def last(self, tags: set[str]) -> int:
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, low: int) -> None:
        for node in self.nodes[low:]:
            self.at[node.tag].pop()
        del self.nodes[low:]

    def close(self, tag: str) -> None:
        """Close the innermost ``tag`` and what is open in it; inline tags don't close what is around a cell or an article."""
        own = self.at.get(tag)
        if own and (tag in _BLOCK or self.last(_WALLS) <= own[-1]):
            self.cut(own[-1])

    def imply(self, closed: set[str], limits: set[str]) -> None:
        limit = self.last(limits - closed)
        low = min((own[i] for t in closed if (own := self.at.get(t)) and (i := bisect_right(own, limit)) < len(own)), default=0)
        if low:
            self.cut(low)


def parse(source: str) -> Node:
    """The page as a tree; what is left open or closed twice does no harm."""
    root = Node("#root")
    stack, at, n = _Open(root), 0, len(source)
    while at < n:
        found = _TOKEN.search(source, at)
        if found is None:
            stack.nodes[-1].children.append(Node("", text=source[at:]))
            break
        if found.start() > at:
            stack.nodes[-1].children.append(Node("", text=source[at : found.start()]))
        at = found.end() if found.end() > found.start() else found.start() + 1
        if found.group(2) is None:
            continue
        tag = found.group(2).lower()
        if found.group(1):
            stack.close(tag)
            continue
        if tag in _CLOSES:
            stack.imply(*_CLOSES[tag])
        node = Node(tag, found.group(3))
        stack.nodes[-1].children.append(node)
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|$)", re.I).search(source, at)
            at = end.end() if end else n
        elif tag not in _VOID and not found.group(3).rstrip().endswith("/"):
            stack.push(node)
    return root


def text_size(node: Node) -> tuple[int, int, int]:
    """Characters of the text below, those in links, and links."""
    total = chars = links = 0
    todo = [(node, False)]
    while todo:
        x, link = todo.pop()
        if not x.tag:
            total += len(x.text.strip())
            chars += len(x.text.strip()) * link
        elif x.tag == "form" or x.tag not in _DROPPED:
            links += x.tag == "a"
            todo += [(c, link or x.tag == "a") for c in x.children]
    return total, chars, links


def _holds(node: Node, tags: set[str]) -> bool:
    todo = [node]
    while todo:
        x = todo.pop()
        if x.tag in tags:
            return True
        todo += [c for c in x.children if c.tag]
    return False


def surrounding(node: Node, inside: bool, whole: int, lenient: bool = False) -> bool:
    """Whether the element is no part of an article by its name, role or marks.

    ``inside`` an article, headers may hold its title.  On an element with more
    than half of the ``whole`` text a loose mark does not count; nor does a
    plain mark, or the name ``form``, if the element holds a main title, main
    part or article too, or if the reading is ``lenient``.
    """

    def frame() -> bool:
        return 2 * text_size(node)[0] > whole and (lenient or _holds(node, {"article", "main", "h1"}))

    if node.tag == "form":
        return not frame()
    if node.tag in _DROPPED or (node.tag == "header" and not inside):
        return True
    if not node.attributes.strip():
        return False
    if node.tag in ("html", "body", "article", "main"):
        return False
    named = " ".join(node.attribute(a) for a in ("class", "id", "role"))
    words = set(re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", named).lower()))
    if words & _MARKS and not frame():
        return True
    if words & _LOOSE_MARKS and 2 * text_size(node)[0] <= whole:
        return True
    style = node.attribute("style").replace(" ", "").lower()
    keys = {k.lower() for k, _ in _ATTRIBUTE.findall(node.attributes)}
    return "hidden" in keys or node.attribute("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style


# Wrapper induction


class Shape:
    """An element as alignment sees it: a symbol, its children, its size, and hashes of its elements and of all that is in it."""

    __slots__ = ("symbol", "children", "node", "number", "size", "form", "key", "filled")

    def __init__(self, node: Node, number: int):
        self.node, self.number = node, number
        self.symbol = f"{node.tag}.{node.attribute('class')}" if node.attributes.strip() else node.tag
        self.children, self.size, self.form, self.key, self.filled = [], 1, 0, 0, False


def shape_of(root: Node) -> tuple[Shape, list[Shape]]:
    """The tree for alignment, and its shapes in page order; of any depth."""
    found: list[Shape] = []
    below: dict[int, Shape] = {}
    todo = [(root, False)]
    while todo:
        node, done = todo.pop()
        if not done:
            below[id(node)] = shape = Shape(node, len(found))
            found.append(shape)
            todo.append((node, True))
            todo += [(c, False) for c in reversed(node.children) if c.tag and c.tag not in _RAW]
            continue
        shape, parts = below[id(node)], []
        for child in node.children:
            if not child.tag:
                parts += child.text.split()
            elif child.tag not in _RAW:
                own = below[id(child)]
                shape.children.append(own)
                shape.size += own.size
                shape.filled |= own.filled
                parts.append(own.key)
        shape.filled |= any(type(x) is str for x in parts)
        shape.key = hash((shape.symbol, *parts))
        shape.form = hash((shape.symbol, *[c.form for c in shape.children]))
    return below[id(root)], found


#: Matching tables with more cells are computed a row at a time in numpy; the result is the same.
_CELLS = 10_000
#: A pair of aligned nodes counts this much more than a pair with equal content.
_PAIR = 1 << 32


def _nodes(top: Shape) -> list[Shape]:
    found, todo = [], [top]
    while todo:
        x = todo.pop()
        found.append(x)
        todo += reversed(x.children)
    return found


class _Wide:
    """Two long lists of children, each known by its signs; gives the rows of their matching table."""

    def __init__(self, matching: "Matching", xs: list[Shape], ys: list[Shape]):
        self.matching, self.xs, self.ys = matching, xs, ys
        self.kinds = list({matching.signs_a[x.number]: x for x in xs}.values())
        signs = [matching.signs_b[y.number] for y in ys]
        firsts = dict(zip(reversed(signs), reversed(ys)))
        place = {sign: i for i, sign in enumerate(firsts)}
        self.place = np.array([place[sign] for sign in signs])
        self.forms: dict[str, dict[int, tuple[list[Shape], list[int]]]] = {}
        for i, y in enumerate(firsts.values()):
            members, at = self.forms.setdefault(y.symbol, {}).setdefault(y.form, ([], []))
            members.append(y)
            at.append(i)
        self.keys = {
            form: np.array([[z.key for z in _nodes(y)] for y in members], np.int64).T.copy()
            for of_symbol in self.forms.values()
            for form, (members, _) in of_symbol.items()
        }
        self.asked, self.kept = 0, {}

    def missing(self) -> list[tuple[Shape, Shape]]:
        """Pairs whose values are needed and not known yet, of one child at a time."""
        while self.asked < len(self.kinds):
            x = self.kinds[self.asked]
            self.asked += 1
            others = [m for f, (m, _) in self.forms.get(x.symbol, {}).items() if f != x.form]
            found = [(x, y) for members in others for y in members if self.matching._known(x, y) is None]
            if found:
                return found
        return []

    def weights(self, x: Shape) -> np.ndarray:
        """Values of ``x`` against each of the other list."""
        sign = self.matching.signs_a[x.number]
        if sign not in self.kept:
            if len(self.kept) > 100:
                self.kept.clear()
            values = np.zeros(int(self.place.max(initial=-1)) + 1, np.int64)
            for form, (members, at) in self.forms.get(x.symbol, {}).items():
                if form == x.form:
                    own = np.array([z.key for z in _nodes(x)], np.int64)
                    values[at] = x.size * _PAIR + (self.keys[form] == own[:, None]).sum(axis=0)
                else:
                    values[at] = [self.matching._known(x, y) for y in members]
            self.kept[sign] = values[self.place]
        return self.kept[sign]

    def rows(self, row: np.ndarray, low: int, high: int) -> Iterator[np.ndarray]:
        """The table's rows after ``row``, which is that of the first ``low`` children."""
        for x in self.xs[low:high]:
            new = row.copy()
            np.maximum(new[1:], row[:-1] + self.weights(x), out=new[1:])
            row = np.maximum.accumulate(new)
            yield row

    def first(self) -> np.ndarray:
        return np.zeros(len(self.ys) + 1, np.int64)

    def value(self) -> int:
        row = self.first()
        for row in self.rows(row, 0, len(self.xs)):
            pass
        return int(row[-1])

    def pairs(self) -> list[tuple[Shape, Shape]]:
        """The aligned children; some rows are kept, and those between them computed again."""
        step = math.isqrt(len(self.xs)) + 1
        marks, row = [], self.first()
        for low in range(0, len(self.xs), step):
            marks.append((low, row))
            for row in self.rows(row, low, low + step):
                pass
        out, j = [], len(self.ys)
        for low, row in reversed(marks):
            table = [row, *self.rows(row, low, low + step)]
            i = len(table) - 1
            while i and j:
                if table[i][j] == table[i - 1][j]:
                    i -= 1
                elif table[i][j] == table[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    out.append((self.xs[low + i], self.ys[j]))
        return out


class Matching:
    """Simple tree matching of two trees: symbols equal, order and parents kept.

    It aligns as many nodes as it can, and of such alignments takes one with
    the most nodes of equal content, whatever the trees' sizes.  Trees of one
    form match node by node, and equal children at both ends of a list each
    other, which never costs a pair; what is between them is matched by a
    table.  If a table is long, a value is computed once for all nodes of one
    sign: those with equal content if the other tree has that content too,
    otherwise those with equal symbols and signs of children.  Tables with more than ``cells`` cells
    are computed by :class:`_Wide`, to the same result; a list's time grows
    with the product of both lengths, its memory with their sum times the root
    of one.
    """

    def __init__(self, a: Shape, b: Shape, cells: int = _CELLS):
        self.top, self.cells = (a, b), cells
        self.plans: dict[tuple[int, int], tuple] = {}
        self.values: dict[tuple[int, int], int] = {}
        self.signs_a, self.signs_b = {}, {}
        todo = [(a, b)]
        while todo:
            x, y = todo[-1]
            if self._known(x, y) is not None:
                todo.pop()
                continue
            equal, xs, ys, wide = self._plan(x, y)
            if wide is None:
                needed = [(p, q) for p in xs for q in ys if self._known(p, q) is None]
            else:
                needed = wide.missing()
            if needed:
                todo += needed
                continue
            todo.pop()
            value = _PAIR + sum(p.size * (_PAIR + 1) for p, _ in equal)
            value += wide.value() if wide is not None else self._rows(xs, ys)[-1][-1]
            self.values[self._signs(x, y)] = value
            if wide is not None:
                del self.plans[x.number, y.number]

    def _signs(self, x: Shape, y: Shape) -> tuple[int, int]:
        return (self.signs_a[x.number], self.signs_b[y.number]) if self.signs_a else (x.number, y.number)

    def _sign(self) -> None:
        """From the first long table on, values go by signs; until then by the nodes themselves."""
        left, right = map(_nodes, self.top)
        common = {x.key for x in left} & {y.key for y in right}
        signs: dict = {}
        for nodes, own in ((left, self.signs_a), (right, self.signs_b)):
            for x in reversed(nodes):
                kind = x.key if x.key in common else (x.symbol, *[own[c.number] for c in x.children])
                own[x.number] = signs.setdefault(kind, len(signs))
        self.values = {(self.signs_a[i], self.signs_b[j]): value for (i, j), value in self.values.items()}

    def _known(self, x: Shape, y: Shape) -> int | None:
        if x.symbol != y.symbol:
            return 0
        if x.key == y.key:
            return x.size * (_PAIR + 1)
        if not x.children or not y.children:
            return _PAIR
        signs = self._signs(x, y)
        value = self.values.get(signs)
        if value is None and x.form == y.form:
            value = self.values[signs] = self._in_step(x, y)
        return value

    @staticmethod
    def _in_step(x: Shape, y: Shape) -> int:
        """The value of two trees of one form: all nodes are aligned, which only one alignment does."""
        value, todo = x.size * _PAIR, [(x, y)]
        while todo:
            a, b = todo.pop()
            if a.key == b.key:
                value += a.size
            else:
                todo += zip(a.children, b.children)
        return value

    def _plan(self, x: Shape, y: Shape) -> tuple:
        plan = self.plans.get((x.number, y.number))
        if plan is None:
            xs, ys, low = x.children, y.children, 0
            high = min(len(xs), len(ys))
            while low < high and xs[low].key == ys[low].key:
                low += 1
            tail = 0
            while tail < high - low and xs[-1 - tail].key == ys[-1 - tail].key:
                tail += 1
            equal = [*zip(xs[:low], ys[:low]), *zip(xs[len(xs) - tail :], ys[len(ys) - tail :])]
            xs, ys = xs[low : len(xs) - tail], ys[low : len(ys) - tail]
            wide = None
            if len(xs) * len(ys) > self.cells:
                if not self.signs_a:
                    self._sign()
                wide = _Wide(self, xs, ys)
            plan = self.plans[x.number, y.number] = (equal, xs, ys, wide)
        return plan

    def _rows(self, xs: list[Shape], ys: list[Shape]) -> list[list[int]]:
        row = [0] * (len(ys) + 1)
        rows = [row]
        for x in xs:
            new = [0]
            for j, y in enumerate(ys):
                best = row[j + 1] if row[j + 1] >= new[j] else new[j]
                if x.symbol == y.symbol:
                    best = max(best, row[j] + self._known(x, y))
                new.append(best)
            rows.append(new)
            row = new
        return rows

    def size(self) -> int:
        """How many pairs of nodes are aligned."""
        return self._known(*self.top) // _PAIR

    def pairs(self) -> list[tuple[Shape, Shape]]:
        """The aligned pairs."""
        out, todo = [], [self.top] if self.size() else []
        while todo:
            x, y = todo.pop()
            out.append((x, y))
            if x.form == y.form:
                todo += zip(x.children, y.children)
                continue
            if not x.children or not y.children:
                continue
            equal, xs, ys, wide = self._plan(x, y)
            todo += equal
            if wide is not None:
                todo += wide.pairs()
                continue
            rows, i, j = self._rows(xs, ys), len(xs), len(ys)
            while i and j:
                if rows[i][j] == rows[i - 1][j]:
                    i -= 1
                elif rows[i][j] == rows[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    todo.append((xs[i], ys[j]))
        return out


def alignment(a: Shape, b: Shape) -> list[tuple[Shape, Shape]]:
    """The aligned pairs of two trees."""
    return Matching(a, b).pairs()


def layout_of(root: Node) -> str:
    """The path of the frames with most text, down to an article, which pages of one template share as a rule."""
    return _frames(root)[0]


def frame_text(root: Node) -> str:
    """All text of the last frame on that path."""
    pieces, todo = [], [_frames(root)[1]]
    while todo:
        node = todo.pop()
        if not node.tag:
            pieces += node.text.split()
        elif node.tag not in _RAW:
            todo += reversed(node.children)
    return " ".join(pieces)


def _frames(root: Node) -> tuple[str, Node]:
    sizes: dict[int, int] = {}
    todo = [(root, False)]
    while todo:
        node, done = todo.pop()
        if not done and node.tag:
            todo.append((node, True))
            todo += [(c, False) for c in node.children]
        elif node.tag:
            sizes[id(node)] = 0 if node.tag in _RAW else sum(sizes[id(c)] for c in node.children)
        else:
            sizes[id(node)] = len(node.text.strip())
    path, last = [], root
    while last.tag != "article":
        frames = [c for c in last.children if c.tag in _FRAMES and any(x.tag in _BLOCK for x in c.children)]
        if not frames:
            break
        last = max(frames, key=lambda c: sizes[id(c)])
        path.append(f"{last.tag}.{last.attribute('class')}" if last.attributes.strip() else last.tag)
    return "/".join(path), last


def main_text(root: Node, template: set[int]) -> str:
    """The article's blocks, joined by empty lines; ``template`` holds the ids of nodes that all pages of the layout share.

    If articles (else main parts) hold half or more of what is no surrounding,
    the text is theirs; otherwise it is the body's, without menus.  A page
    whose whole text lies in a form or in a frame with a mark is read again
    with these taken for frames.
    """
    return _main_text(root, template, False) or _main_text(root, template, True)


def _parts(root: Node, tags: set[str], whole: int, lenient: bool) -> list[Node]:
    """The outermost of these elements (a role of ``main`` counts as the tag) that no surrounding holds."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.tag in tags or ("main" in tags and node.attribute("role") == "main"):
            found.append(node)
        elif node is root or not surrounding(node, False, whole, lenient):
            todo += [c for c in reversed(node.children) if c.tag and c.tag not in ("head", "script")]
    return found


def _kept_size(root: Node, template: set[int], whole: int, lenient: bool) -> int:
    """Characters of the text that is neither template nor surrounding."""
    total, todo = 0, [root]
    while todo:
        node = todo.pop()
        if not node.tag:
            total += len(node.text.strip())
        elif id(node) not in template and not surrounding(node, False, whole, lenient) and not _menu(node):
            todo += node.children
    return total


def _menu(node: Node) -> bool:
    """Whether a list or table is mostly short links."""
    if node.tag not in ("ul", "ol", "dl", "table"):
        return False
    total, chars, links = text_size(node)
    return chars > 0.6 * total and chars < _LINK_CHARS * links


def _main_text(root: Node, template: set[int], lenient: bool) -> str:
    blocks: list[str] = []
    pieces: list[str] = []

    def flush() -> None:
        text = " ".join(entities.unescape("".join(pieces)).split())
        if text:
            blocks.append(text)
        pieces.clear()

    whole = text_size(root)[0]
    parts: list[Node] = []
    for tags in ({"article"}, {"main"}):
        found = _parts(root, tags, whole, lenient)
        if found:
            all_ = _kept_size(root, template, whole, lenient)
            if 2 * sum(_kept_size(p, template, whole, lenient) for p in found) >= all_:
                parts = found
                break
    inside = bool(parts)
    whole = sum(text_size(p)[0] for p in parts) or whole

    # Entered and left nodes are kept in a list, so deep pages need no deep calls.
    todo: list[tuple[Node, bool]] = [(p, True) for p in reversed(parts or [root])]
    while todo:
        node, entering = todo.pop()
        if not node.tag:
            pieces.append(node.text)
            continue
        if not entering:
            flush()
            continue
        if surrounding(node, inside, whole, lenient) or id(node) in template:
            continue
        if not inside and _menu(node):
            continue
        if node.tag in _BLOCK:
            flush()
            todo.append((node, False))
        elif node.tag in ("br", "td", "th", "img"):
            pieces.append(" ")
        todo += [(c, True) for c in reversed(node.children)]
    flush()
    return "\n\n".join(blocks)


def host_of(url: Column) -> Column:
    """Lower-case host of a URL; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def with_layout(pages: DataFrame) -> DataFrame:
    """``pages`` with ``layout``, null without a host or a page."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            host, html = batch.column("host").to_pylist(), batch.column("html")
            layouts = [None if h is None or not t.is_valid else layout_of(parse(t.as_py())) for h, t in zip(host, html)]
            yield batch.append_column("layout", pa.array(layouts, pa.string()))

    schema = T.StructType([*pages.schema.fields, T.StructField("layout", T.StringType())])
    return by_batches(pages, work, schema)


def references(pages: DataFrame, flush_chars: int = 32_000_000) -> DataFrame:
    """``(host, layout, page, html)``: of each host and layout the page with the smallest key.

    Tasks send one page of each at most (more only if they hold more than
    ``flush_chars``), so a host with very many pages is reduced before it is shuffled.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(least: dict) -> pa.RecordBatch:
            rows = [(*h, p, t) for h, (p, t) in least.items()]
            columns = zip(*rows) if rows else ((), (), (), ())
            kinds = (pa.string(), pa.string(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["host", "layout", "page", "html"])

        least, held = {}, 0
        for batch in batches:
            for host, page, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                key = host, layout_of(parse(text))
                if key not in least or page < least[key][0]:
                    least[key] = (page, text)
                    held += len(text)
            if held > flush_chars:
                yield out(least)
                least, held = {}, 0
        yield out(least)

    rows = pages.where("host IS NOT NULL AND page IS NOT NULL AND html IS NOT NULL").select("host", "page", "html")
    return by_batches(rows, work, "host string, layout string, page long, html string").groupBy("host", "layout").agg(
        F.min(F.struct("page", "html")).alias("r")
    ).select("host", "layout", "r.page", "r.html")


class _Wrappers:
    """Parsed reference pages and their constant nodes by host and layout, the last few hundred kept."""

    def __init__(self, table: dict | None):
        self.table, self.kept = table, {}

    def of(self, host: str | None, root: Node, row: tuple):
        """The wrapper of a page: from the broadcast table by its layout, or what a join has put beside it."""
        if host is None:
            return None
        if self.table is not None:
            row = self.table.get((host, layout_of(root))) or self.table.get((host, None))
        layout, source, constant = row or (None, None, None)
        if source is None:
            return None
        if (host, layout) not in self.kept:
            if len(self.kept) > 300:
                self.kept.clear()
            self.kept[host, layout] = (*shape_of(parse(source)), set(constant or ()), layout)
        return self.kept[host, layout]


def _beside(pages: DataFrame, side: DataFrame, limit: int) -> tuple[DataFrame, object]:
    """``pages`` with the ``wrapper`` of their host and layout, from ``side(host, layout, pages, source, constant)``.

    A page whose layout has none gets that of the host's layout with most
    pages.  The column is null and the wrappers are broadcast if they are below
    ``limit`` characters together; beyond, joins fetch them.
    """
    kind = "struct<layout:string,source:string,constant:array<int>>"
    wrapper = F.struct("layout", "source", "constant").cast(kind)
    main = side.groupBy("host").agg(F.max_by(wrapper, F.struct("pages", "layout")).alias("main"))
    total = side.agg(F.coalesce(F.sum(F.length("source") + 100), F.lit(0))).first()[0]
    if total <= limit:
        found = {(r["host"], r["layout"]): (r["layout"], r["source"], r["constant"]) for r in side.collect()}
        found |= {(r["host"], None): tuple(r["main"]) for r in main.collect()}
        return pages.withColumn("wrapper", F.lit(None).cast(kind)), pages.sparkSession.sparkContext.broadcast(found)
    own = with_layout(pages).join(side.select("host", "layout", wrapper.alias("own")), ["host", "layout"], "left")
    return own.join(main, "host", "left").withColumn("wrapper", F.coalesce("own", "main")), None


def constants(pages: DataFrame, refs: DataFrame, least_pages: int, share: float, limit: int) -> DataFrame:
    """``(host, layout, pages, source, constant)``: each reference page with the numbers of the nodes that its pages share.

    Every page is aligned with the reference of its host and layout.  A node is
    constant if its content is that of the reference on at least ``share`` of
    the different pages, and of at least ``least_pages``.  Pages with one text
    in their main frame count once, so copies of an article don't turn it into
    template.  ``refs``
    should be stored.
    """
    side = refs.select("host", "layout", F.lit(0).alias("pages"), F.col("html").alias("source"), F.lit(None).cast("array<int>").alias("constant"))
    beside, shared = _beside(pages.where("host IS NOT NULL AND html IS NOT NULL").select("host", "html"), side, limit)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        wrappers = _Wrappers(shared.value if shared is not None else None)
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for host, text, row in zip(*(c.to_pylist() for c in batch.columns)):
                root = parse(text)
                wrapper = wrappers.of(host, root, tuple((row or {}).values()))
                if wrapper is None:
                    continue
                equal = [x.number for x, y in alignment(wrapper[0], shape_of(root)[0]) if x.filled and x.key == y.key]
                digest = xxhash.xxh64_intdigest(frame_text(root).encode("utf-8", "surrogatepass")) >> 1
                for column, value in zip(out, (host, wrapper[3], digest, equal)):
                    column.append(value)
            kinds = (pa.string(), pa.string(), pa.int64(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["host", "layout", "digest", "same"])

    by = ["host", "layout"]
    rows = by_batches(beside.select("host", "html", "wrapper"), work, "host string, layout string, digest long, same array<int>")
    # Of pages with one text, one page's alignment counts, whichever comes first in order.
    pages_of = rows.groupBy(*by, "digest").agg(F.min("same").alias("same"))
    counted = pages_of.select(*by, F.explode(F.concat(F.array(F.lit(-1)), "same")).alias("node"))
    counted = stored(counted.groupBy(*by, "node").agg(F.count(F.lit(1)).alias("n")))
    totals = counted.where("node = -1").select(*by, F.col("n").alias("pages"))
    kept = (
        counted.where("node >= 0")
        .join(totals, by)
        .where((F.col("n") >= least_pages) & (F.col("n") >= share * F.col("pages")))
        .groupBy(*by)
        .agg(F.first("pages").alias("pages"), F.sort_array(F.collect_list("node")).alias("constant"))
    )
    return refs.select(*by, F.col("html").alias("source")).join(kept, by)


def main_texts(
    table: DataFrame,
    key: str,
    url: str,
    source: str,
    least_pages: int = 8,
    share: float = 0.9,
    limit: int = 64_000_000,
) -> DataFrame:
    """``(page, url, text)`` for every row: the article's text, blocks joined by an empty line.

    A null or empty page has the text ``""``.  Pages without a host in their
    URL, with a null key, or of hosts and layouts with few pages are read by
    element names and marks alone.  Repeated rows give equal rows; an empty
    table gives an empty result; other columns are ignored.  Pages may be of
    any depth and length; the time of an alignment grows with the product of the
    lengths of lists that differ.
    """
    pages = table.select(
        F.col(key).cast("long").alias("page"), F.col(url).cast("string").alias("url"), F.col(source).cast("string").alias("html")
    ).withColumn("host", host_of(F.col("url")))
    wrappers = stored(constants(pages, stored(references(pages)), least_pages, share, limit))
    beside, shared = _beside(pages, wrappers, limit)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Wrappers(shared.value if shared is not None else None)
        for batch in batches:
            texts = []
            for host, text, row in zip(*(c.to_pylist() for c in batch.columns[2:])):
                root = parse(text or "")
                wrapper, template = known.of(host, root, tuple((row or {}).values())), set()
                if wrapper is not None and wrapper[2]:
                    for x, y in alignment(wrapper[0], shape_of(root)[0]):
                        if x.number in wrapper[2] and x.key == y.key:
                            template.add(id(y.node))
                texts.append(main_text(root, template))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page", "url", "text"]
            )

    return by_batches(
        beside.select("page", "url", "host", "html", "wrapper"), work, "page long, url string, text string"
    )
