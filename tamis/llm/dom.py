"""A small, forgiving HTML parser, roles of elements, and simple tree matching."""

from __future__ import annotations

import html
import re

import numpy as np

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</[a-zA-Z][^>]*>|<([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*)>|[^<]+|<", re.S
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_SPLIT = re.compile(r"[^a-z0-9]+")

# Elements nested deeper become siblings, as in browsers; their text stays, and what is apart stays so.
DEEPEST = 200
# Rows of an alignment are held for so many pairs of children at a time, and made anew for the others.
HELD = 1 << 20

# Element names by their part in HTML.
RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("html body div main article section table tbody tr td center".split())
# Elements, ARIA roles and name parts that mark what isn't the article.
_NOT_TEXT = RAW | frozenset("head nav footer aside form button select option datalist svg canvas object audio video dialog menu".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar sidebars nav navbar navigation menu"
    " breadcrumb breadcrumbs footer cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription share sharing"
    " social related recommended comment comments commentlist respond disqus login signup register search widget widgets toolbar pagination"
    " pager copyright legal disclaimer".split()
)
_HEADS = frozenset("header masthead topbar".split())
# Words of layout that may stand beside a name part.
_LAYOUT = frozenset(
    "area bar bars block body bottom box button buttons card col column container content footer group header icon icons inner inline item items"
    " left link links list main outer panel post posts right row section site slot small space text title top unit wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PAGE = ("#root", "html", "body")


def _named(value: str, names: frozenset[str]) -> bool:
    """Whether a class or id consists of name parts and words of layout only: `related-posts` does, `related-work` doesn't."""
    for token in value.lower().split():
        parts = {w for w in _SPLIT.split(token) if w and not w.isdigit()}
        if parts & names and parts <= names | _LAYOUT:
            return True
    return False


class Node:
    """An element: its name, a name with class and id, and its children, which are nodes and strings."""

    __slots__ = ("tag", "sign", "apart", "children", "length")

    def __init__(self, tag: str, attributes: str = "", parent: str = ""):
        self.tag, self.children, self.length = tag, [], 0
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if "=" in attributes else {}
        self.sign = f"{tag}.{found.get('class', '')}#{found.get('id', '')}".lower() if found else tag
        role = found.get("role", "").lower()
        # Titles of an article become ids: below the page itself they say nothing of headings, sections and paragraphs.
        titled = tag in ("section", "p") and parent not in _PAGE
        marks = f"{found.get('class', '')} {'' if titled else found.get('id', '')}" if found else ""
        free = tag in ("html", "body", "article", "main") or tag in HEADINGS
        # 1: never the article; 2: not the article unless inside one
        if tag in _NOT_TEXT or role in _ROLES or not free and _named(marks, _NAMES):
            self.apart = 1
        else:
            self.apart = 2 if tag == "header" or not free and _named(marks, _HEADS) else 0


def parse(text: str) -> Node:
    """The tree of a page; unclosed and stray tags are put right as browsers do for blocks, lists and tables."""
    root = Node("#root")
    stack = [root]
    at, size = 0, len(text)
    beyond: list[Node] = []  # open elements below the deepest, that hold nothing themselves
    while at < size:
        m = _TOKEN.match(text, at)
        at = m.end()
        token = m[0]
        if token[0] != "<" or token == "<":
            apart = next((n for n in beyond if n.apart), None)
            (apart or stack[-1]).children.append(token)
        elif m[1]:
            tag = m[1].lower()
            if not beyond:
                _close_implied(stack, tag)
            node = Node(tag, m[2], stack[-1].tag)
            stack[-1].children.append(node)
            if tag in RAW:
                end = re.compile(f"</{re.escape(tag)}\\s*>", re.I).search(text, at)
                at = end.end() if end else size
            elif tag not in VOID and not m[2].endswith("/"):
                (stack if len(stack) < DEEPEST else beyond).append(node)
        elif token[1] == "/":
            tag = _SPLIT.split(token[2:].lower(), maxsplit=1)[0]
            deep = next((k for k in range(len(beyond) - 1, -1, -1) if beyond[k].tag == tag), None)
            if deep is not None:
                del beyond[deep:]
                continue
            beyond = [] if any(n.tag == tag for n in stack[1:]) else beyond
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if stack[k].tag in ("article", "main", "body", "td", "th", "table") and tag not in ("html", "body", "article", "main", "table", "tr"):
                    break
    return root


_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = frozenset("#root html body article main section div td th table ul ol dl aside nav form header footer".split())


def _close_implied(stack: list[Node], tag: str) -> None:
    ends = ("p",) if tag in BLOCKS else ()
    for names in (ends, _SAME.get(tag, ())):
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                del stack[k:]
                break
            if stack[k].tag in _SCOPE and stack[k].tag not in names:
                break


def blocks(node: Node, inside: bool) -> list[str]:
    """The texts of the blocks below a node, without what is apart; `inside` says that the node lies in an article."""
    out, now = [], []

    def flush() -> None:
        text = " ".join(html.unescape("".join(now)).split())
        now.clear()
        if text:
            out.append(text)

    pending = [(node, 0)]
    while pending:
        top, k = pending.pop()
        if k == 0 and top.tag in BLOCKS:
            flush()
        while k < len(top.children):
            child = top.children[k]
            k += 1
            if isinstance(child, str):
                now.append(child)
            elif child.tag == "br":
                now.append(" ")
            elif child.apart == 1 or child.apart == 2 and not inside:
                flush()
            else:
                pending += [(top, k), (child, 0)]
                break
        else:
            if top.tag in BLOCKS:
                flush()
    flush()
    return out


def measure(node: Node) -> int:
    """Sets the length of the text below each node, without what is apart."""
    order, pending = [], [node]
    while pending:
        top = pending.pop()
        order.append(top)
        pending += [c for c in top.children if isinstance(c, Node) and c.apart != 1]
    for top in reversed(order):
        top.length = sum(len(c.strip()) if isinstance(c, str) else c.length for c in top.children)
    return node.length


def elements(node: Node) -> list[Node]:
    return [c for c in node.children if isinstance(c, Node)]


def with_signs(node: Node, signs: set[str]) -> list[Node]:
    return [c for c in elements(node) if c.sign in signs]


def signs_of(node: Node) -> set[str]:
    """The signs of a node and of all below it."""
    out, pending = set(), [node]
    while pending:
        top = pending.pop()
        out.add(top.sign)
        pending += elements(top)
    return out


def own_text(node: Node) -> str:
    return " ".join("".join(c for c in node.children if isinstance(c, str)).split())


def whole_text(node: Node) -> str:
    """All text below a node, white space as one space."""
    out, pending = [], [node]
    while pending:
        top = pending.pop()
        if isinstance(top, str):
            out.append(top)
        else:
            pending += reversed(top.children)
    return " ".join("".join(out).split())


class Shapes:
    """Numbers for trees of elements by their signs, and the largest matches of what has such numbers.

    Equal trees have one number, so rows of a list that are built alike are compared once.
    """

    def __init__(self):
        self._known: dict[tuple[str, tuple[int, ...]], int] = {}
        self._found: dict[tuple[int, int], int] = {}
        self._pairs: dict[tuple[int, int], list[tuple[int, int]]] = {}
        # the tree matched last, its signs, those of them that the other one had, and its numbers then
        self.last: tuple[Node, set[str], set[str] | None, dict[Node, int]] | None = None
        # by number
        self.signs: list[str] = []
        self.children: list[tuple[int, ...]] = []
        self.sizes: list[int] = []
        self._places: list[dict[str, int]] = []  # by the children's signs, a bit for each that has it
        self._deep: list[set[str]] = []  # signs of children that have children

    def numbered(self, root: Node, signs: set[str]) -> dict[Node, int]:
        """The numbers of a tree and of those below it, as they are when all of other signs are left out."""
        of: dict[Node, int] = {}
        order, pending = [], [root]
        while pending:
            order.append(pending.pop())
            pending += with_signs(order[-1], signs)
        for node in reversed(order):
            children = tuple(of[c] for c in with_signs(node, signs))
            shape = of[node] = self._known.setdefault((node.sign, children), len(self.signs))
            if shape == len(self.signs):
                places: dict[str, int] = {}
                for k, c in enumerate(children):
                    places[self.signs[c]] = places.get(self.signs[c], 0) | 1 << k
                self.signs.append(node.sign)
                self.children.append(children)
                self.sizes.append(1 + sum(self.sizes[c] for c in children))
                self._places.append(places)
                self._deep.append({self.signs[c] for c in children if self.children[c]})
        return of

    def size(self, a: int, b: int) -> int:
        """The size of the largest order-keeping match of two trees; 0 if their roots differ."""
        if a == b:
            return self.sizes[a]
        if self.signs[a] != self.signs[b]:
            return 0
        size = self._found.get((a, b))
        if size is None:
            if self._deep[a].isdisjoint(self._deep[b]):  # each pair of children counts 1
                size = 1 + _common([self.signs[c] for c in self.children[a]], self._places[b], len(self.children[b]))
            else:
                same, left, right = self._apart(a, b)
                size = 1 + sum(self.sizes[c] for c in self.children[a][:same])
                if left and right:
                    xs, ys = [self.children[a][i] for i in left], [self.children[b][j] for j in right]
                    weights, row = self._weights(xs, ys), np.zeros(len(ys) + 1, np.int32)
                    for x in xs:
                        row = _next(row, weights[x])
                    size += int(row[-1])
            self._found[a, b] = size
        return size

    def pairs(self, a: int, b: int) -> list[tuple[int, int]]:
        """The places of the children that the largest match of two trees with equal roots pairs, early ones first."""
        if a == b:
            return [(k, k) for k in range(len(self.children[a]))]
        if (a, b) not in self._pairs:
            same, left, right = self._apart(a, b)
            found = [(k, k) for k in range(same)]
            if left and right:
                xs, ys = [self.children[a][i] for i in left], [self.children[b][j] for j in right]
                found += [(left[i], right[j]) for i, j in _trace(xs, len(ys), self._weights(xs, ys))]
            self._pairs[a, b] = found
        return self._pairs[a, b]

    def _apart(self, a: int, b: int) -> tuple[int, list[int], list[int]]:
        """How many first children are equal, which always match, and the places of the others whose sign both sides have."""
        left, right = self.children[a], self.children[b]
        same = next((k for k, (x, y) in enumerate(zip(left, right, strict=False)) if x != y), min(len(left), len(right)))
        here, there = {self.signs[x] for x in left[same:]}, {self.signs[y] for y in right[same:]}
        places = lambda side, signs: [k for k in range(same, len(side)) if self.signs[side[k]] in signs]
        return same, places(left, there), places(right, here)

    def _weights(self, left: list[int], right: list[int]) -> dict[int, np.ndarray]:
        """By shape on the left, the sizes of its matches with all on the right."""
        shapes, at = np.unique(np.array(right), return_inverse=True)
        return {x: np.array([self.size(x, y) for y in shapes.tolist()], np.int32)[at] for x in dict.fromkeys(left)}


def _common(left: list[str], places: dict[str, int], n_right: int) -> int:
    """The length of the longest common subsequence of two lists, of which the right one is given by places."""
    whole = rest = (1 << n_right) - 1
    for sign in left:
        met = rest & places.get(sign, 0)
        rest = (rest + met | rest - met) & whole
    return n_right - rest.bit_count()


def _next(row: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The best sizes with one more child on the left, by the number of children on the right."""
    out = np.zeros_like(row)
    np.maximum.accumulate(np.maximum(row[1:], row[:-1] + weights[: len(row) - 1]), out=out[1:])
    return out


def _trace(left: list[int], n_right: int, weights: dict[int, np.ndarray]) -> list[tuple[int, int]]:
    """The pairs of the largest match of two lists, of those as large the one of the first children."""
    out = []

    def back(low: int, high: int, row: np.ndarray, j: int) -> int:
        """From the first `high` and `j` children down to the first `low`, whose best sizes are `row`; returns what is left of j."""
        if high - low > 1 and (high - low) * j > HELD:
            middle, half = row, (low + high) // 2
            for x in left[low:half]:
                middle = _next(middle, weights[x])
            j = back(half, high, middle, j)
            return back(low, half, row[: j + 1], j) if j else 0
        rows = [row]
        for x in left[low:high]:
            rows.append(_next(rows[-1], weights[x]))
        i = high - low
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append((low + i, j))
        return j

    back(0, len(left), np.zeros(n_right + 1, np.int32), n_right)
    return out[::-1]


def match_trees(a: Node, b: Node, shapes: Shapes | None = None) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching: the size and the pairs of the largest order-keeping match of two trees with equal roots.

    Lists of any length are matched so. `shapes` keeps what is known of trees for further calls.
    """
    if a.sign != b.sign:
        return 0, []
    shapes = shapes or Shapes()
    if shapes.last is None or shapes.last[0] is not a:
        shapes.last = a, signs_of(a), None, {}
    signs = shapes.last[1] & signs_of(b)
    if shapes.last[2] != signs:
        shapes.last = a, shapes.last[1], signs, shapes.numbered(a, signs)
    of = shapes.last[3] | shapes.numbered(b, signs)
    size, pairs, pending = shapes.size(of[a], of[b]), [], [(a, b)]
    while pending:
        x, y = pending.pop()
        pairs.append((x, y))
        left, right = with_signs(x, signs), with_signs(y, signs)
        pending += [(left[i], right[j]) for i, j in shapes.pairs(of[x], of[y])]
    return size, pairs
