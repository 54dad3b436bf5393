"""Main texts of web pages by wrapper induction over the pages of a host.

1. For each host the reference is the first of up to `SAMPLE_PAGES` pages drawn by hash, one
   per hash class, combined before the shuffle.
2. The DOM trees of all pages are aligned with the reference's by simple tree matching,
   where the pages lie. What a page adds is summed by host, copies once, in every task before it is
   summed over tasks, so a host with a third of all pages is no one task's work. Nodes
   whose text is the same on all pages are template; the rest are slots. The
   wrapper is the path to the slot that holds most of the varying text, which ends
   at the first element that no single child dominates.
   The wrapper also keeps the blocks below the slot that stand at the same path with
   the same text on all pages: they are template too, but for headings, which articles
   of a site share (`Introduction`). If those make up most of the slot, the pages are
   copies of one article, and nothing in it is template.
3. Every page's tree follows the wrapper of its host; below the slot all blocks are
   content except template and elements that are apart by kind (menus, adverts,
   forms, ...). Names mark an element only if they consist of such words altogether;
   they never mark headings, and ids no sections and paragraphs below the page itself.
   A page that the wrapper doesn't fit is judged by its own text lengths.
"""

from __future__ import annotations

import hashlib
import json
import pickle
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.dom import BLOCKS, CONTAINERS, HEADINGS, Node, Shapes, blocks, elements, match_trees, measure, own_text, parse, whole_text
from tamis.llm.scratch import written

SAMPLE_PAGES = 8
# References that a task holds at once, and pages after which what is known of shapes is made anew.
KEPT, RENEWED = 64, 256
DOMINANT = 0.8
_ARTICLE = ("article", "main")


class Reference:
    """The page of a host with which all its pages are aligned."""

    def __init__(self, page: str):
        self.root = parse(page)
        self.nodes = list(_walk(self.root))
        self.index = {n: k for k, n in enumerate(self.nodes)}
        self.texts = [own_text(n) for n in self.nodes]
        self.parents = {self.index[c]: k for k, n in enumerate(self.nodes) for c in elements(n)}
        # the elements that a wrapper's path may lead to, by the step from the one above
        self.steps: dict[int, dict[tuple[str, int], int]] = {}
        pending = [self.root]
        while pending:
            node = pending.pop()
            steps = self.steps[self.index[node]] = {}
            inside = [(c, place) for c, place in _with_places(node) if not c.apart and c.tag in CONTAINERS and node.tag not in _ARTICLE]
            steps.update(((c.sign, place), self.index[c]) for c, place in inside)
            pending += [c for c, _ in inside]
        # the blocks that may be template: path and digest of the text
        self.blocks = list(dict.fromkeys((at, _digest(n)) for n, at in _placed(self.root, "") if _may_be_template(n) and whole_text(n)))
        self.numbers = {block: k for k, block in enumerate(self.blocks)}
        self.paths = {at for at, _ in self.blocks}
        self._shapes, self._aligned = Shapes(), 0

    def align(self, page: str) -> dict:
        """What one page adds to the state of its host; states are summed by `add`.

        `volume` has by node the text below its partner, `same` the nodes whose own text is the
        partner's, `moved` what other nodes that text counts for on the page, but not here (1) or the other way
        round (-1), `slots` by possible slot the pages that have it, their text there and the blocks on all of them.
        """
        tree = parse(page)
        if self._aligned == RENEWED:
            self._shapes, self._aligned = Shapes(), 0
        self._aligned += 1
        pairs = [(self.index[a], b) for a, b in match_trees(self.root, tree, self._shapes)[1]]
        texts, partners = _texts_below(tree), dict(pairs)
        same = {a for a, b in pairs if self.texts[a] and own_text(b) == self.texts[a]}
        moved = {}
        if any(bool(self.nodes[a].apart) != bool(b.apart) for a, b in pairs):
            for a in same:
                here, there = set(self.reached(a)), set(self.reached(a, partners))
                moved |= {(a, up): 1 for up in there - here} | {(a, up): -1 for up in here - there}
        return {"pages": 1, "volume": {a: texts[b] for a, b in pairs if texts.get(b)}, "same": same, "moved": moved, "slots": self._slots(tree)}

    def reached(self, place: int, partners: dict[int, Node] | None = None) -> list[int]:
        """The nodes that a node's text counts for, itself and all above unless one is apart; with partners, as it is on their page."""
        out = [place]
        while place:
            if (partners[place] if partners else self.nodes[place]).apart:
                return []
            out.append(place := self.parents[place])
        return out

    def _slots(self, tree: Node) -> dict[int, tuple[int, int, set[int]]]:
        slots: dict[int, tuple[int, int, set[int]]] = {}
        wholes: dict[Node, str] = {}
        pending: list[tuple[Node, str, int | None, tuple[int, ...]]] = [(tree, "", 0, ())]
        while pending:
            node, signs, slot, above = pending.pop()
            if slot is not None:
                if node not in wholes:
                    wholes[node] = whole_text(node)
                slots[slot] = (1, len(wholes[node]), set())
                above = (*above, slot)
            for child, place in _with_places(node):
                at = f"{signs}>{child.sign}"
                below = None if slot is None else self.steps[slot].get((child.sign, place))
                if at in self.paths and _may_be_template(child):
                    whole = whole_text(child)
                    if below is not None:
                        wholes[child] = whole
                    if (number := self.numbers.get((at, _text_digest(whole)))) is not None:
                        for up in above:
                            slots[up][2].add(number)
                pending.append((child, at, below, above))
        return slots

    def wrapper(self, state: dict) -> dict | None:
        """The wrapper that the summed state of all pages gives; None from fewer than two pages."""
        if state["pages"] < 2:
            return None
        volume = dict(state["volume"])
        for a in state["same"]:  # on all pages: template
            for up in self.reached(a):
                volume[up] = volume.get(up, 0) - state["pages"] * len(self.texts[a])
        for (a, up), times in state["moved"].items():
            if a in state["same"]:
                volume[up] = volume.get(up, 0) - times * len(self.texts[a])
        path = _descend(self.root, lambda n: volume.get(self.index[n], 0))
        return {"path": path, "template": self._constant(path, state["slots"])}

    def _constant(self, path: list[list], slots: dict[int, tuple[int, int, set[int]]]) -> list[list[str]]:
        """The blocks below the slot that all pages have at the same path with the same text."""
        slot = _follow(self.root, path)
        pages, total, common = slots[self.index[slot]]
        if pages < 2:
            return []
        tops: list[set[Node]] = []
        held = 0
        for node, at in _placed(slot, "".join(f">{sign}" for sign, _ in path)):  # what is within a constant block counts once
            if at in self.paths and self.numbers.get((at, _digest(node))) in common and not any(node in inner for inner in tops):
                tops.append(set(_walk(node)))
                held += len(whole_text(node))
        return sorted(list(self.blocks[k]) for k in common) if held * pages <= total / 2 else []


def add(state: dict, more: dict) -> None:
    """Sum the state of some pages into that of others."""
    state["pages"] += more["pages"]
    state["same"] &= more["same"]
    for name in ("volume", "moved"):
        for k, n in more[name].items():
            state[name][k] = state[name].get(k, 0) + n
    for slot, (pages, total, common) in more["slots"].items():
        held = state["slots"].get(slot)
        state["slots"][slot] = (pages, total, common) if held is None else (held[0] + pages, held[1] + total, held[2] & common)


def induce(pages: list[str]) -> dict | None:
    """The wrapper of different pages of one host, aligned with the first; None from fewer than two pages.

    `path` is [sign, place among equal signs] from the root down to the slot;
    `template` are the blocks below it that don't vary, [signs from the root, digest of the text].
    """
    if len(pages) < 2:
        return None
    reference = Reference(pages[0])
    state = reference.align(pages[0])
    for page in pages[1:]:
        add(state, reference.align(page))
    return reference.wrapper(state)


def _may_be_template(node: Node) -> bool:
    return node.tag in BLOCKS and node.tag not in HEADINGS and node.apart != 1


def _with_places(node: Node) -> Iterator[tuple[Node, int]]:
    """The elements of a node with their places among those of their sign."""
    seen: dict[str, int] = {}
    for child in elements(node):
        seen[child.sign] = place = seen.get(child.sign, -1) + 1
        yield child, place


def _digest(node: Node) -> str:
    return _text_digest(whole_text(node))


def _text_digest(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()


def _placed(node: Node, signs: str) -> Iterator[tuple[Node, str]]:
    """The elements below a node with their signs from the root, parents first."""
    for child in elements(node):
        at = f"{signs}>{child.sign}"
        yield child, at
        yield from _placed(child, at)


def _mark_template(root: Node, template: list[list[str]]) -> None:
    known: dict[str, set[str]] = {}
    for signs, digest in template:
        known.setdefault(signs, set()).add(digest)
    for node, at in _placed(root, ""):
        if at in known and _digest(node) in known[at]:
            node.apart = 1


def _walk(node: Node) -> Iterator[Node]:
    yield node
    for child in elements(node):
        yield from _walk(child)


def _texts_below(node: Node) -> dict[Node, int]:
    """By node that isn't within what is apart, the text below it that is not apart."""
    out: dict[Node, int] = {}

    def count(n: Node) -> int:
        out[n] = len(own_text(n)) + sum(count(c) for c in elements(n) if not c.apart)
        return out[n]

    count(node)
    return out


def _descend(node: Node, weight) -> list[list]:
    """The path to the smallest container with most of the weight, at most down to an article."""
    path = []
    while node.tag not in _ARTICLE:
        inside = [c for c in elements(node) if not c.apart and (c.tag in CONTAINERS)]
        best = max(inside, key=weight, default=None)
        if best is None or weight(best) <= 0 or weight(best) < DOMINANT * weight(node):
            break
        path.append([best.sign, [c for c in elements(node) if c.sign == best.sign].index(best)])
        node = best
    return path


def _follow(root: Node, path: list[list]) -> Node | None:
    node = root
    for sign, place in path:
        same = [c for c in elements(node) if c.sign == sign]
        if place >= len(same):
            return None
        node = same[place]
    return node


def main_text(page: str, wrapper: dict | None) -> str:
    """The blocks of the main text, one per line."""
    root = parse(page)
    if wrapper and wrapper["template"]:
        _mark_template(root, wrapper["template"])
    measure(root)
    slot = _follow(root, wrapper["path"]) if wrapper and wrapper["path"] else None
    if slot is None or not slot.length:
        slot = _follow(root, _descend(root, lambda n: n.length))
    if slot.tag not in _ARTICLE:  # several articles, or one beside other text
        inner = [n for n in _walk(slot) if n.tag in _ARTICLE and n.length and not n.apart]
        if inner and sum(n.length for n in inner if not any(n is not o and n in set(_walk(o)) for o in inner)) >= DOMINANT * slot.length:
            tops = [n for n in inner if not any(n is not o and n in set(_walk(o)) for o in inner)]
            return "\n".join(b for n in tops for b in blocks(n, True))
    return "\n".join(blocks(slot, slot.tag in _ARTICLE))


def _aligned(batches):
    """The state of each page of (host, html, reference); of the copies that a task has, once."""
    known: dict[str, Reference] = {}
    seen: set[tuple[str, bytes]] = set()
    for batch in batches:
        found = []
        for i, (host, page) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            digest = hashlib.blake2b(page.encode("utf-8", "surrogatepass"), digest_size=16).digest()
            if (host, digest) in seen:
                continue
            seen.add((host, digest))
            if host not in known:
                if len(known) == KEPT:
                    known.clear()
                known[host] = Reference(batch.column(2)[i].as_py())
            found.append((host, digest, pickle.dumps(known[host].align(page))))
        columns = [[f[k] for f in found] for k in range(3)]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], names=["host", "page", "state"])


def _summed(batches):
    """Of each host one state of its different pages, which come sorted by host and page."""
    last, state = None, None

    def closed():
        return pa.RecordBatch.from_arrays([pa.array([last[0]], pa.string()), pa.array([pickle.dumps(state)], pa.binary())], names=["host", "state"])

    for batch in batches:
        for host, page, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (host, page) == last:
                continue
            if last is not None and host == last[0]:
                add(state, pickle.loads(data))
            else:
                if last is not None:
                    yield closed()
                state = pickle.loads(data)
            last = host, page
    if last is not None:
        yield closed()


def _induced(states: pa.Table, references: pa.Table) -> pa.Table:
    reference = Reference(references.column("reference")[0].as_py())
    first, *others = (pickle.loads(x) for x in states.column("state").to_pylist())
    for state in others:
        add(first, state)
    wrapper = reference.wrapper(first)
    out = {"host": [references.column("host")[0].as_py()], "wrapper": [None if wrapper is None else json.dumps(wrapper)]}
    return pa.table(out, pa.schema([("host", pa.string()), ("wrapper", pa.string())]))


def _extracted(batches):
    for batch in batches:
        known: dict[str | None, dict | None] = {}
        texts = []
        for page, wrapper in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if wrapper not in known:
                known[wrapper] = json.loads(wrapper) if wrapper else None
            texts.append(main_text(page, known[wrapper]) if page else "")
        columns = [batch.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["row", "text", "n_chars"])


def extract(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """The columns of pages but the html, with `text`, the main text, and `n_chars`, its code points.

    Blocks but headings with the same text on all pages of a host are dropped. Character
    references are decoded, white space within a block becomes one
    space, blocks are joined by newlines in page order.

    NULL and empty html give an empty text; a NULL url or one without a host
    belongs to the host ''. Repeated rows and ids are treated one by one.
    Columns called `text` or `n_chars` are replaced; all others pass through. An
    empty table gives an empty result.
    """
    host = F.coalesce(F.regexp_extract(F.col(url_column), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))
    key, mark = f"_{uuid.uuid4().hex}", F.xxhash64(html_column)
    sites = pages.select(host.alias("host"), F.col(html_column).alias("html"), mark.alias("mark")).where("length(html) > 0")
    drawn = sites.groupBy("host", F.pmod("mark", F.lit(SAMPLE_PAGES)).alias("class")).agg(F.min_by("html", "mark").alias("html"))
    references = written(drawn.groupBy("host").agg(F.min("html").alias("reference")), "references")
    states = sites.join(references, "host").select("host", "html", "reference").mapInArrow(_aligned, "host string, page binary, state binary")
    sums = states.repartition("host", "page").sortWithinPartitions("host", "page").mapInArrow(_summed, "host string, state binary")
    wrappers = written(sums.groupBy("host").cogroup(references.groupBy("host")).applyInArrow(_induced, "host string, wrapper string"), "wrappers")

    others = [c for c in pages.columns if c not in (html_column, "text", "n_chars")]
    rows = pages.select(host.alias(key), F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col(html_column).alias("html"))
    fitted = rows.join(wrappers.withColumnRenamed("host", key), key, "left").select("row", "html", "wrapper")
    schema = fitted.select("row", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    found = fitted.mapInArrow(_extracted, schema)
    return found.select(*[F.col("row").getField(c).alias(c) for c in others], "text", "n_chars")
