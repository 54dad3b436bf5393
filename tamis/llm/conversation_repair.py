"""Conversation structure repair: generalised LR over the role grammar, with weighted edits.

The grammar of role initials is `(s?(ua)+)?`, as

    talk  ->  (nothing)  |  turns
    turns ->  open a
    open  ->  u  |  s u  |  turns u

Its LR automaton drives all stacks at once. Stacks share their lower parts, and equal
tops over the same part are one node, which keeps the minimum of (cost, audit). Before
each row and at the end stacks may shift an inserted turn; a row is kept (its own
initial is shifted), reroled (u or a is shifted) or deleted (stacks stay). The audit is
the edits' initials in order: K, R, D, I. Two audits of equal cost that meet in
a node have consumed the same rows, so none begins with the other, and the smaller
stays the smaller whatever follows: the minimum decides ties by ASCII order as well.

Rows are sorted by conversation, turn, role and text over all tasks and packed into
blocks, so that a conversation of any size spreads over many. One that lies within a
block is parsed there. The first and the last of a block may go on elsewhere: such
a segment is parsed from every possible stack, which gives a small table of (cost,
audit) from stack to stack. Tables of consecutive segments are joined `FAN` at a time,
and the cheapest way through says where each segment enters and leaves.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache, partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.scratch import written
from tamis.llm.vectors import _each

BLOCK_ROWS, BLOCK_BYTES, FAN = 4096, 4 << 20, 64

# The grammar, the prices of edits, the roles they give, white space and ends of sentences.
RULES = (("talk", ()), ("talk", ("turns",)), ("turns", ("open", "a")), ("open", ("u",)), ("open", ("s", "u")), ("open", ("turns", "u")))
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
SPACE, ENDS = " \t\n\x0b\x0c\r", (".", "!", "?")


# --- the automaton and its stacks ---------------------------------------------------


def _closed(items: frozenset) -> frozenset:
    found, todo = set(items), list(items)
    while todo:
        rule, dot = todo.pop()
        after = RULES[rule][1][dot : dot + 1]
        for k, (left, _) in enumerate(RULES):
            if after == (left,) and (k, 0) not in found:
                found.add((k, 0))
                todo.append((k, 0))
    return frozenset(found)


def _automaton() -> tuple[list[frozenset], dict[tuple[int, str], int]]:
    """LR(0) states, the first of them the start, and where each symbol leads."""
    states = [_closed(frozenset((k, 0) for k, (left, _) in enumerate(RULES) if left == RULES[0][0]))]
    goto = {}
    for at, state in enumerate(states):  # grows meanwhile
        for symbol in dict.fromkeys(RULES[k][1][dot] for k, dot in sorted(state) if dot < len(RULES[k][1])):
            moved = _closed(frozenset((k, dot + 1) for k, dot in state if RULES[k][1][dot : dot + 1] == (symbol,)))
            if moved not in states:
                states.append(moved)
            goto[at, symbol] = states.index(moved)
    return states, goto


STATES, GOTO = _automaton()

# A stack is its top state and the stack below.
Stack = tuple[int, "Stack | None"]
ROOT: Stack = (0, None)


def _reduced(stack: Stack, whole: bool) -> Iterator[Stack]:
    """The stacks after one reduction; those to the whole talk only at the end."""
    for k, dot in STATES[stack[0]]:
        left, right = RULES[k]
        if dot == len(right) and left != RULES[0][0]:
            below = stack
            for _ in right:
                below = below[1]
            yield GOTO[below[0], left], below
        elif dot == len(right) and whole:
            yield -1, None


@lru_cache(maxsize=None)
def advance(stack: Stack, symbol: str) -> tuple[Stack, ...]:
    """The stacks that can still shift or be complete, once the symbol is shifted."""
    state = GOTO.get((stack[0], symbol))
    found, todo = [], [] if state is None else [(state, stack)]
    while todo:
        now = todo.pop()
        if any(at == now[0] for at, s in GOTO if s in ("s", "u", "a")) or accepted(now):
            found.append(now)
        todo += _reduced(now, False)
    return tuple(dict.fromkeys(found))


@lru_cache(maxsize=None)
def accepted(stack: Stack) -> bool:
    return (-1, None) in _reduced(stack, True)


def _all_stacks() -> list[Stack]:
    found = [ROOT]
    for stack in found:  # grows meanwhile
        found += [s for symbol in "sua" for s in advance(stack, symbol) if s not in found]
    return found


#: The stacks between rows are few: the grammar is left-recursive.
STACKS = _all_stacks()
#: The role initial on top of each.
_SHIFTED = [next((t for t in "sua" for s in STACKS if stack in advance(s, t)), "") for stack in STACKS]

Frontier = dict[Stack, tuple[int, str]]


def _put(frontier: Frontier, stack: Stack, value: tuple[int, str]) -> bool:
    if stack in frontier and frontier[stack] <= value:
        return False
    frontier[stack] = value
    return True


def inserted(frontier: Frontier) -> Frontier:
    """With every number of inserted turns that pays."""
    out, todo = dict(frontier), list(frontier)
    while todo:
        stack = todo.pop()
        cost, audit = out[stack]
        for symbol in ROLES:
            todo += [s for s in advance(stack, symbol) if _put(out, s, (cost + INSERT, audit + "I"))]
    return out


def parsed(pattern: str, frontier: Frontier) -> Frontier:
    """The stacks after the rows of a pattern: one letter each, upper-case where truncated, `-` where the row must go."""
    for letter in pattern:
        after: Frontier = {}
        symbol, extra = letter.lower(), TRUNCATED * letter.isupper()
        for stack, (cost, audit) in inserted(frontier).items():
            _put(after, stack, (cost + DELETE, audit + "D"))
            if letter == "-":
                continue
            for s in advance(stack, symbol):
                _put(after, s, (cost + extra, audit + "K"))
            for role in ROLES:
                for s in advance(stack, role):
                    _put(after, s, (cost + REROLE + extra, audit + "R"))
        frontier = after
    return frontier


def finished(frontier: Frontier) -> tuple[int, str, Stack]:
    """Cost, audit and last stack of the cheapest repair."""
    return min((*value, stack) for stack, value in inserted(frontier).items() if accepted(stack))


def repaired(pattern: str) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of a conversation."""
    return _short(pattern) if len(pattern) <= 32 else finished(parsed(pattern, {ROOT: (0, "")}))[:2]


@lru_cache(maxsize=1 << 16)
def _short(pattern: str) -> tuple[int, str]:
    return finished(parsed(pattern, {ROOT: (0, "")}))[:2]


def edited(rows: list[tuple[str, str]], audit: str, last: str = "") -> list[tuple[str, str]]:
    """Roles and texts after the edits; `last` is the initial that went before, none at the start."""
    out, at = [], 0
    for edit in audit:
        role, text = rows[at] if edit != "I" else ("", "")
        at += edit != "I"
        if edit == "D":
            continue
        if edit != "K":
            role = ROLES["a" if last == "u" else "u"]
        out.append((role, text))
        last = role[:1]
    return out


# --- segments -------------------------------------------------------------------------


@dataclass
class Segment:
    """Consecutive rows of a conversation: figures, what stands at both ends, and the ways from stack to stack.

    A way is cost, audit and the stack after each of the segments that it was joined from.
    """

    rows: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str = ""
    last: str = ""
    low: int | None = None
    high: int | None = None
    turns: int = 0
    ways: list[dict[int, tuple[int, str, tuple[int, ...]]]] = field(default_factory=list)
    parts: list[tuple[int, int]] = field(default_factory=list)

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns

    def then(self, other: Segment) -> Segment:
        known = [s for s in (self, other) if s.low is not None]
        ways = []
        for entry in self.ways:
            best: dict[int, tuple[int, str, tuple[int, ...]]] = {}
            for middle, (cost, audit, via) in entry.items():
                for end, (c, a, v) in other.ways[middle].items():
                    way = (cost + c, audit + a, via + v)
                    if end not in best or way < best[end]:
                        best[end] = way
            ways.append(best)
        return Segment(
            self.rows + other.rows,
            self.blank + other.blank,
            self.duplicate + other.duplicate,
            self.truncated + other.truncated,
            self.illegal + other.illegal + (self.last + other.first not in LEGAL),
            self.first,
            other.last,
            known[0].low if known else None,
            known[-1].high if known else None,
            # rows are sorted by turn
            self.turns + other.turns - (self.high is not None and self.high == other.low),
            ways,
            self.parts + other.parts,
        )


def _key(conv: int | None, role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{conv}:{len(role)}:{role}{text}".encode(), digest_size=16).digest()


def faults(rows: list[tuple], again: set[int] = frozenset()) -> str:
    """The first fault of each row (conv, turn, role, text) of one conversation: b, d, t or blank; `again` says which rows are known from before."""
    seen, out = set(), []
    for at, (_, _, role, text) in enumerate(rows):
        bare = text.rstrip(SPACE)
        if not bare:
            out.append("b")
            continue
        known = at in again or (role, text) in seen
        seen.add((role, text))
        out.append("d" if known else " " if bare.endswith(ENDS) else "t")
    return "".join(out)


def pattern(rows: list[tuple], found: str) -> str:
    initials = (r[2][:1] if r[2][:1] in ("s", "u", "a") else "x" for r in rows)
    return "".join("-" if f in "bd" else i.upper() if f == "t" else i for i, f in zip(initials, found, strict=True))


def measured(rows: list[tuple], found: str) -> Segment:
    """The figures of consecutive rows, without ways."""
    initials = [r[2][:1] for r in rows]
    turns = {r[1] for r in rows if r[1] is not None}
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    counts = (found.count(f) for f in "bdt")
    return Segment(len(rows), *counts, illegal, initials[0], initials[-1], min(turns, default=None), max(turns, default=None), len(turns))


def ways(rows: list[tuple], found: str) -> list[dict[int, tuple[int, str, tuple[int, ...]]]]:
    """From each stack the cheapest way to every other."""
    number = {stack: n for n, stack in enumerate(STACKS)}
    out = []
    for stack in STACKS:
        ends = parsed(pattern(rows, found), {stack: (0, "")})
        out.append({number[s]: (cost, audit, (number[s],)) for s, (cost, audit) in ends.items()})
    return out


# --- blocks -----------------------------------------------------------------------------


def _packed(batches: Iterator[pa.RecordBatch], most: int = BLOCK_ROWS) -> Iterator[pa.RecordBatch]:
    part, seq, rows, held = TaskContext.get().partitionId(), 0, [], 0
    schema = pa.schema([("block", pa.int64()), ("rows", pa.binary())])

    def block():
        return pa.RecordBatch.from_pylist([{"block": (part << 24) + seq, "rows": pickle.dumps(rows)}], schema)

    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in range(4)), strict=True):
            rows.append(row)
            held += len(row[3])
            if held >= BLOCK_BYTES or len(rows) >= most:
                yield block()
                seq, rows, held = seq + 1, [], 0
    if rows:
        yield block()


def _runs(rows: list[tuple]) -> list[tuple[int, int]]:
    """Where each conversation of a block begins and ends."""
    cuts = [n for n in range(1, len(rows)) if rows[n][0] != rows[n - 1][0]]
    return list(zip([0, *cuts], [*cuts, len(rows)], strict=True))


def _outer(runs: list[tuple[int, int]]) -> dict[int, tuple[int, int]]:
    """The runs that may go on in another block: the first and the last."""
    return {n: runs[n] for n in {0, len(runs) - 1}}


_HEADS = pa.schema([("digest", pa.binary()), ("block", pa.int64()), ("at", pa.int32())])


def _heads(batches):
    """The rows of outer runs that aren't blank, each distinct one once."""
    for line in _each(batches):
        rows = pickle.loads(line["rows"])
        out = {}
        for a, b in _outer(_runs(rows)).values():
            for at in range(a, b):
                if rows[at][3].strip(SPACE):
                    out.setdefault(_key(rows[at][0], *rows[at][2:]), at)
        yield pa.RecordBatch.from_pylist([{"digest": d, "block": line["block"], "at": at} for d, at in out.items()], _HEADS)


def _judged(line: dict, rows: list[tuple], a: int, b: int) -> str:
    again = {at - a for at in line.get("again") or () if a <= at < b}
    return faults(rows[a:b], again)


_SEGMENTS = "conv long, at long, data binary"
_SEGMENTS_ARROW = pa.schema([("conv", pa.int64()), ("at", pa.int64()), ("data", pa.binary())])


def _outer_segments(batches):
    for line in _each(batches):
        rows, out = pickle.loads(line["rows"]), []
        for n, (a, b) in sorted(_outer(_runs(rows)).items()):
            found = _judged(line, rows, a, b)
            segment = measured(rows[a:b], found)
            segment.ways, segment.parts = ways(rows[a:b], found), [(line["block"], n)]
            out.append({"conv": rows[a][0], "at": line["number"], "data": pickle.dumps(segment)})
        yield pa.RecordBatch.from_pylist(out, _SEGMENTS_ARROW)


def _joined(table: pa.Table) -> pa.Table:
    parts = sorted(zip(table.column("at").to_pylist(), table.column("data").to_pylist(), strict=True), key=lambda x: x[0])
    whole = pickle.loads(parts[0][1])
    for _, data in parts[1:]:
        whole = whole.then(pickle.loads(data))
    return pa.Table.from_pylist([{"conv": table.column("conv")[0].as_py(), "at": parts[0][0], "data": pickle.dumps(whole)}], _SEGMENTS_ARROW)


_FIGURES = ["gaps", "blank", "duplicate", "truncated", "illegal"]
_VERDICT = ", ".join(f"{c} long" for c in [*_FIGURES, "cost"]) + ", audit string"
_VERDICT_ARROW = [(c, pa.int64()) for c in [*_FIGURES, "cost"]] + [("audit", pa.string())]
_VISIT = pa.struct([("run", pa.int32()), ("enter", pa.int32()), ("leave", pa.int32()), ("tail", pa.int32())])
_WHOLE_ARROW = pa.schema([("conv", pa.int64()), *_VERDICT_ARROW, ("block", pa.int64()), ("visit", _VISIT)])


def _figures(segment: Segment) -> dict:
    return {c: min(getattr(segment, c), (1 << 63) - 1) for c in _FIGURES}


def _settled(batches):
    """Of a joined conversation one row with its verdict, and one for each segment with where it enters and leaves."""
    for line in _each(batches):
        whole: Segment = pickle.loads(line["data"])
        ends = {STACKS[n]: (cost, audit) for n, (cost, audit, _) in whole.ways[0].items()}
        cost, audit, _ = finished(ends)
        # the way whose audit this is, but for turns inserted at the end
        last = min((c + INSERT * (len(audit) - len(a)), n) for n, (c, a, _) in whole.ways[0].items() if audit.startswith(a) and not audit[len(a) :].strip("I"))[1]
        _, before, via = whole.ways[0][last]
        out = [{"conv": line["conv"], **_figures(whole), "cost": cost, "audit": audit}]
        for n, (block, run) in enumerate(whole.parts):
            tail = len(audit) - len(before) if n == len(via) - 1 else 0
            out.append({"conv": line["conv"], "block": block, "visit": {"run": run, "enter": via[n - 1] if n else 0, "leave": via[n], "tail": tail}})
        yield pa.RecordBatch.from_pylist(out, _WHOLE_ARROW)


_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_PARTS_ARROW = pa.schema([("conv", pa.int64()), ("part", pa.int64()), ("whole", pa.bool_()), ("turns", _TURNS), *_VERDICT_ARROW])


def _rewritten(batches):
    """Each conversation within a block with its verdict, and each segment of another, with its repaired turns."""
    for line in _each(batches):
        rows, out = pickle.loads(line["rows"]), []
        visits = {v["run"]: v for v in line.get("visits") or ()}
        for n, (a, b) in enumerate(_runs(rows)):
            found, said = _judged(line, rows, a, b), {}
            plain = [r[2:] for r in rows[a:b]]
            if n in visits:
                visit = visits[n]
                start = STACKS[visit["enter"]]
                audit = parsed(pattern(rows[a:b], found), {start: (0, "")})[STACKS[visit["leave"]]][1] + "I" * visit["tail"]
                turns = edited(plain, audit, _SHIFTED[visit["enter"]])
            else:
                cost, audit = repaired(pattern(rows[a:b], found))
                said, turns = _figures(measured(rows[a:b], found)) | {"cost": cost, "audit": audit}, edited(plain, audit)
            pairs = [{"role": role, "text": text} for role, text in turns]
            out.append({"conv": rows[a][0], "part": line["block"], "whole": n not in visits, "turns": pairs, **said})
        yield pa.RecordBatch.from_pylist(out, _PARTS_ARROW)


# --- the operator ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Repair:
    verdicts: DataFrame
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit: a row for each conversation."""
    parts: DataFrame
    """conv_id, part, whole, turns array<struct<role, text>>: the repaired turns, in order of `part`; one part for most conversations."""


def repair(rows: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> Repair:
    """Find faults in conversations and the cheapest edits that give the roles `(system? (user assistant)+)?`.

    Rows are taken by turn, NULL first; rows of one turn by role, then text (its first 64
    characters, then a hash). A row's first fault counts: blank, duplicate (role and
    text seen before in the conversation), truncated (the last character but white space
    isn't `.`, `!` or `?`). `gaps` are turns missing between the least and the greatest,
    `illegal` neighbours whose role initials aren't su, ua or au. Roles count by their
    first letter as written. A blank or duplicate row has to go.

    A NULL role or text counts as one space; a NULL conversation is one of its own;
    NULL turns are in no gap. Repeated rows are duplicates. Further columns are ignored.
    An empty table gives an empty result.
    """
    space = F.lit(" ")
    plain = rows.select(
        F.col(conv_column).cast("long").alias("conv"),
        F.col(turn_column).cast("long").alias("turn"),
        F.coalesce(F.col(role_column).cast("string"), space).alias("role"),
        F.coalesce(F.col(text_column).cast("string"), space).alias("text"),
    )
    plain = plain.withColumns({"_begin": F.substring("text", 1, 64), "_hash": F.xxhash64("text"), "_stored": F.monotonically_increasing_id()})
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "_begin", "_hash", "_stored"]
    placed = plain.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = written(placed.select("conv", "turn", "role", "text").mapInArrow(partial(_packed, most=BLOCK_ROWS), "block long, rows binary"), "blocks")

    heads = written(blocks.mapInArrow(_heads, "digest binary, block long, at int"), "heads")
    firsts = heads.groupBy("digest").agg(F.min("block").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    later = heads.join(firsts, "digest").where("block > first").groupBy("block").agg(F.collect_list("at").alias("again"))
    known = blocks.join(written(later, "again"), "block", "left")

    # consecutive numbers of the blocks, from one figure per task
    part = F.shiftright("block", 24)
    sizes = sorted((r["part"], r["n"]) for r in blocks.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    base, bases = 0, []
    for p, n in sizes:
        bases.append((p, base))
        base += n
    bases = F.broadcast(rows.sparkSession.createDataFrame(bases, "_part long, _base long"))
    numbered = known.withColumn("_part", part).join(bases, "_part").withColumn("number", F.col("_base") + F.col("block").bitwiseAND((1 << 24) - 1))
    segments = written(numbered.select("block", "rows", "again", "number").mapInArrow(_outer_segments, _SEGMENTS), "segments")
    width = FAN
    while True:
        grouped = segments.withColumn("_group", F.floor(F.col("at") / width)).groupBy("conv", "_group")
        segments = written(grouped.applyInArrow(_joined, _SEGMENTS), "segments")
        if width >= base:
            break
        width *= FAN

    visit = "struct<run: int, enter: int, leave: int, tail: int>"
    settled = written(segments.mapInArrow(_settled, f"conv long, {_VERDICT}, block long, visit {visit}"), "settled")
    visits = written(settled.where("block IS NOT NULL").groupBy("block").agg(F.collect_list("visit").alias("visits")), "visits")
    schema = f"conv long, part long, whole boolean, turns array<struct<role: string, text: string>>, {_VERDICT}"
    done = known.join(visits, "block", "left").mapInArrow(_rewritten, schema).withColumnRenamed("conv", "conv_id")
    done = written(done, "repaired")
    columns = ["conv_id", *_FIGURES, "cost", "audit"]
    split = settled.where("block IS NULL").withColumnRenamed("conv", "conv_id").select(*columns)
    return Repair(done.where("whole").select(*columns).union(split), done.select("conv_id", "part", "whole", "turns"))


def digests(parts: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 (lowercase hex) of `role:text`, joined by newlines.

    A conversation in one part is hashed in place. Parts of one in several are streamed
    through its hash, in order, as a hash chain can't be split; memory holds one part.
    """
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    lines = parts.select("conv_id", "part", "whole", F.size("turns").alias("n"), F.encode(text, "UTF-8").alias("data"))
    arrow = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def chained(batches: Iterable[pa.RecordBatch]):
        conv, state, fresh, open_ = None, None, True, False

        def closed():
            return pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": state.hexdigest()}], arrow)

        for batch in batches:
            for key, n, data in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                if not open_ or key != conv:
                    if open_:
                        yield closed()
                    conv, state, fresh, open_ = key, hashlib.sha256(), True, True
                if n:
                    if not fresh:
                        state.update(b"\n")
                    state.update(data.as_buffer())
                    fresh = False
        if open_:
            yield closed()

    split = lines.where("NOT whole").select("conv_id", "part", "n", "data")
    split = split.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(chained, "conv_id long, repaired_sha256 string")
    return lines.where("whole").select("conv_id", F.sha2("data", 256).alias("repaired_sha256")).union(split)
