"""Conversation repair against all edits of short conversations, and against itself in blocks of every size."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tamis.llm import conversation_repair as cr
from tamis.llm.queries import QUERIES, damaged
from tests.conftest import SF_DIR

GRAMMAR = re.compile(r"(s?(ua)+)?")
EMPTY = hashlib.sha256(b"").hexdigest()


def cheapest(pattern):
    """Minimum (cost, audit) over every edit of a short pattern, with up to two turns inserted at each place."""
    best = None
    gaps = ["", "u", "a", "ua", "au"]
    row = [[("D", "", 3)] if c == "-" else [("D", "", 3), ("K", c.lower(), c.isupper()), ("R", "u", 2 + c.isupper()), ("R", "a", 2 + c.isupper())] for c in pattern]
    for edits in itertools.product(*row):
        for put in itertools.product(gaps, repeat=len(pattern) + 1):
            roles = put[0] + "".join(r + p for (_, r, _), p in zip(edits, put[1:], strict=True))
            if GRAMMAR.fullmatch(roles):
                audit = "I" * len(put[0]) + "".join(e + "I" * len(p) for (e, _, _), p in zip(edits, put[1:], strict=True))
                found = (sum(c for *_, c in edits) + 2 * audit.count("I"), audit)
                best = found if best is None else min(best, found)
    return best


@pytest.mark.parametrize("n", [0, 1, 2])
def test_all_short_patterns(n):
    for letters in itertools.product("suaxSUAX-", repeat=n):
        assert cr.repaired("".join(letters)) == cheapest("".join(letters))


@settings(max_examples=25, deadline=None)
@given(st.text("suaxUA-", min_size=3, max_size=4))
def test_longer_patterns(pattern):
    assert cr.repaired(pattern) == cheapest(pattern)


@settings(max_examples=60, deadline=None)
@given(st.text("suaxSUA-", max_size=40), st.integers(1, 9))
def test_segments_join_to_the_whole(pattern, size):
    """Tables from stack to stack, joined, say what parsing at once says."""
    parts = [pattern[i : i + size] for i in range(0, len(pattern), size)]
    number = {stack: n for n, stack in enumerate(cr.STACKS)}
    whole = None
    for part in parts:
        ways = [{number[s]: (*v, (number[s],)) for s, v in cr.parsed(part, {stack: (0, "")}).items()} for stack in cr.STACKS]
        segment = cr.Segment(first=part[0], last=part[-1], ways=ways)
        whole = segment if whole is None else whole.then(segment)
    if whole:
        ends = {cr.STACKS[n]: v[:2] for n, v in whole.ways[0].items()}
        assert cr.finished(ends)[:2] == cr.repaired(pattern)


def test_stacks_are_few():
    assert len(cr.STACKS) == 4 and all(cr.accepted(s) == (t in ("", "a")) for s, t in zip(cr.STACKS, cr._SHIFTED, strict=True))


def brute(rows):
    """Damaged rows {conv: [(turn, role, text)]}: the expected result, from the contract, with the parser for long patterns."""
    out = {}
    for conv, own in rows.items():
        own = sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in own:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "b" if not bare else "d" if (role, text) in seen else "" if bare[-1] in ".!?" else "t"
            seen.add((role, text))
            faults.append(fault)
        turns = [t for t, *_ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        pattern = "".join(
            "-" if f in ("b", "d") else (r[1][:1] if r[1][:1] in ("s", "u", "a") else "x").upper() if f == "t" else (r[1][:1] if r[1][:1] in ("s", "u", "a") else "x")
            for r, f in zip(own, faults, strict=True)
        )
        cost, audit = cr.repaired(pattern) if len(pattern) > 3 else cheapest(pattern)
        lines, at, last = [], 0, ""
        for e in audit:
            turn, role, text = own[at] if e != "I" else (None, None, "")
            at += e != "I"
            if e == "D":
                continue
            role = role if e == "K" else "assistant" if last == "u" else "user"
            last = role[0]
            lines.append(f"{role}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest)
    return out


def hurt(rows):
    """The damage of the contract, in plain Python, on (conv, turn, role, text)."""
    out = {}
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        role, text, fate = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        own = out.setdefault(conv, [])
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        own += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def results(repair, convs=()):
    hashes = {r.conv_id: r.repaired_sha256 for r in cr.digests(repair.parts).collect()}
    found = {r.conv_id: tuple(r)[1:] + (hashes[r.conv_id],) for r in repair.verdicts.collect()}
    assert len(hashes) == len(found) == repair.verdicts.count()
    return {c: (0, 0, 0, 0, 0, 0, "", EMPTY) for c in convs} | found


def mixture(seed, convs=40, longest=30):
    rng = random.Random(seed)
    pool = ["Yes.", "No!", "Why?", "cut off", "", " \t", "So.\n ", "é?", "a, b", "x.y"]
    rows = []
    for c in range(convs):
        n = rng.choice([1, 2, 3, 5, 8, longest])
        for t in range(n):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]) if rng.random() < 0.4 else ("user", "assistant")[t % 2]
            rows.append((c if c else None, rng.choice([t, t, t, t + 5, None]), role, f"{t} " + rng.choice(pool) if rng.random() < 0.7 else rng.choice(pool)))
    return rows


def test_all_copies_of_a_row_known_from_an_earlier_block_are_duplicates():
    rows = [(1, t, "user", "again.") for t in range(3)] + [(1, 3, "user", "new.")]
    assert cr.faults(rows, {0}) == "ddd "


@pytest.mark.parametrize("size", [1, 3, 7, 4096])
def test_blocks_of_every_size(frame, monkeypatch, size):
    monkeypatch.setattr(cr, "BLOCK_ROWS", size)
    monkeypatch.setattr(cr, "FAN", 2 if size > 1 else 3)
    rows = mixture(size)
    rows += [(99, t, ("user", "assistant")[t % 2], f"{t % 50}.") for t in range(200)]
    rows += [(98, 1, "user", "again and again.")] * 60
    repair = cr.repair(frame("conv_id long, turn long, role string, text string", rows))
    whole = {}
    for conv, turn, role, text in rows:
        whole.setdefault(conv, []).append((turn, role, text))
    assert results(repair) == brute(whole)
    split = repair.parts.where("NOT whole").count()
    assert split > 100 if size == 1 else split > 0 or size == 4096


def test_damaged_test_data(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = QUERIES["op11_conversation_repair"](spark, SF_DIR).collect()
    convs = {r[0] for r in rows}
    assert len(found) == len(convs)
    empty = (0, 0, 0, 0, 0, 0, "", EMPTY)
    expected = {c: empty if not own else brute({c: own})[c] for c, own in hurt(rows).items()}
    assert {r.conv_id: tuple(r)[1:] for r in found} == expected


def test_damage(frame):
    rows = [(c, t, r, x) for c in (1, None) for t in (*range(60), None) for r, x in (("assistant", "Hm. So?! yes"), (None, None))]
    found = {}
    for r in damaged(frame("conv_id long, turn long, role string, text string, fate int", [(*x, 3) for x in rows])).collect():
        found.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    assert {c: sorted(v, key=repr) for c, v in found.items()} == {c: sorted(v, key=repr) for c, v in hurt(rows).items()}


def test_awkward_rows(frame):
    rows = [(1, None, None, None), (2, 5, "user", "x" * 200_000 + "."), (2, 5, "user", "x" * 200_000 + "."), (3, 1, "system", "Only."), (4, 1, "", "No role."), (5, 2, "assistant", "cut")]
    rows += [(6, 3, "user", "b."), (6, 3, "user", "a."), (6, None, "assistant", "first."), (None, 1, "user", "Nobody?"), (None, 2, "assistant", "Nobody.")]
    table = frame("conv_id long, turn long, role string, text string, block int, cost string, n long", [(*r, 1, "x", 2) for r in rows])
    whole = {}
    for conv, turn, role, text in rows:
        whole.setdefault(conv, []).append((turn, role or " ", text or " "))
    repair = cr.repair(table)
    assert results(repair) == brute(whole)
    assert repair.verdicts.where("conv_id IS NULL").first().audit == "KK"
    empty = cr.repair(table.limit(0))
    assert empty.verdicts.count() == empty.parts.count() == cr.digests(empty.parts).count() == 0
