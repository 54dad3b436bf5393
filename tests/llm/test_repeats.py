"""Both repeat removers against brute force over every window."""

import random
from functools import partial

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tamis.llm import repeats, substring_dedup, suffix_dedup
from tests.llm.conftest import prose

NULL = -(1 << 63)


def removed_bytes(docs):
    """(id, text) in order of id: kept bytes, removed, runs."""
    seen, out = set(), []
    for i, text in docs:
        raw, gone = (text or "").encode(), np.zeros(len((text or "").encode()), bool)
        for p in range(len(raw) - 99):
            if raw[p : p + 100] in seen:
                gone[p : p + 100] = True
            seen.add(raw[p : p + 100])
        runs = int(np.diff(gone.astype(int), prepend=0).clip(0).sum())
        out.append((i, len(raw), int(gone.sum()), runs, bytes(np.frombuffer(raw, np.uint8)[~gone])))
    return out


def removed_words(docs):
    first, out = {}, []
    for i, text in docs:
        words = (text or "").encode().split()
        for p in range(len(words) - 49):
            first.setdefault(tuple(words[p : p + 50]), i)
    for i, text in docs:
        words = (text or "").encode().split()
        gone = np.zeros(len(words), bool)
        for p in range(len(words) - 49):
            if first[tuple(words[p : p + 50])] != i:
                gone[p : p + 50] = True
        out.append((i, len(words), int(gone.sum()), b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()))
    return out


@pytest.fixture(params=[1 << 11, 1 << 21], ids=["many blocks", "one block"])
def blocks(request, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", request.param)


@pytest.fixture(scope="module")
def copied(frame):
    """Texts that share passages at all offsets, of lengths around both widths."""
    rng = random.Random(5)
    pool = [prose(100 + k, n) for k, n in enumerate((12, 20, 49, 50, 51, 60, 120))]
    rows = []
    for i in range(60):
        parts = [rng.choice(pool) if rng.random() < 0.6 else prose(1000 + i * 10 + k, rng.randint(1, 70)) for k in range(rng.randint(1, 4))]
        rows.append((i * 3, "\n".join(parts)))
    rows += [(500, "a" * 350), (501, "ab" * 140), (502, "a" * 99), (503, None), (504, ""), (505, rows[0][1]), (506, "é" * 90)]
    return rows, frame("doc_id long, text string", rows)


def test_bytes_equal_brute_force(copied, blocks):
    rows, docs = copied
    assert sorted(map(tuple, suffix_dedup.remove_repeated_bytes(docs).collect())) == removed_bytes(rows)


def test_words_equal_brute_force(copied, blocks):
    rows, docs = copied
    assert sorted(map(tuple, substring_dedup.remove_repeated_passages(docs).collect())) == removed_words(rows)


def test_awkward_rows(awkward):
    rows = sorted(((NULL if r.doc_id is None else r.doc_id), r.text) for r in awkward.select("doc_id", "text").where("doc_id != 10 AND doc_id != 11").collect())
    part = awkward.where("doc_id != 10 AND doc_id != 11")
    plain = lambda found: sorted((tuple(r) for r in found.collect()), key=repr)
    assert plain(suffix_dedup.remove_repeated_bytes(part)) == sorted(removed_bytes(rows), key=repr)
    assert plain(substring_dedup.remove_repeated_passages(part)) == sorted(removed_words(rows), key=repr)
    assert suffix_dedup.remove_repeated_bytes(awkward).count() == substring_dedup.remove_repeated_passages(awkward).count() == 17


def test_rows_that_share_an_id(awkward):
    """Of equal rows one copy of bytes stays; words of the same id never remove each other."""
    twice = awkward.where("doc_id = 11")
    found = suffix_dedup.remove_repeated_bytes(twice).collect()
    assert sorted(r.n_removed for r in found) == [0, found[0].n_bytes]
    assert {r.n_removed for r in substring_dedup.remove_repeated_passages(twice).collect()} == {0}


@pytest.mark.parametrize("lengths", [[1], [300], [300, 2, 90, 400], [40] * 30], ids=str)
def test_corpus_without_a_repeat(frame, blocks, lengths):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(n))) for i, n in enumerate(lengths)]
    docs = frame("doc_id long, text string", rows)
    assert {tuple(r)[2:4] for r in suffix_dedup.remove_repeated_bytes(docs).collect()} == {(0, 0)}
    assert {r.n_removed for r in substring_dedup.remove_repeated_passages(docs).collect()} == {0}


def test_blocks_some_of_which_hold_no_repeat(frame, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 1 << 10)
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(200))) for i in range(12)] + [(20, prose(3, 200)), (30, prose(3, 200))]
    docs = frame("doc_id long, text string", rows)
    assert sorted(map(tuple, suffix_dedup.remove_repeated_bytes(docs).collect())) == sorted(removed_bytes(rows))
    assert sorted(map(tuple, substring_dedup.remove_repeated_passages(docs).collect())) == sorted(removed_words(rows))


def test_empty_tables(nothing):
    assert suffix_dedup.remove_repeated_bytes(nothing).count() == substring_dedup.remove_repeated_passages(nothing).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=60))
def test_packing_round_trip(values):
    values = np.array(sorted(set(values)), np.uint64)
    assert (repeats.unpack_sorted(repeats.pack_sorted(values)) == values).all()


def one_window(block, name, check, owner):
    return {
        "bucket": 0,
        "block": block,
        "base": owner,
        "names": repeats.pack_sorted(np.array([name], np.uint64)),
        "checks": np.array([check], "<u2").tobytes(),
        "owners": repeats._pack_owners(np.array([0], np.uint64)),
    }


@pytest.mark.parametrize("rule", [suffix_dedup.BYTE_RULE, substring_dedup.WORD_RULE])
def test_equal_names_of_different_windows_remove_nothing(rule):
    """Windows whose names agree are told apart by their checks, over blocks and within one."""
    rows = [one_window(1, 77, 5, 10), one_window(2, 77, 6, 20), one_window(3, 77, 5, 30), one_window(4, 78, 5, 40)]
    answer = repeats._later_windows(rule)(pa.Table.from_pylist(rows, repeats._NAMES_ARROW)).to_pylist()
    assert [r["block"] for r in answer] == [3]

    names, checks = np.array([9, 7, 7, 9, 7], np.uint64), np.array([1, 2, 3, 1, 2], "<u2")
    first, same = repeats._distinct(names, checks)
    assert first.tolist() == [1, 2, 0] and same.tolist() == [2, 0, 1, 2, 0]
    assert [a.tolist() for a in repeats._distinct(names, np.zeros(5, "<u2"))] == [[1, 0], [1, 0, 0, 1, 0]]
    assert [len(a) for a in repeats._distinct(names[:0], checks[:0])] == [0, 0]


def test_block_size_reaches_the_tasks(copied, blocks, request):
    texts = copied[1].select("doc_id", "text")
    made = texts.mapInArrow(partial(repeats._blocks, most=repeats.BLOCK_BYTES), repeats._BLOCK).count()
    assert made > 10 if "many" in request.node.name else made == 3


@pytest.mark.parametrize("rule", [suffix_dedup.BYTE_RULE, substring_dedup.WORD_RULE])
def test_covers_hold_every_difference(rule):
    found = {(a - b) % rule.period for a in rule.cover for b in rule.cover}
    assert found == set(range(rule.period))
