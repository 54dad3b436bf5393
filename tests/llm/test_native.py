"""Personal data, mixing and decontamination against plain Python, and their edge cases."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tamis.llm import decontamination, mixing, pii
from tests.llm.conftest import prose

# The patterns as given.
GIVEN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    return [(k, m.start(), m.end()) for k, p in GIVEN.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


def found_base(frame, texts):
    rows = frame("doc_id long, text string", list(enumerate(texts)), 1).select("doc_id", pii.base_spans(F.col("text")).alias("s"))
    return [[(s.kind, s.start, s.end) for s in r.s or []] for r in sorted(rows.collect())]


SPECIMENS = [
    "a@b.c-d.e%x@f.g and a..b@c.d.",
    "x@y 1.2.3.4.5.6.7.8 256.1.1.1 0001.002.03.4 99999999999999999999.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1112 5500000000000004 4111  1111 1111 1111",
    "+1 (559) 555-3893 +49.30.123456 +1 +12345678 +1234567890123456 ++44 20 7946 0958",
    "é😀 mail@exämple.org ünï@x.yz 😀1.1.1.1😀",
    "1" * 5000 + " " + "a" * 5000 + " " + "1 " * 3000 + "." * 3000,
    "",
    None,
]


def test_base_spans(frame):
    assert found_base(frame, SPECIMENS) == [base(t) for t in SPECIMENS]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("0159.@+- ()ab%é\U0001f600\n", max_size=60), min_size=40, max_size=60))
def test_base_spans_of_random_text(frame, texts):
    assert found_base(frame, texts) == [base(t) for t in texts]


def test_terms_that_reveal_an_entity(frame):
    near = "common words here {} wrote to ann@x.org about number {}"
    rows = [(i, near.format("zyxident" if i < 4 else "other", i)) for i in range(8)]
    rows += [(i, f"common words here other wrote about number {i}") for i in range(10, 200)]
    rows += [(900 + i, rows[0][1]) for i in range(5)]
    found = {r.doc_id: r for r in pii.sanitise(frame("doc_id long, text string", rows)).collect()}
    for i, text in rows:
        spans = [(s.kind, text[s.start : s.end]) for s in found[i]._spans]
        assert spans == ([("email", "ann@x.org")] if "@" in text else []) + ([("removed", "zyxident")] if "zyx" in text else [])
    assert found[1]._sanitised == "common words here  wrote to [EMAIL] about number 1"


def test_terms_far_from_an_entity_reveal_it(frame):
    """A name in the heading and one with digits; the address stands at the end, now and then near."""
    rows = []
    for i in range(6):
        gap = "" if i < 3 else " ".join(["filler text goes on"] * 30)
        rows.append((i, f"Zyxident unit77b {gap} number {i} wrote to ann@x.org"))
    rows += [(i, f"filler text goes on, number {i} wrote to nobody") for i in range(10, 200)]
    found = {r.doc_id: r for r in pii.sanitise(frame("doc_id long, text string", rows)).collect()}
    for i, text in rows:
        spans = {(s.kind, text[s.start : s.end]) for s in found[i]._spans}
        assert spans == ({("email", "ann@x.org")} | {("removed", t) for t in ("Zyxident", "unit77b")} if i < 6 else set())


def test_copies_of_one_text_reveal_nothing(frame):
    rows = [(i, "zyxident wrote to ann@x.org") for i in range(20)] + [(100 + i, f"plain {i}") for i in range(50)]
    assert {len(r._spans) for r in pii.sanitise(frame("doc_id long, text string", rows)).where("doc_id < 100").collect()} == {1}


def revealed(texts):
    """Each protected value and each term that gives at least `GENERALISE` of its bits, counted text by text."""
    values, terms = defaultdict(set), defaultdict(set)
    for k, t in enumerate(sorted(set(texts))):
        rest = t
        for kind, a, b in base(t):
            values[kind, t[a:b].lower()].add(k)
            rest = rest.replace(t[a:b], " ")
        for w in re.findall("[a-z0-9]{3,}", rest.lower()):
            terms[w].add(k)
    out, n = {}, len(set(texts))
    for e, at in values.items():
        for w, found in terms.items():
            if len(at) >= pii.SUPPORT and len(at & found) >= pii.SUPPORT:
                share = math.log2(len(at & found) * n / (len(at) * len(found))) / -math.log2(len(at) / n)
                if share >= pii.GENERALISE:
                    out[(*e, w)] = round(share, 9)
    return out


@pytest.mark.parametrize("most", [1 << 20, 5])
def test_disclosures_equal_brute_force(frame, monkeypatch, most):
    """Lists of addresses that stand in the same texts, some in others too, and texts dealt to slices."""
    monkeypatch.setattr(pii, "PAIRS", most)
    rng, texts = random.Random(4), []
    for team in range(4):
        people = [f"p{team}x{k}@team{team}.org" for k in range(9)]
        for k in range(5):
            texts.append(f"list {k} of unit{team}a, name{team} " + " ".join(people[: 9 if k < 3 else 5]) + f" {prose(10 * team + k, 12)} call +1 (559) 555-389{team}")
    texts += [f"{prose(100 + k, 15)} name{rng.randrange(4)} no{k}" for k in range(150)] + texts[:3]
    rows = frame("doc_id long, text string", list(enumerate(texts))).select(F.xxhash64("text").alias("text_id"), "text", pii.base_spans(F.col("text")).alias("spans"))
    found = [((r.kind, r.value, r.term), round(r.share, 9)) for r in pii.disclosures(rows).collect()]
    assert len(found) == len(dict(found)) and dict(found) == revealed(texts) and len(found) >= 36


def test_entities_with_the_same_texts_are_one_class(frame):
    people = " ".join(f"p{k}@team.org" for k in range(200))
    rows = [(k, f"list {k} of unit77a {people}") for k in range(4)] + [(10 + k, f"text {k}") for k in range(30)]
    rows = frame("doc_id long, text string", rows).select(F.xxhash64("text").alias("text_id"), "text", pii.base_spans(F.col("text")).alias("spans"))
    known, members, scored = pii._revealing(rows)
    assert (known.count(), members.count()) == (200, 4)
    assert [r.term for r in scored.collect()].count("unit77a") == 1


def test_sanitise_awkward_rows(awkward, nothing, frame):
    found = pii.sanitise(awkward.withColumn("text", F.when(F.col("doc_id") == 7, "call +1 (559) 555-3893").otherwise(F.col("text"))))
    assert found.columns == [*awkward.columns, "_spans", "_sanitised"] and found.count() == 17
    rows = {r.doc_id: r for r in found.collect()}
    assert rows[4]._sanitised is None and rows[5]._sanitised == "" and rows[7]._sanitised == "call [PHONE]"
    assert rows[8]._sanitised == "tiny text" and rows[4]._spans == []
    assert pii.sanitise(nothing).count() == 0


def levels(sizes):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total = 1.5 * sum(sizes.values())
    target = {s: total * weight[s] / sum(weight.values()) for s in names}
    while over := [s for s in names if target[s] > 2 * sizes[s] + 1e-9]:
        excess = sum(target[s] - 2 * sizes[s] for s in over)
        target |= {s: 2.0 * sizes[s] for s in over}
        free = [s for s in names if target[s] < 2 * sizes[s] - 1e-9]
        for s in free:
            target[s] += excess * weight[s] / sum(weight[f] for f in free)
    return target


@pytest.fixture(scope="module")
def sources(frame):
    rng = random.Random(4)
    names = ["b", "a", "é", "Z", None, "hot"]
    rows = [(i if i % 9 else None, prose(i, rng.randint(0, 400)), "hot" if i % 3 == 0 else rng.choice(names)) for i in range(240)]
    return rows, frame("doc_id long, text string, source string", rows)


def test_mixture(sources):
    rows, docs = sources
    documents, pieces = mixing.mix(docs)
    found = documents.collect()
    sizes, taken = Counter(), Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    assert sorted(r.size for r in found) == sorted(len(t.split()) for _, t, _ in rows)
    target = levels(sizes)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - t) <= 1.5 * mixing.BLOCK for s, t in target.items())
    again = mixing.mix(docs.repartition(7))[0]
    assert sorted(map(repr, again.collect())) == sorted(map(repr, found))

    texts = mixing.mixed_texts(docs, pieces).collect()
    assert sum(r.words for r in texts) == sum(taken.values())
    assert all(len(r.text.split()) == r.words for r in texts)
    slots = defaultdict(int)
    for r in pieces.collect():
        slots[r.ordinal, r.slot] += r.words
        assert r.words > 0
    assert max(slots.values()) == mixing.BLOCK


@pytest.mark.parametrize("blocks", [1, 2, 7, 8, 64, 100, 1023, 1024, 4096])
def test_slots_take_every_block_once_a_round_in_no_order(spark, blocks):
    many = F.lit(blocks).cast("long")
    keys = mixing.round_keys(many, F.lit(3).cast("long"), F.floor(F.col("id") / blocks))
    slots = spark.range(2 * blocks).select("id", mixing.block_of(F.col("id"), many, keys).alias("block"))
    taken = [r.block for r in slots.orderBy("id").collect()]
    rounds = taken[:blocks], taken[blocks:]
    assert all(sorted(r) == list(range(blocks)) for r in rounds)
    if blocks >= 64:
        steps = Counter((b - a) % blocks for a, b in zip(rounds[0], rounds[0][1:], strict=False))
        assert max(steps.values()) < 8 + blocks / 50 and rounds[0] != rounds[1]
        # as many places rise as fall, and neighbours are far apart
        assert 0.3 < sum(b > a for a, b in zip(taken, taken[1:], strict=False)) / len(taken) < 0.7


def test_mixing_awkward_rows(awkward, nothing):
    documents, pieces = mixing.mix(awkward)
    rows = documents.collect()
    assert len(rows) == 17 and {r.taken for r in rows if r.size == 0} == {0}
    assert mixing.mixed_texts(awkward, pieces).count() == pieces.count() > 0
    documents, pieces = mixing.mix(nothing)
    assert documents.count() == pieces.count() == mixing.mixed_texts(nothing, pieces).count() == 0
    blank, none = mixing.mix(awkward.where("doc_id IN (4, 5, 6)"))
    assert {(r.size, r.target, r.taken) for r in blank.collect()} == {(0, 0.0, 0)} and none.count() == 0


def leaks(docs, items):
    """(document, item) with a window of the item's size at any place that is similar enough."""
    found = set()
    for d, text in docs:
        words = (text or "").lower().split()
        for i, item in items:
            own = (item or "").lower().split()
            if not own or not words:
                continue
            size, want = min(5, len(own)), Counter(tuple(own[k : k + min(5, len(own))]) for k in range(max(1, len(own) - 4)))
            for at in range(max(1, len(words) - len(own) + 1)):
                window = words[at : at + len(own)]
                have = Counter(tuple(window[k : k + size]) for k in range(len(window) - size + 1))
                shared = sum((have & want).values())
                if have and shared >= 0.75 * (sum(have.values()) + sum(want.values()) - shared):
                    found.add((d, i))
                    break
    return found


def test_leaks_equal_brute_force(frame):
    rng = random.Random(6)
    items = [(i, prose(500 + i, rng.randint(14, 60))) for i in range(12)] + [(50, "just three words"), (51, "of of of of of of of of"), (52, None), (53, " ")]
    docs = []
    for d in range(60):
        words = prose(d, rng.randint(0, 150)).split()
        own = items[rng.randrange(14)][1].split()
        for _ in range(rng.choice((0, 0, 1, 3))):
            own[rng.randrange(len(own))] = "changed"
        if d % 2:
            at = rng.randint(0, len(words))
            words[at:at] = own[: rng.choice((len(own), len(own), len(own) // 2))]
        docs.append((d, " ".join(words)))
    docs += [(100, items[3][1].upper()), (101, " ".join(items[4][1].split()[1:])), (102, None), (103, "")]
    found = decontamination.contaminations(frame("doc_id long, text string", docs), frame("item_id long, text string", items))
    rows = found.collect()
    assert {(r.doc_id, r.item_id) for r in rows} == leaks(docs, items)
    assert all(r.similarity >= 0.75 and r.distance <= decontamination.RADIUS for r in rows)


def test_leaks_between_aligned_starts(frame):
    """Words put in and taken out in the middle: the best window lines up with neither half of the item."""
    items = [(1, prose(901, 59)), (2, prose(902, 52)), (3, prose(903, 132))]
    docs = []
    for k, (edge, more) in enumerate([(1, 3), (1, 2), (5, 10)]):
        own = items[k][1].split()
        n = len(own)
        own[:edge], own[n - edge :] = ["first"] * edge, ["last"] * edge
        docs.append((k, " ".join([*prose(k, 40).split(), *own[: n // 2], *[f"new{j}" for j in range(more)], *own[n // 2 :], *prose(50 + k, 40).split()])))
    rng = random.Random(11)
    for d in range(60):
        own = items[d % 3][1].split()
        for _ in range(rng.choice((1, 1, 2))):
            at, many = rng.randrange(len(own)), rng.randint(1, 4)
            own[at : at + rng.choice((0, many))] = ["x"] * rng.choice((0, many))
        docs.append((10 + d, " ".join([*prose(d, 30).split(), *own, *prose(200 + d, 30).split()])))
    found = decontamination.contaminations(frame("doc_id long, text string", docs), frame("item_id long, text string", items)).collect()
    assert leaks(docs, items) >= {(0, 1), (1, 2), (2, 3)}
    assert {(r.doc_id, r.item_id) for r in found} == leaks(docs, items)


def test_starts_are_all_windows_with_enough_places(frame):
    """Each start once, without lists of all windows around each place in between."""
    rng = random.Random(8)
    rows = []
    for _ in range(150):
        n, last = rng.randint(1, 12), rng.randint(-2, 40)
        rows.append((n, last, sorted(rng.sample(range(max(last, 0) + n), rng.randint(1, max(last, 0) + n)))))
    for r in frame("n int, last int, places array<int>", rows).withColumn("starts", decontamination._starts()).collect():
        least = math.ceil(1.5 / 1.75 * r.n - 1e-6)
        enough = [s for s in range(max(r["last"], 0) + 1) if sum(s <= p < s + r.n for p in r.places) >= least]
        assert r.starts == (enough if r["last"] > 0 else [0])
    long = frame("id long", [(0,)]).selectExpr("40000 AS n", "100000 AS last", "sequence(0, 139999) AS places")
    assert long.select(decontamination._starts().alias("s")).selectExpr("size(s) AS n", "array_max(s) AS most").first()[:] == (100001, 100000)


def test_windows_are_sorted_without_the_words_of_texts(frame, monkeypatch):
    """A text with many windows is not held once for each of them."""
    seen = {}
    written = decontamination.written
    monkeypatch.setattr(decontamination, "written", lambda df, name: seen.update({name: df}) or written(df, name))
    own = prose(77, 40)
    docs = frame("doc_id long, text string", [(k, " ".join([prose(k, 20), own, prose(300 + k, 20)])) for k in range(3)])
    assert decontamination.contaminations(docs, frame("item_id long, text string", [(1, own)])).count() > 3
    plan = seen["windows"]._jdf.queryExecution().optimizedPlan().toString()
    told_apart = [x for x in plan.splitlines() if "Aggregate [" in x and "first_word" in x]
    assert told_apart and not any("words#" in x.replace("n_words#", "") for x in told_apart)


def test_decontaminate_awkward_rows(awkward, nothing, frame):
    items = frame("item_id long, text string, extra int", [(1, prose(4, 30), 1), (2, None, 2), (None, prose(1, 20), 3)])
    kept = decontamination.decontaminate(awkward, items)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [4, 5, 6, 7, 8, 9, 10, 12, 13]
    assert {r.doc_id for r in decontamination.contaminations(awkward, items).collect()} == {None, 1, 2, 3, 10, 11}
    assert decontamination.decontaminate(awkward, items.limit(0)).count() == 17
    assert decontamination.contaminations(nothing, items).count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 2**63 - 1), st.sets(st.integers(0, 62), max_size=20)), min_size=1, max_size=20))
def test_blocks_find_all_within_the_radius(frame, pairs):
    rows = [(p, p ^ sum(1 << b for b in flips)) for p, flips in pairs]
    blocks = frame("a long, b long", rows, 1).select(F.arrays_overlap(decontamination._blocks(F.col("a")), decontamination._blocks(F.col("b"))).alias("met"))
    assert all(r.met for r in blocks.collect())


def test_bit_table_loses_none(frame):
    from tamis.llm.bits import listed

    rows = frame("x long", [(k * k,) for k in range(3000)])
    assert rows.where(listed(F.col("x"), rows, "x")).count() == 3000
    others = rows.selectExpr("-x - 5 AS x")
    assert others.where(listed(F.col("x"), rows, "x")).count() < 60


def test_bit_table_is_not_in_the_text_of_a_plan(frame):
    from tamis.llm.bits import listed

    rows = frame("x long", [(k * k,) for k in range(3000)])
    found = rows.where(listed(F.col("x"), rows, "x"))
    assert found.count() == 3000
    assert len(found._jdf.queryExecution().toString()) < 10_000
