"""Hard negatives against brute force, nearest neighbours by recall and exactness, and their shared helpers."""

import math

import numpy as np
import pytest

from tamis.llm import hard_negatives, nearest, vectors
from tamis.llm.queries import QUERIES
from tests.conftest import SF_DIR

LONG = (1 << 63) - 1


def sound(rows):
    return [r for r in rows if r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]


def mined(rows, every, p, n):
    """(id, vector, label) rows: all hard negatives, by brute force."""
    whole = [(i, [math.floor(256 * x) for x in v], l) for i, v, l in sound(rows) if l is not None]
    near = lambda s: max(-LONG - 1, min(LONG, s))
    out = []
    for q, a, label in whole:
        if q % every:
            continue
        scores = [(-sum(x * y for x, y in zip(a, b, strict=False)), i, l) for i, b, l in whole if i != q]
        for ps, pid, _ in sorted(s for s in scores if s[2] == label)[:p]:
            fit = sorted(s for s in scores if s[2] != label and 80 * -ps <= 100 * -s[0] <= 100 * -ps)[:n]
            out += [(q, pid, k + 1, nid, near(-ps), near(-ns)) for k, (ns, nid, _) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("block", [16, 4096])
@pytest.mark.parametrize("dims, size", [(12, 1.0), (64, 1.0), (70, 0.01), (12, 1e6), (12, 1e17)])
def test_hard_negatives_equal_brute_force(frame, monkeypatch, block, dims, size):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 8)
    rng = np.random.default_rng(dims)
    centres = rng.standard_normal((4, dims))
    labels = rng.integers(0, 3, 160)
    points = (centres[rng.integers(0, 4, 160)] + 0.5 * rng.standard_normal((160, dims))) * np.where(rng.random((160, 1)) < 0.3, size, 1.0)
    rows = [(7 * i - 70, [float(x) for x in v], int(k)) for i, (v, k) in enumerate(zip(points, labels, strict=True))]
    rows += [(5000 + i, rows[9][1], i % 2) for i in range(30)] + [(5000, rows[9][1], 0)]
    found = hard_negatives.mine(frame("vec_id long, embedding array<double>, label int", rows), every=5)
    assert sorted(map(tuple, found.collect())) == mined(rows, 5, 5, 5)


def test_walks_broadcast_no_blocks(frame, monkeypatch):
    """Small files may hold large blocks, once more for each group: the driver must not gather them."""
    plans, written = [], vectors.written

    def noted(df, name):
        plans.append((name, df._jdf.queryExecution().sparkPlan().toString()))
        return written(df, name)

    monkeypatch.setattr(vectors, "written", noted)
    monkeypatch.setattr(hard_negatives, "BLOCK", 8)
    rows = [(i, [float(i % 7), 1.0], i % 3) for i in range(60)]
    assert hard_negatives.mine(frame("vec_id long, embedding array<double>, label int", rows), every=5).count() > 0
    joins = [plan for name, plan in plans if name == "states" and "Join" in plan]
    assert joins and all("SortMergeJoin" in plan and "Broadcast" not in plan for plan in joins)


def test_hard_negatives_of_the_test_data(spark):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op12_hard_negatives"](spark, SF_DIR).collect())) == mined(rows, 100, 5, 5)


def test_hard_negatives_awkward_rows(frame):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (2, [1.0], 1), (4, [], 2), (6, None, 1), (8, [1.0, None], 1), (10, [nan, 1.0], 1), (12, [inf, 1.0], 1), (None, [1.0, 1.0], 1)]
    rows += [(14, [1.0, 1.0], None), (1, [0.9, 1.9], 2), (3, [0.5, 0.5], 2), (5, [0.0, 0.0], 2), (16, [0.0, 0.0], 2), (18, [-1.0, -1.0], 3), (20, [-1.0, -1.0], 3)]
    table = frame("vec_id long, embedding array<float>, label int, rank int, score string", [(*r, 1, "x") for r in rows])
    assert sorted(map(tuple, hard_negatives.mine(table, every=2).collect())) == mined(rows, 2, 5, 5)
    assert hard_negatives.mine(table.limit(0), every=2).count() == 0
    assert hard_negatives.mine(table.where("vec_id = 4"), every=2).count() == 0
    assert hard_negatives.mine(table.where("label = 1"), every=2).count() == 0


@pytest.mark.parametrize("dims", [1, 3, 64, 65, 130])
def test_intervals_hold_the_scores(dims):
    rng = np.random.default_rng(dims)
    codes = hard_negatives.Codes(dims)
    for scale in (1, 300, 1e6):
        q, c = (np.floor(scale * rng.standard_normal((20, dims))) for _ in "qc")
        c[:3] = q[:3]
        c[4] = 0
        middle, half = codes.interval(q, codes.stored(c))
        assert (np.abs(q @ c.T - middle) <= half).all()


def test_intervals_drop_most_pairs_of_clusters():
    rng = np.random.default_rng(2)
    centres = np.floor(256 * rng.standard_normal((16, 64)))
    x = centres[np.arange(400) % 16] + np.floor(30 * rng.standard_normal((400, 64)))
    codes = hard_negatives.Codes(64)
    middle, half = codes.interval(x[:32], codes.stored(x))
    close = np.arange(32)[:, None] % 16 == np.arange(400) % 16
    assert ((middle + half)[~close] < (x[:32] @ x.T)[close].min()).mean() > 0.6


@pytest.mark.parametrize("size", [1.0, 1e6, 1e9, 1e30])
def test_products_are_exact(size):
    rng = np.random.default_rng(3)
    a, b = (np.floor(rng.uniform(-1, 1, (9, 5)) * np.where(rng.random((9, 1)) < 0.5, size, 10)) for _ in "ab")
    expected = [[sum(int(x) * int(y) for x, y in zip(u, v, strict=True)) for v in b] for u in a]
    assert [[int(x) for x in row] for row in vectors.products(a, b)] == expected


# --- nearest neighbours


def close(rows, every, k):
    """Nearest others of each query, by brute force: {query: [(distance, id), ...]} in order."""
    whole = [(i, v) for i, v, *_ in sound(rows) if any(v)]
    out = {}
    for q, a in whole:
        if q % every == 0:
            pairs = [(_distance(a, b), i) for i, b in whole if i != q]
            out.setdefault(q, []).append(sorted(pairs)[:k])
    return out


def _distance(a, b):
    total = 0.0
    for d in range(max(len(a), len(b))):
        gap = (a[d] if d < len(a) else 0.0) - (b[d] if d < len(b) else 0.0)
        total += gap * gap
    return math.sqrt(total)


def judged(found, rows, every, k):
    """The recall of a result whose rows must each be exact and in order."""
    expected, seen, vectors_ = close(rows, every, k), {}, {}
    for i, v, *_ in rows:
        vectors_.setdefault(i, []).append(v)
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        seen.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert any(r.score == _distance(a, b) for a in vectors_[r.query_id] for b in vectors_[r.vec_id])
    hits = []
    for q, answers in expected.items():
        if len(answers) == 1:
            assert seen.get(q, []) == sorted(seen.get(q, [])) and len(seen.get(q, [])) == len(answers[0])
            hits += [len(set(answers[0]) & set(seen.get(q, []))) / max(1, len(answers[0]))]
    return float(np.mean(hits))


@pytest.mark.parametrize("kind", ["even", "clusters", "lengths", "copies"])
def test_recall(frame, kind):
    rng = np.random.default_rng(6)
    v = rng.standard_normal((1500, 24))
    if kind == "clusters":
        v = 10 * rng.standard_normal((30, 24))[rng.integers(0, 30, 1500)] + 0.2 * v
    if kind == "lengths":
        v *= rng.lognormal(0, 2, (1500, 1))
    if kind == "copies":
        v[:500] = v[0]
    rows = [(3 * i, [float(x) for x in x_]) for i, x_ in enumerate(v.astype(np.float32))]
    found = nearest.nearest(frame("vec_id long, embedding array<float>", rows), every=20).collect()
    assert judged(found, rows, 20, 10) >= 0.9


def test_recall_on_the_test_data(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    assert judged(QUERIES["op13_nearest"](spark, "/root/testdata/sf0.1").collect(), rows, 100, 10) >= 0.9


def test_crowded_buckets_fill_many_packs(frame, monkeypatch):
    monkeypatch.setattr(nearest, "PACK", 16)
    monkeypatch.setattr(nearest, "QUERIES", 4)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)] + [(300 + i, [float(i), 0.0, 1.0]) for i in range(1, 40)]
    found = nearest.nearest(frame("vec_id long, embedding array<double>", rows), every=25, k=5).collect()
    for q in range(0, 300, 25):
        assert [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == q] == [i for i in range(6) if i != q][:5]


def test_queries_with_few_finds_search_all(frame, monkeypatch):
    """A cell so narrow that nothing is found near by: the exact way answers."""
    monkeypatch.setattr(nearest, "SUCCESS", 1e-9)
    monkeypatch.setattr(nearest, "_WIDTH", 1e-3)
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((300, 8)))]
    found = nearest.nearest(frame("vec_id long, embedding array<double>", rows), every=30, k=7).collect()
    assert judged(found, rows, 30, 7) == 1.0


def test_nearest_awkward_rows(frame):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (2, [1.0]), (4, []), (6, None), (8, [1.0, None]), (10, [nan, 1.0]), (12, [inf, 1.0]), (None, [1.0, 1.0])]
    rows += [(14, [0.0, 0.0]), (1, [0.5, -0.25]), (3, [0.5, -0.25]), (5, [1e200, 1.0]), (16, [-1e200, 1.0])]
    table = frame("vec_id long, embedding array<double>, rank int, score string, `row` int", [(*r, 1, "x", 2) for r in rows])
    found = nearest.nearest(table, every=2)
    assert judged(found.collect(), rows, 2, 10) == 1.0
    twice = nearest.nearest(table.where("vec_id IN (0, 1)").union(table.where("vec_id = 0")), every=2).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in twice] == [(0, 1, 1)] * 2
    assert nearest.nearest(table.limit(0), every=2).count() == 0
    assert nearest.nearest(table.where("vec_id = 14"), every=2).count() == 0
    assert nearest.nearest(table.where("vec_id = 0"), every=2).count() == 0


def test_buckets_are_visited_in_order_of_success():
    rng = np.random.default_rng(1)
    hashing = nearest.Hashing.fit(rng.standard_normal((500, 16)), 500, 10)
    q = rng.standard_normal(16)
    visits = [hashing.probes(q, r, 0) for r in (0.01, 1.0, 4.0)]
    assert all(v[0] == hashing.buckets(q[None, :], 0)[0] for v in visits[:1]) and len(visits[0]) < len(visits[2])
    near = q + rng.standard_normal((4000, 16)) * 4.0 / 4
    radius = np.linalg.norm(near - q, axis=1).mean()
    shares = [np.isin(hashing.buckets(near, t), hashing.probes(q, radius, t)).mean() for t in range(nearest.TABLES)]
    assert np.mean(shares) == pytest.approx(1 - (1 - nearest.SUCCESS) ** (1 / nearest.TABLES), abs=0.15)
