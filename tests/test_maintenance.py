"""Indicators and alerts against plain loops, over stretches of every size; cuts of skewed keys."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tamis.operators.alerts import alerts
from tamis.operators.indicators import indicators
from tamis.sources import jdbc

LIMITS = {"temperature": 60.0, "vibration": 4.0}
START = datetime(2026, 1, 30)
SCHEMA = "id int, date timestamp, instal string, temperature_max double, temperature_mean double, vibration_max double, cable int, ailette int"


def some_rows(seed, n=400, equipment=("A", "A", "A", "B", "C", None)):
    rng = random.Random(seed)
    value = lambda limit: rng.choice([None, limit - 1, limit, limit + 0.25, limit * 1.1, limit * 2])
    rows = []
    for i in range(n):
        moment = None if rng.random() < 0.05 else START + timedelta(hours=rng.randrange(n // 4))
        hot = value(60.0)
        rows.append((i if rng.random() < 0.95 else None, moment, rng.choice(equipment), hot, hot, value(4.0), rng.choice([0, 0, 1, None]), 0))
    return rows


def plain_alerts(rows):
    first = lambda x: (x is not None, x if x is not None else 0)
    found = []
    for equipment in {r[2] for r in rows}:
        own = sorted((r for r in rows if r[2] == equipment and r[1] is not None), key=lambda r: (r[1], first(r[0]), first(r[3]), first(r[5])))
        for feature, column in (("temperature", 3), ("vibration", 5)):
            run = []
            for r in [*own, (None,) * 8]:
                if r[column] is not None and r[column] > LIMITS[feature]:
                    run.append(r)
                elif run:
                    peak = max(x[column] for x in run)
                    severity = "critical" if peak >= LIMITS[feature] * 1.1 else "warning"
                    found.append((equipment, feature, run[0][1], run[-1][1], len(run), peak, severity))
                    run = []
    return Counter(found)


@pytest.mark.parametrize("partitions", [1, 4, 23, 150])
def test_alerts_over_stretches(spark, partitions):
    rows = some_rows(partitions)
    frame = spark.createDataFrame(rows, SCHEMA)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = Counter(map(tuple, alerts(frame, limits=LIMITS).collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == plain_alerts(rows)


def test_one_equipment_always_above(spark):
    """One alert over every stretch, and one made of equal rows."""
    rows = [(i, START + timedelta(minutes=i), "A", 99.0, 99.0, 1.0, 0, 0) for i in range(3000)]
    rows += [(7, START, "B", 61.0, 61.0, 1.0, 0, 0)] * 500
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = sorted(map(tuple, alerts(frame, limits=LIMITS).collect()))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == [
        ("A", "temperature", rows[0][1], rows[2999][1], 3000, 99.0, "critical"),
        ("B", "temperature", START, START, 500, 61.0, "warning"),
    ]


def test_alerts_of_nothing(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert alerts(frame, limits=LIMITS).count() == 0
    assert alerts(spark.createDataFrame([(1, START, "A", 60.0, 60.0, None, 0, 0)], SCHEMA), limits=LIMITS).count() == 0


def test_indicators_by_hand(spark):
    later = START + timedelta(days=4)
    rows = [
        (1, START, "A", 61.0, 50.0, 1.0, 0, 0),
        (2, later, "A", 10.0, None, 5.0, 1, 0),
        (3, later, "B", None, None, None, None, 0),
        (4, None, None, 60.0, 20.0, 4.0, 0, 0),
    ]
    found = {(r.level, r.equipment, str(r.month)): r for r in indicators(spark.createDataFrame(rows, SCHEMA), limits=LIMITS).collect()}
    assert set(found) == {
        ("equipment_month", "A", "2026-01-01"),
        ("equipment_month", "A", "2026-02-01"),
        ("equipment_month", "B", "2026-02-01"),
        ("equipment_month", None, "None"),
        ("equipment", "A", "None"),
        ("equipment", "B", "None"),
        ("equipment", None, "None"),
        ("month", None, "2026-01-01"),
        ("month", None, "2026-02-01"),
        ("month", None, "None"),
        ("all", None, "None"),
    }
    a = found["equipment", "A", "None"]
    assert (a.n_inspections, a.n_hot, a.n_shaking, a.n_flagged, a.n_alarming, a.alarm_ratio) == (2, 1, 1, 1, 2, 1.0)
    assert (a.first_seen, a.last_seen, a.mean_gap_hours, a.temperature_peak, a.temperature_mean) == (START, later, 96.0, 61.0, 50.0)
    whole = found["all", None, "None"]
    assert (whole.n_inspections, whole.n_alarming, whole.mean_gap_hours, whole.temperature_mean, whole.vibration_peak) == (4, 2, 48.0, 35.0, 5.0)
    assert found["equipment", "B", "None"].mean_gap_hours is None and found["equipment", "B", "None"].temperature_mean is None
    assert indicators(spark.createDataFrame([], SCHEMA), limits=LIMITS).count() == 0


def test_indicators_are_summed_before_the_shuffle(spark):
    plan = indicators(spark.createDataFrame(some_rows(1), SCHEMA), limits=LIMITS)._jdf.queryExecution().executedPlan().toString()
    first = plan.rindex("Exchange hashpartitioning")
    assert "HashAggregate" in plan[first:] and "Expand" in plan[:first] and "Expand" not in plan[first:]


# --- ranges of a database scan ------------------------------------------------------


def counter(keys, asked=None):
    def histogram(low, high, buckets):
        if asked is not None:
            asked.append((low, high))
        width = -(-(high - low + 1) // buckets)
        return Counter((k - low) // width for k in keys if low <= k <= high)

    return histogram


def in_ranges(keys, cuts):
    edges = [float("-inf"), *cuts, float("inf")]
    return [sum(a <= k < b for k in keys) for a, b in zip(edges, edges[1:], strict=False)]


def test_cuts_of_a_skewed_key():
    rng = random.Random(1)
    keys = sorted({int(rng.lognormvariate(10, 3)) for _ in range(20_000)})
    asked = []
    cuts = jdbc.equi_depth_cuts(counter(keys, asked), keys[0], keys[-1], 16, buckets=64)
    sizes = in_ranges(keys, cuts)
    assert sum(sizes) == len(keys) and max(sizes) <= 2 * len(keys) / 16 and len(sizes) <= 32 and len(asked) < 40
    even = in_ranges(keys, jdbc.even_cuts(keys[0], keys[-1], 16))
    assert max(even) > 10 * len(keys) / 16


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-1000, 10**9), min_size=1, max_size=200), st.integers(1, 12))
def test_cuts_cover_every_key(keys, parts):
    cuts = jdbc.equi_depth_cuts(counter(keys), min(keys), max(keys), parts, buckets=8)
    assert cuts == sorted(set(cuts)) and sum(in_ranges(keys, cuts)) == len(keys)
    most = max(Counter(keys).values())
    assert max(in_ranges(keys, cuts)) <= max(2 * len(keys) / parts, most + len(keys) / parts)


def test_histogram_query():
    query = jdbc.histogram_query("jdbc:mysql://db/x", "t", "id", 5, 104, 10)
    assert query == (
        "SELECT FLOOR((`id` - 5) / 10) AS bucket, COUNT(*) AS n FROM `t` WHERE `id` >= 5 AND `id` <= 104 GROUP BY FLOOR((`id` - 5) / 10)"
    )
    with pytest.raises(ValueError):
        jdbc.histogram_query("jdbc:mysql://db/x", "t", "id;", 5, 104, 10)


@pytest.mark.parametrize("cuts", [None, [], [3], [3, 9, 20]])
def test_a_high_water_mark_is_shared_by_all_ranges(spark, cuts):
    rows = spark.createDataFrame([(i,) for i in [*range(-3, 60), None]], "id int")
    conditions = jdbc.range_predicates("id", -3, 25, 5, cuts, high_water=True)
    counts = {r.id: r.n for r in rows.selectExpr("id", " + ".join(f"int(coalesce({c}, false))" for c in conditions) + " AS n").collect()}
    assert counts == {i: int(i is not None and i <= 25) for i in [*range(-3, 60), None]}


def test_a_high_water_mark_of_an_empty_table():
    assert jdbc.range_predicates("id", None, None, 5, high_water=True) == ["1 = 0"]


def test_unknown_split(spark):
    with pytest.raises(ValueError, match="random"):
        jdbc.read_table(spark, "jdbc:mysql://db/x", "t", split="random")
