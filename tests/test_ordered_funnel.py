"""Funnels in event order and first-touch segments against plain Python, one
session holding a third of all events."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest

from baobab.operators import funnel
from baobab.operators.ordered import in_runs, running_max
from pyspark.sql import functions as F

T0 = dt.datetime(2025, 1, 1)
STEPS = funnel.STEPS


@pytest.fixture(scope="module")
def events(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(6000):
        session = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"s{rnd.randint(1, 300)}"
        # many equal times; the hot session only meets its last step at the very end
        kinds = ["view_product", "error"] if session == "hot" else [*STEPS, "error"]
        when = None if i % 97 == 0 else T0 + dt.timedelta(minutes=rnd.randint(0, 600))
        rows.append((i, when, session, rnd.choice(kinds), rnd.choice(["mobile", "desktop", None])))
    rows += [(7001, T0 + dt.timedelta(minutes=601), "hot", "add_to_cart", "mobile"),
             (7002, T0 + dt.timedelta(minutes=601), "hot", "purchase", "mobile"),
             (7000, T0 + dt.timedelta(minutes=602), "back", "purchase", "mobile"),
             (7003, T0 + dt.timedelta(minutes=602), "back", "add_to_cart", "desktop")]
    frame = spark.createDataFrame(rows, "event_id long, event_time timestamp, session_id string, event_type string, device string")
    return rows, frame.repartition(8)


def brute_reached(rows, within):
    by = defaultdict(list)
    for i, t, s, e, _ in rows:
        if s is not None:
            by[s].append((t, i, e))
    out = Counter(sessions=len(by))
    for found in by.values():
        found = sorted(x for x in found if x[0] is not None)
        best = 0
        for k, (t, _, e) in enumerate(found):
            if e != STEPS[0]:
                continue
            reached = 1
            for t2, _, e2 in found[k + 1 :]:
                if reached < len(STEPS) and e2 == STEPS[reached] and (within is None or t2 - t <= within):
                    reached += 1
            best = max(best, reached)
        for n in funnel.STEP_NAMES[:best]:
            out[n] += 1
    return out


@pytest.mark.parametrize("within,delta", [(None, None), ("20 minutes", dt.timedelta(minutes=20))])
def test_ordered_funnel(events, within, delta):
    rows, frame = events
    got = funnel.ordered_funnel(frame, within=within).first().asDict()
    assert got == {n: brute_reached(rows, delta)[n] for n in ("sessions", *funnel.STEP_NAMES)}
    assert got["sessions"] > got["vues"] >= got["paniers"] >= got["achats"] > 0


def test_hot_session_is_not_one_task(spark, events):
    rows, frame = events
    flags = {r.session_id: (r._s0, r._s1, r._s2) for r in funnel.ordered_steps(frame).collect()}
    assert flags["hot"] == (1, 1, 1) and flags["back"] == (0, 0, 0)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one task
    try:
        runs = in_runs(frame.filter(F.col("session_id") == "hot"), "session_id", ["event_time", "event_id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in runs.groupBy("_run").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 0.7 * sum(sizes)


def test_running_max_over_runs(spark):
    rnd = random.Random(2)
    data = [(g, k, rnd.randint(0, 1000) if rnd.random() < 0.3 else None) for g in ("a", "b", None) for k in range(400)]
    runs = in_runs(spark.createDataFrame(data, "g string, k int, v int").repartition(5), "g", ["k"])
    got = {(r.g, r.k): r.before for r in running_max(runs, "g", F.col("v"), "before").collect()}
    for g in ("a", "b"):
        top = None
        for h, k, v in data:
            if h == g:
                assert got[g, k] == top
                top = v if top is None or (v is not None and v > top) else top


def test_ordered_funnel_of_nothing(events):
    _, frame = events
    assert tuple(funnel.ordered_funnel(frame.limit(0)).first()) == (0, 0, 0, 0)


def test_first_touch_adds_up(events):
    rows, frame = events
    got = {r.device: r for r in funnel.first_touch(frame, "device").collect()}
    first = {}
    for i, t, s, _, d in rows:
        if s is not None:
            key = (t is None, t or T0, i)
            if s not in first or key < first[s][0]:
                first[s] = (key, d)
    assert {d: r.sessions for d, r in got.items()} == Counter(d for _, d in first.values())
    whole = funnel.funnel_counts(frame).first()
    for n in ("sessions", *funnel.STEP_NAMES):
        assert sum(r[n] for r in got.values()) == whole[n]
    plan = funnel.first_touch(frame, "device")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan  # the hot session is a row per map task before it is moved
