"""Conversion funnel over web events.

The reference counts ``COUNT(DISTINCT CASE WHEN step THEN session END)``
once per step; Catalyst plans that with an Expand (one copy of every event
per distinct aggregate) and two aggregation levels.  Here each session is
first reduced to one row of step flags (``max`` of a boolean: a partial
aggregate, so a session with a huge share of events is collapsed map-side),
and the flags are then summed: one shuffle by session, same counts.
NULL sessions are dropped, as ``COUNT(DISTINCT)`` ignores NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baobab.functions import rules
from baobab.operators.ordered import in_runs, running_max

# --- Fixed values: the funnel steps and their output names -------------------
STEPS = ("view_product", "add_to_cart", "purchase")
STEP_NAMES = ("vues", "paniers", "achats")
# -----------------------------------------------------------------------------


def session_flags(
    events: DataFrame,
    by: Sequence[str] = (),
    steps: Sequence[str] = STEPS,
    session: str = "session_id",
    event_type: str = "event_type",
) -> DataFrame:
    """One row per (by..., session) with a 0/1 flag per step."""
    flags = [
        F.max(F.when(F.col(event_type) == s, 1).otherwise(0)).alias(f"_s{i}") for i, s in enumerate(steps)
    ]
    return events.filter(F.col(session).isNotNull()).groupBy(*by, session).agg(*flags)


def funnel_counts(
    events: DataFrame,
    by: Sequence[str] = (),
    steps: Sequence[str] = STEPS,
    names: Sequence[str] = STEP_NAMES,
    session: str = "session_id",
    event_type: str = "event_type",
    strict: bool = False,
) -> DataFrame:
    """Distinct sessions overall and at each step (per group ``by``).

    Steps are counted independently, as in the reference, so a later step
    can exceed an earlier one (X14).  With ``strict=True`` a session counts
    at a step only if it also reached every earlier step.
    """
    f = session_flags(events, by, steps, session, event_type)
    cols = []
    reached = F.lit(1)
    for i, name in enumerate(names):
        flag = F.col(f"_s{i}")
        if strict:
            reached = reached * flag
            flag = reached
        # 0, not NULL, on empty input, as COUNT(DISTINCT ...) gives
        cols.append(F.coalesce(F.sum(flag), F.lit(0)).cast("bigint").alias(name))
    return f.groupBy(*by).agg(F.count("*").alias("sessions"), *cols)


def funnel_rates(counts: DataFrame, names: Sequence[str] = STEP_NAMES) -> DataFrame:
    """Step-to-step and global conversion (%), one decimal."""
    chain = ["sessions", *names]
    out = [
        rules.pct(F.col(chain[i + 1]), F.col(chain[i]), 1).alias(f"t_{chain[i + 1]}") for i in range(len(names))
    ]
    return counts.select(*out, rules.pct(F.col(chain[-1]), F.col("sessions"), 1).alias("t_global"))


def funnel_by(events: DataFrame, by: str, session: str = "session_id", event_type: str = "event_type", final_step: str = "purchase") -> DataFrame:
    """Sessions, purchasing sessions and global rate (%, 2 decimals)
    per segment.  One session seen under several segments counts in each
    (X16)."""
    c = funnel_counts(events, (by,), (final_step,), ("achats",), session, event_type)
    return c.withColumn("taux_global", rules.pct(F.col("achats"), F.col("sessions"), 2))


def top_segments(events: DataFrame, by: str, k: int = 10) -> DataFrame:
    """The ``k`` segments with most sessions (ties by segment)."""
    return funnel_by(events, by).orderBy(F.col("sessions").desc(), F.col(by)).limit(k)


def anonymous_share(events: DataFrame, session: str = "session_id") -> DataFrame:
    """Events without a session, counted and as a share (%)."""
    return events.agg(
        F.count("*").alias("n_events"),
        F.count_if(F.col(session).isNull()).alias("n_sans_session"),
    ).withColumn("part_sans_session_pct", rules.pct(F.col("n_sans_session"), F.col("n_events"), 2))


def ordered_steps(
    events: DataFrame,
    steps: Sequence[str] = STEPS,
    within: str | None = None,
    session: str = "session_id",
    event_type: str = "event_type",
    event_time: str = "event_time",
    event_id: str = "event_id",
) -> DataFrame:
    """C29 in event order: one row per session with a 0/1 flag ``_s0``, ``_s1`` ... per step.

    A session reaches a step if it has an event of each step up to it, one after
    the other by time (equal times: by id), the last of them at most ``within``
    (an interval such as ``"6 hours"``) after the first; any event of the first
    step can begin such a chain.  Of the chains that end with an event the one
    that began last reaches furthest, so each event only carries that beginning:
    a running maximum per step.  Events without a time take no part; a session
    without any step has a row of zeros; NULL sessions are dropped.
    """
    known = events.filter(F.col(session).isNotNull())
    timed = known.filter(F.col(event_type).isin(*steps) & F.col(event_time).isNotNull())
    runs = in_runs(timed.select(session, event_type, event_time, event_id), session, [event_time, event_id])
    began = F.when(F.col(event_type) == steps[0], F.col(event_time))
    runs = runs.withColumn("_b0", began)
    for k, step in enumerate(steps[1:], 1):
        runs = running_max(runs, session, F.col(f"_b{k - 1}"), "_before")
        intime = F.lit(True) if within is None else F.col(event_time) <= F.col("_before") + F.expr(f"INTERVAL {within}")
        runs = runs.withColumn(f"_b{k}", F.when((F.col(event_type) == step) & intime, F.col("_before"))).drop("_before")
    flags = [F.col(f"_b{k}").isNotNull().cast("int").alias(f"_s{k}") for k in range(len(steps))]
    none = [F.lit(0).alias(f"_s{k}") for k in range(len(steps))]
    # sessions without a step count as well: one partial aggregate over both
    rows = runs.select(session, *flags).unionByName(known.select(session, *none))
    return rows.groupBy(session).agg(*(F.max(f"_s{k}").alias(f"_s{k}") for k in range(len(steps))))


def ordered_funnel(
    events: DataFrame,
    steps: Sequence[str] = STEPS,
    names: Sequence[str] = STEP_NAMES,
    within: str | None = None,
    session: str = "session_id",
    event_type: str = "event_type",
    event_time: str = "event_time",
    event_id: str = "event_id",
) -> DataFrame:
    """Sessions overall and those that reach each step in order (see :func:`ordered_steps`).

    Counts never grow from one step to the next."""
    f = ordered_steps(events, steps, within, session, event_type, event_time, event_id)
    reached = [F.coalesce(F.sum(f"_s{k}"), F.lit(0)).cast("bigint").alias(n) for k, n in enumerate(names)]
    return f.agg(F.count("*").alias("sessions"), *reached)


def first_touch(
    events: DataFrame,
    by: str,
    steps: Sequence[str] = STEPS,
    names: Sequence[str] = STEP_NAMES,
    session: str = "session_id",
    event_type: str = "event_type",
    event_time: str = "event_time",
    event_id: str = "event_id",
) -> DataFrame:
    """C31 with segments that add up: each session counts once, in the segment of
    its first event (by time, NULL times last, equal times by id).

    Columns: ``by``, sessions, one count per step, and the global rate (%, 2
    decimals).  Sums over the segments are those of :func:`funnel_counts`; a first
    event without a segment counts under NULL.  The first event is a partial
    aggregate, like the flags."""
    order = F.struct(F.col(event_time).isNull(), F.col(event_time), F.col(event_id))
    flags = [F.max(F.when(F.col(event_type) == s, 1).otherwise(0)).alias(f"_s{i}") for i, s in enumerate(steps)]
    each = events.filter(F.col(session).isNotNull()).groupBy(session).agg(F.min_by(F.col(by), order).alias(by), *flags)
    sums = [F.sum(f"_s{i}").cast("bigint").alias(n) for i, n in enumerate(names)]
    counted = each.groupBy(by).agg(F.count("*").alias("sessions"), *sums)
    return counted.withColumn("taux_global", rules.pct(F.col(names[-1]), F.col("sessions"), 2))
