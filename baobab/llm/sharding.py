"""Operator 8: sharding by balanced label propagation.

Documents that share a group are linked.  Linked documents start on a hashed
shard; in every round each looks at how many members of its groups every shard
holds and asks to move to the fullest one.  Requests are granted as flows between
shards that leave none above its quota.  Groups that are still split then go as a
whole to a shard that has room for them, the largest first.  Documents without links
and whatever is above a quota fill the shards to exactly their quotas.

All steps are joins and aggregations.  Groups count per shard (one row a group),
so a group of any size is a partial sum; requests are ordered over a fixed
number of cells, whose counts are added up before only the rows of the cell at
the edge of a quota are ranked.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from baobab.llm.common import cell_offsets, cut, text_key
from baobab.llm.components import components

#: Cells of the ordering: so many for groups, each with so many for the documents of a group.
GROUP_CELLS, MEMBER_CELLS = 64, 256
ROUNDS = 12


def _cell(group: Column, member: Column) -> Column:
    """Documents of a group stand together, a large group over many cells."""
    return F.pmod(group, F.lit(GROUP_CELLS)) * MEMBER_CELLS + F.pmod(member, F.lit(MEMBER_CELLS))


def ranked(rows: DataFrame, group: str, out: str) -> DataFrame:
    """Adds ``out``, the row's gapless number from 0 within ``group``, in the
    order of ``cell`` and ``rid``, without one sort per group: cells are counted,
    their counts added up, and rows numbered within their cell."""
    counts = rows.groupBy(group, "cell").agg(F.count("*").alias("n"))
    before = cut(cell_offsets(counts, [group], ["cell"])).drop("n")
    nth = F.row_number().over(W.partitionBy(group, "cell").orderBy("rid")) - 1
    numbered = rows.withColumn("__nth", nth)
    return numbered.join(before, [group, "cell"]).withColumn(out, (F.col("__nth") + F.col("before")).cast("long")).drop(
        "__nth", "before"
    )


def quotas(n: int, shards: int) -> list[int]:
    """Rows of each shard; at most one apart."""
    return [n // shards + (s < n % shards) for s in range(shards)]


def grant(asked: dict[tuple[int, int], int], held: list[int], quota: list[int]) -> dict[tuple[int, int], int]:
    """How many of the requests (from, to) -> n are granted so that no shard ends
    above its quota: the largest flows, found by cutting down what flows into an
    overfull shard until none is.  What leaves a shard makes room in it."""
    flow = dict(asked)
    while True:
        cut_any = False
        for to in range(len(quota)):
            inward = sum(n for (_, t), n in flow.items() if t == to)
            outward = sum(n for (f, _), n in flow.items() if f == to)
            room = max(quota[to] - held[to] + outward, 0)
            if inward > room:
                cut_any = True
                left = room
                for pair in sorted(p for p in flow if p[1] == to):
                    share = min(flow[pair], -(-flow[pair] * room // inward), left)
                    flow[pair], left = share, left - share
        if not cut_any:
            return flow


def propagate(members: DataFrame, quota: list[int], rounds: int = ROUNDS) -> DataFrame:
    """Shards of the linked rows: columns rid, g (one of its groups), shard.

    ``members``: rid (a unique long) and g (a group, as a long), one row for each
    group of a row.  Every other round passes over the shards that are
    at their quota, so that a large group goes on to its next best one.  Stops
    after two rounds without a move, or after ``rounds``."""
    shards = len(quota)
    state = cut(
        members.groupBy("rid")
        .agg(F.min("g").alias("g"))
        .withColumn("shard", F.pmod(F.xxhash64("rid"), F.lit(shards)).cast("int"))
    )
    here = [F.sum((F.col("shard") == s).cast("long")).alias(f"n{s}") for s in range(shards)]
    idle = 0
    for nth_round in range(rounds):
        if idle == 2:
            break
        counted = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.count("*").alias("n")).collect()}
        held = [counted.get(s, 0) for s in range(shards)]
        full = {s for s in range(shards) if held[s] >= quota[s]} if nth_round % 2 else set()
        if len(full) == shards:
            idle += 1
            continue
        in_group = cut(members.join(state.select("rid", "shard"), "rid").groupBy("g").agg(*here))
        votes = (
            members.join(in_group, "g")
            .groupBy("rid")
            .agg(*(F.sum(f"n{s}").alias(f"n{s}") for s in range(shards)))
        )
        # the fullest shard, of equal ones the first; a tie with the own shard only towards a smaller one
        choice = [F.struct(F.col(f"n{s}").alias("n"), F.lit(-s).alias("s")) for s in range(shards) if s not in full]
        best = F.sort_array(F.array(*choice), asc=False)[0]
        own = F.get(F.array(*(f"n{s}" for s in range(shards))), F.col("shard"))
        asked = cut(
            state.join(votes, "rid")
            .withColumn("best", best)
            .select("rid", "g", "shard", (-F.col("best.s")).alias("target"), F.col("best.n").alias("n"), own.alias("own"))
            .where((F.col("n") > F.col("own")) | ((F.col("n") == F.col("own")) & (F.col("target") < F.col("shard"))))
            .select(
                "rid",
                (F.col("shard") * shards + F.col("target")).alias("pair"),
                _cell(F.xxhash64("g"), F.xxhash64("rid")).alias("cell"),
            )
        )
        wanted = {divmod(r["pair"], shards): r["n"] for r in asked.groupBy("pair").agg(F.count("*").alias("n")).collect()}
        granted = grant(wanted, held, quota)
        if not sum(granted.values()):
            idle += 1
            continue
        idle = 0
        free = F.get(F.array(*(F.lit(granted.get(divmod(p, shards), 0)) for p in range(shards * shards))), F.col("pair"))
        before = cut(cell_offsets(asked.groupBy("pair", "cell").agg(F.count("*").alias("n")), ["pair"], ["cell"]))
        fits = asked.join(before, ["pair", "cell"]).withColumn("free", free).where(F.col("before") < F.col("free"))
        whole = fits.where(F.col("before") + F.col("n") <= F.col("free")).select("rid", "pair")
        edge = fits.where(F.col("before") + F.col("n") > F.col("free"))
        nth = F.row_number().over(W.partitionBy("pair").orderBy("rid"))  # rows of one cell for each pair of shards
        edge = edge.withColumn("nth", nth).where(F.col("before") + F.col("nth") <= F.col("free")).select("rid", "pair")
        moves = whole.unionByName(edge).select("rid", (F.col("pair") % shards).cast("int").alias("target"))
        state = cut(
            state.join(moves, "rid", "left").select("rid", "g", F.coalesce("target", "shard").cast("int").alias("shard"))
        )
    return state


def fitted(sizes: dict[int, int], room: list[int]) -> tuple[list[tuple], list[tuple]]:
    """Places for ``sizes`` (size -> how many) in the room of the shards, best fit
    decreasing.  The first list has (size, first, end, shard): the units of a size
    numbered from first to end - 1 go there whole.  The second has (size, number,
    first, end, shard): rows of a unit that no shard has room for."""
    room, whole, parts = list(room), [], []
    for size in sorted(sizes, reverse=True):
        nth = 0
        while nth < sizes[size]:
            roomy = [s for s in range(len(room)) if room[s] >= size]
            if roomy:
                to = min(roomy, key=lambda s: (room[s], s))
                n = min(room[to] // size, sizes[size] - nth)
                whole.append((size, nth, nth + n, to))
                room[to] -= n * size
                nth += n
                continue
            at = 0
            for to in sorted(range(len(room)), key=lambda s: (-room[s], s)):
                n = min(room[to], size - at)
                if n > 0:
                    parts.append((size, nth, at, at + n, to))
                    room[to], at = room[to] - n, at + n
            nth += 1
    return whole, parts


def _plan(rows: list[tuple], names: list[str], spark) -> DataFrame:
    """A few rows of longs (at most ``shards`` for each distinct size and split unit) as a broadcast table."""
    schema = "array<struct<" + ",".join(f"{x}:bigint" for x in names) + ">>"
    text = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    return F.broadcast(spark.range(1).select(F.inline(F.from_json(F.lit(text), schema))))


def united(state: DataFrame, members: DataFrame, quota: list[int]) -> DataFrame:
    """``state`` of :func:`propagate` with its split groups put together.

    A unit is a group, or all groups that share rows.  Units that lie in several
    shards, and as many of a shard above its quota as are above it, are taken out
    and placed anew where they fit whole; one that fits nowhere is dealt shard
    after shard.  Groups that share rows and are larger than a quota stay as
    propagation left them."""
    shards, spark = len(quota), state.sparkSession
    rows = state.withColumn("unit", F.col("g")).withColumn("shares", F.lit(False))
    if members.count() > state.count():
        links = members.join(state.select("rid", F.col("g").alias("b")), "rid").where("g <> b")
        roots = components(links.select(F.col("g").alias("a"), "b")).select(F.col("node").alias("g"), "root")
        rows = state.join(roots, "g", "left").select(
            "rid", "g", "shard", F.coalesce("root", "g").alias("unit"), F.col("root").isNotNull().alias("shares")
        )
    rows = cut(rows)
    held = [F.sum((F.col("shard") == s).cast("long")).alias(f"n{s}") for s in range(shards)]
    units = rows.groupBy("unit").agg(
        F.count("*").alias("n"), F.min("shard").alias("lo"), F.max("shard").alias("hi"), F.max("shares").alias("shares"), *held
    )
    moves = (F.col("n") <= min(quota)) | ~F.col("shares")
    cells = F.pmod(F.xxhash64("unit"), F.lit(GROUP_CELLS * MEMBER_CELLS))
    units = cut(units.withColumn("cell", cells).withColumn("out", moves & (F.col("lo") != F.col("hi"))))
    total = [F.coalesce(F.sum(f"n{s}"), F.lit(0)) for s in range(shards)]
    stay = list(units.where("not out").agg(*total).first())
    if any(stay[s] > quota[s] for s in range(shards)):
        # whole units beyond the quota, by cells
        fixed = list(units.where(~moves).agg(*total).first())
        limit = F.get(F.array(*(F.lit(max(quota[s] - fixed[s], 0)) for s in range(shards))), F.col("lo"))
        whole = units.where(moves & ~F.col("out"))
        before = cell_offsets(whole.groupBy("lo", "cell").agg(F.sum("n").alias("n")), ["lo"], ["cell"])
        over = cut(before.where(F.col("before") + F.col("n") > limit).select("lo", "cell", F.lit(True).alias("over")))
        units = units.join(F.broadcast(over), ["lo", "cell"], "left")
        units = cut(units.withColumn("out", F.col("out") | (moves & F.coalesce("over", F.lit(False)))))
        stay = list(units.where("not out").agg(*total).first())
    taken = units.where("out").select(F.col("unit").alias("rid"), F.col("n").alias("size"), "cell")
    sizes = {r["size"]: r["n"] for r in taken.groupBy("size").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return state
    whole, parts = fitted(sizes, [max(quota[s] - stay[s], 0) for s in range(shards)])
    nth = cut(ranked(taken, "size", "nth").select(F.col("rid").alias("unit"), "size", "nth"))
    plan = _plan(whole, ["size", "first", "end", "target"], spark)
    inside = (F.col("nth") >= F.col("first")) & (F.col("nth") < F.col("end"))
    targets = cut(nth.join(plan, "size").where(inside).select("unit", F.col("target").cast("int").alias("target")))
    placed = rows.join(targets, "unit", "left").select("rid", "g", "unit", F.coalesce("target", "shard").alias("shard"))
    if not parts:
        return cut(placed.drop("unit"))
    dealt = _plan(parts, ["size", "nth", "first", "end", "target"], spark)
    dealt = cut(nth.join(dealt, ["size", "nth"]).select("unit", "first", "end", F.col("target").cast("int").alias("target")))
    torn = F.broadcast(dealt.select("unit").distinct())
    some = placed.join(torn, "unit", "left_semi").withColumn("cell", F.pmod(F.xxhash64("rid"), F.lit(GROUP_CELLS * MEMBER_CELLS)))
    row = ranked(cut(some), "unit", "k").join(F.broadcast(dealt), "unit")
    row = row.where((F.col("k") >= F.col("first")) & (F.col("k") < F.col("end"))).select("rid", "g", F.col("target").alias("shard"))
    return cut(placed.join(torn, "unit", "left_anti").drop("unit").unionByName(row))


def shard_documents(
    docs: DataFrame,
    shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    links: DataFrame | None = None,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Put all rows of ``docs`` into ``shards`` shards whose row counts are at most one apart.

    ``links`` (columns ``id_col`` and group, any type, not null) names the groups
    that link documents; without it, equal texts are one group.  A group larger
    than a quota fills shard after shard.  Returns per row: the id, size (UTF-8
    bytes of the text plus 1), text_crc32 (unsigned), law (`rows`), shard, slot
    (from 0 within the shard, gapless) and grown_shard (null under this law).

    A null text has size 1 and crc 0 and no links of its own; repeated rows are
    equal texts; a null id has no ``links``.  An empty table gives an empty
    result.  Other columns are not read."""
    text = F.col(text_col).cast("string")
    key = text_key(text)
    base = cut(
        docs.select(
            F.col(id_col).alias("id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit(""))).cast("long").alias("text_crc32"),
            key["a"].alias("a"),
            key["b"].alias("b"),
            F.monotonically_increasing_id().alias("rid"),
        )
    )
    if links is None:
        group = base.where("a is not null").select("rid", F.xxhash64("a", "b").alias("g"))
    else:
        named = links.select(F.col(id_col).alias("id"), F.xxhash64("group").alias("g")).where("id is not null")
        group = base.select("rid", "id").join(named, "id").select("rid", "g")
    several = cut(group.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g"))
    members = cut(group.join(several, "g").select("rid", "g"))
    quota = quotas(base.count(), shards)
    state = united(propagate(members, quota, rounds), members, quota)
    # linked rows take the first slots of their shard, up to its quota
    placed = cut(ranked(state.withColumn("cell", _cell(F.xxhash64("g"), F.xxhash64("rid"))), "shard", "slot"))
    limit = F.get(F.array(*(F.lit(q) for q in quota)), F.col("shard"))
    placed = placed.where(F.col("slot") < limit).select("rid", "shard", "slot")
    held = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    # all others fill the rest, numbered from 0 over all shards
    rest = base.join(placed.select("rid"), "rid", "left_anti").select(
        "rid",
        F.lit(0).alias("all"),
        F.pmod(F.xxhash64("rid"), F.lit(GROUP_CELLS * MEMBER_CELLS)).alias("cell"),
    )
    numbered = ranked(cut(rest), "all", "number")
    shard, slot, start = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for s in range(shards):
        end = start + quota[s] - held.get(s, 0)
        inside = (F.col("number") >= start) & (F.col("number") < end)
        shard = F.when(inside, F.lit(s)).otherwise(shard)
        slot = F.when(inside, F.col("number") - start + held.get(s, 0)).otherwise(slot)
        start = end
    filled = numbered.select("rid", shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))
    return base.join(placed.unionByName(filled), "rid").select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
