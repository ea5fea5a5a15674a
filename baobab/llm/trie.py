"""Operator 11: prefix trie of conversations, by a van Emde Boas recursion.

A node of the trie is a distinct sequence of first turns.  Sequences are cut at
half their depth: the cut prefix gets a name, the turns above the cut make the
upper trie, those below it the lower forests, and both are cut at half their
depth again, all of one size in one step.  Blocks of 1, 2, 4, ... turns are
named first, from two halves each; then prefixes are named from the top, at
half the depth, at the quarters, at the eighths, each from the prefix above it
and one block.  So a conversation of n turns takes 2n rows in log(n) steps, and
no step ever holds more of a conversation than two blocks of it.

Totals go up the same cuts: the totals of lower trees are grafted onto the nodes
where their upper trie ends, first within blocks of twice the height each time,
then of whole subtrees, from the half depth to the single levels.  Whatever is
summed at a node is a partial sum, so a first turn that a third of all
conversations share is no burden to one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baobab.llm.common import cut, positions

#: Conversations of one base, first turns that are lent at most.
FAMILY, LENT = 100, 6
#: Ids that are joined into one string before the strings of a node are hashed in order.
CHUNK = 256
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def _name(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def own_turns(conversations: DataFrame) -> DataFrame:
    """Columns c, pos (from 0), name (128-bit identity of role and text) and chars of every turn."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        _name(F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("name"),
        F.length(text).cast("long").alias("chars"),
    )
    placed = positions(turns, ["c"], [F.col("turn").asc_nulls_first(), F.col("role"), F.col("name")])
    return placed.select("c", "pos", "name", "chars")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of the rebuilt conversations (c, pos, name, chars), and all
    conversations with their numbers of turns (c, n)."""
    own = cut(own_turns(conversations))
    sizes = cut(own.groupBy("c").agg(F.count("*").alias("own")))
    lent = (F.crc32(F.col("c").cast("string").cast("binary")) % LENT).alias("h")
    sizes = sizes.select("c", "own", lent, (F.col("c") - F.col("c") % FAMILY).alias("base"))
    bases = sizes.where("c = base").select("base", F.col("own").alias("base_own"))
    sizes = cut(
        sizes.join(bases, "base", "left").select(
            "c", "own", "h", "base", F.least("h", F.coalesce("base_own", F.lit(0))).alias("m")
        )
    )
    heads = own.where((F.col("c") % FAMILY == 0) & (F.col("pos") < LENT - 1)).withColumnRenamed("c", "base")
    first = sizes.select("c", "h", "base").join(heads, "base").where("pos < h").select("c", "pos", "name", "chars")
    rest = own.join(sizes.select("c", "h", "m"), "c").where("pos >= h")
    rest = rest.select("c", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "name", "chars")
    length = (F.col("m") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")
    return cut(first.unionByName(rest)), sizes.select("c", length)


def named_prefixes(turns: DataFrame, convs: DataFrame, levels: int) -> tuple[DataFrame, list[DataFrame]]:
    """Names of all prefixes: columns c, d (turns), name and up (the prefix at the
    cut above), and the same by level.

    Level k has the prefixes whose number of turns is an odd multiple of 2^k;
    their ``up`` is 2^k turns shorter."""
    halves = [turns.select("c", F.col("pos").alias("j"), "name")]
    for _ in range(1, levels):
        last = halves[-1]
        pair = F.shiftright("j", 1)
        left = last.where("j % 2 = 0").select("c", pair.alias("j"), F.col("name").alias("l"))
        right = last.where("j % 2 = 1").select("c", pair.alias("j"), F.col("name").alias("r"))
        halves.append(cut(left.join(right, ["c", "j"]).select("c", "j", _name(F.col("l"), F.col("r")).alias("name"))))
    root = F.unhex(F.md5(F.lit("")))
    known = convs.select("c", F.lit(0).cast("long").alias("d"), root.alias("name"), F.lit(None).cast("binary").alias("up"))
    by_level: list[DataFrame] = [known] * levels
    for k in reversed(range(levels)):
        block = halves[k].where("j % 2 = 0").select("c", F.shiftleft("j", k).alias("d"), F.col("name").alias("block"))
        below = known.select("c", "d", F.col("name").alias("up")).join(block, ["c", "d"])
        name = _name(F.col("up"), F.col("block"))
        by_level[k] = cut(below.select("c", (F.col("d") + (1 << k)).alias("d"), name.alias("name"), "up"))
        known = known.unionByName(by_level[k])
    return known, by_level


def subtree_totals(nodes: DataFrame, by_level: list[DataFrame]) -> DataFrame:
    """Sums of ``leaf`` and ``saved`` over the subtree of every node: name, leaves, total.

    ``nodes``: name, up, d, conv, leaf, saved."""
    levels = len(by_level)
    sums = (F.sum("leaf").alias("more_leaf"), F.sum("saved").alias("more_saved"))
    both = [(F.col(x) + F.coalesce(F.col(f"more_{x}"), F.lit(0))).alias(x) for x in ("leaf", "saved")]
    # block totals: of the 2^k depths from a node on, 2^k being what its own depth is an odd multiple of
    here, blocks = nodes.select("name", "up", "d", "conv", "leaf", "saved"), []
    for k in range(levels):
        odd = F.shiftright("d", k) % 2 == 1
        blocks.append(here.where(odd))
        grafts = here.where(odd).groupBy(F.col("up").alias("name")).agg(*sums)
        here = cut(here.where(~odd).join(grafts, "name", "left").select("name", "up", "d", "conv", *both))
    # whole subtrees: a block and the subtrees that are grafted onto its lower end
    done = here  # the root alone
    for k in reversed(range(levels)):
        ends = done.where("d > 0").select(F.col("conv").alias("c"), (F.col("d") - (1 << k)).alias("d"), "leaf", "saved")
        grafts = ends.join(by_level[k].select("c", "d", "name"), ["c", "d"]).groupBy("name").agg(*sums)
        whole = cut(blocks[k].join(grafts, "name", "left").select("name", "up", "d", "conv", *both))
        done = done.unionByName(whole)
    return done.select("name", F.col("leaf").alias("leaves"), F.col("saved").alias("total"))


def ends_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids c of every name, comma-joined: name, ends_sha256.

    Ids are numbered and joined in chunks wherever they are; a name's chunks are
    then hashed one after the other, as a stream that holds one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None
        for batch in batches:
            names, digests = [], []
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name == current:
                    digest.update(b"," + ids.encode())
                    continue
                if current is not None:
                    names.append(current)
                    digests.append(digest.hexdigest())
                current, digest = name, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(digests, pa.string())], names=["name", "sha"])
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([digest.hexdigest()])], names=["name", "sha"])

    numbered = positions(ends, ["name"], [F.col("c")])
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("c")), lambda x: x.cast("string")), ",")
    chunks = numbered.groupBy("name", F.floor(F.col("pos") / CHUNK).alias("chunk")).agg(ids.alias("ids"))
    ordered = chunks.repartition("name").sortWithinPartitions("name", "chunk").select("name", "ids")
    return ordered.mapInArrow(run, "name binary, sha string").withColumnRenamed("sha", "ends_sha256")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations, a row a node: conv_id (its smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.

    Turns are ordered by turn, null first; turns of the same number by role and
    then by an identity of the text, so repeated rows are turns of their own.  A
    null role or text is empty; rows without a conv_id belong to no conversation
    and are left out.  An empty table gives an empty result.  Other columns are
    not read.  Conversations whose base lends them nothing and that have no turns
    of their own left are members of the root alone."""
    turns, convs = rebuilt(conversations)
    convs = cut(convs)
    deepest = convs.agg(F.max("n")).first()[0] or 0
    prefixes, by_level = named_prefixes(turns, convs, int(deepest).bit_length())
    nodes = cut(
        prefixes.groupBy("name", "d", "up").agg(F.min("c").alias("conv"), F.count("*").alias("n_convs"))
    )
    # the parent is the prefix one turn shorter; the last turn has its place
    parents = prefixes.select("c", F.col("d").alias("pos"), F.col("name").alias("parent"))
    above = nodes.select("name", F.col("conv").alias("c"), (F.col("d") - 1).alias("pos"))
    above = above.join(turns.select("c", "pos", "chars"), ["c", "pos"]).join(parents, ["c", "pos"])
    above = cut(above.select("name", "chars", "parent"))
    children = above.groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    nodes = cut(
        nodes.join(above, "name", "left")
        .join(children, "name", "left")
        .select(
            "name", "up", "d", "conv", "n_convs", "parent",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            F.col("n_children").isNull().cast("long").alias("leaf"),
            ((F.col("n_convs") - 1) * F.coalesce("chars", F.lit(0))).cast("long").alias("saved"),
        )
    )
    totals = cut(subtree_totals(nodes, by_level))
    last = convs.select("c", F.col("n").alias("d")).join(prefixes.select("c", "d", "name"), ["c", "d"])
    digests = cut(ends_digests(last.select("name", "c")))
    top = nodes.select(F.col("name").alias("parent"), F.col("conv").alias("parent_conv_id"))
    return (
        nodes.join(totals, "name")
        .join(digests, "name", "left")
        .join(top, "parent", "left")
        .select(
            F.col("conv").alias("conv_id"),
            F.col("d").cast("long").alias("depth"),
            "parent_conv_id",
            F.col("n_convs").cast("long").alias("n_convs"),
            "n_children",
            F.col("leaves").cast("long").alias("n_leaves"),
            F.col("total").cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
        )
    )


SQL = """
WITH own AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT c, c - c % 100 AS base,
           xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda s: ord(s)::BIGINT)),
               lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1)))),
               4294967295::BIGINT) % 6 AS h
    FROM (SELECT DISTINCT c FROM own)
), turns AS (
    SELECT k.c, o.pos, o.role, o.text FROM convs k JOIN own o ON o.c = k.base AND o.pos < k.h
    UNION ALL
    SELECT o.c, o.pos, o.role, o.text FROM own o JOIN convs k ON k.c = o.c WHERE o.pos >= k.h
), numbered AS (
    SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY pos) AS d FROM turns
), prefixes AS (
    SELECT c, d, length(text) AS chars,
           sha256(string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY c ORDER BY d)) AS name
    FROM numbered
    UNION ALL
    SELECT c, 0, 0, 'root' FROM convs
), steps AS (
    SELECT c, d, chars, name, lag(name) OVER (PARTITION BY c ORDER BY d) AS parent,
           lead(name) OVER (PARTITION BY c ORDER BY d) IS NULL AS is_end
    FROM prefixes
), nodes AS (
    SELECT name, any_value(parent) AS parent, min(c) AS conv_id, any_value(d) AS depth, count(*) AS n_convs,
           (count(*) - 1) * any_value(chars) AS saved,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE is_end), '')) AS ends_sha256
    FROM steps GROUP BY name
), childless AS (
    SELECT n.*, (SELECT count(*) FROM nodes k WHERE k.parent = n.name) AS n_children FROM nodes n
), totals AS (
    -- every node stands once below each node on the path of its smallest member
    SELECT s.name, sum((n.n_children = 0)::BIGINT) AS n_leaves, sum(n.saved) AS saved_tokens
    FROM childless n JOIN steps s ON s.c = n.conv_id AND s.d <= n.depth GROUP BY s.name
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
       t.n_leaves::BIGINT AS n_leaves, t.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM childless n JOIN totals t USING (name) LEFT JOIN nodes p ON p.name = n.parent
"""
