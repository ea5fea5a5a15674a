"""Operator 13: conversation structure repair by Knuth's lightest derivation.

A conversation is legal when its role initials read `(s?(ua)+)?`.  An item
(rows read, state) says how far a repair has come; the state is what its output
so far ends with: nothing, a system, a user or an assistant turn.  Every edit is
a deduction from one item to another whose weight is the item's own (cost,
audit) with the edit's added.  Such functions are superior: they are monotone
and never below what they start from (two audits of one item and cost are never
each other's beginning, as a longer one has paid for what it has more).  So an
agenda that always pops the lightest item finalises it with its lightest
derivation, and ends when the goal items are popped.

Conversations of any length are cut into segments.  The agenda finds, for every
state before and after a segment, the lightest derivation between them;
neighbouring segments are combined pairwise, in as many steps as the logarithm of
their number, and the states chosen on the way are handed down again.  What a
segment is asked depends on its rows' codes alone, so equal ones are solved once
by a worker.  Rows are numbered, compared and joined in Spark by conversation
and place; only the digest of a repaired conversation is one stream, as SHA-256
must be, which holds a batch of its lines at a time.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baobab.llm.common import SPACES, cut, positions

#: Rows that one agenda works on.
SEGMENT = 256
#: What the edits cost, and the initials of the rows that damage takes.
RETYPE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
KINDS, ROLES = 20, {"u": "user", "a": "assistant"}
#: States 0 to 3 (nothing, system, user, assistant last) and what each may be followed by.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
STATES, GOALS = 4, (0, 3)
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


@lru_cache(maxsize=100_000)
def lightest(codes: str, start: int) -> tuple[tuple[int, str] | None, ...]:
    """(cost, audit) of the lightest derivation from (0 rows, ``start``) to each state after all rows.

    ``codes`` has a letter for each row: its initial, x for a role that is none
    of them, in upper case if the text is truncated, or - if it must go."""
    agenda, final = [(0, "", 0, start)], {}
    while agenda:
        cost, audit, at, state = heapq.heappop(agenda)
        if (at, state) in final:
            continue
        final[at, state] = cost, audit
        deduced = [(INSERT, "I", at, to) for initial, to in NEXT[state].items() if initial in ROLES]
        if at < len(codes):
            code = codes[at]
            deduced.append((DELETE, "D", at + 1, state))
            if code != "-":
                fee = TRUNCATED if code.isupper() else 0
                if code.lower() in NEXT[state]:
                    deduced.append((fee, "K", at + 1, NEXT[state][code.lower()]))
                deduced += [(fee + RETYPE, "R", at + 1, to) for initial, to in NEXT[state].items() if initial in ROLES]
        for more, edit, place, to in deduced:
            if (place, to) not in final:
                heapq.heappush(agenda, (cost + more, audit + edit, place, to))
    return tuple(final.get((len(codes), state)) for state in range(STATES))


def edits(codes: str, start: int, audit: str) -> list[tuple[int, str, str | None]]:
    """(place, edit, role that it gives) of every edit but deletions; an insertion
    has the place of the row that it stands before."""
    at, state, out = 0, start, []
    for edit in audit:
        if edit == "K":
            state = NEXT[state][codes[at].lower()]
            out.append((at, edit, None))
        elif edit in "RI":
            initial, state = next((i, to) for i, to in NEXT[state].items() if i in ROLES)
            out.append((at, edit, ROLES[initial]))
        at += edit != "I"
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """Fault injection: rows of conversations c (the id as text) by the CRC-32 of
    `conv_id:turn` modulo 20: 0 is dropped, 1 loses its text, 2 its full stops and
    exclamation and question marks, 3 is repeated, 4 becomes a user's."""
    space = lambda x: F.coalesce(F.col(x).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % KINDS
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = conversations.select(
        space("conv_id").alias("c"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"),
        kind.alias("kind"),
    ).where("kind <> 0")
    copies = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    return rows.select(
        "c", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def _faulty(rows: DataFrame) -> DataFrame:
    """The rows (rid, c, turn) in place, with their first fault, code and initial."""
    trimmed = F.btrim(F.col("text"), F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    small = rows.select(
        "rid", "c", "turn", "role",
        F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")).alias("key"),
        (trimmed == "").alias("is_blank"),
        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("is_cut"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("x")).alias("initial"),
    )
    placed = cut(positions(small, ["c"], [F.col("turn").asc_nulls_first(), F.col("role"), F.col("key")]).drop("role"))
    first = cut(placed.groupBy("c", "key").agg(F.min("pos").alias("first")))
    fault = (
        F.when(F.col("is_blank"), F.lit("blank"))
        .when(F.col("pos") > F.col("first"), F.lit("duplicate"))
        .when(F.col("is_cut"), F.lit("truncated"))
    )
    code = (
        F.when(F.col("fault").isin("blank", "duplicate"), F.lit("-"))
        .when(F.col("fault") == "truncated", F.upper("initial"))
        .otherwise(F.col("initial"))
    )
    seen = placed.join(first, ["c", "key"]).withColumn("fault", fault).withColumn("code", code)
    return cut(seen.select("rid", "c", "turn", "pos", "fault", "code", "initial"))


_WEIGHTS = "array<struct<cost:bigint,audit:string>>"
_WEIGHT_TYPE = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))


def _weight(found: tuple[int, str] | None) -> dict | None:
    return None if found is None else {"cost": found[0], "audit": found[1]}


def _solved(segments: DataFrame) -> DataFrame:
    """Adds w, the lightest (cost, audit) from each state to each (16, row by row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for nth, codes in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                starts = range(STATES if nth else 1)  # a conversation begins with nothing
                found.append([_weight(w) for s in starts for w in lightest(codes, s)] + [None] * STATES * (STATES - len(starts)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, _WEIGHT_TYPE)], names=["c", "seg", "codes", "w"])

    return segments.mapInArrow(run, f"c string, seg bigint, codes string, w {_WEIGHTS}")


def _combined(pairs: DataFrame) -> DataFrame:
    """Of two neighbours l and r (or l alone) the lightest from each state to each, and the states between."""

    def both(left: list, right: list | None) -> tuple[list, list | None]:
        if right is None:
            return left, None
        w, mid = [], []
        for a in range(STATES):
            for b in range(STATES):
                ways = (
                    (x["cost"] + y["cost"], x["audit"] + y["audit"], m)
                    for m in range(STATES)
                    if (x := left[a * STATES + m]) and (y := right[m * STATES + b])
                )
                least = min(ways, default=None)
                w.append(least and {"cost": least[0], "audit": least[1]})
                mid.append(least and least[2])
        return w, mid

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):  # weights of long conversations are long: one at a time
                one = batch.slice(row, 1)
                w, mid = both(one.column(2)[0].as_py(), one.column(3)[0].as_py())
                yield pa.RecordBatch.from_arrays(
                    [one.column(0), one.column(1), pa.array([w], _WEIGHT_TYPE), pa.array([mid], pa.list_(pa.int32()))],
                    names=["c", "seg", "w", "mid"],
                )

    return pairs.mapInArrow(run, f"c string, seg bigint, w {_WEIGHTS}, mid array<int>")


def _paths(solved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lightest derivation of each conversation (c, cost, audit), and the states
    a before and b after each of its segments (c, seg, a, b)."""
    last = solved.agg(F.max("seg")).first()[0] or 0
    levels, now = [], solved.select("c", "seg", "w")
    for _ in range(int(last).bit_length()):
        left = now.where("seg % 2 = 0").select("c", F.shiftright("seg", 1).alias("seg"), F.col("w").alias("l"))
        right = now.where("seg % 2 = 1").select("c", F.shiftright("seg", 1).alias("seg"), F.col("w").alias("r"))
        up = cut(_combined(left.join(right, ["c", "seg"], "left").select("c", "seg", "l", "r")))
        levels.append(up.select("c", "seg", "mid"))
        now = up.select("c", "seg", "w")
    ends = F.array(*(F.struct(F.col("w")[g]["cost"].alias("cost"), F.col("w")[g]["audit"].alias("audit"), F.lit(g).alias("b")) for g in GOALS))
    best = F.array_min(F.filter(ends, lambda x: x["cost"].isNotNull()))
    top = cut(now.select("c", "seg", best.alias("best")).select("c", "seg", "best.*"))
    path = top.select("c", "seg", F.lit(0).alias("a"), "b")
    for level in reversed(levels):
        at = path.join(level, ["c", "seg"])
        mid = F.get("mid", F.col("a") * STATES + F.col("b"))
        halves = F.when(
            F.col("mid").isNotNull(),
            F.array(
                F.struct((F.col("seg") * 2).alias("seg"), F.col("a").alias("a"), mid.alias("b")),
                F.struct((F.col("seg") * 2 + 1).alias("seg"), mid.alias("a"), F.col("b").alias("b")),
            ),
        ).otherwise(F.array(F.struct((F.col("seg") * 2).alias("seg"), F.col("a").alias("a"), F.col("b").alias("b"))))
        path = cut(at.select("c", F.inline(halves)))
    return top.select("c", "cost", "audit"), path


def _edited(segments: DataFrame) -> DataFrame:
    """Lines of the repaired conversations: c, at (two for each row), sub, pos of the row that is kept, role that is new."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [], [])
            for c, seg, codes, a, audit in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                for nth, (place, edit, role) in enumerate(edits(codes, a, audit)):
                    pos = seg * SEGMENT + place
                    line = (c, 2 * pos + (edit != "I"), seg * 2 * SEGMENT + nth, None if edit == "I" else pos, role)
                    for column, value in zip(columns, line, strict=True):
                        column.append(value)
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=["c", "at", "sub", "pos", "new"]
            )

    return segments.mapInArrow(run, "c string, at bigint, sub bigint, pos bigint, new string")


def _digests(lines: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's lines in order, newline-joined: c, sha."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None
        for batch in batches:
            names, digests = [], []
            for c, line in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                if c == current:
                    digest.update(b"\n" + line.as_py())
                    continue
                if current is not None:
                    names.append(current)
                    digests.append(digest.hexdigest())
                current, digest = c, hashlib.sha256(line.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(digests, pa.string())], names=["c", "sha"])
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current]), pa.array([digest.hexdigest()])], names=["c", "sha"])

    ordered = lines.repartition("c").sortWithinPartitions("c", "at", "sub").select("c", "line")
    return ordered.mapInArrow(run, "c string, sha string")


def repaired(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repair conversations: their reports and their lines.

    ``rows``: c (a string, not null), turn (a long or null), role and text (not
    null).  Rows stand by turn, nulls first; of one turn by role and an identity
    of the text, equal rows together.  Reports: c, gaps, blank, duplicate,
    truncated, illegal, cost, audit.  Lines: c, at and sub (their order), line
    (`role:text`).  A role that begins with none of s, u, a, or an empty one, can
    not be kept as it is."""
    rows = cut(rows.select("c", "turn", "role", "text").withColumn("rid", F.monotonically_increasing_id()))
    placed = _faulty(rows)
    faults = [F.sum((F.col("fault") == x).cast("long")).alias(x) for x in ("blank", "duplicate", "truncated")]
    turns = placed.withColumn("fault", F.coalesce("fault", F.lit(""))).groupBy("c", "turn").agg(*faults)
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long")
    facts = turns.groupBy("c").agg(gaps.alias("gaps"), *(F.sum(x).alias(x) for x in ("blank", "duplicate", "truncated")))

    joined = lambda field: F.array_join(F.transform("rows", lambda x: x[field]), "")
    grouped = placed.groupBy("c", F.floor(F.col("pos") / SEGMENT).alias("seg"))
    segments = grouped.agg(F.sort_array(F.collect_list(F.struct("pos", "code", "initial"))).alias("rows"))
    segments = cut(segments.select("c", "seg", joined("code").alias("codes"), joined("initial").alias("initials")))
    # neighbours inside a segment, and the last of one with the first of the next
    before = segments.select("c", (F.col("seg") + 1).alias("seg"), F.right("initials", F.lit(1)).alias("before"))
    chain = F.concat(F.coalesce("before", F.lit("")), F.col("initials"))
    pairs = F.transform(F.sequence(F.lit(1), F.length("chain") - 1), lambda k: F.substring(F.col("chain"), k, F.lit(2)))
    wrong = F.when(F.length("chain") > 1, F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au")))).otherwise(0)
    illegal = segments.join(before, ["c", "seg"], "left").withColumn("chain", chain).groupBy("c").agg(F.sum(wrong).alias("illegal"))

    solved = cut(_solved(segments.select("c", "seg", "codes")))
    top, path = _paths(solved)
    piece = F.get("w", F.col("a") * STATES + F.col("b"))["audit"]
    chosen = solved.join(path, ["c", "seg"]).select("c", "seg", "codes", "a", piece.alias("audit"))
    edited = cut(_edited(chosen))
    kept = edited.where("pos is not null").join(placed.select("c", "pos", "rid"), ["c", "pos"]).select("rid", "c", "at", "sub", "new")
    kept = kept.join(rows.select("rid", "role", "text"), "rid")
    line = F.concat(F.coalesce("new", "role"), F.lit(":"), F.col("text")).alias("line")
    added = edited.where("pos is null").select("c", "at", "sub", F.concat("new", F.lit(":")).alias("line"))
    lines = kept.select("c", "at", "sub", line).unionByName(added)
    return facts.join(illegal, "c").join(top, "c"), lines


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """Damage all conversations and repair them; a row for every conv_id.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost (longs),
    audit, repaired_sha256.  Nulls in any column are one space, so rows without a
    conv_id are one conversation (its conv_id is null) and a null text is blank;
    a null turn stands first and makes no gap.  Repeated rows are duplicates.
    A conversation that damage leaves no rows of has zeros, an empty audit and the
    digest of nothing.  An empty table gives an empty result; other columns are
    not read."""
    every = conversations.select("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("c")).distinct()
    reports, lines = repaired(damaged(conversations))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (
        every.join(reports, "c", "left")
        .join(_digests(lines), "c", "left")
        .select(
            "conv_id",
            *(F.coalesce(x, F.lit(0)).cast("long").alias(x) for x in counts),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("sha", F.lit(EMPTY_SHA256)).alias("repaired_sha256"),
        )
    )


SQL = r"""
WITH RECURSIVE spaced AS (
    SELECT conv_id, coalesce(conv_id::VARCHAR, ' ') AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place
    FROM conversations
), kinds AS (
    SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(place, ''), lambda s: ord(s)::BIGINT)),
                  lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1)))),
                  4294967295::BIGINT) % 20 AS kind
    FROM spaced
), hurt AS (
    SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM kinds, range(2) AS copies(k)
    WHERE kind <> 0 AND (k = 0 OR kind = 3)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i,
           regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body, left(role, 1) AS initial
    FROM hurt
), marked AS (
    SELECT *, CASE WHEN body = '' THEN 'blank' WHEN i > min(i) OVER (PARTITION BY c, role, text) THEN 'duplicate'
                   WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           lag(initial) OVER (PARTITION BY c ORDER BY i) || initial AS pair
    FROM placed
), facts AS (
    SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
           count(*) FILTER (WHERE fault = 'truncated') AS truncated,
           count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
    FROM marked GROUP BY c
), inserted(q, r, fee, letters, lines) AS (
    VALUES ('0', '0', 0, '', ''), ('s', 's', 0, '', ''), ('u', 'u', 0, '', ''), ('a', 'a', 0, '', ''),
           ('0', 'u', 2, 'I', E'\nuser:'), ('s', 'u', 2, 'I', E'\nuser:'), ('a', 'u', 2, 'I', E'\nuser:'),
           ('u', 'a', 2, 'I', E'\nassistant:'), ('0', 'a', 4, 'II', E'\nuser:\nassistant:'),
           ('s', 'a', 4, 'II', E'\nuser:\nassistant:')
), follows(r, t, role) AS (
    VALUES ('0', 's', NULL), ('0', 'u', 'user'), ('s', 'u', 'user'), ('u', 'a', 'assistant'), ('a', 'u', 'user')
), edited AS (
    SELECT m.c, m.i, f.r, f.t, (fault = 'truncated')::INT AS fee, 'K' AS letter, chr(10) || m.role || ':' || text AS line
    FROM marked m JOIN follows f ON f.t = m.initial WHERE fault NOT IN ('blank', 'duplicate')
    UNION ALL
    SELECT m.c, m.i, f.r, f.t, 2 + (fault = 'truncated')::INT, 'R', chr(10) || f.role || ':' || text
    FROM marked m, follows f WHERE f.role IS NOT NULL AND fault NOT IN ('blank', 'duplicate')
    UNION ALL
    SELECT m.c, m.i, q.r, q.r, 3, 'D', '' FROM marked m, (SELECT DISTINCT r FROM follows) q
), items AS (
    SELECT c, 0::BIGINT AS i, '0' AS q, {'cost': 0, 'audit': '', 'text': ''} AS best FROM facts
    UNION ALL
    SELECT t.c, e.i, e.t, min({'cost': t.best.cost + n.fee + e.fee, 'audit': t.best.audit || n.letters || e.letter,
                               'text': t.best.text || n.lines || e.line})
    FROM items t JOIN inserted n ON n.q = t.q JOIN edited e ON e.c = t.c AND e.i = t.i + 1 AND e.r = n.r
    GROUP BY t.c, e.i, e.t
), goals AS (
    SELECT t.c, min({'cost': t.best.cost + n.fee, 'audit': t.best.audit || n.letters, 'text': t.best.text || n.lines}) AS best
    FROM items t JOIN facts f ON f.c = t.c AND f.n = t.i JOIN inserted n ON n.q = t.q AND n.r IN ('0', 'a') GROUP BY t.c
)
SELECT e.conv_id, coalesce(f.gaps, 0)::BIGINT AS gaps, coalesce(f.blank, 0)::BIGINT AS blank,
       coalesce(f.duplicate, 0)::BIGINT AS duplicate, coalesce(f.truncated, 0)::BIGINT AS truncated,
       coalesce(f.illegal, 0)::BIGINT AS illegal, coalesce(g.best.cost, 0)::BIGINT AS cost,
       coalesce(g.best.audit, '') AS audit, sha256(coalesce(substr(g.best.text, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, c FROM spaced) e LEFT JOIN facts f ON f.c = e.c LEFT JOIN goals g ON g.c = e.c
"""
