"""Prefix trie, exact de-duplication, conversation repair and lineage cuts against
plain Python versions, and their edge cases."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from baobab.llm import exact, repair, trie
from baobab.llm.common import cut, positions
from baobab.llm.components import components
from tests_llm_helpers import rows

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def lower_az(text):
    return "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text)


def null_first(x):
    return (x is not None, x or 0)


@pytest.fixture(scope="module")
def talks(spark):
    """Null ids, turns, roles and texts, repeated and tied rows, an empty and a very
    long text, a long conversation, and columns of the operators' own names."""
    data = [
        (100, 0, "system", "Be brief."), (100, 1, "user", "Hi."), (100, 2, "assistant", "Yes."),
        (101, 0, "user", "One?"), (101, 1, "assistant", "Two."), (101, 1, "assistant", "Two."),
        (102, None, "user", "No turn"), (102, 3, None, "no role"), (102, 5, "tool", None), (102, 9, "assistant", ""),
        (103, 0, "user", " \t\n"), (103, 0, "user", "tie b."), (103, 0, "assistant", "tie a."),
        (None, 0, "user", "Nobody's."), (None, None, None, None),
        (205, 0, "", "No role."), (205, 1, "user", "x" * 300_000 + "."), (206, 0, "user", "İ Σ é \U0001f600"),
        *[(300, t, "user" if t % 3 else "assistant", f"t {t // 2}.") for t in range(150)],
        *[(c, t, "user" if t % 2 == 0 else "assistant", f"Same {t}.") for c in range(900, 960) for t in range(7)],
    ]
    clash = "c long, pos long, name string, n int, d int, text2 string, rid int, kind int, seg int, h long, conv long"
    return spark.createDataFrame(
        [x + (None,) * len(clash.split(", ")) for x in data], f"conv_id long, turn long, role string, text string, {clash}"
    )


# 11: prefix trie


def brute_trie(table):
    own = defaultdict(list)
    for r in table:
        if r["conv_id"] is not None:
            own[r["conv_id"]].append((null_first(r["turn"]), r["role"] or "", r["text"] or ""))
    own = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out, totals = [], {}
    for node in sorted(members, key=len, reverse=True):
        below = [totals[k] for k in children[node]]
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        totals[node] = (sum(x[0] for x in below) or 1, saved + sum(x[1] for x in below))
        ends = sorted(c for c in members[node] if built[c] == node)
        out.append((
            min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
            len(children[node]), *totals[node], sha(",".join(map(str, ends))),
        ))
    return sorted(out, key=str)


TRIE = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def test_trie_edges(talks, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 4)  # the ends of a node come in many chunks
    # the turns that tie differ in role, so that their order does not hang on the text
    got = sorted((tuple(r[c] for c in TRIE) for r in rows(trie.prefix_trie(talks))), key=str)
    assert got == brute_trie(rows(talks.select("conv_id", "turn", "role", "text")))
    deepest = max(got, key=lambda r: r[1])
    assert deepest[1] >= 144 and deepest[5] == 1


def test_trie_of_nothing_and_of_turnless(spark, talks):
    assert rows(trie.prefix_trie(talks.limit(0))) == []
    # its only turn is before the cut, and no base lends one
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 0)
    lone = spark.createDataFrame([(c, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    got = rows(trie.prefix_trie(lone))
    assert got == [
        dict(conv_id=c, depth=0, parent_conv_id=None, n_convs=1, n_children=0, n_leaves=1, saved_tokens=0, ends_sha256=sha(str(c)))
    ]


def test_positions_of_a_hot_group(spark):
    data = [(1, i // 50) for i in range(2000)] + [(k, k) for k in range(2, 1000)]
    numbered = rows(positions(spark.createDataFrame(data, "g long, v long").repartition(8), ["g"], [F.col("v")]))
    hot = sorted((r["pos"], r["v"]) for r in numbered if r["g"] == 1)
    assert [p for p, _ in hot] == list(range(2000)) and [v for _, v in hot] == sorted(v for _, v in hot)
    assert all(r["pos"] == 0 for r in numbered if r["g"] != 1) and len(numbered) == 2998


# 12: exact de-duplication

TEXTS = [
    (1, "Same Text"), (2, "same text"), (9, "SAME TEXT"), (3, "same  text"), (4, None), (5, ""), (5, ""), (6, "É"), (7, "é"),
    (8, "İ K"), (10, "i̇ k"), (None, "same TEXT"), (None, "alone"), (None, "ALONE"), (11, "A" * 200_000), (12, "a" * 200_000),
    *[(100 + i, "hot copy") for i in range(40)], *[(200 + i, f"text {i}") for i in range(40)],
]


@pytest.fixture(scope="module")
def texts(spark):
    clash = "h long, rid int, sha string, n int, keep_id string, bucket int, slot int, depth int"
    return spark.createDataFrame([x + (None,) * 8 for x in TEXTS], f"doc_id long, text string, {clash}")


def check_exact(got):
    groups = defaultdict(list)
    for i, t in TEXTS:
        groups[sha(lower_az(t or ""))].append(i)
    by_text = defaultdict(list)
    for r in got:
        by_text[r["text_sha256"]].append(r)
    assert {k: sorted(map(null_first, v)) for k, v in groups.items()} == {
        k: sorted(null_first(r["doc_id"]) for r in v) for k, v in by_text.items()
    }
    for k, found in by_text.items():
        largest = max(groups[k], key=null_first)
        assert all(r["keep_id"] == largest and r["group_size"] == len(groups[k]) for r in found)
        assert [r["doc_id"] for r in found if r["kept"]] == [largest]  # exactly one row


@pytest.mark.parametrize("capacity,hashes,most", [(16_384, None, 1_000_000), (2, 7, 1_000_000), (4, 1, 0)])
def test_exact_duplicates(texts, capacity, hashes, most):
    """Also with few hashes, so that different texts share them, buckets overflow and chains are long."""
    key = F.xxhash64 if hashes is None else lambda c: F.pmod(F.xxhash64(c), F.lit(hashes)) * F.lit(2**60)
    check_exact(rows(exact.exact_duplicates(texts, capacity=capacity, key=key, broadcast_keys=most)))


def test_exact_duplicates_of_nothing(texts):
    assert rows(exact.exact_duplicates(texts.limit(0))) == []


def test_directory_doubles_only_what_is_overfull(spark):
    # three quarters of the keys begin with the same bits
    skewed = F.when(F.col("id") % 4 == 0, F.xxhash64("id")).otherwise(F.shiftrightunsigned(F.xxhash64("id"), 3))
    keys = spark.range(4000).select(skewed.alias("h")).distinct()
    slots, bits = exact.directory(keys, capacity=200)
    found = rows(slots)
    buckets = defaultdict(int)
    for r in found:
        buckets[r["depth"], r["slot"] >> (bits - r["depth"])] += r["n"]
    assert sum(buckets.values()) == keys.count() and len({d for d, _ in buckets}) > 1
    assert all(n <= 200 for (d, _), n in buckets.items() if d < bits)
    # a bucket's sibling is there because both together are more than one holds
    whole = lambda d, p: sum(n for (e, q), n in buckets.items() if e >= d and q >> (e - d) == p)
    assert all(d == 0 or whole(d - 1, p >> 1) > 200 for d, p in buckets)


def test_exact_dedup_is_native(spark):
    plan = exact.exact_duplicates(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# 13: conversation repair


def brute_repair(initials, codes):
    """Least (cost, audit, output) over all edits, by trying them."""
    best = {("", 0): (0, "", ())}
    legal = re.compile("(s?(ua)+)?")
    todo, done = [(0, "", 0, "", ())], []
    limit = 3 * len(codes) + 4
    seen = {}
    while todo:
        cost, audit, at, out, lines = todo.pop()
        key = (at, out[-1:] if out else "", audit)
        if cost > limit or seen.get(key, (limit + 1,)) <= (cost,):
            continue
        seen[key] = (cost,)
        if at == len(codes) and legal.fullmatch(out):
            done.append((cost, audit, lines))
        nexts = {"": "su", "s": "u", "u": "a", "a": "u"}[out[-1:]]
        for x in nexts:
            if x != "s" and audit[-2:] != "II":
                todo.append((cost + 2, audit + "I", at, out + x, (*lines, (None, x))))
        if at < len(codes):
            todo.append((cost + 3, audit + "D", at + 1, out, lines))
            if codes[at] != "-":
                fee = codes[at].isupper()
                if codes[at].lower() in nexts:
                    todo.append((cost + fee, audit + "K", at + 1, out + codes[at].lower(), (*lines, (at, None))))
                for x in nexts:
                    if x != "s":
                        todo.append((cost + fee + 2, audit + "R", at + 1, out + x, (*lines, (at, x))))
    assert best
    return min(done)


def test_lightest_derivations():
    for n in range(5):
        for codes in itertools.product("suaxU-", repeat=n) if n < 4 else random.Random(1).sample(list(itertools.product("suaxUA-", repeat=4)), 300):
            codes = "".join(codes)
            found = min(w for g in repair.GOALS if (w := repair.lightest(codes, 0)[g]))
            want = brute_repair(codes, codes)
            assert found == want[:2], codes
            lines = [(None if e == "I" else at, role) for at, e, role in repair.edits(codes, 0, found[1])]
            assert lines == [(at, repair.ROLES.get(role)) for at, role in want[2]], codes


def brute_reports(table):
    every, by = {}, defaultdict(list)
    for r in table:
        c, turn, role, text = (" " if x is None else x for x in (r["conv_id"], r["turn"], r["role"], r["text"]))
        every[c] = r["conv_id"]
        kind = zlib.crc32(f"{c}:{turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        by[c] += [(r["turn"], "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for c, conv_id in every.items():
        # of one turn by role and digest, as the operator has it
        found = sorted(by[c], key=lambda x: (null_first(x[0]), x[1], hashlib.md5(f"{len(x[1].encode())}:{x[1]}{x[2]}".encode()).hexdigest()))
        seen, faults, codes = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, ""
        for _, role, text in found:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += "-" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
            if fault:
                faults[fault] += 1
        turns = [t for t, _, _ in found if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in found]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit = min(w for g in repair.GOALS if (w := repair.lightest.__wrapped__(codes, 0)[g]))
        lines = [f"{role or found[at][1]}:{'' if e == 'I' else found[at][2]}" for at, e, role in repair.edits(codes, 0, audit)]
        out.append((conv_id, gaps, *faults.values(), illegal, cost, audit, sha("\n".join(lines))))
    return sorted(out, key=str)


REPORT = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


@pytest.mark.parametrize("segment", [256, 3])
def test_repair_edges(talks, monkeypatch, segment):
    monkeypatch.setattr(repair, "SEGMENT", segment)
    got = sorted((tuple(r[c] for c in REPORT) for r in rows(repair.repair_conversations(talks))), key=str)
    assert got == brute_reports(rows(talks.select("conv_id", "turn", "role", "text")))
    assert any(r[0] is None for r in got) and max(r[6] for r in got) > 60


def test_repair_of_nothing(spark, talks):
    assert rows(repair.repair_conversations(talks.limit(0))) == []
    # a conversation whose only row is dropped
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    lone = spark.createDataFrame([(gone, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    (r,) = rows(repair.repair_conversations(lone))
    assert [r[c] for c in REPORT] == [gone, 0, 0, 0, 0, 0, 0, "", sha("")]


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_exact_dedup", "op13_conversation_repair"])
def test_new_queries_match_sql(spark, name):
    import __spark_entry__ as entry

    db = duckdb.connect()
    for t in ("documents", "conversations"):
        db.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    want = db.sql(entry.oracle_sql()[name])
    got = entry.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted((tuple(r) for r in got.select(*want.columns).collect()), key=str) == sorted(want.fetchall(), key=str)


# lineage cuts


def test_cut_knows_its_size_and_keeps_void_columns(spark):
    small = spark.range(100).selectExpr("id", "id % 7 AS g")
    wide = small.join(small.withColumnRenamed("id", "b"), "g").join(small.withColumnRenamed("id", "c"), "g")
    done = cut(wide.withColumn("nothing", F.lit(None)))
    assert done.columns == [*wide.columns, "nothing"] and done.where("nothing is null").count() == wide.count()
    assert int(str(done._jdf.queryExecution().analyzed().stats().sizeInBytes())) < 1_000_000
    assert cut(small.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    n = 3000
    shuffled = random.Random(3).sample(range(n), n)
    links = spark.createDataFrame(list(itertools.pairwise(shuffled)), "a long, b long")
    found = components(links)
    assert found.where("root <> 0").count() == 0 and found.count() == n
    assert int(str(found._jdf.queryExecution().analyzed().stats().sizeInBytes())) < 10**9
