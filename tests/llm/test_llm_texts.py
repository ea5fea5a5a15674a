"""Operators on documents against brute-force versions, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
import public_tokenizers as tokens
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as entry
from baobab.llm import bpe, chat, counts, lines, packing, quality, sharding, simhash, toxicity
from baobab.llm.components import components
from baobab.llm.queries import BYTE_RANKS, WORD_TOKENS
from tests_llm_helpers import brute_components, brute_fingerprint, brute_lines, check_packing, rows

SF = "/root/testdata/sf0.001"
LONG = "the of and thonnt " * 12_000


@pytest.fixture(scope="module")
def docs():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, empty and very long texts, ties, repeated rows, further columns of clashing names."""
    data = [
        (1, None, "en"),
        (2, "", "en"),
        (3, " \t\n\x0b\x0c\r ", None),
        (4, LONG, "en"),
        (5, "one line\nof two\nand three\nand four", "en"),
        (5, "one line\nof two\nand three\nand four", "en"),
        (6, "one line\nof two\nand three\nand four", "de"),
        (None, "one line\nof two\nand three\nand four", None),
        (None, None, None),
        (7, "a a a a a a", "en"),
        (8, "'re it's İ Σ é \x1c \x85 　 <|endoftext|> \U0001f600", ""),
    ]
    clash = "id string, fp string, rid int, n_lines string, quality string, shard int, y int, tk int, word string, n int"
    n = len(clash.split(", "))
    return spark.createDataFrame(
        [(i, t, lang, "s", len(t or "")) + (None,) * n for i, t, lang in data],
        f"doc_id long, text string, lang string, source string, n_chars long, {clash}",
    )


@pytest.fixture(scope="module")
def tik():
    ranks = bpe.replay(BYTE_RANKS, tokens.PATTERN).ranks
    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})


# 1 and 3: byte-level BPE and counts that follow edits


def test_byte_bpe_query(spark, docs, tik):
    got = {r["doc_id"]: r for r in rows(entry.queries()["op3_byte_bpe"](spark, SF))}
    assert len(got) == len(docs)
    for d in docs:
        ids = np.array(tik.encode_ordinary(d["text"]), dtype="<u4")
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(d["text"].encode()).hexdigest()


def test_byte_bpe_edges(spark, edge, tik):
    out = bpe.encode(edge, BYTE_RANKS, tokens.PATTERN)
    by_text = defaultdict(list)
    for r in rows(out):
        by_text[r["decoded_sha256"]].append(r["ids"])
    for r in rows(edge.select("text")):
        t = r["text"] or ""
        assert tik.encode_ordinary(t) in by_text[hashlib.sha256(t.encode()).hexdigest()]
    assert out.count() == edge.count()
    back = bpe.decode(out, BYTE_RANKS, tokens.PATTERN)
    assert Counter(bytes(r["decoded"]) for r in rows(back)) == Counter((r["text"] or "").encode() for r in rows(edge))
    assert bpe.encode(edge.limit(0), BYTE_RANKS, tokens.PATTERN).count() == 0


def test_replay_fuzz(tik):
    coder, rnd = bpe.replay(BYTE_RANKS, tokens.PATTERN), random.Random(3)
    alphabet = [chr(c) for c in [*range(0x250), 0x1680, 0x2003, 0x3000, 0x200B, 0x4E00, 0x1F600, 0x301, 0x660]]
    alphabet += [" "] * 60 + list("'aeiouthn") * 10
    texts = ["".join(rnd.choices(alphabet, k=rnd.randint(0, 60))) for _ in range(1500)] + ["a" * 5000, " " * 999]
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == tik.encode_ordinary(text)


def test_count_tree_follows_edits(tik):
    coder, rnd = bpe.replay(BYTE_RANKS, tokens.PATTERN), random.Random(5)
    letters = list("abc  \n\n'strevmld 12é!.") + ["'re", "  ", " the"]

    def make(n):
        return "".join(rnd.choices(letters, k=n))

    for _ in range(300):
        now = make(rnd.choice([0, 1, 50, 2000]))
        words = coder.find(now)
        coder.learn(set(words))
        tree = counts.CountTree(coder, words)
        for _ in range(4):
            start, length, new = rnd.randint(-2, len(now) + 3), rnd.choice([0, 1, 5, 60]), make(rnd.choice([0, 2, 100]))
            tree.edit(start, length, new)
            a = min(max(start, 0), len(now))
            now = now[:a] + new + now[min(a + length, len(now)) :]
            assert tree.text() == now and sum(tree.leaves, []) == coder.find(now)
            assert tree.total == len(tik.encode_ordinary(now))
        assert tree.again <= len(words) + 800


def test_token_counts_query(spark, docs, tik):
    from pyspark.sql import functions as F

    got = {r["doc_id"]: r for r in rows(entry.queries()["op1_token_counts"](spark, SF))}
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    edits = {
        r["doc_id"]: r["edits"]
        for r in rows(frame.select("doc_id", counts.stand_in_edits(F.col("text"), F.col("doc_id")).alias("edits")))
    }
    for d in docs:
        now = d["text"]
        for e in edits[d["doc_id"]]:
            a = min(e["start"], len(now))
            now = now[:a] + e["replacement"] + now[a + e["length"] :]
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(tik.encode_ordinary(d["text"]))
        assert r["n_tokens_edited"] == len(tik.encode_ordinary(now)) and r["n_edits"] == 3


def test_token_counts_edges(spark, edge):
    from pyspark.sql import functions as F

    kind = "array<struct<start:int,length:int,replacement:string>>"
    some = edge.withColumn("edits", F.expr(f"cast(array(null, named_struct('start', null, 'length', null, 'replacement', null)) as {kind})"))
    out = rows(counts.count_edits(some, BYTE_RANKS, tokens.PATTERN, with_text=True))
    assert len(out) == edge.count() and all(r["n_tokens"] == r["n_tokens_edited"] for r in out)
    none = edge.withColumn("edits", F.lit(None).cast(kind))
    assert all(r["n_edits"] == 0 for r in rows(counts.count_edits(none, BYTE_RANKS, tokens.PATTERN)))
    assert counts.count_edits(none.limit(0), BYTE_RANKS, tokens.PATTERN).count() == 0


# 2: quality


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    with_word = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(with_word) - len(set(with_word)),
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 50 or 100 * len(covered) > 50 * len(words),
    }


def histograms(text, common):
    rest, classes = text or "", []
    for pattern in ("[\x20\x09-\x0d]", "[a-z]", "[A-Z]", "[0-9]"):
        kept = re.sub(pattern, "", rest)
        classes.append(len(rest) - len(kept))
        rest = kept
    letters = sum(c.isalpha() for c in rest)
    marks = sum(c in ".,;:!?'\"()-" for c in rest)
    classes += [letters, marks, len(rest) - letters - marks]
    words = Counter(re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower()))
    of = [words[w] for w in common]
    return np.array(classes, float), np.array(of + [sum(words.values()) - sum(of)], float)


def distance(p, q):
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    part = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m, strict=True) if a > 0)
    return math.sqrt(max((part(p) + part(q)) / 2, 0))


def test_quality_query(spark, docs):
    got = {r["doc_id"]: r for r in rows(entry.queries()["op2_quality"](spark, SF))}
    by_lang = defaultdict(Counter)
    for d in docs:
        by_lang[d["lang"]].update(re.findall(r"[^\x20\x09-\x0D]+", d["text"].lower()))
    common = {k: [w for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[: quality.COMMON]] for k, c in by_lang.items()}
    sums = {k: [np.zeros(7), np.zeros(len(v) + 1)] for k, v in common.items()}
    made = {}
    for d in docs:
        made[d["doc_id"]] = histograms(d["text"], common[d["lang"]])
        for total, own in zip(sums[d["lang"]], made[d["doc_id"]], strict=True):
            total += own
    for d in docs:
        r, want = got[d["doc_id"]], base(d["text"])
        assert {k: r[k] for k in want} == want, d["doc_id"]
        kept = not want["base_failed"]
        if want["n_words"] >= quality.GUARD_WORDS and sum(by_lang[d["lang"]].values()) >= quality.GUARD_REFERENCE_WORDS:
            far = [distance(a, b) for a, b in zip(made[d["doc_id"]], sums[d["lang"]], strict=True)]
            assert abs(far[0] - r["class_distance"]) < 1e-6 and abs(far[1] - r["word_distance"]) < 1e-6  # the query rounds
            kept &= far[0] <= quality.MOST_CLASS_DISTANCE and far[1] <= quality.MOST_WORD_DISTANCE
        else:
            assert r["class_distance"] is None and r["word_distance"] is None
        assert r["kept"] == kept


def test_quality_keeps_clean_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    got = [r for r in rows(entry.queries()["op2_quality"](spark, sf)) if r["doc_id"] in labels and not r["base_failed"]]
    assert all(r["kept"] for r in got if labels[r["doc_id"]] == 1)
    assert not any(r["kept"] for r in got if labels[r["doc_id"]] == 0)


def test_quality_edges(spark, edge):
    out = rows(quality.measure(edge))
    assert len(out) == edge.count() and set(out[0]) == set(edge.columns)
    for r in out:
        want = base(r["text"])
        assert {k: r["quality"][k] for k in want} == want
    assert quality.measure(edge.limit(0)).count() == 0
    assert quality.measure(edge.select("doc_id", "text"), lang_col=None).count() == edge.count()


# 4: SimHash


def test_simhash_query(spark, docs):
    got = {r["doc_id"]: r for r in rows(entry.queries()["op4_simhash"](spark, SF))}
    fps = {d["doc_id"]: brute_fingerprint(d["text"]) for d in docs}
    near = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    want = brute_components(fps, near)
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {
        i: (f"{fps[i]:016x}", want[i]) for i in fps
    }


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_covering_masks_miss_no_pair(radius):
    masks, rnd = simhash.covering_masks(radius), random.Random(radius)
    for _ in range(3000):
        bits = sum(1 << b for b in rnd.sample(range(64), radius))
        assert any(not bits & m for m in masks)
        left = [m for m in masks if not bits & m][0]
        assert any(not bits & m for m in simhash.refine(left, radius))


def test_large_buckets_lose_no_link(spark):
    """Many fingerprints that agree in most bits: buckets are split, pairs are the same."""
    rnd = random.Random(1)
    centre = rnd.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))) for _ in range(250)} | {0, 1, 3}
    signed = [simhash._signed(x) for x in fps]
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    for bucket in (4, 16, 256):
        assert {(r["a"], r["b"]) for r in rows(simhash.covering_links(frame, 2, bucket))} == want


def test_components(spark):
    rnd = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rnd.randint(200, 260), rnd.randint(200, 260)) for _ in range(30)]
    got = {r["node"]: r["root"] for r in rows(components(spark.createDataFrame(links, "a long, b long")))}
    want = brute_components({x for a in links for x in a}, links)
    alone = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    assert got == {k: v for k, v in want.items() if k not in alone}


def test_simhash_edges(spark, edge):
    out = rows(simhash.near_duplicates(edge))
    assert len(out) == edge.count()
    zero = [r for r in out if r["fingerprint"] == "0" * 16]
    assert {r["component_id"] for r in zero} == {1} and len(zero) == 4
    assert sum(r["component_id"] == 5 for r in out) == 4  # 5 twice, 6 and the copy without an id
    assert simhash.near_duplicates(edge.limit(0)).count() == 0


# 5: lines


def test_line_dedup_query(spark, docs):
    got = {r["doc_id"]: r for r in rows(entry.queries()["op5_line_dedup"](spark, SF))}
    want = brute_lines({d["doc_id"]: d["text"] for d in docs})
    assert {i: r["text"] for i, r in got.items()} == want
    assert any(r["n_removed"] for r in got.values())


def test_line_dedup_overlaps(spark):
    texts = {1: "a\n\na\na\na\na\n", 2: "x\ny\nz\nq\n", 3: "y\nz\nq\nw", 4: "x\ny\n z \nq\nw", 5: "a\na", 6: "q\r\nw\r\ne"}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in rows(lines.dedup_lines(frame))} == brute_lines(texts)


def test_line_dedup_edges(spark, edge):
    out = rows(lines.dedup_lines(edge))
    assert len(out) == edge.count()
    of = {r["doc_id"]: r for r in out if r["doc_id"]}
    copies = [r for r in out if r["doc_id"] is None and r["text"] is not None]
    assert copies[0]["n_removed"] == 0  # a null id comes first
    assert [r["text"] for r in out if r["doc_id"] == 5] == ["", ""] and of[6]["text"] == ""
    assert of[1]["text"] is None and of[2]["text"] == "" and of[3]["n_lines"] == 0
    assert lines.dedup_lines(edge.limit(0)).count() == 0


def shuffled_bytes(plan):
    """Bytes that the exchanges of an executed plan wrote, before compression."""
    stages = {"ShuffleQueryStage": "plan", "BroadcastQueryStage": "plan", "ResultQueryStage": "plan"}
    inner = ({"AdaptiveSparkPlan": "executedPlan"} | stages).get(plan.nodeName().split(" ")[0])
    if inner:
        return shuffled_bytes(getattr(plan, inner)())
    own = plan.metrics().apply("dataSize").value() if plan.nodeName() == "Exchange" else 0
    return own + sum(shuffled_bytes(plan.children().apply(i)) for i in range(plan.children().size()))


def test_line_dedup_moves_only_texts_that_lose_lines(spark):
    """Tables too large to broadcast: texts without a repeated window are not shuffled."""
    texts = {i: f"{i} a\n{i} b\n{i} c\n" + f"{i} " * 3_000 for i in range(60)}
    texts |= {60: texts[7] + "\nz", 61: "1 a\n1 b\n1 c", 62: "x\ny\nx\ny\nx\ny", 63: ""}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done = lines.dedup_lines(frame)
        out = rows(done)
        moved = shuffled_bytes(done._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert {r["doc_id"]: r["text"] for r in out} == brute_lines(texts) and len(out) == len(texts)
    assert {r["doc_id"] for r in out if r["n_removed"]} == {60, 61, 62}
    assert len(texts[60]) < moved < sum(map(len, texts.values())) / 5


def test_parted_loses_no_key(spark):
    """Two words of marks for 300 keys: every row is in one part, every key in the first."""
    frame = spark.range(3000).select("id", F.xxhash64("id").alias("h"))
    for n, bits in ((0, 19), (1, 1), (300, 1), (300, 19)):
        keys = frame.where(F.col("id") < n).select("h")
        may, no = ([r["id"] for r in rows(part)] for part in lines.parted(frame, keys, "h", bits))
        assert sorted(may + no) == list(range(3000)) and set(range(n)) <= set(may)
        if bits == 19:
            assert len(may) < n + 10


# 7: chat


def test_chat_parts(spark):
    data = [
        (1, "chosen", 0, "user", "hi"), (1, "rejected", 0, "user", "hi"),
        (1, "chosen", 1, "assistant", "yes <|end|>"), (1, "rejected", 1, "assistant", "no"),
        (1, "chosen", 2, "user", "bye"), (1, "chosen", 2, "user", "bye"),
        (2, "chosen", 0, None, "same"), (2, "rejected", 0, None, "same"),
        (3, "rejected", None, "assistant", None),
        (None, "chosen", 0, "user", "lost"), (4, "else", 0, "user", "lost"),
    ]
    frame = spark.createDataFrame([(*d, "x") for d in data], "pair_id long, side string, turn long, role string, text string, part string")
    made = chat.format_preferences(frame)
    pairs = {r["pair_id"]: r for r in rows(chat.assemble(made))}
    assert set(pairs) == {1, 2, 3}
    assert pairs[1]["prompt"] == "<|user|>\nhi<|end|>\n"
    assert pairs[1]["chosen"] == "<|assistant|>\nyes < |end|><|end|>\n<|user|>\nbye<|end|>\n"
    assert pairs[1]["rejected"] == "<|assistant|>\nno<|end|>\n"
    span = pairs[1]["chosen_spans"][0]
    assert pairs[1]["chosen"][span["start"] : span["start"] + span["length"]] == "yes < |end|><|end|>\n"
    assert pairs[2] | {"pair_id": 2} == {"pair_id": 2, "prompt": "<|user|>\nsame<|end|>\n", "chosen": "", "rejected": "", "chosen_spans": [], "rejected_spans": []}
    assert pairs[3]["rejected"] == "<|assistant|>\n<|end|>\n" and pairs[3]["prompt"] == ""
    assert chat.format_preferences(frame.limit(0)).count() == 0


def test_chat_long_conversation(spark):
    """Offsets over several stretches of turns."""
    data = [(1, s, t, "user", "x" * (t % 7) + ("" if s == "chosen" or t < 900 else "!")) for t in range(1500) for s in ("chosen", "rejected")]
    frame = spark.createDataFrame(data, "pair_id long, side string, turn long, role string, text string")
    for part in ("prompt", "chosen", "rejected"):
        at = 0
        for r in sorted((r for r in rows(chat.format_preferences(frame)) if r["part"] == part), key=lambda r: r["turn"]):
            assert r["start"] == at
            at += len(r["rendered"])


# 8: sharding


def check_shards(out, n):
    sizes = Counter(r["shard"] for r in out)
    assert len(out) == n and max(sizes.values()) - min(sizes.get(s, 0) for s in range(8)) <= 1
    for s in sizes:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sizes[s]))


def test_sharding_query(spark, docs):
    out = rows(entry.queries()["op8_sharding"](spark, SF))
    check_shards(out, len(docs))
    of, texts = {r["doc_id"]: r for r in out}, defaultdict(set)
    for d in docs:
        r = of[d["doc_id"]]
        assert r["size"] == len(d["text"].encode()) + 1 and r["text_crc32"] == zlib.crc32(d["text"].encode())
        assert r["law"] == "rows" and r["grown_shard"] is None
        texts[d["text"]].add(r["shard"])
    assert max(len(s) for s in texts.values()) == 1  # every group is whole


def test_sharding_large_group_and_links(spark):
    data = [(i, "copy" if i % 3 == 0 else f"t{i % 90}" if i % 3 == 1 else f"own {i}") for i in range(900)]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    out = rows(sharding.shard_documents(frame))
    check_shards(out, 900)
    group = Counter(r["shard"] for r in out if r["doc_id"] % 3 == 0)
    assert len(group) <= 5  # 300 copies need three quotas of 113 rows at least; smaller groups hold part of them
    small = defaultdict(set)
    for r in out:
        if r["doc_id"] % 3 == 1:
            small[r["doc_id"] % 90].add(r["shard"])
    assert sum(len(s) == 1 for s in small.values()) >= 25  # of 30
    links = frame.selectExpr("doc_id", "doc_id % 50 as group")
    linked = rows(sharding.shard_documents(frame, links=links))
    check_shards(linked, 900)
    whole = defaultdict(set)
    for r in linked:
        whole[r["doc_id"] % 50].add(r["shard"])
    assert sum(map(len, whole.values())) <= 0.7 * 50 * 7.3  # shards a group; 7.3 by chance, 6.25 groups fit a shard


def test_sharding_splits_no_group_that_has_room(spark):
    """A third of the rows in one group and 720 pairs; then pairs alone, without any other row."""
    for hot, pairs, own in ((800, 720, 160), (0, 720, 0)):
        texts = ["copy"] * hot + [f"t{i // 2}" for i in range(2 * pairs)] + [f"own {i}" for i in range(own)]
        frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        out = rows(sharding.shard_documents(frame, rounds=2))
        check_shards(out, len(texts))
        of = defaultdict(set)
        for r in out:
            of[texts[r["doc_id"]]].add(r["shard"])
        assert not [t for t, s in of.items() if t != "copy" and len(s) > 1]


def brute_propagation(shard, groups, cells, quota, rounds):
    """Label propagation, row by row.  shard: row -> its first shard; groups: group -> rows."""
    shard, idle, n = dict(shard), 0, len(quota)
    of = defaultdict(list)
    for g, members in groups.items():
        for r in members:
            of[r].append(g)
    for nth_round in range(rounds):
        if idle == 2:
            break
        held = [sum(s == k for s in shard.values()) for k in range(n)]
        free = [k for k in range(n) if nth_round % 2 == 0 or held[k] < quota[k]]
        inside = {g: Counter(shard[r] for r in members) for g, members in groups.items()}
        asked = defaultdict(list)
        for r, own in shard.items():
            votes = sum((inside[g] for g in of[r]), Counter())
            best = min(free, key=lambda k: (-votes[k], k), default=own)
            if (votes[best], -best) > (votes[own], -own):
                asked[own, best].append(r)
        granted = sharding.grant({pair: len(x) for pair, x in asked.items()}, held, quota)
        idle = 0 if sum(granted.values()) else idle + 1
        for pair, x in asked.items():
            for r in sorted(x, key=lambda r: (cells[r], r))[: granted[pair]]:
                shard[r] = pair[1]
    return shard


def cut_links(shard, groups):
    """Members of a group that are not in the shard that holds most of it."""
    return sum(len(x) - max(Counter(shard[r] for r in x).values()) for x in groups.values())


def test_propagation_equals_plain_rounds_and_cuts_fewer_links(spark):
    """Overlapping groups: a row in one of 40, a third of them in a neighbouring one too."""
    rnd = random.Random(8)
    pairs = {(i, i % 40) for i in range(600)} | {(i, (i + 1) % 40) for i in range(600) if rnd.random() < 0.3}
    groups = defaultdict(list)
    for r, g in sorted(pairs):
        groups[g].append(r)
    members = spark.createDataFrame(sorted(pairs), "rid long, g long")
    quota = sharding.quotas(640, 8)
    start = members.groupBy("rid").agg(F.min("g").alias("g")).select(
        "rid",
        F.pmod(F.xxhash64("rid"), F.lit(8)).alias("shard"),
        sharding._cell(F.xxhash64("g"), F.xxhash64("rid")).alias("cell"),
    )
    start = start.collect()
    first = {r["rid"]: r["shard"] for r in start}
    state = sharding.propagate(members, quota, rounds=5)
    got = {r["rid"]: r["shard"] for r in state.collect()}
    assert got == brute_propagation(first, groups, {r["rid"]: r["cell"] for r in start}, quota, 5)
    assert max(Counter(got.values()).values()) <= max(quota)
    # all groups hang together and are larger than a quota, so what follows leaves them to propagation
    after = {r["rid"]: r["shard"] for r in sharding.united(state, members, quota).collect()}
    hashed, moved = cut_links(first, groups), cut_links(got, groups)
    assert moved <= 0.7 * hashed and cut_links(after, groups) == moved, (hashed, moved)


def test_granted_flows_keep_quotas():
    rnd = random.Random(1)
    for _ in range(500):
        quota = [rnd.randint(0, 20) for _ in range(4)]
        held = [rnd.randint(0, q) for q in quota]
        asked = {(a, b): rnd.randint(0, max(held[a] // 3, 0)) for a in range(4) for b in range(4) if a != b}
        flow = sharding.grant(asked, held, quota)
        assert all(0 <= flow[p] <= asked[p] for p in asked)
        for s in range(4):
            after = held[s] + sum(n for (_, t), n in flow.items() if t == s) - sum(n for (f, _), n in flow.items() if f == s)
            assert 0 <= after <= quota[s]
    assert sharding.grant({(0, 1): 5, (1, 0): 5}, [9, 9], [9, 9]) == {(0, 1): 5, (1, 0): 5}


def test_sharding_edges(spark, edge):
    out = rows(sharding.shard_documents(edge))
    check_shards(out, edge.count())
    assert {(r["size"], r["text_crc32"]) for r in out if r["doc_id"] == 1} == {(1, 0)}
    assert sharding.shard_documents(edge.limit(0)).count() == 0


# 9: packing


def brute_best_fit(lengths, capacity):
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, x in enumerate(left) if x >= n]
        if fits:
            left[min(fits, key=lambda i: left[i])] -= n
        else:
            left.append(capacity - n)
    return sorted(left)


def test_packing_query(spark, docs):
    out = rows(entry.queries()["op9_packing"](spark, SF))
    bins = check_packing(out, [(d["doc_id"], d["text"]) for d in docs])
    want = brute_best_fit([r["length"] for r in out], 2048)
    assert sorted(2048 - sum(n for _, n in b) for b in bins.values()) == want


def test_runs_are_best_fit():
    rnd = random.Random(4)
    for _ in range(200):
        capacity = rnd.choice([7, 16, 64, 100])
        lengths = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 120))]
        runs = packing.best_fit_runs(dict(Counter(lengths)), capacity)
        left = Counter()
        for length, n in Counter(lengths).items():
            mine = sorted(r for r in runs if r[0] == length)
            for nth in range(n):
                _, first, at, _, per = [r for r in mine if r[1] <= nth][-1]
                left[at + (nth - first) // per] += length
        assert sorted(capacity - x for x in left.values()) == brute_best_fit(lengths, capacity)


def test_packing_edges(spark, edge):
    out = rows(packing.pack(edge, WORD_TOKENS, with_ids=True))
    check_packing(out, [(r["doc_id"], r["text"]) for r in rows(edge)])
    assert all(len(r["ids"]) == r["length"] for r in out)
    assert packing.pack(edge.limit(0), WORD_TOKENS).count() == 0


def test_word_tokens_fuzz():
    coder, rnd = packing.word_tokens(WORD_TOKENS), random.Random(1)
    alphabet = [chr(c) for c in [*range(0x250), 0x1680, 0x2003, 0x3000, 0x200B, 0x4E00, 0x301, 0x3A3, 0x130, 0x212A]]
    alphabet += [" "] * 60 + list("'aeiouthn.,Σ") * 10
    texts = ["".join(rnd.choices(alphabet, k=rnd.randint(0, 60))) for _ in range(2500)]
    assert [coder.direct(t) for t in texts] == coder.encode(texts)


# 10: toxicity


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    out = {r["doc_id"]: r for r in rows(entry.queries()["op10_toxicity"](spark, sf))}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in out.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in out.values())
    held = [i for i in labels if out[i]["held_out"]]
    order = sorted(held, key=lambda i: out[i]["score"])
    toxic = sum(labels[i] for i in held)
    auc = (sum(k for k, i in enumerate(order) if labels[i]) - toxic * (toxic - 1) / 2) / (toxic * (len(held) - toxic))
    hits = [labels[i] for i in held if out[i]["predicted"]]
    assert auc > 0.93 and sum(hits) / len(hits) > 0.9 and sum(hits) / toxic > 0.55


def test_toxicity_edges(spark, edge):
    from pyspark.sql import functions as F

    sf = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scorer = toxicity.learn(sf, labels)
    out = rows(edge.select("doc_id", toxicity.score(F.col("text"), scorer, spark).alias("s")))
    assert len(out) == edge.count() and all(0 <= r["s"] <= 1 for r in out)
    nothing = toxicity.learn(edge.limit(0), labels)
    assert {r["s"] for r in rows(edge.select(toxicity.score(F.col("text"), nothing, spark).alias("s")))} == {0.0}
    assert toxicity.learn(edge, labels.limit(0)).model is None


def test_no_label_of_the_held_out_fold_is_learnt(spark):
    """Turning all labels of that fold around changes no score."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.withColumn(
        "toxic", F.when(toxicity.fold(F.col("doc_id")) == toxicity.HELD_OUT, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    a, b = (toxicity.learn(docs, x) for x in (labels, turned))
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias
    assert all(np.array_equal(a.model.t[k], b.model.t[k]) for k in a.model.t)


def test_toxicity_counts_are_exact_at_any_vocabulary(spark):
    """Toxic words keep their scores beside 400,000 ordinary words of another script (3 million n-grams)."""
    base = [(f"vrek{a}{b}ust", 20, 0) for a in "abcd" for b in "efgh"] + [(f"lomi{a}{b}nar", 0, 20) for a in "abcd" for b in "efgh"]
    schema = "word string, n_toxic long, n_ordinary long"
    few = spark.createDataFrame(base, schema)
    many = spark.range(400_000, numPartitions=8).selectExpr(
        "translate(substr(hex(xxhash64(id)), 1, 12), '0123456789ABCDEF', 'абвгдежзийклмноп') as word",
        "0L as n_toxic", "20L as n_ordinary",
    )
    words = [w for w, toxic, _ in base if toxic]
    alone, among = (toxicity.fit_model(x).word_scores(words) for x in (few, few.unionByName(many)))
    assert alone.min() > 8 and among.min() > 0.95 * alone.min()


def test_toxicity_counts_every_labelled_row(spark):
    """A word that only rows of the fitted quarter have is in the counts that score."""
    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 3 != toxicity.HELD_OUT]
    fits = {i for i in ids if zlib.crc32(str(i).encode()) // 3 % 4 == 0}
    data = [(i, f"{'vrekust' if i % 2 else 'lominar'} {'zzqx' if i % 2 and i in fits else 'and'}", i % 2) for i in ids]
    docs = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    scorer = toxicity.learn(docs, docs.select("doc_id", "toxic"))
    assert scorer.model.word_scores(["zzqx"])[0] > 2
    everywhere = sum(t for _, _, t in data)
    keys, counts = scorer.model.t["top_gram"], scorer.model.t["toxic"]
    gram = toxicity.Grams(["vrekust"]).gram(toxicity.ORDER, np.array([8]))
    assert counts[np.searchsorted(keys, gram)[0]] == everywhere


def brute_kneser_ney(words, order=toxicity.ORDER, discount=toxicity.DISCOUNT):
    """Plain dictionaries: words are (word, toxic, ordinary)."""
    top, total, kinds = (Counter(), Counter()), (Counter(), Counter()), (Counter(), Counter())
    grams = defaultdict(Counter)
    for word, *n in words:
        marked = f"\x02{word}\x03"
        for end in range(2, len(marked) + 1):
            for k in range(1, min(end, order) + 1):
                gram = marked[end - k : end]
                grams[k][gram] += 1
                if k == order or k == end:
                    for c in (0, 1):
                        top[c][gram] += n[c]
    for c in (0, 1):
        for gram, n in top[c].items():
            total[c][gram[:-1]] += n
            kinds[c][gram[:-1]] += n > 0
    follows = Counter(gram[1:] for k in grams if k > 1 for gram in grams[k])
    shared = {g: n for k in grams if k < order for g in grams[k] if (n := follows[g])}
    shared_total, shared_kinds = Counter(), Counter()
    for g, n in shared.items():
        shared_total[g[:-1]] += n
        shared_kinds[g[:-1]] += 1

    def one(n, all_of, many, back):
        return min(max(n - discount, 0) / all_of, 1) + min(discount * many / all_of, 1) * back if all_of else back

    def ratio(word):
        marked, out = f"\x02{word}\x03", 0.0
        for end in range(2, len(marked) + 1):
            p = 1 / 256
            for k in range(1, min(end - 1, order - 1) + 1):
                g = marked[end - k : end]
                p = one(shared.get(g, 0), shared_total[g[:-1]], shared_kinds[g[:-1]], p)
            g = marked[end - min(end, order) : end]
            a, b = (one(top[c][g], total[c][g[:-1]], kinds[c][g[:-1]], p) + 1e-30 for c in (0, 1))
            out += math.log(a) - math.log(b)
        return out

    return ratio


def test_toxicity_models_are_kneser_ney(spark):
    rnd = random.Random(5)
    pool = ["".join(rnd.choices("abcé", k=rnd.randint(1, 9))) for _ in range(300)]
    words = [(w, rnd.choice([0, 0, 1, 7]), rnd.choice([0, 2, 9])) for w in sorted(set(pool))]
    words = [x for x in words if x[1] + x[2]]
    model = toxicity.fit_model(spark.createDataFrame(words, "word string, n_toxic long, n_ordinary long"))
    asked = [w for w, *_ in words] + ["abab", "zzz", "", "aéz", "abcabcabcabcabc"]
    ratio = brute_kneser_ney(words)
    assert np.allclose(model.word_scores(asked), [ratio(w) for w in asked], rtol=1e-4, atol=1e-4)


def test_toxicity_joined_models_score_alike(spark, edge):
    """Models that are too large to be broadcast: the same scores by joins."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = docs.unionByName(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").where("doc_id >= 200"))
    near, far = toxicity.learn(docs, labels), toxicity.learn(docs, labels, broadcast_grams=0)
    assert not isinstance(far.model, toxicity.Model) and np.allclose(near.weights, far.weights) and np.isclose(near.bias, far.bias)
    texts = edge.unionByName(docs.where("doc_id < 40"), allowMissingColumns=True)
    a, b = (sorted((str(r["doc_id"]), str(r["text"]), r["s"]) for r in rows(toxicity.scored(texts, x, out="s"))) for x in (near, far))
    assert [x[:2] for x in a] == [x[:2] for x in b] and np.allclose([x[2] for x in a], [x[2] for x in b], atol=1e-9)


def test_toxicity_rare_class(spark):
    """One toxic row in 400, more rows than the fit takes: both classes are in the sample, and keep their rates."""
    ids = [i for i in range(60_000) if zlib.crc32(str(i).encode()) % 3 != toxicity.HELD_OUT]
    data = [(i, f"{'vrekust' if i % 400 == 0 else 'lominar'} and the {i % 50}", int(i % 400 == 0)) for i in ids]
    docs = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    scorer = toxicity.learn(docs, docs.select("doc_id", "toxic"), fit_rows=400)
    got = rows(toxicity.scored(docs.where("doc_id % 400 = 0 or doc_id % 97 = 1"), scorer))
    assert all((r["score"] >= toxicity.REJECT) == bool(r["toxic"]) for r in got)
