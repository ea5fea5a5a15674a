"""Nearest neighbours, the pipeline, and the queries that SQL can express."""

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from baobab.llm import neighbours, quality, toxicity
from baobab.llm.queries import oracle_sql, queries
from pyspark.sql import functions as F
from tests_llm_helpers import brute_components, brute_fingerprint, brute_lines, check_packing, rows

SF = "/root/testdata/sf0.001"


def brute_nearest(ids, vectors, query, k=20):
    scores = vectors @ vectors[query]
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != ids[query]][:k]
    return [(int(ids[i]), float(scores[i])) for i in order]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_neighbours_recall(spark, sf):
    data = pq.read_table(f"{sf}/embeddings.parquet").to_pylist()
    ids, vectors = np.array([r["vec_id"] for r in data]), np.array([r["embedding"] for r in data], dtype=np.float64)
    got = {}
    for r in rows(entry.queries()["op6_neighbours"](spark, sf)):
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    asked = [i for i in range(len(ids)) if ids[i] % 20 == 0]
    assert set(got) == {int(ids[i]) for i in asked}
    hits = 0
    for i in asked:
        want, mine = brute_nearest(ids, vectors, i), got[int(ids[i])]
        assert sorted(mine) == list(range(1, 21))
        assert [mine[r][1] for r in sorted(mine)] == sorted((s for _, s in mine.values()), reverse=True)
        at = {int(v): k for k, v in enumerate(ids)}
        assert all(abs(vectors[i] @ vectors[at[v]] - s) < 1e-12 for v, s in mine.values())
        hits += len({v for v, _ in want} & {v for v, _ in mine.values()})
    assert hits >= 0.9 * 20 * len(asked)


def test_neighbours_edges(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [3.0, -1.0]),
        (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]),
        (9, [1.0, 2.0, 3.0]), (20, []), (40, [-1.0, 0.0]),
    ]
    frame = spark.createDataFrame([(*d, 1, "x") for d in data], "vec_id long, embedding array<double>, leaf int, vec string")
    got = {}
    for r in rows(neighbours.nearest(frame, F.col("vec_id") % 20 == 0, k=20)):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got[0]) == [(1, 3, 3.0), (2, 1, 0.5), (3, 2, 0.5), (4, 40, -1.0)]
    assert sorted(got[40]) == [(1, 1, -0.5), (2, 2, -0.5), (3, 0, -1.0), (4, 3, -3.0)]
    assert set(got) == {0, 40}
    for none in (frame.limit(0), frame.where("vec_id = 5"), frame.where("vec_id = 1")):
        assert neighbours.nearest(none, F.col("vec_id") % 20 == 0).count() == 0


def test_neighbours_large_group_of_copies(spark):
    """A vector that a third of all rows share, over several blocks."""
    random = np.random.default_rng(1)
    data = [(i, ([0.6, 0.8] if i % 3 == 0 else random.normal(size=2).tolist())) for i in range(900)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    before = neighbours.ROW_BLOCK, neighbours.QUERY_BLOCK
    neighbours.ROW_BLOCK, neighbours.QUERY_BLOCK = 64, 8
    try:
        out = rows(neighbours.nearest(frame, F.col("vec_id") % 20 == 0, k=5, recall=1.0))
    finally:
        neighbours.ROW_BLOCK, neighbours.QUERY_BLOCK = before
    ids, vectors = np.arange(900), np.array([v for _, v in data])
    for q in range(0, 900, 20):
        mine = [(r["vec_id"], r["score"]) for r in sorted((r for r in out if r["query_id"] == q), key=lambda r: r["rank"])]
        scores = (vectors * vectors[q]).sum(axis=1)
        want = [i for i in np.lexsort((ids, -scores)) if i != q][:5]
        assert [m[0] for m in mine] == want


def normal(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    made = con.execute(oracle_sql()[name])
    names = [d[0] for d in made.description]
    frame = queries()[name](spark, SF)
    assert sorted(names) == sorted(frame.columns)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    want = sorted((tuple(map(normal, r)) for r in made.fetchall()), key=key)
    assert want == sorted((tuple(normal(r[c]) for c in names) for r in rows(frame)), key=key)


@pytest.mark.parametrize("name", ["op2_quality", "op5_line_dedup", "op7_chat", "op8_sharding"])
def test_native_plans_hold_no_python(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"):
        assert bad not in plan, bad


# the pipeline


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder, sf = tmp_path_factory.mktemp("stages"), "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append((name, docs))
    return out


def test_stages_follow_their_operators(spark, stages):
    of = {name: {r["doc_id"]: r for r in rows(df)} for name, df in stages[:-1]}
    sf = "/root/testdata/sf0.01"
    scores = {r["doc_id"]: r["predicted"] for r in rows(entry.queries()["op10_toxicity"](spark, sf))}
    assert set(of["toxicity"]) == {i for i in of["documents"] if not scores[i]}
    judged = {r["doc_id"]: r["quality"]["kept"] for r in rows(quality.measure(stages[1][1]))}
    assert set(of["quality"]) == {i for i in of["toxicity"] if judged[i]}
    left = brute_lines({i: r["text"] for i, r in of["quality"].items()})
    assert {i: r["text"] for i, r in of["line_dedup"].items()} == left
    assert all(r["n_chars"] == len(r["text"]) for i, r in of["line_dedup"].items() if r["text"] != of["quality"][i]["text"])
    fps = {i: brute_fingerprint(t) for i, t in left.items()}
    near = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    roots = set(brute_components(fps, near).values())
    assert set(of["near_duplicates"]) == roots
    check_packing(rows(stages[-1][1]), [(i, left[i]) for i in roots])
    for name, df in stages[:-1]:
        assert df.columns == stages[0][1].columns, name


def test_pipeline_run_is_its_stages(spark, stages):
    columns = ["doc_id", "piece", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.01").select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages[-1][1].select(*columns).collect()))


def test_stages_on_edges(spark, tmp_path):
    long = " ".join(f"w{i} the x{i} of" for i in range(3000))
    data = [(1, None, "en"), (2, "", None), (3, long, "en"), (3, long, "en"), (4, long, "de"), (None, long, "en"), (None, None, None)]
    data += [(None, long + " and quite another ending of this text", None)] * 2 + [(9, "short text", "en")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, id string, quality int, fp int, n_lines int"
    frame = spark.createDataFrame([(i, t, x, None, None, "i", None, None, None) for i, t, x in data], schema)
    sf = "/root/testdata/sf0.01"
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, sf)
        assert out.columns == frame.columns, name
        assert stage(spark, frame.limit(0), sf).count() == 0, name
        if name == "quality":
            assert all(r["text"] for r in rows(out)) and out.count() >= 5
        if name == "line_dedup":
            assert out.count() == frame.count()
            assert {r["n_lines"] for r in rows(out)} == {None}  # columns of that name keep their values
        if name == "near_duplicates":
            left = rows(out)
            assert sum(r["doc_id"] == 3 for r in left) == 1 and not any(r["doc_id"] == 4 for r in left)
            assert sum(not r["text"] for r in left) == 1
            assert len(left) <= 4
    assert corpus_pipeline.packing_stage(spark, frame, sf).count() >= frame.count()
    assert toxicity.REJECT == 0.7


def test_near_duplicate_stage_loses_no_document_of_a_shared_id(spark):
    """One id on unrelated texts, one of them a copy of a smaller id's."""
    a, b, c = (" ".join(f"{x}{i} the {x}x{i} of" for i in range(200)) for x in "abc")
    data = [(1, a), (7, a), (7, b), (7, b), (8, b), (7, c), (None, c), (None, None), (None, "")]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    left = rows(corpus_pipeline.near_duplicate_stage(spark, frame, ""))
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in left) == sorted([("1", a), ("7", b), ("7", c), ("None", "")])


def test_neighbours_beside_small_leaves(spark):
    """Outliers have leaves of a row each: every query still gets all 20 neighbours."""
    rnd = np.random.default_rng(7)
    near = rnd.normal(size=(3000, 8)) * 0.01 + rnd.normal(size=(4, 8)).repeat(750, axis=0)
    far = rnd.normal(size=(12, 8)) * 1000
    data = [(i, [float(x) for x in v]) for i, v in enumerate(np.concatenate([far, near]))]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    asks = (F.col("vec_id") < 12) | (F.col("vec_id") % 100 == 0)
    got = rows(neighbours.nearest(frame, asks, k=20, recall=0.01))
    n = {}
    for r in got:
        n[r["query_id"]] = n.get(r["query_id"], 0) + 1
    assert set(n.values()) == {20} and len(n) == 12 + 30
