"""Operator 6: approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample; every row is put into a leaf.  A query
walks the tree best bin first through a priority queue.  How many leaves a query
visits is calibrated: for a stated set of queries the exact neighbours among all
rows are found, and visits are widened until so many of them lie in visited
leaves; a query beside small leaves visits more until it has met enough rows.  Rows meet queries per leaf in blocks of bounded size, so a leaf or a
group of copies of any size is many small products, and only each block's best
rows go on.
"""

from __future__ import annotations

import heapq
import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from baobab.llm.common import bounded_sample, cut

#: Bounds: rows that the tree is fitted on, sample rows of a leaf, queries that calibrate.
FIT_ROWS, LEAF_ROWS, CALIBRATION_QUERIES = 20_000, 64, 256
#: Rows and queries that meet in one product at most.
ROW_BLOCK, QUERY_BLOCK = 8_192, 2_048
BRANCH = 8
log = logging.getLogger(__name__)
#: Recall that visits are widened to; the result is to reach 0.9.
RECALL = 0.96


class Tree:
    """Hierarchical k-means: centres of all nodes, children of inner ones, numbers of leaves."""

    def __init__(self, sample: np.ndarray, branch: int = BRANCH, leaf_rows: int = LEAF_ROWS, rounds: int = 8):
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaf: list[int] = []
        self.leaves = 0
        random = np.random.default_rng(42)
        todo = [(self._node(sample.mean(axis=0) if len(sample) else np.zeros(sample.shape[1])), sample)]
        while todo:
            node, rows = todo.pop()
            parts = self._split(rows, branch, rounds, random) if len(rows) > leaf_rows else []
            if len(parts) < 2:  # small, or all rows are equal
                self.leaf[node] = self.leaves
                self.leaves += 1
                continue
            for part in parts:
                child = self._node(part.mean(axis=0))
                self.children[node].append(child)
                todo.append((child, part))
        self.centres_array = np.array(self.centres)

    def _node(self, centre: np.ndarray) -> int:
        self.centres.append(centre)
        self.children.append([])
        self.leaf.append(-1)
        return len(self.leaf) - 1

    @staticmethod
    def _split(rows: np.ndarray, branch: int, rounds: int, random: np.random.Generator) -> list[np.ndarray]:
        centres = rows[random.choice(len(rows), size=min(branch, len(rows)), replace=False)]
        nearest = np.zeros(len(rows), dtype=np.int64)
        for _ in range(rounds):
            nearest = (2 * rows @ centres.T - (centres**2).sum(axis=1)).argmax(axis=1)
            centres = np.array([rows[nearest == k].mean(axis=0) if (nearest == k).any() else c for k, c in enumerate(centres)])
        return [rows[nearest == k] for k in range(len(centres)) if (nearest == k).any()]

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """Leaf of each row: at every node the nearest child."""
        out = np.zeros(len(rows), dtype=np.int32)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            below = self.children[node]
            if not below:
                out[at] = self.leaf[node]
                continue
            c = self.centres_array[below]
            nearest = (2 * rows[at] @ c.T - (c**2).sum(axis=1)).argmax(axis=1)
            todo += [(child, at[nearest == k]) for k, child in enumerate(below) if (nearest == k).any()]
        return out

    def visits(self, queries: np.ndarray, most: int, sizes: np.ndarray | None = None, rows: int = 0) -> list[list[int]]:
        """For each query its first ``most`` leaves, best bin first, and as many more
        as it takes to meet ``rows`` rows, by the leaves' ``sizes``."""
        scores, out = queries @ self.centres_array.T, []
        for row in scores:
            queue, found, met = [(-row[0], 0)], [], 0
            while queue and (len(found) < most or met < rows):
                _, node = heapq.heappop(queue)
                if self.leaf[node] >= 0:
                    found.append(self.leaf[node])
                    met += 0 if sizes is None else sizes[self.leaf[node]]
                for child in self.children[node]:
                    heapq.heappush(queue, (-row[child], child))
            out.append(found)
        return out


def usable(vector: Column) -> Column:
    """Not null, of finite components, not all of them zero."""
    return (
        vector.isNotNull()
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0)
    )


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Packed vectors of a binary column as rows of doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(-1, dim)


def best(
    queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every query the k rows of largest inner product, ties to the smaller
    id, none with the query's own id; repeated rows once.  Positions of the
    queries and of the rows, and the scores."""
    one = np.arange(len(row_ids))
    if len(np.unique(row_ids)) < len(row_ids):
        one = np.sort(np.unique(np.column_stack([row_ids.view(np.float64), rows]), axis=0, return_index=True)[1])
    ours, names = rows[one], row_ids[one]
    at_query, at_row, scores = [], [], []
    for start in range(0, len(queries), 256):
        product = queries[start : start + 256] @ ours.T
        for i, line in enumerate(product, start):
            line[names == query_ids[i]] = -np.inf
            near = np.arange(len(line))
            if len(line) > k:  # rounding differs with the shape of a product: take what is near the edge as well
                edge = np.partition(line, len(line) - k)[len(line) - k]
                near = np.flatnonzero(line >= edge - 1e-9 * max(1.0, abs(edge)))
            near = one[near[line[near] > -np.inf]]
            exact = (rows[near] * queries[i]).sum(axis=1)
            order = np.lexsort((row_ids[near], -exact))[:k]
            at_query.append(np.full(len(order), i))
            at_row.append(near[order])
            scores.append(exact[order])
    if not at_query:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    return np.concatenate(at_query), np.concatenate(at_row), np.concatenate(scores)


def calibrate(rows: DataFrame, queries: list, tree: Tree, dim: int, k: int, recall: float) -> tuple[int, float]:
    """Leaf visits that reach ``recall`` on the stated queries, and the recall there.

    Their exact neighbours come from a product with every row, task by task;
    ``k`` rows a query and task are all that moves."""
    ids = np.array([r["vec_id"] for r in queries], dtype=np.int64)
    matrix = np.frombuffer(b"".join(bytes(r["vec"]) for r in queries), dtype="<f8").reshape(-1, dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROW_BLOCK):
                part = batch.slice(start, ROW_BLOCK)
                row_ids = part.column(0).to_numpy(zero_copy_only=False)
                q, r, s = best(matrix, ids, _matrix(part.column(1), dim), row_ids, k)
                leaf = part.column(2).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q.astype(np.int32)), pa.array(row_ids[r]), pa.array(s), pa.array(leaf[r])],
                    names=["q", "vec_id", "score", "leaf"],
                )

    found = rows.select("vec_id", "vec", "leaf").mapInArrow(run, "q int, vec_id bigint, score double, leaf int")
    nth = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    exact = found.withColumn("nth", nth).where(F.col("nth") <= k).select("q", "leaf").collect()  # k rows a query
    if not exact:
        return 1, 1.0
    ranks = [{leaf: i for i, leaf in enumerate(order)} for order in tree.visits(matrix, tree.leaves)]
    place = np.array([ranks[r["q"]][r["leaf"]] for r in exact])
    most = 1
    while (place < most).mean() < recall and most < tree.leaves:
        most = min(tree.leaves, most + max(1, most // 8))
    return most, float((place < most).mean())


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    recall: float = RECALL,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest rows of every row where ``is_query`` holds, by largest
    inner product in double precision: query_id, rank (from 1), vec_id, score.

    Candidates are all rows but those of the query's own id, fewer than k give
    all; nearest first, ties to the smaller id.  Rows whose id or vector is null,
    or whose vector is zero, of another length than the most frequent one (of
    equally frequent ones the longest), or holds a null or non-finite component,
    take no part.  Repeated rows (equal id and vector) count once, as queries and
    as candidates.  An empty table gives an empty result.  Other columns are read
    for ``is_query`` alone."""
    spark = vectors.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    whole = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    lengths = whole.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim"))
    common = lengths.first()
    if common is None:
        return spark.createDataFrame([], schema)
    dim = common["dim"]
    whole = whole.where(F.size("v") == dim)
    sample = bounded_sample(whole, FIT_ROWS, common["n"], "vec_id", "v").select("v").toArrow().column("v")
    flat = np.concatenate([c.flatten().to_numpy() for c in sample.chunks])
    tree = Tree(flat.reshape(-1, dim))
    shared = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            packed = [r.tobytes() for r in np.ascontiguousarray(rows, dtype="<f8")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(packed, pa.binary()), pa.array(shared.value.assign(rows)), batch.column(2)],
                names=["vec_id", "vec", "leaf", "asks"],
            )

    placed = cut(whole.mapInArrow(place, "vec_id bigint, vec binary, leaf int, asks boolean"))
    asking = placed.where("asks").select("vec_id", "vec").distinct()
    some = bounded_sample(asking, CALIBRATION_QUERIES, asking.count(), "vec_id", "vec").collect()
    if not some:
        return spark.createDataFrame([], schema)
    visits, reached = calibrate(placed, some, tree, dim, k, recall)
    log.info("%d of %d leaves a query; calibrated recall %.3f", visits, tree.leaves, reached)
    # different ids of each leaf: a query meets more than k of them, so that it has k besides its own
    ids = placed.select("leaf", "vec_id").distinct().groupBy("leaf").agg(F.count("*").alias("n")).collect()
    sizes = np.zeros(tree.leaves, dtype=np.int64)
    for r in ids:
        sizes[r["leaf"]] = r["n"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                orders = shared.value.visits(_matrix(part.column(1), dim), visits, sizes, k + 1)
                row = np.repeat(np.arange(part.num_rows), [len(o) for o in orders])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(orders).astype(np.int32)), *(part.column(c).take(pa.array(row)) for c in (0, 1))],
                    names=["leaf", "query_id", "query"],
                )

    walked = cut(asking.mapInArrow(walk, "leaf int, query_id bigint, query binary"))

    def pieces(counted: DataFrame, block: int) -> Column:
        """Number of blocks per leaf, from at most one row a leaf."""
        n = {r["leaf"]: r["n"] for r in counted.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
        return F.get(F.array(*(F.lit(-(-n.get(leaf, 1) // block)) for leaf in range(tree.leaves))), F.col("leaf"))

    row_blocks, query_blocks = pieces(placed, ROW_BLOCK), pieces(walked, QUERY_BLOCK)
    rows = placed.select(
        "leaf",
        F.pmod(F.xxhash64("vec_id"), row_blocks).cast("int").alias("rb"),
        F.explode(F.sequence(F.lit(0), query_blocks - 1)).alias("qb"),
        "vec_id",
        "vec",
    )
    asked = walked.select(
        "leaf",
        F.explode(F.sequence(F.lit(0), row_blocks - 1)).alias("rb"),
        F.pmod(F.xxhash64("query_id"), query_blocks).cast("int").alias("qb"),
        "query_id",
        "query",
    )

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        row_ids = left.column("vec_id").to_numpy()
        query_ids = right.column("query_id").to_numpy()
        q, r, s = (
            best(_matrix(right.column("query"), dim), query_ids, _matrix(left.column("vec"), dim), row_ids, k)
            if len(row_ids) and len(query_ids)
            else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
        )
        return pa.table(
            {
                "query_id": query_ids[q] if len(q) else pa.array([], pa.int64()),
                "qn": right.column("qn").to_numpy()[q] if len(q) else pa.array([], pa.int64()),
                "vec_id": row_ids[r] if len(q) else pa.array([], pa.int64()),
                "score": s,
            }
        )

    keys = ["leaf", "rb", "qb"]
    found = (
        rows.groupBy(*keys)
        .cogroup(asked.withColumn("qn", F.xxhash64("query")).groupBy(*keys))
        .applyInArrow(meet, "query_id bigint, qn bigint, vec_id bigint, score double")
    )
    nth = F.row_number().over(W.partitionBy("query_id", "qn").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", nth).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
