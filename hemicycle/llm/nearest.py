"""Exact top-k by integer inner product with a KD-tree for each shard.

A shard is a few thousand vectors in one tree: median splits along the widest side, tight bounding
boxes, small leaves. The best score that a box can hold bounds its subtree, so a query visits leaves in
the order of their bounds and stops at the first one below its kth score, which it takes along from
shard to shard. Queries travel in blocks; a task holds one block and one shard.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hemicycle.session import stored

SCALE = 256
TOP = 5
EVERY = 50
#: Vectors of a tree, of a leaf, and queries of a block.
SHARD, LEAF, BLOCK = 8192, 256, 512
#: Shards that one task searches one after the other, with the kth scores taken along.
CHAIN = 16
#: Sums of products below this size are exact in double precision.
_EXACT = 2.0**53
#: The score of no vector; all others are greater.
_NONE = -(2**63 - 1)


def quantised(vectors: list) -> np.ndarray:
    """floor(256 x) of each component; shorter vectors are filled up with zeros."""
    width = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    out = np.floor(out * SCALE)
    if not np.isfinite(out).all():
        raise ValueError(f"components times {SCALE} must be finite")
    return out


def _largest(points: np.ndarray) -> float:
    return float(np.abs(points).max()) if points.size else 0.0


def products(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers of any size, as 64-bit integers; an error if one does not fit."""
    if _largest(queries) * _largest(points) * queries.shape[1] < _EXACT:
        return (queries @ points.T).astype(np.int64)
    size = np.abs(queries) @ np.abs(points).T
    # Below 2^62 no sum leaves 64 bits, and a component beyond that has only zeros to meet.
    short = [np.where(np.abs(x) < 2.0**62, x, 0).astype(np.int64) for x in (queries, points)]
    out = short[0] @ short[1].T
    for i, j in zip(*np.nonzero(size >= 2.0**61), strict=True):
        score = sum(int(a) * int(b) for a, b in zip(queries[i], points[j], strict=True))
        if abs(score) >= -_NONE:
            raise ValueError("a score does not fit into 64 bits")
        out[i, j] = score
    return out


class Tree:
    """Points in leaf order, with the boxes of the nodes of each level and which leaves they hold."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF):
        pieces = [np.arange(len(ids))]
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        first_child = None
        while True:
            low = np.array([points[p].min(axis=0) for p in pieces])
            high = np.array([points[p].max(axis=0) for p in pieces])
            self.levels.append((low, high, first_child))
            if max(map(len, pieces)) <= leaf:
                break
            split, parent = [], []
            for number, (p, a, b) in enumerate(zip(pieces, low, high, strict=True)):
                if len(p) <= leaf:
                    split.append(p)
                    parent.append(number)
                    continue
                half = len(p) // 2
                order = p[np.argpartition(points[p, int(np.argmax(b - a))], half)]
                split += [order[:half], order[half:]]
                parent += [number, number]
            pieces, first_child = split, np.array(parent)
        order = np.concatenate(pieces)
        self.ids, self.points = ids[order], points[order]
        self.ends = np.cumsum([0, *map(len, pieces)])

    def bounds(self, queries: np.ndarray, kth: np.ndarray) -> np.ndarray:
        """Best score of any point in each leaf's box; minus infinity below a node that cannot matter."""
        plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
        best = np.full((len(queries), 1), np.inf)
        for low, high, parent in self.levels:
            above = best if parent is None else best[:, parent]
            open_ = np.flatnonzero((above >= kth[:, None]).any(axis=0))
            best = np.full((len(queries), len(low)), -np.inf)
            best[:, open_] = plus @ high[open_].T + minus @ low[open_].T
            best[above < kth[:, None]] = -np.inf
        return best

    def search(self, query_ids: np.ndarray, queries: np.ndarray, scores: np.ndarray, found: np.ndarray) -> None:
        """Improves the best scores and ids of each query, in descending order of score, then by id."""
        top = scores.shape[1]
        if _largest(queries) * _largest(self.points) * queries.shape[1] < _EXACT:
            bounds = self.bounds(queries, scores[:, -1])
        else:  # bounds would be rounded
            bounds = np.full((len(queries), len(self.ends) - 1), np.inf)
        visits = np.argsort(-bounds, axis=1, kind="stable")
        for turn in range(bounds.shape[1]):
            leaf = visits[:, turn]
            bound = bounds[np.arange(len(queries)), leaf]
            # An equal score can still win by its smaller id.
            live = np.flatnonzero((bound >= scores[:, -1]) & (bound > -np.inf))
            if not len(live):
                break
            for number in np.unique(leaf[live]):
                mine = live[leaf[live] == number]
                span = slice(self.ends[number], self.ends[number + 1])
                ids = self.ids[span]
                new = products(queries[mine], self.points[span])
                new[query_ids[mine][:, None] == ids[None, :]] = _NONE
                # Only points at or above the kth score enter the exact order.
                all_scores = np.concatenate([scores[mine], new], axis=1)
                all_ids = np.concatenate([found[mine], np.broadcast_to(ids, new.shape)], axis=1)
                order = np.lexsort((all_ids, -all_scores), axis=1)[:, :top]
                scores[mine] = np.take_along_axis(all_scores, order, axis=1)
                found[mine] = np.take_along_axis(all_ids, order, axis=1)


def _rows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    ids: list[int] = []
    vectors: list = []
    for batch in batches:
        ids += batch.column("vec_id").to_pylist()
        vectors += batch.column("vector").to_pylist()
        while len(ids) >= size:
            yield np.array(ids[:size]), quantised(vectors[:size])
            ids, vectors = ids[size:], vectors[size:]
    if ids:
        yield np.array(ids), quantised(vectors)


def _packed(size: int, trees: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, points in _rows(batches, size):
            value = pickle.dumps(Tree(ids, points) if trees else (ids, points), protocol=5)
            yield pa.RecordBatch.from_arrays([pa.array([value], pa.binary())], ["packed"])

    return run


def _numbered(rows: DataFrame, size: int, trees: bool, label: str) -> DataFrame:
    """Packed blocks with numbers from 0; one row for thousands of vectors."""
    packed = stored(rows.mapInArrow(_packed(size, trees), "packed binary").withColumn("at", F.monotonically_increasing_id()), label)
    numbers = packed.select("at", (F.row_number().over(Window.orderBy("at")) - 1).alias("number"))
    return packed.join(numbers, "at").drop("at")


def _searched(top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, state = None, None

        def give() -> pa.RecordBatch:
            ids, _, scores, found = state
            real = scores > _NONE
            query = np.repeat(ids, real.sum(axis=1))
            return pa.RecordBatch.from_arrays(
                [pa.array(query, pa.int64()), pa.array(found[real], pa.int64()), pa.array(scores[real])],
                ["query_id", "vec_id", "score"],
            )

        for batch in batches:
            for i in range(batch.num_rows):
                key = (batch.column("block")[i].as_py(), batch.column("chain")[i].as_py())
                if key != block:
                    if state:
                        yield give()
                    ids, points = pickle.loads(batch.column("queries")[i].as_py())
                    state = (ids, points, np.full((len(ids), top), _NONE), np.full((len(ids), top), np.iinfo(np.int64).max))
                    block = key
                tree = pickle.loads(batch.column("packed")[i].as_py())
                ids, points, scores, found = state
                width = min(points.shape[1], tree.points.shape[1])
                if width < tree.points.shape[1]:
                    points = np.pad(points, ((0, 0), (0, tree.points.shape[1] - width)))
                elif width < points.shape[1]:
                    points = points[:, :width]
                tree.search(ids, points, scores, found)
        if state:
            yield give()

    return run


def top_scores(vectors: DataFrame, every: int = EVERY, top: int = TOP) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` best other rows of every query row.

    Args: ``vectors`` with ``vec_id`` and ``embedding``; queries are the rows whose id ``every`` divides.
    Rows with a null id, a null vector or a null or non-finite component take no part; an empty vector
    scores 0. A vector shorter than the other counts as filled up with zeros. Rows that repeat an id are
    candidates of their own, none of them of that id's query, which is asked once for each distinct
    vector. Scores are exact for components of any size; one that does not fit into 64 bits is an error.
    An empty table gives an empty table.
    """
    # Fewer rows than a batch usually has: a row here is a whole tree.
    small = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = small.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~bad)
    vectors.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    trees = _numbered(usable, SHARD, True, "nearest_trees")
    asked = usable.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "vector"])
    blocks = _numbered(asked, BLOCK, False, "nearest_queries").withColumnRenamed("packed", "queries").withColumnRenamed("number", "block")
    last = trees.agg(F.max("number").alias("last"))
    pairs = blocks.join(last).withColumn("number", F.explode(F.sequence(F.lit(0), "last"))).join(trees, "number")
    chain = F.floor(F.col("number") / CHAIN).alias("chain")
    dealt = pairs.select("block", chain, "number", "queries", "packed").repartition("block", "chain").sortWithinPartitions("block", "chain", "number")
    found = dealt.select("block", "chain", "queries", "packed").mapInArrow(_searched(top), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
