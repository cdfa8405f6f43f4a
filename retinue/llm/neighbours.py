"""Approximate nearest neighbours by a forest of random-projection trees.

The trees are fitted on a bounded sample: each inner node has a random direction and the
sample's median along it. Every vector is put into one leaf of each tree. A query goes
down all trees at once through one priority queue, which holds the nodes not yet opened by
the margins it would have to cross, and ends when it has reached a given number of leaves.
The vectors of these leaves are the candidates; they are ranked by exact inner products,
leaf by leaf, and the best of all leaves are kept.

For inner products, vectors get one more component that gives all of them the same length;
queries get 0 there. The order by distance is then the order by inner product.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retinue.llm.common import written

TREES, DEPTH = 4, 6
#: Leaves that a query reaches, of TREES * 2**DEPTH. Vectors without any structure need
#: this many for a recall of 0.9; clustered ones need far fewer.
VISITS = 96
SAMPLE = 8_192
BLOCK_ROWS, BLOCK_QUERIES = 4_096, 2_000


class Forest:
    """Directions and thresholds of complete binary trees, in heap order."""

    def __init__(self, sample: np.ndarray, trees: int, depth: int, longest: float, seed: int):
        rng = np.random.default_rng(seed)
        self.depth, self.longest, inner = depth, longest, 2**depth - 1
        points = self.lengthened(sample)
        self.directions = rng.normal(size=(trees, inner, points.shape[1]))
        self.thresholds = np.zeros((trees, inner))
        for t in range(trees):
            at = np.zeros(len(points), dtype=np.int64)
            for node in range(inner):
                here = np.nonzero(at == node)[0]
                along = points[here] @ self.directions[t, node]
                self.thresholds[t, node] = np.median(along) if len(here) else 0.0
                at[here] = 2 * node + 1 + (along > self.thresholds[t, node])
        self.directions /= (norms := np.linalg.norm(self.directions, axis=2, keepdims=True))
        self.thresholds /= norms[:, :, 0]

    def lengthened(self, vectors: np.ndarray) -> np.ndarray:
        rest = self.longest**2 - np.einsum("ij,ij->i", vectors, vectors)
        return np.column_stack([vectors, np.sqrt(np.maximum(rest, 0.0))])

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree, numbered through all trees."""
        points, inner = self.lengthened(vectors), self.thresholds.shape[1]
        found = np.empty((len(points), len(self.directions)), dtype=np.int64)
        for t, directions in enumerate(self.directions):
            side = points @ directions.T > self.thresholds[t]
            at = np.zeros(len(points), dtype=np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + side[np.arange(len(points)), at]
            found[:, t] = at - inner + t * (inner + 1)
        return found

    def search(self, query: np.ndarray, visits: int, held: dict[int, int], least: int) -> list[int]:
        """The leaves that one priority queue over all trees reaches first.

        It goes on past ``visits`` until the leaves reached of some tree hold ``least``
        members (``held`` by leaf), which are distinct, or no leaf is left.
        """
        margins = self.directions[:, :, :-1] @ query - self.thresholds
        inner = margins.shape[1]
        queue = [(0.0, t, 0) for t in range(len(margins))]
        reached, members = [], [0] * len(margins)
        while queue and (len(reached) < visits or max(members) < least):
            cost, t, node = heapq.heappop(queue)
            if node >= inner:
                reached.append(node - inner + t * (inner + 1))
                members[t] += held.get(reached[-1], 0)
                continue
            margin = margins[t, node]
            near = 2 * node + 1 + int(margin > 0)
            heapq.heappush(queue, (cost, t, near))
            heapq.heappush(queue, (cost + margin * margin, t, 4 * node + 3 - near))
        return reached


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def nearest(
    vectors: DataFrame,
    every: int = 20,
    k: int = 20,
    trees: int = TREES,
    depth: int = DEPTH,
    visits: int = VISITS,
    sample: int = SAMPLE,
    seed: int = 3,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each query.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but
    those of the query's id. Score is the inner product in double precision, ties go to
    the smaller id. Rows with null id, or a vector that is null, zero, of another length
    than most or has null or non-finite components, take no part. Repeated rows count
    once; an id with several vectors is found by its best. No row, no result; with at most
    ``k`` distinct vectors all candidates are looked at, else leaves that hold more than ``k``
    distinct ones at least. Other columns are not read.

    Equal vectors are one candidate that carries its ``k + 1`` smallest ids, which is all
    that any result can show of it, so a vector with very many copies is no hot leaf.
    """
    value = F.col(embedding)
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    usable = vectors.where(
        F.col(vec_id).isNotNull() & value.isNotNull() & finite & F.exists(value, lambda x: x != 0)
    ).select(F.col(vec_id).cast("long").alias("vec_id"),
             value.cast("array<double>").alias("v")).distinct()
    lengths = usable.groupBy(F.size("v").alias("n")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("n")).first()
    spark = vectors.sparkSession
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    usable = written(usable.where(F.size("v") == common["n"]), "ann-vectors")

    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    classes = written(
        usable.withColumn("nth", nth).where(F.col("nth") <= k + 1)
        .groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "ann-classes")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    n, longest = classes.agg(F.count("*"), F.max(norm)).first()
    picked = classes.select("v").orderBy(F.xxhash64("v", F.lit(seed))).limit(sample).collect()
    forest = spark.sparkContext.broadcast(Forest(
        np.array([r["v"] for r in picked]), trees, depth, longest, seed))
    queries = usable.where(F.col("vec_id") % every == 0)
    leaves = 2**depth
    blocks = max(1, -(-n // (leaves * BLOCK_ROWS)))
    asked = queries.count() * visits
    query_blocks = max(1, -(-asked // (trees * leaves * BLOCK_QUERIES)))

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for t, column in enumerate(forest.value.leaves(_matrix(rows["v"])).T):
                yield rows.assign(leaf=column)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for start in range(0, len(rows), 50):
                part = rows.iloc[start:start + 50]
                reached = [forest.value.search(q, visits, held, least)
                           for q in _matrix(part["v"])]
                yield part.assign(leaf=reached).explode("leaf")

    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    deal = lambda column, n: F.pmod(F.xxhash64(column), F.lit(n)).cast("int")
    members = classes.mapInPandas(index, "v array<double>, ids array<long>, leaf long")
    # A number for each leaf of the forest, trees * leaves at most.
    held = {r["leaf"]: r["count"] for r in members.groupBy("leaf").count().collect()}
    least = min(k + 1, n)
    members = members.withColumn("block", deal("v", blocks)).withColumn(
        "query_block", spread(query_blocks))
    asking = queries.withColumnRenamed("vec_id", "query_id").mapInPandas(
        ask, "query_id long, v array<double>, leaf long")
    asking = asking.withColumn("query_block", deal("query_id", query_blocks)).withColumn(
        "block", spread(blocks))

    def rank(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(members):
            inside, ids = _matrix(members["v"]), members["ids"].to_numpy()
            for start in range(0, len(queries), 256):
                part = queries.iloc[start:start + 256]
                asked = _matrix(part["v"])
                scores = asked @ inside.T
                # Products that differ by rounding alone are all kept until they are exact.
                keep = min(k + 1, scores.shape[1])
                least = np.partition(scores, scores.shape[1] - keep, axis=1)[:, -keep]
                for q, query in enumerate(part["query_id"]):
                    near = np.nonzero(scores[q] >= least[q] - 1e-9 * abs(least[q]))[0]
                    exact = (inside[near] * asked[q]).sum(axis=1)
                    best = sorted((-s, i) for s, c in zip(exact, near) for i in ids[c]
                                  if i != query)
                    found.extend((query, i, -s) for s, i in best[:k])
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    keys = ("leaf", "block", "query_block")
    found = asking.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInPandas(
        rank, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
