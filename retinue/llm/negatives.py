"""Hard negatives by lists that the anchors of a cluster share, walked until certified.

Candidates are put into blocks of similar direction, anchors into clusters likewise. For a
cluster, no inner product of a member u with a candidate c exceeds
``|u| |c| cos(max(0, angle(centre, c) - radius))``, where the radius is the widest angle between
a member and the centre. Sorted by that bound, the candidates are one list for all members,
block after block and candidate after candidate; each member walks it until the bound shows
that nothing better can follow. Members first look for their positives, which fix the range
of scores of their negatives, then walk for these.

Blocks are visited in rounds, more of them in each; a cluster stops asking when all its
members are certified. What travels are packed clusters and packed blocks, and between
rounds only the best found so far.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retinue.llm.common import written

#: Vectors on which the centres are fitted, and the most centres there are.
SAMPLE, CENTRES = 8_192, 1_024
#: Vectors of a block that there should be, and the most in one of its parts.
BLOCK_ROWS, PART_ROWS = 2_048, 16_384
#: Anchors walking together, and clusters that one copy of a block serves at once.
CLUSTER_ROWS, TURN = 512, 64
#: Blocks visited in a member's first round, and how much more in each that follows.
FIRST_BLOCKS, GROWTH = 4, 8
#: Candidates of a list that are looked at together.
STEP = 512
#: Lanes in which the finds of a round are merged before they meet.
LANES = 16
#: Longer quantised vectors take no part, so that no percentage of a product leaves the
#: range of a long.
LONGEST = 2.0**27

ENTRY = np.dtype([("member", "<i4"), ("place", "<i4"), ("score", "<i8"), ("id", "<i8")])


def _unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=np.zeros(vectors.shape), where=norms > 0)


def _angles(units: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ centre, -1.0, 1.0))


def fitted_centres(sample: np.ndarray, count: int, seed: int, rounds: int = 8) -> np.ndarray:
    """Directions that spread over a sample, by a few rounds of spherical k-means."""
    points = _unit(sample)
    points = points[np.linalg.norm(points, axis=1) > 0]
    if not len(points):
        return np.eye(1, sample.shape[1])
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(count, len(points)), replace=False)]
    for _ in range(rounds):
        nearest = (points @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        centres = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 0, _unit(sums), centres)
    return centres


@dataclass
class Blocks:
    """What bounds a block: its centre, its widest angle, its least and greatest norm."""

    number: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    least: np.ndarray
    most: np.ndarray
    parts: np.ndarray

    def bounds(self, centre: np.ndarray, radius: float) -> np.ndarray:
        """The most that a unit member of a cluster can score in each block."""
        angle = _angles(self.centre, centre) - self.radius - radius
        cosine = np.cos(np.clip(angle, 0.0, np.pi))
        return np.where(cosine >= 0, cosine * self.most, cosine * self.least)


def _raised(bound: np.ndarray | float) -> np.ndarray | float:
    """A bound with room for rounding."""
    return bound + np.abs(bound) * 1e-9 + 1e-6


def best(entries: np.ndarray, keep: int) -> np.ndarray:
    """The ``keep`` highest scores of each member and place, ties to the smaller id."""
    entries = entries[np.lexsort((entries["id"], -entries["score"], entries["place"],
                                  entries["member"]))]
    same = np.zeros(len(entries), dtype=bool)
    same[1:] = ((entries["member"][1:] == entries["member"][:-1])
                & (entries["place"][1:] == entries["place"][:-1]))
    at = np.arange(len(entries))
    rank = at - np.maximum.accumulate(np.where(same, 0, at))
    return entries[rank < keep]


@dataclass
class Cluster:
    """Anchors of one cluster and what they have found."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    centre: np.ndarray
    radius: float
    positives: int
    negatives: int
    share: tuple[int, int]
    finding: int = 0  # 0 positives, 1 negatives, 2 done
    visited: int = 0
    step: int = FIRST_BLOCKS
    found: list[np.ndarray] = field(default_factory=lambda: [np.empty(0, ENTRY) for _ in (0, 1)])

    def ranges(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which places of members have a positive, and the scores its negatives may have."""
        shape = len(self.ids), self.positives
        used, low, high = np.zeros(shape, bool), np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        p = self.found[0]
        # Found positives are in order, the place being the rank.
        used[p["member"], p["place"]] = True
        low[p["member"], p["place"]] = -(-self.share[0] * p["score"] // 100)
        high[p["member"], p["place"]] = self.share[1] * p["score"] // 100
        return used & (low <= high), low, high

    def needed(self) -> np.ndarray:
        """The least score that still matters to each member; infinite for none."""
        entries, m = self.found[self.finding], len(self.ids)
        if self.finding == 0:
            counts = np.bincount(entries["member"], minlength=m)
            least = np.full(m, np.inf)
            np.minimum.at(least, entries["member"], entries["score"].astype(float))
            return np.where(counts >= self.positives, least, -np.inf)
        used, low, _ = self.ranges()
        counts, least = np.zeros(used.shape, int), np.full(used.shape, np.inf)
        np.add.at(counts, (entries["member"], entries["place"]), 1)
        np.minimum.at(least, (entries["member"], entries["place"]), entries["score"].astype(float))
        need = np.where(counts >= self.negatives, np.maximum(least, low), low.astype(float))
        return np.where(used, need, np.inf).min(axis=1, initial=np.inf)

    def open_members(self, bound: float) -> np.ndarray:
        """Members to whom a unit score of at most ``bound`` can still matter."""
        return _raised(np.linalg.norm(self.vectors, axis=1) * bound) >= self.needed()

    def walk(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        """Look through a block's candidates in the order of the cluster's bound."""
        norms = np.linalg.norm(vectors, axis=1)
        angles = _angles(_unit(vectors), self.centre) - self.radius
        bounds = _raised(norms * np.cos(np.clip(angles, 0.0, np.pi)))
        order = np.lexsort((ids, -bounds))
        exact = np.linalg.norm(self.vectors, axis=1).max() * norms.max(initial=0) < 2.0**52
        kind = np.float64 if exact else np.int64
        members, limit = self.vectors.astype(kind), self.ranges()
        for start in range(0, len(order), STEP):
            here = order[start:start + STEP]
            open_ = np.nonzero(self.open_members(bounds[here[0]]))[0]
            if not len(open_):
                return
            scores = (members[open_] @ vectors[here].astype(kind).T).astype(np.int64)
            same = self.labels[open_][:, None] == labels[here][None, :]
            need = np.clip(self.needed()[open_], -2.0**62, 2.0**62)
            wanted = scores >= (need - np.abs(need) * 1e-15)[:, None]
            if self.finding == 0:
                u, c = np.nonzero(wanted & same & (self.ids[open_][:, None] != ids[here][None, :]))
                self._add(open_[u], np.zeros(len(u), int), scores[u, c], ids[here][c])
                continue
            u, c = np.nonzero(wanted & ~same)
            used, low, high = (x[open_][u] for x in limit)
            inside = used & (low <= scores[u, c][:, None]) & (scores[u, c][:, None] <= high)
            e, place = np.nonzero(inside)
            self._add(open_[u[e]], place, scores[u[e], c[e]], ids[here][c[e]])

    def _add(self, member, place, score, id_) -> None:
        made = np.empty(len(member), ENTRY)
        made["member"], made["place"], made["score"], made["id"] = member, place, score, id_
        self.merge(made)

    def merge(self, entries: np.ndarray) -> None:
        if self.finding == 0:
            pool = np.concatenate([self.found[0], entries])
            pool["place"] = 0
            pool = np.unique(pool)
            pool = best(pool, self.positives)
            first = np.searchsorted(pool["member"], pool["member"])
            pool["place"] = np.arange(len(pool)) - first
            self.found[0] = pool
        else:
            self.found[1] = best(np.unique(np.concatenate([self.found[1], entries])),
                                 self.negatives)

    def proceed(self, blocks: Blocks) -> None:
        """After a round: go on, turn to the negatives, or end."""
        self.visited, self.step = self.visited + self.step, self.step * GROWTH
        bounds = np.sort(blocks.bounds(self.centre, self.radius))[::-1]
        rest = bounds[self.visited] if self.visited < len(bounds) else -np.inf
        if not np.isfinite(rest) or not self.open_members(rest).any():
            self.finding, self.visited, self.step = self.finding + 1, 0, FIRST_BLOCKS
            if self.finding == 1 and not np.isfinite(self.needed()).any():
                self.finding = 2

    def asked(self, blocks: Blocks) -> list[int]:
        """Places of the blocks that are next in the list and can still matter."""
        bounds = blocks.bounds(self.centre, self.radius)
        order = np.lexsort((blocks.number, -bounds))[self.visited:self.visited + self.step]
        return [b for b in order if self.open_members(bounds[b]).any()]


def usable(vectors: DataFrame, scale: int, vec_id: str, label: str, embedding: str) -> DataFrame:
    """(vec_id, label, v) of rows that take part, one for each id, quantised."""
    value = F.col(embedding)
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(LONGEST / scale)))
    rows = vectors.where(
        F.col(vec_id).isNotNull() & F.col(label).isNotNull() & value.isNotNull() & finite
    ).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
             F.transform(value, lambda x: F.floor(x.cast("double") * scale)).alias("v"))
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    rows = rows.where(length < F.lit(LONGEST**2))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select(
        "vec_id", "r.label", "r.v")


def _matrix(column: pd.Series, kind=np.int64) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(kind)


def mine(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    share: tuple[int, int] = (50, 95),
    scale: int = 256,
    sample: int = SAMPLE,
    block_rows: int = BLOCK_ROWS,
    part_rows: int = PART_ROWS,
    cluster_rows: int = CLUSTER_ROWS,
    seed: int = 5,
    vec_id: str = "vec_id",
    label: str = "label",
    embedding: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components are multiplied by ``scale`` and floored; a score is the integer inner
    product. The positives of an anchor (rows of ``vectors`` where ``anchors``, a condition on
    ``vec_id``, holds) are its ``positives`` best other rows of its label; for each, the
    ``negatives`` best rows of other labels follow whose score is between the two ``share``
    percentages of the positive's. Ties go to the smaller id; fewer rows give fewer.

    Rows with null id, label or vector, with null or non-finite components, of another length
    than most, or longer than 2^27 once quantised take no part. Repeated rows count once; of an
    id with several rows, the least by label and vector counts. Equal vectors of different ids
    are candidates each. An empty table gives an empty result; other columns are not read.

    The result is exact. ``sample`` vectors fix the centres and with them only the speed.
    """
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, "
              "positive_score long, negative_score long")
    spark = vectors.sparkSession
    rows = usable(vectors, scale, vec_id, label, embedding)
    rows = written(rows.where(F.size("v") > 0), "negatives-vectors")
    lengths = rows.groupBy(F.size("v").alias("size")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    if common is None:
        return spark.createDataFrame([], schema)
    rows, n = rows.where(F.size("v") == common["size"]), common["count"]
    picked = rows.select("v").orderBy(F.xxhash64("vec_id", F.lit(seed))).limit(sample).collect()
    centres = spark.sparkContext.broadcast(fitted_centres(
        np.array([r["v"] for r in picked], dtype=float),
        int(min(CENTRES, max(1, n // block_rows))), seed))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            values = _matrix(part["v"], float)
            units = _unit(values)
            block = (units @ centres.value.T).argmax(axis=1)
            cosine = np.einsum("ij,ij->i", units, centres.value[block])
            norm = np.linalg.norm(values, axis=1)
            # A zero vector has no direction; its score is 0, which any angle bounds.
            angle = np.where(norm > 0, np.arccos(np.clip(cosine, -1.0, 1.0)), 0.0)
            yield part.assign(block=block, norm=norm, angle=angle)

    placed = written(rows.mapInPandas(
        place, "vec_id long, label long, v array<long>, block int, norm double, angle double"),
        "negatives-placed")
    # One row for each centre.
    known = placed.groupBy("block").agg(
        F.max("angle"), F.min("norm"), F.max("norm"), F.count("*")).orderBy("block").collect()
    held = {r[0]: -(-r[4] // part_rows) for r in known}
    blocks = spark.sparkContext.broadcast(Blocks(
        np.array([r[0] for r in known]), centres.value[[r[0] for r in known]],
        np.array([r[1] for r in known]) + 1e-7, np.array([r[2] for r in known]),
        np.array([r[3] for r in known]), np.array([held[r[0]] for r in known])))
    sizes = spark.createDataFrame([(r[0], held[r[0]]) for r in known], "block int, parts long")

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        data = pickle.dumps((part["vec_id"].to_numpy(), part["label"].to_numpy(),
                             _smallest(_matrix(part["v"]))))
        return pd.DataFrame({"block": part["block"].iloc[:1], "part": part["part"].iloc[:1],
                             "data": [data]})

    lists = written(
        placed.join(F.broadcast(sizes), "block")
        .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
        .select("block", "part", "vec_id", "label", "v").groupBy("block", "part")
        .applyInPandas(pack, "block int, part int, data binary"), "negatives-lists")

    def gather(part: pd.DataFrame) -> pd.DataFrame:
        values = _matrix(part["v"])
        units = _unit(values.astype(float))
        units = units[np.linalg.norm(units, axis=1) > 0]
        centre = centres.value[part["block"].iloc[0]]
        if len(units) and np.linalg.norm(units.sum(axis=0)) > 0:
            centre = _unit(units.sum(axis=0, keepdims=True))[0]
        radius = float(_angles(units, centre).max(initial=0.0)) + 1e-7
        state = Cluster(part["vec_id"].to_numpy(), part["label"].to_numpy(), _smallest(values),
                        centre, radius, positives, negatives, share)
        return pd.DataFrame({"cluster": part["cluster"].iloc[:1], "finding": [0],
                             "state": [pickle.dumps(state)]})

    chosen = written(rows.where(anchors).select("vec_id").join(placed, "vec_id"), "negatives-anchors")
    chunks = chosen.groupBy("block").agg(F.ceil(F.count("*") / cluster_rows).alias("chunks"))
    state_schema = "cluster long, finding int, state binary"
    states = written(
        chosen.join(F.broadcast(chunks), "block")
        .withColumn("cluster", F.col("block") + F.lit(CENTRES) * F.pmod(
            F.xxhash64("vec_id"), F.col("chunks"))).select("cluster", "block", "vec_id", "label", "v")
        .groupBy("cluster").applyInPandas(gather, state_schema), "negatives-state")

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for cluster, data in zip(part["cluster"], part["state"]):
                spots = [(blocks.value.number[b], p)
                         for b in pickle.loads(data).asked(blocks.value)
                         for p in range(blocks.value.parts[b])]
                if spots:
                    yield pd.DataFrame(spots, columns=["block", "part"]).assign(
                        cluster=cluster, state=data)

    def look(asking: pd.DataFrame, lists: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(lists):
            ids, labels, values = pickle.loads(lists["data"].iloc[0])
            values = values.astype(np.int64)
            for cluster, data in zip(asking["cluster"], asking["state"]):
                state = pickle.loads(data)
                state.walk(ids, labels, values)
                out.append((cluster, state.finding, state.found[state.finding].tobytes(),
                            lists["block"].iloc[0] % LANES))
        return pd.DataFrame(out, columns=["cluster", "finding", "found", "lane"])

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        finding = int(part["finding"].iloc[0])
        pool = np.concatenate([np.frombuffer(x, ENTRY) for x in part["found"]])
        if finding == 0:
            pool["place"] = 0
        pool = best(np.unique(pool), (positives, negatives)[finding])
        return pd.DataFrame({"cluster": part["cluster"].iloc[:1], "finding": [finding],
                             "found": [pool.tobytes()]})

    def update(states: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        state = pickle.loads(states["state"].iloc[0])
        for x in found["found"]:
            state.merge(np.frombuffer(x, ENTRY))
        state.proceed(blocks.value)
        return pd.DataFrame({"cluster": states["cluster"].iloc[:1], "finding": [state.finding],
                             "state": [pickle.dumps(state)]})

    find_schema = "cluster long, finding int, found binary"
    done = []
    while True:
        done.append(states.where("finding = 2"))
        states = states.where("finding < 2")
        if states.isEmpty():
            break
        asking = written(states.mapInPandas(
            ask, "block int, part int, cluster long, state binary").withColumn(
            "turn", F.pmod(F.xxhash64("cluster"), F.lit(-(-states.count() // TURN)))),
            "negatives-asked")
        keys = ("block", "part", "turn")
        copies = asking.select(*keys).distinct().join(lists, ["block", "part"]).toDF(*keys, "data")
        found = asking.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInPandas(
            look, f"{find_schema}, lane int")
        found = found.groupBy("cluster", "lane").applyInPandas(merge, find_schema)
        states = written(
            states.groupBy("cluster").cogroup(found.groupBy("cluster")).applyInPandas(
                update, state_schema), "negatives-state")

    def result(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for data in part["state"]:
                state = pickle.loads(data)
                known = {(p["member"], p["place"]): p for p in state.found[0]}
                rank, last = 0, None
                out = []
                for e in state.found[1]:
                    key = (e["member"], e["place"])
                    rank, last = (rank + 1 if key == last else 1), key
                    p = known[key]
                    out.append((state.ids[e["member"]], p["id"], rank, e["id"], p["score"],
                                e["score"]))
                yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    ended = done[0]
    for more in done[1:]:
        ended = ended.unionByName(more)
    return ended.mapInPandas(result, schema)


def _smallest(values: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest type that holds them."""
    most = int(np.abs(values).max(initial=0))
    return values.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64)
                              if most <= np.iinfo(t).max))
