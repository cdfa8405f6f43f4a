"""Hard negatives against a look at all candidates, whatever the blocks."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from retinue.llm import negatives, queries
from tests.conftest import SF_DIR
from tests.oracle import compare


def direct(rows, every, k=5, m=3, scale=256):
    """Rows are (id, label, vector), one for each id."""
    items = [(i, y, [int(np.floor(np.float64(x) * scale)) for x in v]) for i, y, v in rows]
    out = []
    for i, y, u in items:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(u, v)), j, z) for j, z, v in items if j != i)
        for s, j, _ in [x for x in scored if x[2] == y][:k]:
            fitting = [(t, n) for t, n, z in scored if z != y and 50 * -s <= 100 * -t <= 95 * -s]
            out += [(i, j, r + 1, n, -s, -t) for r, (t, n) in enumerate(fitting[:m])]
    return sorted(out)


def mined(df, every, **options):
    return sorted(map(tuple, negatives.mine(df, F.col("vec_id") % every == 0, **options).collect()))


def frame(spark, rows):
    return spark.createDataFrame(
        rows, "vec_id long, label int, embedding array<float>").selectExpr(
        "*", "vec_id AS cluster", "label AS block")


def test_query_equals_sql(spark, duck):
    _, problem = compare(queries.op12_negatives(spark, SF_DIR), duck,
                         queries.ORACLE_SQL["op12_negatives"])
    assert not problem


@pytest.mark.parametrize("block_rows,part_rows,cluster_rows", [(2048, 16_384, 512), (20, 7, 3)])
def test_against_all(spark, block_rows, part_rows, cluster_rows):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    vectors = centres[rng.integers(0, 6, 300)] + rng.normal(scale=0.3, size=(300, 8))
    vectors[40:140] = vectors[40]  # a third are equal
    vectors[7] = 0
    vectors[8] *= 40
    vectors[9] *= -1
    rows = [(k, int(rng.integers(0, 3)) if k < 290 else 9, v.astype(np.float32).tolist())
            for k, v in enumerate(vectors)]
    got = mined(frame(spark, rows), 5, block_rows=block_rows, part_rows=part_rows,
                cluster_rows=cluster_rows)
    assert got == direct(rows, 5)


def test_unfit_rows(spark):
    good = [(k, k % 2, [1.0 + k / 9, 2.0, -0.5]) for k in range(12)]
    bad = [(None, 1, [1.0, 2.0, 3.0]), (50, None, [1.0, 2.0, 3.0]), (51, 1, None),
           (52, 1, [None, 1.0, 1.0]), (53, 1, [float("nan"), 1.0, 1.0]),
           (54, 1, [float("inf"), 1.0, 1.0]), (55, 1, [1.0]), (56, 1, []), (57, 1, [1e30, 0.0, 0.0])]
    repeated = [good[0], good[0], (1, 1, [9.0, 9.0, 9.0])]
    assert mined(frame(spark, good + bad + repeated), 2) == direct(good, 2)
    assert mined(frame(spark, good[:1]), 2) == []
    assert mined(frame(spark, bad), 2) == [] and mined(frame(spark, good).limit(0), 2) == []
    # Products that a double cannot hold exactly.
    large = [(k, k % 2, [2.0**18 + k, 2.0**17 - k, float(k)]) for k in range(12)]
    assert mined(frame(spark, large), 2) == direct(large, 2)


def test_walks_end_early():
    """A list is left as soon as nothing better can follow."""
    rng = np.random.default_rng(1)
    near = rng.integers(90, 110, (40, 4))
    far = near * [[1, -1, 1, -1]]
    state = negatives.Cluster(np.arange(4), np.zeros(4, int), near[:4], np.full(4, 0.5), 0.2, 5, 3,
                              (50, 95))
    state.walk(np.arange(40), np.zeros(40, int), near)
    bound = np.cos(np.pi / 2 - 0.3) * np.linalg.norm(far, axis=1).max()
    assert not state.open_members(bound).any() and len(state.found[0]) == 20
