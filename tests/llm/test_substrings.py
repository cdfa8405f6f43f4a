"""Removal of repeated passages against a look at every window."""

from __future__ import annotations

import hashlib
import random

import pytest

from retinue.llm import queries, substrings
from tests.conftest import SF_DIR
from tests.oracle import compare


def direct(rows, window):
    """Rows are (id, text) of distinct ids, null last."""
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        words = (text or "").encode().split()
        gone = set()
        for k in range(len(words) - window + 1):
            run = tuple(words[k:k + window])
            if run in seen:
                gone |= set(range(k, k + window))
            seen.add(run)
        left = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def found(df, **options):
    got = substrings.repeats(df, **options).collect()
    for r in got:
        assert sum(s.end - s.start for s in r.removed) == r.n_removed
    return sorted((tuple(r)[:4] for r in got), key=str)


def frame(spark, rows, ids="long"):
    return spark.createDataFrame(rows, f"doc_id {ids}, text string").selectExpr(
        "*", "1 AS digest", "2 AS at", "3 AS n_words", "4 AS first_id")


@pytest.mark.parametrize("period", [1, 2, 5, 7, 13, 17])
def test_cover(period):
    cover = substrings.difference_cover(period)
    assert {(x - y) % period for x in cover for y in cover} == set(range(period))


def test_query_equals_sql(spark, duck):
    _, problem = compare(queries.op11_substrings(spark, SF_DIR), duck,
                         queries.ORACLE_SQL["op11_substrings"])
    assert not problem


@pytest.mark.parametrize("window,period,flush", [(20, 13, 1_500_000), (6, 3, 40), (4, 1, 7)])
def test_against_all_windows(spark, window, period, flush):
    rng = random.Random(window)
    passages = [[rng.choice("abcde") + str(rng.randint(0, 3)) for _ in range(40)] for _ in range(6)]
    rows = []
    for k in range(60):
        words = [rng.choice("uvwxyz") * rng.randint(1, 4) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            p, i = rng.choice(passages), rng.randint(0, 20)
            at = rng.randint(0, len(words))
            words[at:at] = p[i:i + rng.randint(1, 40)]
        rows.append((k * 7 % 60, rng.choice([" ", "\n\t", "\x0b "]).join(words)))
    rows += [(100 + k, "same " * 30 + "words") for k in range(4)]  # near copies of themselves
    rows += [(104, "same " * 30), (200, None), (201, ""), (202, " \t"), (203, "é\xa0ü " * 25),
             (None, " ".join(passages[0])), (-5, " ".join(passages[1])), (2**62 + 5, rows[3][1])]
    got = found(frame(spark, rows).repartition(5), window=window, period=period, slice_chars=900,
                flush_words=flush)
    assert got == direct(rows, window)


def test_repeated_rows_and_ids(spark):
    text, other = "one two three four five six", "two three four five six seven eight"
    rows = [(1, text), (1, text), (1, text), (2, text), (None, text), (None, text), (3, "a b"),
            (3, "a b"), (4, other), (4, "zero " + other)]
    got = found(frame(spark, rows), window=4, period=2)
    assert [(r[0], r[1], r[2]) for r in got][:4] == [(1, 6, 0), (1, 6, 6), (1, 6, 6), (2, 6, 6)]
    assert {r[:3] for r in got if r[0] == 3} == {(3, 2, 0)}
    assert {r[:3] for r in got if r[0] is None} == {(None, 6, 6)}
    # Of two texts with one id the one that comes first keeps what is new in it.
    assert sorted(r[2] for r in got if r[0] == 4) in ([5, 7], [5, 8])
    assert found(frame(spark, rows).limit(0)) == []
    assert len(found(frame(spark, rows, "int"))) == len(rows)


def test_many_copies_are_spelled_out(spark):
    rows = spark.range(25_003).selectExpr("1L AS doc_id", "'a b c d e' AS text")
    got = substrings.repeats(rows, window=4, period=2).groupBy("n_removed").count().collect()
    assert {r.n_removed: r["count"] for r in got} == {0: 1, 5: 25_002}
