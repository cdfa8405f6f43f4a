"""Fingerprints against sets compared one by one."""

from __future__ import annotations

import hashlib
import random

import pytest

from retinue.llm import fingerprints


def cut(text):
    """The pieces of a text."""
    made = set()
    for line in filter(None, (text or "").split("\n")):
        words = line.split(" ")
        made.add(words[0])
        at = 1
        while at < len(words):
            made.add(" ".join(words[at:2 * at]))
            at *= 2
    return made


def brute(rows):
    ordered = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (doc_id, text) in enumerate(ordered):
        own = text or ""
        following = ordered[(k + 1) % len(ordered)][1] or ""
        third = len(own) // 3
        edited = own[:len(own) - third] + following[:third]
        likeness = [1.0 if not cut(own) | cut(o) else len(cut(own) & cut(o)) / len(cut(own) | cut(o))
                    for o in (edited, following)]
        out[doc_id] = (len(own), hashlib.sha256(edited.encode()).hexdigest(), *likeness)
    return out


def sample(n):
    rng = random.Random(n)
    text = lambda size: " ".join(
        rng.choice(["ä€", "b", "cc", "d\n", "e", "😀f"]) + str(rng.randrange(50))
        for _ in range(size))
    rows = [(k * k, text(rng.choice([1, 2, 5, 30, 200]))) for k in range(n)]
    rows += [(10**6 + k, rows[k][1]) for k in range(5)]
    return rows + [(10**7, ""), (10**7 + 1, None), (10**7 + 2, "\n\n"), (-5, "only one")]


@pytest.mark.parametrize("bucket_rows", [1000, 7])
def test_equals_sets(spark, bucket_rows):
    rows = sample(60)
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, nth int")
    got = {r.doc_id: r for r in fingerprints.compare(docs, bucket_rows).collect()}
    want = brute(rows)
    assert len(got) == len(rows)
    for doc_id, (n, sha, edited, following) in want.items():
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert r.near_edited == pytest.approx(edited) and r.near_next == pytest.approx(following)
    assert got[10**6 + 2].fingerprint == got[4].fingerprint
    assert got[10**7].fingerprint == got[10**7 + 1].fingerprint


def test_a_sketch_that_is_too_small_is_tried_again(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "CELLS_PER_DIGEST", 0.3)
    monkeypatch.setattr(fingerprints, "LEAST_CELLS", 2)
    rows = sample(12)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    for r in fingerprints.compare(docs).collect():
        assert r.near_next == pytest.approx(want[r.doc_id][3])


def test_repeated_rows_null_ids_single_and_empty(spark):
    schema = "doc_id long, text string"
    rows = [(1, "a b"), (1, "a b"), (None, "c"), (None, None), (2, "d e f")]
    assert fingerprints.compare(spark.createDataFrame(rows, schema)).count() == 5
    one = fingerprints.compare(spark.createDataFrame([(3, "x y z")], schema)).collect()
    assert one[0].near_next == 1.0
    assert fingerprints.compare(spark.createDataFrame([], schema)).count() == 0


def test_buckets_of_clustered_null_and_equal_ids(spark):
    rng = random.Random(3)
    ids = [*range(300), 10**15, 10**15 + 1, -2**63, 2**63 - 1]
    rows = [(k, f"text {rng.random()}") for k in ids]
    rows += [(None, f"none {k}") for k in range(150)] + [(7, "the same")] * 60 + [(None, "")] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    placed = fingerprints._followed(docs, 20).select(
        "doc_id", "text", "bucket", "follower.text").toDF("doc_id", "text", "bucket", "next").collect()
    assert sorted(map(str, ((r.doc_id, r.text) for r in placed))) == sorted(map(str, rows))
    sizes = {}
    for r in placed:
        sizes[r.bucket] = sizes.get(r.bucket, 0) + 1
    assert max(sizes.values()) <= 60 and len(sizes) >= len(rows) // 20
    # Every text follows as often as it occurs, and ids descend along with the followers.
    assert sorted(r.next for r in placed) == sorted(t for _, t in rows)
    after = {r.doc_id: r.next for r in placed if r.doc_id not in (None, 7)}
    want = sorted((r for r in rows if r[0] is not None), key=lambda r: -r[0])
    for (doc_id, _), (following, text) in zip(want, want[1:]):
        if doc_id != 7 and following != 7:
            assert after[doc_id] == text
    got = fingerprints.compare(docs.limit(60), 7).count()
    assert got == 60
