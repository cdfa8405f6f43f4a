"""The similarity join against all pairs, one by one."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from retinue.llm import graph, jaccard


def brute(rows, words, percent):
    """{row number: (size, component)} by comparing all pairs of texts."""
    sets = []
    for _, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(
            {c: c + 32 for c in range(65, 91)}))
        width = min(words, len(found))
        sets.append({tuple(found[i:i + width]) for i in range(len(found) - width + 1)}
                    if found else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        named = [d for j, (d, _) in enumerate(rows) if find(j) == find(i) and d is not None]
        out.append((doc_id, len(sets[i]), min(named) if named else None))
    brute.groups = {}
    for i in range(len(rows)):
        brute.groups.setdefault(find(i), []).append(i)
    brute.sets = sets
    return sorted(out, key=str)


def texts(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(30))
    made = []
    for size in (1, 2, 3, 4, 9, 12, 25, 60, 140):
        base = [word() for _ in range(size)]
        made.append(" ".join(base))
        for changes in (0, 1, 1, 2, 3, 5):
            copy = list(base)
            for _ in range(changes):
                at = rng.randrange(len(copy))
                if rng.random() < 0.5:
                    copy[at] = word()
                elif len(copy) > 1:
                    del copy[at]
            made.append(("  " if changes else "\n").join(copy).upper())
    return made


@pytest.mark.parametrize("words,percent,block", [(3, 90, 10**6), (5, 80, 10**6), (2, 60, 700)])
def test_equals_all_pairs(spark, words, percent, block):
    rows = [(1000 - i, t) for i, t in enumerate(texts(words))]
    rows += [(2000, None), (2001, ""), (None, rows[3][1]), (None, "only here nothing else"),
             (None, None), (5000, rows[10][1]), (5000, "quite another text of that id"),
             rows[20], rows[20], (3000, " \t\n "), (2**62 + 5, "huge ids " * 9),
             (2**62 + 9, "HUGE ids " * 9), (2**63 - 1, "huge  ids " * 9), (2**63 - 2, rows[2][1]),
             (-(2**63), "the least of all ids is here"), (7, "the least of all ids is here")]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows],
                                 "doc_id long, text string, digest string")
    got = jaccard.similar(docs, words, percent, block_hashes=block).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, words, percent)


def test_empty_table(spark):
    assert jaccard.similar(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("percent", [90, 80])
def test_linked_sets_share_a_key(percent):
    rng = np.random.default_rng(percent)
    bands = jaccard._bands(percent)
    for _ in range(3000):
        size = int(rng.integers(1, 120))
        base = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
        keep = base[rng.random(len(base)) > rng.uniform(0, 0.2)]
        other = np.union1d(keep, rng.integers(0, 2**64, int(rng.integers(0, 1 + size // 8)),
                                              dtype=np.uint64))
        if len(other) and jaccard.linked(base, other, percent):
            keys = [set(jaccard.part_keys(s, percent, bands).tolist()) for s in (base, other)]
            assert keys[0] & keys[1]


def test_many_near_copies_are_one_group():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**64, 400, dtype=np.uint64)
    members = {str(k): np.unique(np.concatenate([
        np.delete(base, rng.integers(0, 400, 8)), rng.integers(0, 2**64, 8, dtype=np.uint64)]))
        for k in range(500)}
    assert len(jaccard.spanning_links(members, None, 90)) == 499


def test_representatives(spark):
    """One row of each component stays, whatever its ids; names of columns may clash."""
    rows = [(1000 - i, t) for i, t in enumerate(texts(5))]
    rows += [(2**62 + 5, "huge ids " * 9), (2**62 + 9, "huge  ids " * 9), (2**63 - 1, rows[30][1]),
             (5, "one text of an id and more of it"), (5, "quite another text under that id"),
             (None, rows[12][1]), (None, "q r s t u v"), (None, "q r s t u  v"), (2, None), (7, ""),
             (None, ""), (None, "words of their own, without an id"), rows[8], rows[8]]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows],
                                 "doc_id long, text string, _id int, label string")
    kept = jaccard.representatives(docs, 5, 80)
    assert kept.columns == docs.columns
    got = {(r.doc_id, r.text) for r in kept.collect()}
    assert len(got) == kept.count()
    brute(rows, 5, 80)
    want = set()
    for members in brute.groups.values():
        own = [rows[i] for i in members]
        if not brute.sets[members[0]]:
            want |= set(own)
            continue
        first = min(own, key=lambda r: (r[0] is None, r[0] or 0))
        # Of several texts with the least id any one may stay.
        stays = [r for r in own if r[0] == first[0] and r in got]
        assert len(set(stays)) == 1
        want |= set(stays)
    assert got == want
    assert jaccard.representatives(docs.limit(0), 5, 80).collect() == []


def test_rows_without_ids_cost_no_more(spark):
    """A thousand near copies without an id are compared as those with one are."""
    rows = [(None, " ".join(f"w{(k * 7 + j) % 997}" if j == k % 90 else f"same{j}"
                            for j in range(90))) for k in range(1_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert jaccard.similar(docs, 5, 80).where("component_id IS NULL").count() == 1_000
    assert jaccard.representatives(docs, 5, 80).count() == 1


def test_pairs_of_a_block_are_stars():
    sets = {f"{g}-{k}": np.arange(g * 10_000 + k, g * 10_000 + k + 100, dtype=np.uint64)
            for g in range(3) for k in range(40)}
    pairs = jaccard.spanning_links(sets, None, 90)
    assert len(pairs) == 3 * 39
    assert {top for top, _ in pairs} == {"0-0", "1-0", "2-0"}


@pytest.mark.parametrize("most", [0, 100_000])
def test_components_against_union_find_and_stars_without_a_round(spark, monkeypatch, most):
    monkeypatch.setattr(graph, "BROADCAST_EDGES", most)
    rng = random.Random(9)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)]
    edges += [(k, k + 1) for k in range(1_000, 1_030)] + edges[:5] + [(7, 7)]
    parent = {n: n for e in edges for n in e if e[0] != e[1]}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        if a != b and find(a) != find(b):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    wanted = sorted((n, find(n)) for n in parent)
    rows = spark.createDataFrame(edges, "a long, b long")
    assert sorted(tuple(r) for r in graph.components(rows).collect()) == wanted

    writes, written = [], graph.written
    monkeypatch.setattr(graph, "written", lambda df, name: writes.append(name) or written(df, name))
    stars = spark.createDataFrame([(label, n) for n, label in wanted], "a long, b long")
    assert sorted(tuple(r) for r in graph.components(stars).collect()) == wanted
    assert len(writes) == 1
    assert graph.components(rows.limit(0)).isEmpty()
