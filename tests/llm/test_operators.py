"""Small tables with nulls, ties, repeated rows and clashing names, against plain Python."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from retinue.llm import licences, mixing, neighbours, packing, queries, sharding, toxicity, urls
from tests.conftest import SF_DIR
from tests.oracle import compare

DOCS = "doc_id long, text string, source string, size int, row string, shard int"
ROWS = [(1, "a b c", "s", 1, "r", 0), (1, "a b c", "s", 1, "r", 0), (2, None, None, 2, "r", 0),
        (None, "d e " * 400, "t", 3, "r", 0), (3, "", "t", 4, None, 0), (4, "A  b\nc", "s", 5, "r", 0),
        (5, "w " * 5000, "u", 6, "r", 0), (6, " \t", None, 7, "r", 0)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    _, problem = compare(queries.QUERIES[name](spark, SF_DIR), duck, queries.ORACLE_SQL[name])
    assert not problem


def test_mix(spark, docs):
    rows = mixing.mix(docs, rows_per_range=2).collect()
    assert len(rows) == len(ROWS)
    assert all(r.taken <= 3 * r.size and r.target <= 3 * r.source_size for r in rows)
    assert sum({r.row.source: r.target for r in rows}.values()) == pytest.approx(
        sum(r.size for r in rows))
    assert mixing.repeated(mixing.mix(docs)).columns == docs.columns
    assert mixing.mix(docs.limit(0)).count() == 0


def test_shard(spark, docs):
    many = spark.createDataFrame(
        [(k + 100, "same text" if k % 3 else f"text {k} " * (k % 7), "s", 0, "", 0) for k in range(900)],
        DOCS).unionByName(docs)
    rows = sharding.shard(many, shards=5, rows_per_range=40).collect()
    assert len(rows) == 900 + len(ROWS)
    slots, sizes = {}, {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in rows)
    texts = {r.doc_id: r.text_crc32 for r in rows if r.doc_id == 4}
    assert texts == {4: zlib.crc32(b"A  b\nc")}
    assert sharding.shard(docs.limit(0)).count() == 0


def plain_best_fit(items, capacity):
    """The tightest bin that allows an item, by looking at all of them."""
    bins, placed = [], []
    for size, source, cluster in items:
        fits = [(left, k) for k, (left, s, c, _) in enumerate(bins)
                if left >= size and source not in s and (cluster < 0 or cluster not in c)]
        if not fits:
            bins.append((capacity, set(), set(), 0))
            fits = [(capacity, len(bins) - 1)]
        left, k = min(fits)
        placed.append((k, bins[k][3]))
        bins[k] = (left - size, bins[k][1] | {source}, bins[k][2] | {cluster}, bins[k][3] + 1)
    return placed


def test_best_fit_equals_looking_at_all_bins():
    rng = random.Random(2)
    for _ in range(50):
        items = [(rng.randint(1, 20), rng.randrange(6), rng.choice([-1, -1, 0, 1]))
                 for _ in range(rng.randrange(60))]
        assert packing.best_fit(items, 20) == plain_best_fit(items, 20)


def test_pack(docs):
    rows = packing.pack(docs, capacity=100, block_rows=3).collect()
    assert sum(r.length for r in rows) == 3 * 3 + 800 + 5000
    assert sum(r.bin is None for r in rows) == 3
    held = {}
    for r in rows:
        if r.bin is not None:
            held.setdefault(r.bin, []).append(r)
    for inside in held.values():
        assert sum(r.length for r in inside) <= 100
        assert len({r.source for r in inside}) == len({r.cluster for r in inside}) == len(inside)
    assert packing.pack(docs.limit(0)).count() == 0


def test_urls(spark):
    cases = [("HTTP://A.Example.com/en/x?y#z", "a.example.com", "/en/x", "example.com/en/", "block"),
             ("x://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
             ("x://com/", "com", "/", "com/", "allow"), ("x://b.net/fr/1", "b.net", "/fr/1",
                                                         "net/fr/", "block"),
             ("x://nocom/", "nocom", "/", None, None), ("no host", "", "", None, None),
             ("x://q.com?a=/en/", "q.com", "", None, None), (None, "", "", None, None)]
    pages = spark.createDataFrame([(k, c[0], 1) for k, c in enumerate(cases)],
                                  "page_id long, url string, label int")
    got = {r.page_id: r for r in urls.judge(pages).collect()}
    for k, (_, host, path, rule, verdict) in enumerate(cases):
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule)
        assert got[k].verdict == verdict if verdict else got[k].verdict in ("allow", "block")
    assert urls.judge(pages.limit(0)).count() == 0


def test_urls_learn_from_both_verdicts_and_count_all(spark, monkeypatch):
    block = [f"x://h{k}.net/fr/{k}" for k in range(60)]
    allow = [f"x://h{k}.com/{'a' * (k % 9)}{k}" for k in range(60)]
    names = spark.createDataFrame([(u,) for u in block + allow], "url string")
    first = names.selectExpr("url", "xxhash64(url, 5) AS at").orderBy("at").first()["url"]
    # One URL with the lowest hash has more copies than the trees have rows.
    rows = block + allow + [first] * 50 + ["x://other.net/fra/1", "x://some.org/1"]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = {r.page_id: r.score for r in urls.judge(pages, train_rows=20).collect()}
    assert len(got) == len(rows) and all(0 < x < 1 for x in got.values())
    assert sum(got[k] for k in range(60)) > 50 > 10 > sum(got[60 + k] for k in range(60))

    # Statistics of a suffix are the same whatever the sample.
    seen = []
    fitted = urls.GBTClassifier.fit

    def fit(self, train):
        seen.append(train.collect())
        return fitted(self, train)

    monkeypatch.setattr(urls.GBTClassifier, "fit", fit)
    many = [f"x://a.com/{k}" for k in range(90)] + [f"x://b{k}.net/fr/" for k in range(90)]
    pages = spark.createDataFrame(list(enumerate(many * 2)), "page_id long, url string")
    urls.judge(pages, train_rows=10).count()
    assert len(seen[0]) == 10 and {r.label for r in seen[0]} == {0.0, 1.0}
    assert sum(r.weight for r in seen[0]) == pytest.approx(360)
    at = urls.FEATURES.index("f_suffix_seen")
    assert {r.features[at] for r in seen[0] if r.label == 0.0} == {180.0}


def test_licences(spark, docs):
    text = "Copyright 2020 Somebody\nRELEASED under the  MIT Licence\n"
    more = spark.createDataFrame([(9, text, "s", 0, "", 0)], DOCS).unionByName(docs)
    rows = {r.doc_id: r for r in licences.scan(more, licences.known_digests(spark)).collect()}
    assert (rows[9].text_licence, rows[9].notices, rows[9].n_lines) == ("MIT", "MIT", 2)
    assert (rows[2].text_licence, rows[2].notices, rows[2].n_lines) == (None, "", 0)


def test_licence_texts_headers_and_wrapped_notices(spark):
    full = {n: t for n, t in licences.table() if t.count("\n") > 8}
    mit = full["MIT"][full["MIT"].index("Permission"):]
    rewrapped = "\n\n".join(" ".join(block.split()) for block in full["ISC"].split("\n\n"))
    commented = "".join(f"# {line}\n" for line in full["BSD-2-Clause"].splitlines())
    cases = [
        (full["GPL-3.0-only"], "GPL-3.0-only", "GPL-3.0-only", 1),
        ("Copyright (c) 2020 Some Body\n\n" + mit, "MIT", "MIT", 1),
        ("MIT License\n\nCopyright (c) 2020 X\n\n" + mit, "MIT", "MIT", 1),
        (rewrapped, "ISC", "ISC", 1),
        (commented, "BSD-2-Clause", "BSD-2-Clause", 1),
        ("Some words.\n\nCopyright 2020 X\n\n" + mit + "\n\nOther words.", None, "MIT", 1),
        ("Some words.\n \nThis work is licensed under the GNU\nGeneral Public License,\n"
         "version 3.\n\nOther words.", None, "GPL-3.0-only", 1),
        ("int x;\n// SPDX-License-Identifier: MPL-2.0\nint y;", None, "MPL-2.0", 1),
        (mit.split("\n\n")[0] + "\n\nand nothing else", None, "", 0),
        ("Released under the MIT License.\n\n\n\nRELEASED under the MIT licence", None, "MIT", 2),
        ("words\n\nCopyright 2020 X\nReleased under the MIT License.\n\nwords", None, "MIT", 1),
        ("words\n\n" + full["Apache-2.0"], None, "Apache-2.0", 1),
    ]
    docs = spark.createDataFrame([(k, c[0]) for k, c in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r for r in licences.scan(docs, licences.known_digests(spark)).collect()}
    for k, (_, whole, notices, n) in enumerate(cases):
        assert (k, got[k].text_licence, got[k].notices, got[k].n_notices) == (k, whole, notices, n)
    table = spark.createDataFrame([("X-1", "one\ntwo\n\nthree")], "licence string, text string")
    own = licences.scan(spark.createDataFrame([(1, "a\n\nOne two\n\nthree\n")], docs.schema),
                        licences.known_digests(spark, table)).first()
    assert (own.text_licence, own.notices, own.n_notices) == (None, "X-1", 1)


def test_nearest(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(600, 16))
    rows = [(k, [float(x) for x in v], "x") for k, v in enumerate(vectors)]
    rows += [(700 + k, rows[40][1], "x") for k in range(50)] + [
        (900, None, "x"), (901, [0.0] * 16, "x"), (902, [float("nan")] * 16, "x"),
        (None, rows[0][1], "x"), (903, [1.0], "x"), (0, rows[0][1], "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    kept = {r[0]: np.array(r[1]) for r in rows[:650]}
    got = {}
    for r in neighbours.nearest(table).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(got) == {k for k in kept if k % 20 == 0}
    found = 0
    for q, ranks in got.items():
        best = sorted((-float((kept[q] * v).sum()), k) for k, v in kept.items() if k != q)[:20]
        found += len({k for _, k in best} & {v for v, _ in ranks.values()})
        assert all(s == pytest.approx(float(kept[q] @ kept[v])) for v, s in ranks.values())
    assert found / (20 * len(got)) >= 0.9
    assert neighbours.nearest(table.limit(0)).count() == 0


@pytest.mark.parametrize("n", [5, 15, 30])
def test_nearest_of_few_vectors_are_all_listed(spark, n):
    rng = np.random.default_rng(n)
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(rng.normal(size=(n, 24)))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for r in neighbours.nearest(table, every=1, visits=4).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert {q: len(f) for q, f in found.items()} == {k: min(20, n - 1) for k in range(n)}


def test_toxicity(spark):
    rng = random.Random(5)
    text = lambda bad: " ".join(rng.choices([f"w{k}" for k in range(200)], k=60) + bad)
    rows = [(k, text(["vile"] if k % 3 == 0 else []), k % 3 == 0) for k in range(400)]
    docs = spark.createDataFrame(
        [(k, t, 1) for k, t, _ in rows] + [(1000, None, 1), (None, "", 1)],
        "doc_id long, text string, score int")
    labels = spark.createDataFrame([(k, int(b)) for k, _, b in rows] + [(7, None), (None, 1)],
                                   "doc_id long, toxic int")
    got = toxicity.judge(docs, labels).collect()
    assert len(got) == 402 and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 400]
    right = sum(r.predicted == int(r.doc_id % 3 == 0) for r in held)
    assert right / len(held) > 0.95
    assert toxicity.judge(docs, labels.limit(0)).where("predicted = 1").count() == 0


def test_long_and_repeated_texts_do_not_empty_the_sample(spark):
    """Forty texts longer than the bound, and an id that holds a third of all rows."""
    rng = random.Random(6)
    text = lambda bad: " ".join(rng.choices([f"w{k}" for k in range(100)], k=30) + bad)
    rows = [(k, text(["vile"] if k % 3 == 0 else [])) for k in range(300)]
    long = [(1_000 + k, "vile " * 30_000) for k in range(40)]
    docs = spark.createDataFrame(rows + long + [(1, rows[1][1])] * 150, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0 or k >= 1_000)) for k, _ in rows + long],
                                   "doc_id long, toxic int")
    got = toxicity.judge(docs, labels, train_chars=140_000).collect()
    assert len(got) == 490
    wrong = sum(r.predicted != int(r.doc_id % 3 == 0 or r.doc_id >= 1_000) for r in got)
    assert wrong < 15


def test_all_labelled_texts_are_learnt_from(spark):
    """Words that five of 8,000 texts hold are known, whichever shard the texts are in."""
    rng = random.Random(7)
    rows = [(k, rng.choices([f"w{j}" for j in range(50)], k=8) + (["vile"] if k % 2 else []))
            for k in range(8_000)]
    learning = [k for k, _ in rows if zlib.crc32(str(k).encode()) % 5]
    rare = [f"r{j}" for j in range(50)]
    for word, holders in zip(rare, np.array(rng.sample(learning, 250)).reshape(50, 5)):
        for k in holders:
            rows[k][1].append(word)
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    codes = model.codes()
    assert all(codes[w.encode()] >> 32 != toxicity.BUCKETS for w in rare)
    held = [(k, w) for k, w in rows if k not in set(learning)]
    scores = model.scores([" ".join(w) for _, w in held], codes)
    assert ((scores >= 0.5) == [k % 2 for k, _ in held]).mean() > 0.95
    again = toxicity.fit(docs.repartition(7), labels)
    np.testing.assert_array_equal(model.words, again.words)
    np.testing.assert_array_equal(model.thresholds, again.thresholds)


def test_pieces_of_a_long_text_have_the_peaks_of_the_whole(monkeypatch):
    rng = np.random.default_rng(8)
    model = toxicity._start(bytes(toxicity.SLOTS // 8), bytes(toxicity.SLOTS // 8), 1)
    batch = [rng.integers(0, 40, n) << 32 | rng.integers(0, 40, n) << 8 for n in (3, 95, 4, 41, 60)]
    whole = toxicity._peaks(model, batch)
    monkeypatch.setattr(toxicity, "PIECE", 20)
    for a, b in zip(whole, toxicity._peaks(model, batch)):
        np.testing.assert_allclose(a, b, rtol=1e-5)
