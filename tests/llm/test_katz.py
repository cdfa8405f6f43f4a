"""Backoff scores against a model of plain dictionaries."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from retinue.llm import katz


def words_of(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), 1]


def discounts(times, least):
    n = {r: times.get(r, 0) for r in range(1, 7)}
    rest = 6 * n[6] / n[1] if n[1] else 1.0
    out = {}
    for r in range(1, 6):
        d = ((r + 1) * n[r + 1] / n[r] / r - rest) / (1 - rest) if n[r] and n[r + 1] and rest < 1 \
            else 1.0
        out[r] = 0.0 if r < least else d if 0 < d < 1 else 1.0
    return out


class Plain:
    def __init__(self, texts, least):
        tokens = [words_of(t) for t in texts]
        self.c = Counter(w for t in tokens for w in t)
        self.b = Counter(p for t in tokens for p in zip([0, *t], t))
        self.n = sum(self.c.values())
        d = discounts(Counter(self.c.values()), 1)
        raw = {w: c * d.get(c, 1.0) / self.n for w, c in self.c.items()}
        mass = sum(raw.values())
        self.unknown = max(1 - mass, 1 / (self.n + 1))
        self.p = {w: x * (1 - self.unknown) / mass for w, x in raw.items()}
        d = discounts(Counter(self.b.values()), least)
        kept = {p: c * d.get(c, 1.0) for p, c in self.b.items() if c >= least}
        self.q, self.alpha = {}, {}
        for h in {h for h, _ in kept}:
            after = {w: x for (g, w), x in kept.items() if g == h}
            seen = self.c[h or 1]
            left = max(1 - sum(after.values()) / seen, 1 / (seen + 1))
            for w, x in after.items():
                self.q[h, w] = x * (1 - left) / sum(after.values())
            self.alpha[h] = left / (1 - sum(self.p[w] for w in after))

    def prob(self, h, w):
        return self.q.get((h, w)) or self.alpha.get(h, 1.0) * self.p.get(w, self.unknown)


def corpus(n):
    rng = random.Random(4)
    usual = "the of and to in is that it for was".split()
    text = lambda: " ".join(
        rng.choice(usual) if rng.random() < 0.6 else f"w{int(rng.paretovariate(0.7))}"
        for _ in range(rng.choice([1, 5, 40, 300])))
    rows = [(k, text()) for k in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, "Is onhe. " * 200), (3, rows[3][1]),
                   (None, "THE of"), (n + 3, "\t never seen before ")]


@pytest.mark.parametrize("slices,least", [(5, 3), (12, 2)])
def test_equals_plain_model(spark, slices, least):
    rows = corpus(120)
    docs = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, key int")
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    plain = Plain([t for d, t in rows if not held(d)], least)
    got = katz.judge(docs, slices=slices, min_count=least).collect()
    assert len(got) == len(rows)
    want = {}
    for d, t in rows:
        tokens = words_of(t)
        base = sum(math.log10((plain.c[w] + 0.1) / (plain.n + 0.1 * (len(plain.c) + 1)))
                   for w in tokens)
        log_p = sum(math.log10(plain.prob(h, w)) for h, w in zip([0, *tokens], tokens))
        want[d] = (held(d), len(tokens), sum(plain.c[w] > 0 for w in tokens), plain.n, base, log_p)
    for r in got:
        assert tuple(r)[1:5] == want[r.doc_id][:4]
        assert r.base_score == pytest.approx(want[r.doc_id][4])
        assert r.score == pytest.approx(want[r.doc_id][5])


def test_default_model_has_bigrams_seen_once(spark):
    rows = corpus(120)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    plain = Plain([t for d, t in rows if not held(d)], 1)
    assert any(n == 1 and (h, w) in plain.q for (h, w), n in plain.b.items())
    for r in katz.judge(docs, slices=7).collect():
        tokens = words_of(dict(rows)[r.doc_id])
        assert r.score == pytest.approx(
            sum(math.log10(plain.prob(h, w)) for h, w in zip([0, *tokens], tokens)))


def test_probabilities_after_a_history_sum_to_one():
    plain = Plain([t for _, t in corpus(150)], 3)
    for h in [0, *list(plain.alpha)[:20], "never"]:
        total = sum(plain.prob(h, w) for w in plain.c) + plain.prob(h, object())
        assert total == pytest.approx(1.0)


def test_nothing_to_learn_from(spark):
    schema = "doc_id long, text string"
    assert katz.judge(spark.createDataFrame([], schema), slices=3).count() == 0
    alone = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 10 == 0)
    row = katz.judge(spark.createDataFrame([(alone, "a b")], schema), slices=3).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.score) == (3, 0, 0, 0.0)


def test_counts_of_a_slice_span_rows(monkeypatch):
    slicing = katz.Slicing(3, np.array([katz.START, 7]))
    texts = [np.array([7, 5, 7, 8, 11, 5]), np.array([5, 7, 5]), np.zeros(0, np.int64)]
    packs = [p for t in ([texts[0]], texts[1:]) for p in katz._packs(t, slicing, False)]
    monkeypatch.setattr(katz, "TABLE_ROW", 2)
    got, asked = Counter(), set()
    for s in range(3):
        rows = katz._frame([(p[0], katz._PACK, 0, 0, *p[1:]) for p in packs if p[0] == s],
                           katz._PACKED)
        out = katz._frame(list(katz._counted(rows, slicing, 1)), katz._PACKED)
        for r in out[out.kind.isin([katz._TABLE, katz._HOT_TABLE])].itertuples():
            columns = katz._unpacked(r)
            assert len(columns[0]) <= 2
            for h, w, n in zip(*columns):
                got[int(h), int(w)] += int(n)
        for r in out[out.kind == katz._WANTED].itertuples():
            words = katz._unpack_sorted(r.words)
            assert set(words % 3) == {r.slice} and r.base == s
            asked |= set(words.tolist())
    ended = [[*t.tolist(), katz.END] for t in texts]
    assert got == Counter(p for t in ended for p in zip([katz.START, *t], t))
    assert asked == {5, 8, 11}  # neither the frequent word nor the end of text


def test_very_long_text(spark):
    text = " ".join(f"w{k % 997}" for k in range(400_000))
    rows = [(k, t) for k, t in enumerate(["w1 w2", text, "w3 W4"]) for _ in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = lambda d: zlib.crc32(str(d).encode()) % 10 == 0
    plain = Plain([t for d, t in rows if not held(d)], 1)
    for r in katz.judge(docs, slices=4).collect():
        tokens = words_of(dict(rows)[r.doc_id])
        assert r.n_tokens == len(tokens)
        assert r.score == pytest.approx(
            sum(math.log10(plain.prob(h, w)) for h, w in zip([0, *tokens], tokens)))
