"""Alignment of two tokenizers against a direct count, whatever the ranges."""

from __future__ import annotations

import hashlib
from collections import Counter
from functools import reduce

import numpy as np
import pytest
import tokenizers as hf
from sentencepiece import SentencePieceProcessor

from retinue.llm import alignment as al

TEXTS = ["a plain text, with 12 words or so", "", None, " ", "\n\n  two  spaces\t\tand tabs ",
         "<|endoftext|> and <s> are plain", "naïve café — 日本語のテキスト 🙂🙂 ok", "x", "a▁b",
         "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 40, "nul \0 byte", "a plain text, with 12 words or so",
         "word " * 3000, "é" * 500, "don't we'll I'M  x y　z", "ﬁ ﬂ ① Å é",
         "0123456789" * 30 + " end", "\r\n\x0b\x0c mixed lines"]


class Direct:
    def __init__(self):
        self.a = hf.Tokenizer.from_file(f"{al.TOKENIZERS}/{al.BYTE_BPE}")
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=f"{al.TOKENIZERS}/{al.PIECE_BPE}")
        byte = al.byte_alphabet()
        self.a_bytes = {i: bytes(byte[c] for c in t) for t, i in self.a.get_vocab().items()
                        if t != "<|endoftext|>"}

    def groups(self, text):
        """Groups of one text as (ids of a, ids of b)."""
        if not text:
            return []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        size_a = [len(self.a_bytes[i]) for i in a]
        pieces = [self.b.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i)
                   else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        whole = (" " + text).encode()
        if b"".join(self.a_bytes[i] for i in a) != whole or b"".join(bytes_b) != whole:
            return []
        out, x, y, at_x, at_y, left, right = [], 0, 0, 0, 0, [], []
        while x < len(a) or y < len(b):
            if at_x <= at_y:
                at_x += size_a[x]
                left.append(a[x])
                x += 1
            else:
                at_y += len(bytes_b[y])
                right.append(b[y])
                y += 1
            if at_x == at_y:
                out.append((left, right))
                left, right = [], []
        return out


def expected(texts):
    direct = Direct()
    docs = [direct.groups(t) for t in texts]
    links = [Counter((i, j) for a, b in groups for i in a for j in b) for groups in docs]
    n = Counter(p for d in links for p in d)
    most = {}
    for (i, _), k in n.items():
        most[i] = max(most.get(i, 0), k)
    rows = []
    for k, (groups, of) in enumerate(zip(docs, links)):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        rows.append((k, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups),
                     len(groups), sum(of.values()),
                     sum(t for p, t in of.items() if n[p] == most[p[0]]),
                     sum(t * n[p] for p, t in of.items()),
                     hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return rows


@pytest.mark.parametrize("range_bytes,block_pairs", [(65_536, 1_000_000), (7, 40), (300, 300)])
def test_align(spark, range_bytes, block_pairs):
    docs = spark.createDataFrame(
        [(k, t, k, "x") for k, t in enumerate(TEXTS)], "doc_id long, text string, row long, at string")
    got = al.align(docs, range_bytes=range_bytes, block_pairs=block_pairs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                           "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == expected(TEXTS)


def test_empty_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "same"), (None, "same"), (1, None)], "doc_id long, text string")
    got = sorted(map(tuple, al.align(docs).collect()), key=str)
    assert [r[0] for r in got] == [1, None, None] and got[1] == got[2]
    assert got[1][6] == 2 * got[1][4]
    assert al.align(docs.limit(0)).collect() == []


def test_fragments_are_a_monoid():
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 4, (2, 200))
    a, b = rng.integers(0, 5, (2, 200))
    ends_a, ends_b = np.cumsum(sizes, axis=1)
    ends_a[-1] = ends_b[-1] = max(ends_a[-1], ends_b[-1])
    whole = al.whole(al.fragment(a, ends_a, b, ends_b))
    for size in (1, 5, 90):
        parts = [f for _, f in al._ranges(a, ends_a, b, ends_b, size)]
        left = reduce(al.Fragment.join, parts, al.Fragment())
        right = reduce(lambda x, y: y.join(x), reversed(parts), al.Fragment())
        k = len(parts) // 2
        middle = reduce(al.Fragment.join, parts[:k], al.Fragment()).join(
            reduce(al.Fragment.join, parts[k:], al.Fragment()))
        for f in (left, right, middle, al.Fragment.unpacked(left.packed())):
            assert al.whole(f).text == whole.text and al.whole(f).n_links == whole.n_links
            assert al.whole(f).pairs.tolist() == whole.pairs.tolist()
            assert al.whole(f).times.tolist() == whole.times.tolist()


def test_merges_are_by_rank():
    """Each token can only arise by the merge that the file lists for it."""
    import json

    with open(f"{al.TOKENIZERS}/{al.BYTE_BPE}", encoding="utf-8") as f:
        merges = json.load(f)["model"]["merges"]
    byte = al.byte_alphabet()
    plain = lambda t: bytes(byte[c] for c in t)
    ranks = al.vocabulary(f"{al.TOKENIZERS}/{al.BYTE_BPE}")
    before = -1
    for merge in merges:
        left, right = map(plain, merge.split(" ") if isinstance(merge, str) else merge)
        rank = ranks[left + right]
        assert rank > before
        before, parts = rank, [bytes([c]) for c in left + right]
        while len(parts) > 2:
            best = min(range(len(parts) - 1),
                       key=lambda k: ranks.get(parts[k] + parts[k + 1], 1 << 60))
            assert ranks[parts[best] + parts[best + 1]] < rank
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        assert parts == [left, right]
