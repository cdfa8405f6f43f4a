"""Alignment of two tokenizers over the same texts, by an associative monoid of fragments.

A text is cut into groups at the byte offsets where tokens of both tokenizers end. A byte
range of a text gives a ``Fragment``: an open prefix (tokens up to the first common end,
whose group may have begun before the range), the closed groups inside, and an open suffix
(tokens after the last common end). Joining two neighbours closes the left one's suffix and
the right one's prefix into one group; the operation is associative and the empty fragment
is its identity. So the ranges of a very long text are reduced as a tree, a level a shuffle,
in which closed groups travel as a summary of what they hold.

Which pairs of ids share a group is counted over the whole corpus. Documents are kept in
blocks with a dictionary of the block's pairs; only dictionaries are counted, and the counts
come back to the blocks, so a pair that every document holds is one row a block.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from retinue.llm.common import written

TOKENIZERS = "/opt/tokenizers"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Texts longer than this many bytes are cut into ranges of this size.
RANGE_BYTES = 65_536
#: A block of documents ends at so many pairs of a document and ids.
BLOCK_PAIRS = 1_000_000
#: Fragments joined by one task of a level of the tree.
FAN_IN = 8
#: Characters tokenized at once in a task.
BATCH_CHARS = 1_000_000
#: Groups with more pairs than this are paired by their distinct ids, one by one.
WIDE_GROUP = 4_096
SHIFT = 32

#: Fixed value: the pattern by which the byte-level vocabulary splits texts into words.
WORDS = (r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")

BLOCK_SCHEMA = (
    "block long, doc_ids array<string>, n_a array<long>, n_b array<long>, n_groups array<long>, "
    "n_links array<long>, sha array<string>, starts binary, at binary, times binary, pairs binary"
)
FRAGMENT_SCHEMA = "row long, doc_id string, part long, fragment binary"


def byte_alphabet() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable Latin-1
    characters stand for themselves, the other bytes for the characters from 256 on."""
    plain = [b for b in range(256)
             if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def vocabulary(path: str) -> dict[bytes, int]:
    """Bytes and id of each ordinary token of a byte-level BPE file."""
    with open(path, encoding="utf-8") as f:
        stored = json.load(f)
    special = {t["content"] for t in stored["added_tokens"]}
    byte = byte_alphabet()
    return {bytes(byte[c] for c in token): i
            for token, i in stored["model"]["vocab"].items() if token not in special}


class Tokenizers:
    """Both tokenizers of one process, with the bytes of every id.

    The byte-level one is run by rank: its merges are in the order of its ids and each is
    the only way its token can arise, so both ways give the same tokens.
    """

    def __init__(self, folder: str):
        import sentencepiece
        import tiktoken

        ranks = vocabulary(os.path.join(folder, BYTE_BPE))
        self.byte_bpe = tiktoken.Encoding(
            "byte-level", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(
            model_file=os.path.join(folder, PIECE_BPE))
        self.a_bytes = [b""] * (1 + max(ranks.values()))
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b_bytes = [self._piece(i) for i in range(self.pieces.get_piece_size())]
        self.a_size = np.array([len(b) for b in self.a_bytes])
        self.b_size = np.array([len(b) for b in self.b_bytes])

    def _piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        if self.pieces.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of each text by both; none where the bytes are not those of the text."""
        found = []
        second = self.pieces.encode(texts, num_threads=1)
        for text, b in zip(texts, second):
            whole = " " + text
            a, data = self.byte_bpe.encode_ordinary(whole), whole.encode()
            same = (text and b"".join([self.a_bytes[i] for i in a]) == data
                    and b"".join([self.b_bytes[i] for i in b]) == data)
            found.append((a, b) if same else ([], []))
        return found


@lru_cache(1)
def tokenizers(folder: str) -> Tokenizers:
    return Tokenizers(folder)


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sum of their numbers."""
    if not len(keys):
        return keys.astype(np.int64), times.astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(times, np.nonzero(first)[0])


def linked(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of ids in the same group, how often, and the group, for groups of ``n_a`` ids of
    ``a`` and ``n_b`` of ``b`` in turn. A pair may come several times in a group."""
    start_a, start_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    wide = n_a * n_b > WIDE_GROUP
    group = np.repeat(np.arange(len(n_a)), n_a)
    wanted = ~wide[group]
    each = n_b[group][wanted]
    at = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    at += np.repeat(start_b[group][wanted], each)
    keys = [np.repeat(a[wanted].astype(np.int64), each) << SHIFT | b[at]]
    times, groups = [np.ones(len(at), dtype=np.int64)], [np.repeat(group[wanted], each)]
    for g in np.nonzero(wide)[0]:
        left, of_left = np.unique(a[start_a[g]:start_a[g] + n_a[g]], return_counts=True)
        right, of_right = np.unique(b[start_b[g]:start_b[g] + n_b[g]], return_counts=True)
        keys.append((left.astype(np.int64)[:, None] << SHIFT | right[None, :]).ravel())
        times.append((of_left[:, None] * of_right[None, :]).ravel())
        groups.append(np.full(len(keys[-1]), g))
    return np.concatenate(keys), np.concatenate(times), np.concatenate(groups)


def group_text(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> list[str]:
    """Each group as ``a1,a2|b1``."""
    ends_a, ends_b = np.cumsum(n_a).tolist(), np.cumsum(n_b).tolist()
    left, right = list(map(str, a.tolist())), list(map(str, b.tolist()))
    out, i, j = [], 0, 0
    for x, y in zip(ends_a, ends_b):
        if x - i == 1 and y - j == 1:
            out.append(left[i] + "|" + right[j])
        else:
            out.append(",".join(left[i:x]) + "|" + ",".join(right[j:y]))
        i, j = x, y
    return out


def _ints(values=()) -> np.ndarray:
    return np.asarray(values, dtype=np.int64)


@dataclass
class Fragment:
    """Tokens of a byte range: open prefix, closed groups in sum, open suffix.

    Without a common end (``cut`` false) all tokens are in the prefix.
    """

    cut: bool = False
    prefix: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: (_ints(), _ints()))
    suffix: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: (_ints(), _ints()))
    text: str = ""
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    pairs: np.ndarray = field(default_factory=_ints)
    times: np.ndarray = field(default_factory=_ints)

    def join(self, right: Fragment) -> Fragment:
        """This range followed by ``right``."""
        open_ = self.suffix if self.cut else self.prefix
        open_ = tuple(np.concatenate(x) for x in zip(open_, right.prefix))
        if not self.cut:
            return Fragment(right.cut, open_, right.suffix, right.text, right.n_a, right.n_b,
                            right.n_groups, right.n_links, right.pairs, right.times)
        if not right.cut:
            return Fragment(True, self.prefix, open_, self.text, self.n_a, self.n_b,
                            self.n_groups, self.n_links, self.pairs, self.times)
        return closed(self, open_, right)

    def packed(self) -> bytes:
        head = json.dumps([self.cut, self.text, self.n_a, self.n_b, self.n_groups, self.n_links,
                           *(len(x) for x in self._arrays())]).encode()
        return len(head).to_bytes(8, "little") + head + b"".join(
            x.tobytes() for x in self._arrays())

    def _arrays(self) -> tuple[np.ndarray, ...]:
        return (*self.prefix, *self.suffix, self.pairs, self.times)

    @staticmethod
    def unpacked(data: bytes) -> Fragment:
        at = 8 + int.from_bytes(data[:8], "little")
        cut, text, n_a, n_b, n_groups, n_links, *sizes = json.loads(data[8:at])
        arrays = []
        for size in sizes:
            arrays.append(np.frombuffer(data, np.int64, size, at))
            at += 8 * size
        return Fragment(cut, tuple(arrays[:2]), tuple(arrays[2:4]), text, n_a, n_b, n_groups,
                        n_links, *arrays[4:])


def closed(left: Fragment, group: tuple[np.ndarray, np.ndarray], right: Fragment) -> Fragment:
    """Both neighbours around a group that has just been closed."""
    a, b = group
    n_a, n_b = _ints([len(a)]), _ints([len(b)])
    pairs, times, _ = linked(a, b, n_a, n_b)
    texts = [left.text, *group_text(a, b, n_a, n_b), right.text]
    pairs, times = _summed(np.concatenate([left.pairs, pairs, right.pairs]),
                           np.concatenate([left.times, times, right.times]))
    return Fragment(
        True, left.prefix, right.suffix, ";".join(t for t in texts if t),
        left.n_a + len(a) + right.n_a, left.n_b + len(b) + right.n_b,
        left.n_groups + 1 + right.n_groups, left.n_links + len(a) * len(b) + right.n_links,
        pairs, times)


def fragment(a: np.ndarray, ends_a: np.ndarray, b: np.ndarray, ends_b: np.ndarray) -> Fragment:
    """The fragment of a byte range, of the tokens that end in it and where they end."""
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    if not len(cuts):
        return Fragment(prefix=(a, b))
    of_a, of_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
    n_a, n_b = (np.bincount(x, minlength=len(cuts) + 1) for x in (of_a, of_b))
    inner = slice(n_a[0], len(a) - n_a[-1]), slice(n_b[0], len(b) - n_b[-1])
    in_a, in_b, k_a, k_b = a[inner[0]], b[inner[1]], n_a[1:-1], n_b[1:-1]
    pairs, times, _ = linked(in_a, in_b, k_a, k_b)
    pairs, times = _summed(pairs, times)
    return Fragment(
        True, (a[:n_a[0]], b[:n_b[0]]), (a[inner[0].stop:], b[inner[1].stop:]),
        ";".join(group_text(in_a, in_b, k_a, k_b)), len(in_a), len(in_b), len(k_a),
        int((k_a * k_b).sum()), pairs, times)


def whole(found: Fragment) -> Fragment:
    """A complete text: its prefix is a group, as it begins where the text does."""
    return closed(Fragment(cut=True), found.prefix, found) if found.cut else Fragment()


def _ranges(a, ends_a, b, ends_b, size: int) -> Iterator[tuple[int, Fragment]]:
    last = int(ends_a[-1]) if len(ends_a) else 0
    for part, low in enumerate(range(0, last, size)):
        x = slice(*np.searchsorted(ends_a, [low, low + size], side="right"))
        y = slice(*np.searchsorted(ends_b, [low, low + size], side="right"))
        yield part, fragment(a[x], ends_a[x], b[y], ends_b[y])


class _Blocks:
    """Documents of a task gathered into block rows."""

    def __init__(self, limit: int, numbers: Iterator[int]):
        self.limit, self.numbers = limit, numbers
        self._clear()

    def _clear(self) -> None:
        self.rows, self.pairs, self.times, self.sizes, self.held = [], [], [], [], 0

    def add(self, doc_ids, n_a, n_b, n_groups, n_links, sha, sizes, pairs, times) -> bool:
        """Documents with the number of their distinct pairs; true when the block is full."""
        self.rows.append((doc_ids, n_a, n_b, n_groups, n_links, sha))
        self.pairs.append(pairs)
        self.times.append(times)
        self.sizes.append(sizes)
        self.held += len(pairs) + len(doc_ids)
        return self.held >= self.limit

    def flush(self) -> dict | None:
        if not self.rows:
            return None
        distinct, at = np.unique(np.concatenate(self.pairs), return_inverse=True)
        columns = [np.concatenate([np.asarray(r[k], dtype=object) for r in self.rows]).tolist()
                   for k in range(6)]
        starts = np.cumsum(np.concatenate([[0], *self.sizes]))
        made = dict(zip(("doc_ids", "n_a", "n_b", "n_groups", "n_links", "sha"), columns))
        made |= {"block": next(self.numbers), "starts": starts.astype("<i8").tobytes(),
                 "at": at.astype("<u4").tobytes(),
                 "times": np.concatenate(self.times).astype("<i8").tobytes(),
                 "pairs": distinct.astype("<i8").tobytes()}
        self._clear()
        return made


def _short(texts: list[tuple[list[int], list[int]]], tools: Tokenizers):
    """Counts, texts and pairs of several whole texts at once."""
    n = len(texts)
    size_a, size_b = (_ints([len(t[k]) for t in texts]) for k in (0, 1))
    a = _ints([i for t in texts for i in t[0]])
    b = _ints([i for t in texts for i in t[1]])
    ends_a, ends_b = np.cumsum(tools.a_size[a]), np.cumsum(tools.b_size[b])
    # Every text ends in a cut, so texts one after another need no marks between them.
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    n_a = np.bincount(np.searchsorted(cuts, ends_a), minlength=len(cuts))
    n_b = np.bincount(np.searchsorted(cuts, ends_b), minlength=len(cuts))
    last = np.concatenate([[0], ends_a])[np.cumsum(size_a)]
    stop = np.searchsorted(cuts, last, side="right")
    start = np.concatenate([[0], stop[:-1]])
    groups = group_text(a, b, n_a, n_b)
    sha = [hashlib.sha256(";".join(groups[i:j]).encode()).hexdigest() if j > i else ""
           for i, j in zip(start.tolist(), stop.tolist())]
    links = np.concatenate([[0], np.cumsum(n_a * n_b)])
    doc_of = np.repeat(np.arange(n), stop - start)
    pairs, times, group = linked(a, b, n_a, n_b)
    doc = doc_of[group]
    order = np.lexsort((pairs, doc))
    pairs, times, doc = pairs[order], times[order], doc[order]
    first = np.ones(len(pairs), dtype=bool)
    first[1:] = (pairs[1:] != pairs[:-1]) | (doc[1:] != doc[:-1])
    if len(pairs):
        times = np.add.reduceat(times, np.nonzero(first)[0])
    return (size_a, size_b, stop - start, links[stop] - links[start], sha,
            np.bincount(doc[first], minlength=n), pairs[first], times)


def _numbers() -> Iterator[int]:
    """Numbers that no other task gives."""
    k = TaskContext.get().partitionId() << 40
    while True:
        yield k
        k += 1


def encode(docs: DataFrame, folder: str, range_bytes: int, block_pairs: int) -> DataFrame:
    """Blocks of short documents and fragments of long ones; columns of the other are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tools, numbers = tokenizers(folder), _numbers()
        blocks = _Blocks(block_pairs, numbers)
        for rows in batches:
            ids, texts = (rows.column(c).to_pylist() for c in ("doc_id", "text"))
            part_of = np.cumsum([len(t or "") + 64 for t in texts]) // BATCH_CHARS
            for part in np.split(np.arange(len(ids)), np.nonzero(np.diff(part_of))[0] + 1):
                coded = tools.encode([texts[k] or "" for k in part])
                size = [int(tools.a_size[_ints(t[0])].sum()) for t in coded]
                short = [k for k, n in enumerate(size) if n <= range_bytes]
                if short and blocks.add(
                        [ids[part[k]] for k in short], *_short([coded[k] for k in short], tools)):
                    yield blocks.flush()
                for k in (k for k, n in enumerate(size) if n > range_bytes):
                    a, b = map(_ints, coded[k])
                    row = next(numbers)
                    for p, f in _ranges(a, np.cumsum(tools.a_size[a]), b,
                                        np.cumsum(tools.b_size[b]), range_bytes):
                        yield {"row": row, "doc_id": ids[part[k]], "part": p,
                               "fragment": f.packed()}
        if made := blocks.flush():
            yield made

    both = f"{BLOCK_SCHEMA}, {FRAGMENT_SCHEMA}"
    return docs.mapInArrow(_rows(run, both), both)


def _rows(run, schema: str):
    """Dictionaries as Arrow batches of one row each."""
    types = to_arrow_schema(StructType.fromDDL(schema))

    def batches(given):
        for row in run(given):
            yield pa.RecordBatch.from_pylist([{c: row.get(c) for c in types.names}], types)

    return batches


def reduce_tree(fragments: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """(row, doc_id, fragment) of whole documents, by joining neighbours level by level."""

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        made = Fragment()
        for data in rows["fragment"]:
            made = made.join(Fragment.unpacked(data))
        first = rows.iloc[0]
        return pd.DataFrame([(first["row"], first["doc_id"], first["up"], made.packed())],
                            columns=["row", "doc_id", "part", "fragment"])

    while (fragments.agg(F.max("part")).first()[0] or 0) > 0:
        up = fragments.withColumn("up", F.floor(F.col("part") / fan_in))
        fragments = written(up.groupBy("row", "up").applyInPandas(join, FRAGMENT_SCHEMA),
                            "align-level")
    return fragments


def _whole_blocks(fragments: DataFrame, block_pairs: int) -> DataFrame:
    """Blocks of documents that were reduced from fragments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        # Numbers of the first pass are below these.
        blocks = _Blocks(block_pairs, (1 << 62 | k for k in _numbers()))
        for rows in batches:
            for doc_id, data in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "fragment"))):
                f = whole(Fragment.unpacked(data))
                sha = hashlib.sha256(f.text.encode()).hexdigest() if f.n_groups else ""
                if blocks.add([doc_id], [f.n_a], [f.n_b], [f.n_groups], [f.n_links], [sha],
                              [len(f.pairs)], f.pairs, f.times):
                    yield blocks.flush()
        if made := blocks.flush():
            yield made

    return fragments.mapInArrow(_rows(run, BLOCK_SCHEMA), BLOCK_SCHEMA)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold each pair linked, and whether no other pair of
    its first id is held by more."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for at, pairs in zip(rows["at"], rows["pairs"]):
                pairs = np.frombuffer(pairs, "<i8")
                n = np.bincount(np.frombuffer(at, "<u4"), minlength=len(pairs))
                yield pd.DataFrame({"pair": pairs, "n": n})

    counts = written(
        blocks.select("at", "pairs").mapInPandas(count, "pair long, n long")
        .groupBy("pair").agg(F.sum("n").alias("n")), "align-counts")
    first = F.shiftright("pair", SHIFT).alias("a")
    most = counts.groupBy(first).agg(F.max("n").alias("most"))
    return counts.withColumn("a", first).join(most, "a").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(
    docs: DataFrame,
    folder: str = TOKENIZERS,
    range_bytes: int = RANGE_BYTES,
    block_pairs: int = BLOCK_PAIRS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), a row a row.

    Tokens are those of a space and the text by the byte-level BPE (a) and of the text by
    the piece BPE (b), which puts the space there itself; both files are in ``folder`` on
    every machine. Strings of special tokens are ordinary text. Texts that are null, empty
    or that the tokens of either do not spell have no tokens: zeros and ''. A link is a pair of
    occurrences in one group; ``count`` of an id pair is the number of rows whose text
    holds it linked; ``n_best`` are the links whose count is the highest of their a id, ties
    included, ``count_sum`` the sum over all links.

    Repeated rows are documents each, as are rows with null id. A very long text is tokenized
    whole by one task and cut into byte ranges. An empty table gives an empty result; other
    columns are not read.
    """
    kind = docs.schema[doc_id].dataType
    narrow = docs.select(F.col(doc_id).cast("string").alias("doc_id"),
                         F.col(text).cast("string").alias("text"))
    coded = written(encode(narrow, folder, range_bytes, block_pairs), "align-coded")
    names = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")]
    long = reduce_tree(coded.where("fragment IS NOT NULL").select(
        "row", "doc_id", "part", "fragment"))
    long = written(_whole_blocks(long, block_pairs), "align-long")
    blocks = coded.where("block IS NOT NULL").select(*names).unionByName(long)
    counts = written(pair_counts(blocks), "align-pairs")

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for block, pairs in zip(rows["block"], rows["pairs"]):
                yield pd.DataFrame({"block": block, "pair": np.frombuffer(pairs, "<i8")})

    asked = blocks.select("block", "pairs").mapInPandas(ask, "block long, pair long")
    answers = asked.join(counts, "pair")

    def total(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        answers = answers.sort_values("pair")
        row = next(blocks.itertuples(index=False))  # the only one of its number
        starts = np.frombuffer(row.starts, "<i8")
        at, times = np.frombuffer(row.at, "<u4"), np.frombuffer(row.times, "<i8")
        best, n = (answers[c].to_numpy(np.int64)[at] * times for c in ("best", "n"))
        best, n = (np.concatenate([[0], np.cumsum(x)])[starts] for x in (best, n))
        return pd.DataFrame({
            "doc_id": row.doc_ids, "n_a": row.n_a, "n_b": row.n_b, "n_groups": row.n_groups,
            "n_links": row.n_links, "n_best": np.diff(best), "count_sum": np.diff(n),
            "groups_sha256": row.sha})

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        total, "doc_id string, n_a long, n_b long, n_groups long, n_links long, n_best long, "
        "count_sum long, groups_sha256 string").withColumn("doc_id", F.col("doc_id").cast(kind))
