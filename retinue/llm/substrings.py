"""Removal of repeated passages by anchors on a difference cover.

A window of ``window`` words repeats if the same words start a window earlier. Hashing every
window is not needed to find the repeats: with a difference cover D of a period v (each
difference modulo v is one of two members of D), any two equal windows of at least
``v - 1 + w`` words have an offset below v at which both stand on a cover position, wherever
they begin. So only runs of w words at cover positions (``anchors``) are hashed and compared,
4 of 13 positions for the default, and windows are looked at only where they contain an
anchor that occurs elsewhere too: there the match is extended to the whole window by a
96-bit hash, and of equal windows all but the earliest are marked.

Anchors and windows travel packed, by slices of their hash. A task keeps only its earliest
copy of a window and marks the others at once, so that a passage of very many documents is
one entry a task. Equal texts are one text; its copies repeat it as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retinue.llm.common import WORD, word_count, written

WINDOW, PERIOD = 20, 13
#: Characters of text whose hashes make up one slice, and what a task gathers before packing.
SLICE_CHARS = 48_000_000
FLUSH_WORDS = 1_500_000
#: Characters split into words at once.
BATCH_CHARS = 1_500_000
#: Repeated rows are spelled out in runs of this many.
COPIES = 10_000

#: Odd bases of the two polynomial hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Order of documents: known ids first, then by id, then by digest.
PLACE = np.dtype([("none", "u1"), ("id", "<i8"), ("a", "<u8"), ("b", "<u8")])

ANCHOR_SCHEMA = "slice int, docs binary, hash binary, doc binary, at binary"
WINDOW_SCHEMA = "slice int, docs binary, high binary, low binary, doc binary, at binary"
FOUND_SCHEMA = "bucket int, docs binary, doc binary, at binary"
DIGEST = "<u8,<u8"


@lru_cache(8)
def difference_cover(period: int) -> tuple[int, ...]:
    """A smallest set, with 0 in it, whose differences are all residues of ``period``."""
    for size in range(1, period + 1):
        for rest in combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(x - y) % period for x in cover for y in cover}) == period:
                return cover
    raise ValueError(f"no period: {period}")


class Hashes:
    """Hashes of any run of words out of a stream, by two polynomials over word hashes."""

    def __init__(self, words: list[bytes]):
        stored = np.empty(len(words), dtype=object)
        stored[:] = words
        first = pd.util.hash_array(stored, categorize=False).astype(np.uint64)
        second = (first ^ (first >> np.uint64(31))) * np.uint64(0xFF51AFD7ED558CCD)
        self.sums, self.back = [], []
        for values, base in zip((first, second ^ (second >> np.uint64(33))), BASES):
            powers, inverse = _powers(base, len(words))
            self.sums.append(np.concatenate(
                [np.zeros(1, np.uint64), np.cumsum(values * powers, dtype=np.uint64)]))
            self.back.append(inverse)

    def runs(self, at: np.ndarray, length: int, which: int = 0) -> np.ndarray:
        sums = self.sums[which]
        mixed = (sums[at + length] - sums[at]) * self.back[which][at]
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return mixed ^ (mixed >> np.uint64(32))


def _powers(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    made = []
    for b in (base, pow(base, -1, 2**64)):
        run = np.full(count, b, dtype=np.uint64)
        run[:1] = 1
        made.append(np.multiply.accumulate(run))
    return made[0], made[1]


def _words(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """The words of several texts in turn, and how many each has."""
    split = [t.encode().split() for t in texts]
    return [w for words in split for w in words], np.array([len(w) for w in split], dtype=np.int64)


def _parts(texts: list[str]) -> Iterator[np.ndarray]:
    part = np.cumsum([len(t) for t in texts]) // BATCH_CHARS
    yield from np.split(np.arange(len(texts)), np.nonzero(np.diff(part))[0] + 1)


def _pick(keys: list[np.ndarray], count: int) -> Iterator[tuple[int, slice]]:
    """Slices (by the first key) that occur, with where they lie in the sorted entries."""
    bounds = np.searchsorted(keys[0], np.arange(count + 1))
    for s in np.nonzero(np.diff(bounds))[0]:
        yield int(s), slice(bounds[s], bounds[s + 1])


def _referred(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The documents of entries that are in their order, and how many entries each has."""
    used, counts = np.unique(doc, return_counts=True)
    return used, counts.astype("<u4")


def anchors(rows: DataFrame, slices: int, window: int, period: int, flush: int) -> DataFrame:
    """Packed anchors of the texts: by slice, their hashes, documents and positions."""
    cover, width = difference_cover(period), window - period + 1
    types = _types(ANCHOR_SCHEMA)

    def pack(digests, hashes, docs, at) -> Iterator[dict]:
        hashes, docs, at = map(np.concatenate, (hashes, docs, at))
        by = (hashes % np.uint64(slices)).astype(np.int64)
        order = np.argsort(by, kind="stable")
        names = np.frombuffer(b"".join(digests), "V16")
        # Half of the hash will do within a slice: a coincidence costs a look, no result.
        hashes = (hashes >> np.uint64(32)).astype("<u4")
        for s, here in _pick([by[order]], slices):
            used, doc = _referred(docs[order[here]])
            yield {"slice": s, "docs": names[used].tobytes(), "hash": hashes[order[here]].tobytes(),
                   "doc": doc.tobytes(), "at": at[order[here]].astype("<u4").tobytes()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen, held, found = {}, 0, ([], [], [])
        for batch in batches:
            digests, texts = (batch.column(c).to_pylist() for c in ("digest", "text"))
            for part in _parts(texts):
                part = [k for k in part if digests[k] not in seen and not seen.update(
                    {digests[k]: len(seen)})]
                words, sizes = _words([texts[k] for k in part])
                if not words:
                    continue
                doc = np.repeat([seen[digests[k]] for k in part], sizes)
                at = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                fits = np.isin(at % period, cover) & (
                    at + width <= np.repeat(np.where(sizes >= window, sizes, 0), sizes))
                where = np.nonzero(fits)[0]
                for into, values in zip(found, (Hashes(words).runs(where, width), doc[where],
                                                at[where])):
                    into.append(values)
                held += len(where)
                if held >= flush:
                    yield from pack(list(seen), *found)
                    seen, held, found = {}, 0, ([], [], [])
        if held:
            yield from pack(list(seen), *found)

    return rows.mapInArrow(_dicts(run, types), ANCHOR_SCHEMA)


def _types(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(),
             "spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))}
    return pa.schema([(c.split()[0], kinds.get(c.split()[1], kinds["spans"]))
                      for c in schema.split(", ")])


def _dicts(run, types: pa.Schema, rows: int = 64):
    """Dictionaries as small Arrow batches."""

    def batches(given):
        held = []
        for row in run(given):
            held.append(row)
            if len(held) == rows:
                yield pa.RecordBatch.from_pylist(held, types)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, types)

    return batches


def _joined(packs: pd.DataFrame, column: str, kind: str) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, kind) for x in packs[column]])


def _documents(packs: pd.DataFrame, kind) -> tuple[np.ndarray, np.ndarray]:
    """The distinct documents of several packs, in order, and that of each entry."""
    names, at = np.unique(_joined(packs, "docs", kind), return_inverse=True)
    return names, np.repeat(at, _joined(packs, "doc", "<u4"))


def _by_bucket(names: np.ndarray, doc: np.ndarray, at: np.ndarray, buckets: int) -> Iterator[dict]:
    """Positions in documents, packed by buckets of digests, so that rows do not multiply
    where a document has some in every slice."""
    by = (names["f0"] % np.uint64(buckets)).astype(np.int64)[doc]
    order = np.lexsort((at, doc, by))
    by, doc, at = by[order], doc[order], at[order]
    for bucket, here in _pick([by], buckets):
        used, local = _referred(doc[here])
        yield {"bucket": bucket, "docs": names[used].tobytes(), "doc": local.tobytes(),
               "at": at[here].astype("<u4").tobytes()}


def gather(packs: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: each document with all its positions."""
    names, doc = _documents(packs, DIGEST)
    at = _joined(packs, "at", "<u4")
    order = np.argsort(doc, kind="stable")
    at, bounds = at[order], np.searchsorted(doc[order], np.arange(len(names) + 1))
    return pd.DataFrame({"digest": [n.tobytes() for n in names],
                         "at": [at[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:])]})


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, in sorted entries."""
    first = np.ones(len(keys[0]), dtype=bool)
    first[1:] = False
    for k in keys:
        first[1:] |= k[1:] != k[:-1]
    return first


def shared_anchors(packs: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """Of one slice: documents and the positions of their anchors that occur elsewhere too."""
    names, doc = _documents(packs, DIGEST)
    hashes, at = _joined(packs, "hash", "<u4"), _joined(packs, "at", "<u4")
    order = np.lexsort((at, doc, hashes))
    hashes, doc, at = hashes[order], doc[order], at[order]
    # A text that several tasks hold gives the same entries more than once.
    once = _starts(hashes, doc, at)
    hashes, doc, at = hashes[once], doc[once], at[once]
    run = np.cumsum(_starts(hashes)) - 1
    shared = np.bincount(run)[run] > 1
    return _frame(_by_bucket(names, doc[shared], at[shared], buckets))


def _frame(rows: Iterator[dict]) -> pd.DataFrame:
    return pd.DataFrame(list(rows), columns=[c.split()[0] for c in FOUND_SCHEMA.split(", ")])


def _digests(places: np.ndarray) -> np.ndarray:
    made = np.empty(len(places), dtype=DIGEST)
    made["f0"], made["f1"] = places["a"], places["b"]
    return made


def candidate_starts(shared: np.ndarray, words: int, window: int, period: int) -> np.ndarray:
    """Where windows begin that contain a shared anchor."""
    steps = np.zeros(words + 1, dtype=np.int64)
    np.add.at(steps, np.maximum(shared - (period - 1), 0), 1)
    np.add.at(steps, shared + 1, -1)
    return np.nonzero(np.cumsum(steps)[:max(0, words - window + 1)])[0]


def windows(rows: DataFrame, slices: int, window: int, period: int, flush: int) -> DataFrame:
    """Packed windows around shared anchors, the earliest of equal ones in a task.

    Rows without hashes are marks already made, by digest; their slice is a bucket.
    """
    types = _types(WINDOW_SCHEMA)

    def pack(places, high, low, doc, at) -> Iterator[dict]:
        places = np.array(places, dtype=PLACE)
        high, low, doc, at = map(np.concatenate, (high, low, doc, at))
        rank = np.empty(len(places), dtype=np.int64)
        ordered = np.argsort(places, order=PLACE.names)
        rank[ordered] = np.arange(len(places))
        doc, places = rank[doc], places[ordered]
        by = (high % np.uint64(slices)).astype(np.int64)
        order = np.lexsort((at, doc, low, high, by))
        by, high, low, doc, at = (x[order] for x in (by, high, low, doc, at))
        first = _starts(by, high, low)
        for marked in _by_bucket(_digests(places), doc[~first], at[~first], slices):
            marked["slice"] = marked.pop("bucket")
            yield marked
        order = np.lexsort((at[first], doc[first], by[first]))
        by, high, low, doc, at = (x[first][order] for x in (by, high, low, doc, at))
        for s, here in _pick([by], slices):
            used, local = _referred(doc[here])
            yield {"slice": s, "docs": places[used].tobytes(), "high": high[here].tobytes(),
                   "low": low[here].astype("<u4").tobytes(), "doc": local.tobytes(),
                   "at": at[here].astype("<u4").tobytes()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        places, held, found = [], 0, ([], [], [], [])
        for batch in batches:
            digests, ids, texts, shared = (
                batch.column(c).to_pylist() for c in ("digest", "first_id", "text", "at"))
            for part in _parts(texts):
                words, sizes = _words([texts[k] for k in part])
                starts = [candidate_starts(
                    np.frombuffer(shared[k], "<u4").astype(np.int64), n, window, period)
                    for k, n in zip(part, sizes.tolist())]
                doc = np.repeat(np.arange(len(places), len(places) + len(part)),
                                [len(s) for s in starts])
                at = np.concatenate(starts)
                where = at + np.repeat(np.cumsum(sizes) - sizes, [len(s) for s in starts])
                hashes = Hashes(words)
                for into, values in zip(found, (hashes.runs(where, window),
                                                hashes.runs(where, window, 1) >> np.uint64(32),
                                                doc, at)):
                    into.append(values)
                places += [(ids[k] is None, ids[k] or 0, *np.frombuffer(digests[k], "<u8"))
                           for k in part]
                held += len(at)
                if held >= flush:
                    yield from pack(places, *found)
                    places, held, found = [], 0, ([], [], [], [])
        if held:
            yield from pack(places, *found)

    return rows.mapInArrow(_dicts(run, types), WINDOW_SCHEMA)


def repeated_windows(packs: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """Of one slice: documents and the starts of windows that are not the earliest."""
    made = packs["high"].isna()
    marks = packs[made].rename(columns={"slice": "bucket"})[["bucket", "docs", "doc", "at"]]
    packs = packs[~made]
    if not len(packs):
        return marks
    names, doc = _documents(packs, PLACE)
    high, low = _joined(packs, "high", "<u8"), _joined(packs, "low", "<u4")
    at = _joined(packs, "at", "<u4")
    order = np.lexsort((at, doc, low, high))
    later = order[~_starts(high[order], low[order])]
    found = _frame(_by_bucket(_digests(names), doc[later], at[later], buckets))
    return pd.concat([marks, found]) if len(marks) else found


def _kept(rows: DataFrame, window: int) -> DataFrame:
    """What is left of each text whose repeated windows begin ``at``."""
    schema = ("digest binary, first_id long, n_removed long, kept_sha256 string, "
              "removed array<struct<start:long,end:long>>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("digest", "first_id", "text", "at"))
            for digest, first, text, at in zip(*columns):
                words = text.encode().split()
                steps = np.zeros(len(words) + 1, dtype=np.int64)
                if at:
                    starts = np.frombuffer(at, "<u4").astype(np.int64)
                    np.add.at(steps, starts, 1)
                    np.add.at(steps, starts + window, -1)
                gone = np.cumsum(steps)[:-1] > 0
                edges = np.nonzero(np.diff(np.concatenate([[False], gone, [False]])))[0]
                left = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
                yield {"digest": digest, "first_id": first, "n_removed": int(gone.sum()),
                       "kept_sha256": hashlib.sha256(left).hexdigest(),
                       "removed": [{"start": s, "end": e}
                                   for s, e in zip(edges[::2].tolist(), edges[1::2].tolist())]}

    types = _types("digest binary, first_id long, n_removed long, kept_sha256 string, removed spans")
    return rows.mapInArrow(_dicts(run, types, 1_000), schema)


def repeats(
    docs: DataFrame,
    window: int = WINDOW,
    period: int = PERIOD,
    slice_chars: int = SLICE_CHARS,
    flush_words: int = FLUSH_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, removed), a row for each row.

    A word is removed if a window of ``window`` consecutive words over it also starts earlier:
    in a document of smaller id, or before in the same one. ``removed`` are spans of words
    (start, end after the last), ``kept_sha256`` is the digest of the rest joined by one space.
    ``doc_id`` is a whole number; rows with null id come after all others. Among rows of one id
    those of smaller text digest come first; of repeated rows one comes first, and the
    others, like all later copies of a text, are removed as a whole if a window fits into them.
    Null and empty texts have no words; texts below a window keep all. A very long text is
    read whole by one task. An empty table gives an empty result; other columns are not read.
    """
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                         F.col(text).cast("string").alias("text"))
    digest = F.unhex(F.md5("text")).alias("digest")
    filled = narrow.where("text <> ''").select(digest, "doc_id", "text")
    chars = filled.agg(F.sum(F.length("text"))).first()[0] or 0
    slices = int(max(1, -(-chars // slice_chars)))

    def by_document(packs: DataFrame, judge) -> DataFrame:
        found = packs.groupBy("slice").applyInPandas(lambda p: judge(p, slices), FOUND_SCHEMA)
        return found.groupBy("bucket").applyInPandas(gather, "digest binary, at binary")

    shared = written(by_document(
        anchors(filled.select("digest", "text"), slices, window, period, flush_words),
        shared_anchors), "substrings-shared")
    texts = filled.groupBy("digest").agg(
        F.min("doc_id").alias("first_id"), F.first("text").alias("text"))
    marks = by_document(
        windows(texts.join(shared, "digest"), slices, window, period, flush_words),
        repeated_windows).toDF("digest", "at")
    kept = _kept(texts.join(marks, "digest", "left"), window)

    # Rows need a text's result only if they are its first; others need their words alone.
    words = F.when(F.col("n_words") < window, F.array_join(
        F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), " "))
    rows = narrow.withColumn("n_words", word_count(F.col("text"))).select(
        "doc_id", F.coalesce(digest, F.unhex(F.lit(""))).alias("digest"), "n_words",
        F.sha2(F.coalesce(words, F.lit("")), 256).alias("own_sha"))
    rows = rows.groupBy("doc_id", "digest", "n_words", "own_sha").agg(F.count("*").alias("times"))
    rows = rows.alias("r").join(
        kept.alias("k"), (F.col("r.digest") == F.col("k.digest"))
        & F.col("r.doc_id").eqNullSafe(F.col("k.first_id")), "left")
    is_long, first = F.col("n_words") >= window, F.col("k.digest").isNotNull()
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    none = F.lit(None).cast("array<struct<start:long,end:long>>")
    later = F.struct(
        F.when(is_long, F.col("n_words")).otherwise(0).alias("n_removed"),
        F.col("own_sha").alias("kept_sha256"),
        F.when(is_long, whole).otherwise(F.coalesce(none, F.array())).alias("removed"))
    mine = F.struct(*[F.col(f"k.{c}") for c in ("n_removed", "kept_sha256", "removed")])
    runs = rows.select(
        F.col("r.doc_id").alias("doc_id"), "n_words", first.alias("first"), mine.alias("mine"),
        later.alias("later"), "times",
        F.explode(F.sequence(F.lit(0), F.floor((F.col("times") - 1) / COPIES))).alias("run"))
    last = F.least(F.col("times") - F.col("run") * COPIES, F.lit(COPIES))
    copies = runs.withColumn("copy", F.explode(F.sequence(F.lit(1), last.cast("int"))))
    chosen = F.when((F.col("run") == 0) & (F.col("copy") == 1) & F.col("first"),
                    F.col("mine")).otherwise(F.col("later"))
    return copies.select("doc_id", "n_words", chosen.alias("c")).select("doc_id", "n_words", "c.*")
