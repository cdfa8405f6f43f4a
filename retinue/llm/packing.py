"""Conflict-constrained best-fit packing of documents into training sequences.

A document longer than a sequence fills sequences of its own; what remains of it, like
any shorter document, is packed. Two pieces conflict if they share a source or belong to
one cluster of duplicates, and conflicting pieces never share a bin. Rows are dealt evenly
to blocks, and each block is packed on its own by best fit, largest piece first.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retinue.llm.common import ascii_lower, word_count, written

CAPACITY = 2048
#: Rows of a block; a block is what one task packs, so this bounds its memory.
BLOCK_ROWS = 2_000
SCHEMA = "bin long, slot int, piece int, start long, length long"


def text_cluster(text: Column) -> Column:
    """Cluster of documents that are equal but for case and spacing."""
    return F.md5(F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))),
                                         r"[\x20\x09-\x0D]+", " ")))


def best_fit(items: list[tuple[int, int, int]], capacity: int) -> list[tuple[int, int]]:
    """(bin, slot) for each item (size, source, cluster), in the order of ``items``.

    Bins are kept sorted by residual, each with one bitmap of the sources and one of the
    clusters it holds. The search starts at the first bin that is large enough, which
    would be the tightest, and goes on to the next larger one until the bitmaps allow it.
    Clusters are negative where a single item has them; those never conflict.
    """
    order: list[tuple[int, int]] = []  # (residual, bin)
    sources: list[int] = []
    clusters: list[int] = []
    held: list[int] = []
    placed = []
    for size, source, cluster in items:
        has_source = 1 << source
        has_cluster = 1 << cluster if cluster >= 0 else 0
        at = bisect.bisect_left(order, (size, -1))
        while at < len(order):
            b = order[at][1]
            if not sources[b] & has_source and not clusters[b] & has_cluster:
                break
            at += 1
        if at < len(order):
            left, b = order.pop(at)
        else:
            left, b = capacity, len(held)
            sources.append(0)
            clusters.append(0)
            held.append(0)
        sources[b] |= has_source
        clusters[b] |= has_cluster
        bisect.insort(order, (left - size, b))
        placed.append((b, held[b]))
        held[b] += 1
    return placed


def _numbers(values: list) -> list[int]:
    """Small numbers for the values, in order of appearance; null is a value."""
    seen: dict = {}
    return [seen.setdefault(None if pd.isna(v) else v, len(seen)) for v in values]


def pack_block(rows: pd.DataFrame, capacity: int) -> Iterator[tuple]:
    """(row, bin, slot, piece, start, length) for the rows (key, size, source, cluster)."""
    sizes, keys = rows["size"].tolist(), rows["key"].tolist()
    source, cluster = _numbers(rows["source"].tolist()), _numbers(rows["cluster"].tolist())
    times = Counter(cluster)
    shared = {c: k for k, c in enumerate(c for c, n in times.items() if n > 1)}
    tails = sorted((k for k, s in enumerate(sizes) if s % capacity),
                   key=lambda k: (-(sizes[k] % capacity), keys[k], k))
    bins = best_fit([(sizes[k] % capacity, source[k], shared.get(cluster[k], -1)) for k in tails],
                    capacity)
    opened = 1 + max((b for b, _ in bins), default=-1)
    for k, (b, slot) in zip(tails, bins):
        full = sizes[k] // capacity
        yield k, b, slot, full, full * capacity, sizes[k] % capacity
    for k, size in enumerate(sizes):
        for piece in range(size // capacity):
            yield k, opened, 0, piece, piece * capacity, capacity
            opened += 1
        if size == 0:
            yield k, None, None, 0, 0, 0


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    cluster: Column | None = None,
    block_rows: int = BLOCK_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """(doc_id, source, cluster, size, bin, slot, piece, start, length), a row per piece.

    ``size`` is the document's words, ``start`` and ``length`` the words of the piece.
    ``cluster`` defaults to texts equal but for case and spacing; any column will do,
    such as the component of a similarity join, and a null one conflicts with nothing.
    A null source is a source. Empty and null texts get one row with null bin. Repeated
    rows are packed each, in different bins, as they conflict. An empty table gives an
    empty result; other columns are not looked at.

    Rows are dealt round-robin, so a source or cluster that holds a third of all rows
    holds a third of each block, and no block exceeds its rows.
    """
    narrow = written(docs.select(
        F.col(doc_id).cast("string").alias("doc_id"), F.col(source).cast("string").alias("source"),
        (text_cluster(F.col(text)) if cluster is None else cluster).cast("string").alias("cluster"),
        word_count(F.col(text)).alias("size")), "pack-sizes")
    blocks = max(1, -(-narrow.count() // block_rows))
    names = ["doc_id", "source", "cluster", "size"]
    kind = docs.schema[doc_id].dataType

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        alone = [f"\0{k}" if pd.isna(c) else c for k, c in enumerate(rows["cluster"])]
        ids = rows["doc_id"]
        keyed = pd.DataFrame({"key": [(str(i), str(c)) for i, c in zip(ids, rows["cluster"])],
                              "size": rows["size"], "source": rows["source"], "cluster": alone})
        first = TaskContext.get().partitionId() << 32
        out: list[tuple] = []

        def frame() -> pd.DataFrame:
            at = [o[0] for o in out]
            made = rows.iloc[at].reset_index(drop=True)
            made["bin"] = pd.array([None if o[1] is None else first + o[1] for o in out], "Int64")
            made["slot"] = pd.array([o[2] for o in out], "Int32")
            for j, c in enumerate(("piece", "start", "length"), 3):
                made[c] = [o[j] for o in out]
            out.clear()
            return made

        for piece in pack_block(keyed, capacity):
            out.append(piece)
            if len(out) == 50_000:
                yield frame()
        if out:
            yield frame()

    dealt = narrow.select(*names).repartition(blocks)
    # Ids travel as text, since pandas turns whole numbers with nulls into floats.
    return dealt.mapInPandas(
        packed, f"doc_id string, source string, cluster string, size long, {SCHEMA}"
    ).withColumn("doc_id", F.col("doc_id").cast(kind))
