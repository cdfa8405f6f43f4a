"""Sharding by sampled splitters, to shards of near equal bytes.

Records are ordered by (hash of text, hash of id, number), so equal texts are neighbours.
A sample in which a record's chance is in proportion to its size gives the quantiles of
bytes; these split the order into ranges that one task can sort. Ranges that turn out
overfull are sampled again and subdivided, down to single records if one text has many
copies. Sums per range and running sums inside a range give each record its exact place,
and thereby its shard and slot.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retinue.llm.common import written

SHARDS = 24
ROWS_PER_RANGE = 20_000
SAMPLES_PER_RANGE = 64
#: Groups of equal texts stay together up to this part of a shard.
GROUP_SHARE = 0.01
KEY = ("t", "i", "m")
_LEAST = -(2**63)


def _sampled(rows: DataFrame, rate: float, seed: int) -> list[tuple]:
    """Keys and weights of a sample in which a byte counts as ``rate`` records."""
    draw = F.shiftrightunsigned(F.xxhash64(*KEY, F.lit(seed)), 11) / F.lit(float(2**53))
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(rate))
    picked = rows.where(draw < chance).select(
        *KEY, F.greatest(F.col("size").cast("double"), F.lit(1 / rate)).alias("w"))
    return sorted(tuple(r) for r in picked.collect())


def _quantiles(sample: list[tuple], parts: int) -> list[tuple]:
    """Lower bounds of ``parts`` ranges of equal weight, the first one left out."""
    if not sample or parts < 2:
        return []
    total = np.cumsum([s[3] for s in sample])
    at = np.searchsorted(total, total[-1] * np.arange(1, parts) / parts)
    return sorted({sample[k][:3] for k in at})


def _whole_groups(splitters: list[tuple]) -> list[tuple]:
    """Move a splitter before its group of equal texts, unless it splits a large group."""
    texts = [s[0] for s in splitters]
    return sorted({s if texts.count(s[0]) > 1 else (s[0], _LEAST, _LEAST) for s in splitters}) \
        if len(set(texts)) < len(texts) else [(t, _LEAST, _LEAST) for t in texts]


def _range_of(splitters: list[tuple]) -> Column:
    """Number of splitters at or below the key."""
    first = np.array([s[0] for s in splitters], dtype=np.int64)

    @F.pandas_udf("int")
    def number(t: pd.Series, i: pd.Series, m: pd.Series) -> pd.Series:
        low = np.searchsorted(first, t.to_numpy(), "left")
        high = np.searchsorted(first, t.to_numpy(), "right")
        for k in np.nonzero(low != high)[0]:
            key = (t.iat[k], i.iat[k], m.iat[k])
            low[k] = bisect.bisect_right(splitters, key, low[k], high[k])
        return pd.Series(low.astype(np.int32))

    return number(*KEY)


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    rows_per_range: int = ROWS_PER_RANGE,
    samples_per_range: int = SAMPLES_PER_RANGE,
    seed: int = 11,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row of ``docs``.

    Size is the text's UTF-8 bytes plus 8. Shards differ by about one record or one small
    group of equal texts; larger groups are split between neighbouring shards. Slots of a
    shard count from 0 without gaps. A null text counts as empty (size 8, CRC 0), null ids
    are allowed, repeated rows are separate records, an empty table gives an empty result;
    other columns are not looked at.

    The driver holds ``samples_per_range`` keys of 32 bytes for each range of
    ``rows_per_range`` records, and nothing else that grows.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    records = written(docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.xxhash64(body).alias("t"),
        F.xxhash64(doc_id).alias("i"),
        F.monotonically_increasing_id().alias("m"),
    ), "shard-records")
    n, total, largest = records.agg(F.count("*"), F.sum("size"), F.max("size")).first()
    total, largest = total or 1, largest or 0
    ranges = max(shards, -(-n // rows_per_range))
    rate = samples_per_range * ranges / total
    splitters = _whole_groups(_quantiles(_sampled(records, rate, seed), ranges))

    for attempt in range(1, 4):
        held = _held(records, splitters)
        over = {r: size for r, (rows, size) in held.items()
                if rows > 4 * rows_per_range or size > 4 * total / ranges and rows > 1}
        if not over:
            break
        # Only the overfull ranges are sampled again, at a higher rate.
        inside = records.where(_range_of(splitters).isin(list(over)))
        extra: dict[int, list[tuple]] = {}
        for s in _sampled(inside, rate * 8, seed + attempt):
            extra.setdefault(bisect.bisect_right(splitters, s[:3]), []).append(s)
        finer = [q for r, sample in extra.items()
                 for q in _quantiles(sample, max(2, -(-over[r] * ranges // total)))]
        splitters = sorted({*splitters, *finer})
    held = _held(records, splitters)

    starts, rows_before, bytes_before = [], 0, 0
    for r in sorted(held):
        starts.append((r, rows_before, bytes_before))
        rows_before, bytes_before = rows_before + held[r][0], bytes_before + held[r][1]
    spark = docs.sparkSession
    before = F.broadcast(spark.createDataFrame(  # a row for each range
        starts, "range int, rows_before long, bytes_before long"))

    order = Window.partitionBy("range").orderBy(*KEY)
    preceding = order.rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy("range", "t")
    tolerance = max(largest, int(total / shards * GROUP_SHARE))
    whole = F.col("group_size") <= tolerance
    middle = F.when(whole, F.col("group_start") * 2 + F.col("group_size")).otherwise(
        F.col("start") * 2 + F.col("size"))
    placed = (
        records.withColumn("range", _range_of(splitters)).join(before, "range")
        .withColumn("nth", F.col("rows_before") + F.row_number().over(order) - 1)
        .withColumn("start", F.col("bytes_before")
                    + F.coalesce(F.sum("size").over(preceding), F.lit(0)))
        .withColumn("group_start", F.min("start").over(group))
        .withColumn("group_size", F.sum("size").over(group))
        .withColumn("shard", F.least(F.lit(shards - 1), F.floor(
            middle.cast("decimal(38,0)") * shards / (2 * total))).cast("int"))
        .select("doc_id", "size", "text_crc32", "shard", "nth")
    )
    placed = written(placed, "shard-placed")
    first = F.broadcast(placed.groupBy("shard").agg(F.min("nth").alias("first")))  # a row a shard
    return placed.join(first, "shard").select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("nth") - F.col("first")).cast("long").alias("slot"))


def _held(records: DataFrame, splitters: list[tuple]) -> dict[int, tuple[int, int]]:
    rows = records.groupBy(_range_of(splitters).alias("range")).agg(
        F.count("*").alias("n"), F.sum("size").alias("size")).collect()  # a row for each range
    return {r["range"]: (r["n"], r["size"]) for r in rows}


def write_shards(docs: DataFrame, placed: DataFrame, path: str, doc_id: str = "doc_id") -> None:
    """The documents as Parquet files, a folder for each shard; ids must be unique."""
    target = placed.select(F.col("doc_id").alias("_id"), F.col("shard"))
    joined = docs.join(target, docs[doc_id].eqNullSafe(target["_id"])).drop("_id")
    joined.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
