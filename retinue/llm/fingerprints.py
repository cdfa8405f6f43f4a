"""Document fingerprints by invertible Bloom lookup sketches, with DataFrame functions only.

A text is the set of digests of its paragraph pieces: each line is cut into runs of 1, 1,
2, 4, 8, ... words, so a change touches few pieces of a short line and of a long one. A
sketch has three rows of cells; a digest is added to one cell of each row, and a cell holds
the number, the XOR of the digests and the XOR of their checks. Subtracting the sketches of
two texts leaves the digests in which they differ. A cell with one digest gives it away;
taking it out of its other cells frees further ones, until nothing is left. If something
stays, the pair is tried again with twice the cells and other hashes.

Cells are rows and all steps are aggregations by (bucket, document, ...), where a bucket is
what one partition holds after the only shuffle of texts. So no step but the rare second
attempt shuffles anything else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retinue.llm.common import small, written

BUCKET_ROWS = 1_000
#: Cells for each digest of both texts, and the least number in each of the three rows.
CELLS_PER_DIGEST, LEAST_CELLS = 2.0, 12
ROUNDS, ATTEMPTS = 8, 12
BASE_CELLS = 4
_FOUND, _INFO = -1, -2


def pieces(text: Column) -> Column:
    """Distinct digests of the pieces of a text, in order of appearance."""
    lines = F.filter(F.split(text, r"\n"), lambda line: line != "")
    cut = F.transform(
        F.transform(lines, lambda line: F.split(line, " ")),
        lambda words: F.transform(
            F.sequence(F.lit(0), F.ceil(F.log2(F.size(words).cast("double"))).cast("int")),
            lambda i: F.array_join(F.slice(
                words,
                F.when(i == 0, 1).otherwise(F.pow(F.lit(2), i - 1).cast("int") + 1),
                F.when(i == 0, 1).otherwise(F.pow(F.lit(2), i - 1).cast("int"))), " ")))
    return F.array_distinct(F.transform(F.flatten(cut), lambda piece: F.xxhash64(piece)))


def _cell(key: Column, row: int, width: Column, seed: Column) -> Column:
    return (F.pmod(F.xxhash64(key, F.lit(row), seed), width) + width * row).cast("int")


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(77))


def fingerprint(keys: Column) -> Column:
    """Number of digests and the cells of the smallest sketch: number and XOR, in hex."""
    def cell(at: Column) -> Column:
        row = F.floor(at / BASE_CELLS)
        inside = F.filter(keys, lambda k: F.pmod(
            F.xxhash64(k, row, F.lit(0)), F.lit(BASE_CELLS)) == F.pmod(at, F.lit(BASE_CELLS)))
        both = F.aggregate(inside, F.lit(0).cast("long"), lambda x, k: x.bitwiseXOR(k))
        return F.concat(F.lower(F.hex(F.size(inside))), F.lit("."), F.lower(F.hex(both)))

    cells = F.transform(F.sequence(F.lit(0), F.lit(3 * BASE_CELLS - 1)), cell)
    return F.concat_ws("-", F.size(keys).cast("string"), cells)


def _bounds(ids: DataFrame, bucket_rows: int) -> DataFrame:
    """(bucket, run, key, head): where the buckets begin, in the order of (doc_id, tie).

    ``key`` is the least of a bucket and ``head`` its greatest. Rows that are alike may
    fill several buckets, which then have one key; ``run`` is the first of those.
    """
    order = (F.asc_nulls_first("doc_id"), F.asc("tie"))
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ids.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # Partitions hold their rows in order, and the number has the place in its lower 33 bits.
    begun = ranged.withColumn("at", F.monotonically_increasing_id()).where(
        F.col("at").bitwiseAND((1 << 33) - 1) % bucket_rows == 0)
    along = Window.orderBy("at")  # a row for each bucket
    begun = written(begun.select(F.struct("doc_id", "tie").alias("key"), "at"), "fingerprint-begun")
    return written(begun.select(
        "key", F.row_number().over(along).alias("bucket")).withColumn(
        "run", F.min("bucket").over(Window.partitionBy("key"))), "fingerprint-bounds")


def _bucketed(rows: DataFrame, bounds: DataFrame, n: int) -> DataFrame:
    """``rows`` with the ``bucket`` of their (doc_id, tie); rows that are alike are dealt out."""
    stride = max(1, int(n ** 0.5))
    listed = bounds.withColumn("cell", ((F.col("bucket") - 1) / stride).cast("int"))
    cells = listed.groupBy("cell").agg(F.array_sort(F.collect_list(
        F.struct("bucket", "run", "key"))).alias("inside"))
    # Two short lists are searched for each row: the cells, then what is inside of one.
    cells = written(cells, "fingerprint-cells")
    firsts = cells.agg(F.array_sort(F.collect_list(F.struct(
        "cell", F.col("inside")[0].key.alias("key")))).alias("firsts"))
    key = F.struct("doc_id", "tie")
    found = rows.withColumn("key", key).withColumn(
        "deal", F.xxhash64(F.monotonically_increasing_id())).crossJoin(F.broadcast(firsts))
    found = found.withColumn("cell", F.element_at("firsts", F.size(F.filter(
        "firsts", lambda f: f.key <= F.col("key")))).cell).drop("firsts")
    found = found.join(small(cells), "cell").withColumn("last", F.element_at(
        "inside", F.size(F.filter("inside", lambda b: b.key <= F.col("key"))))).drop("inside")
    first, last = F.col("last.run"), F.col("last.bucket")
    dealt = F.when(F.col("last.key") == F.col("key"), first + F.pmod(
        F.col("deal"), last - first + 1).cast("int")).otherwise(last)
    return found.withColumn("bucket", dealt).select(*rows.columns, "bucket")


def _heads(ids: DataFrame, bounds: DataFrame, n: int) -> DataFrame:
    """(bucket, doc_id, tie): the row by which each bucket's last one is followed."""
    last = bounds.groupBy("key").agg(F.max("bucket").alias("bucket"), F.min("run").alias("run"))
    # The greatest of a bucket: the last of equal ones may have greater rows, the others not.
    single = last.select("bucket", F.col("bucket").alias("run"), "key")
    greatest = _bucketed(ids, single, n).groupBy("bucket").agg(
        F.max(F.struct("doc_id", "tie")).alias("greatest"))
    along = Window.orderBy(F.desc("bucket"))
    wrapped = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = bounds.join(greatest, "bucket", "left").select(
        "bucket", F.coalesce("greatest", "key").alias("head"))
    return written(heads.select("bucket", F.coalesce(
        F.lead("head").over(along), F.first("head").over(wrapped)).alias("next")).select(
        "bucket", "next.doc_id", "next.tie"), "fingerprint-heads")


def _followed(rows: DataFrame, bucket_rows: int) -> DataFrame:
    """``rows`` (doc_id, text) with ``keys``, ``bucket``, ``nth`` in it and ``follower``.

    The follower is (text, keys) of the next row by descending id, after the last the first. Buckets are
    ranges of (doc_id, tie) of about ``bucket_rows`` rows, however the ids are spread; the
    first row of a bucket is also appended to the bucket before it. Rows with equal ids are
    ordered by a hash of their text, the tie; null ids come last.
    """
    ids = written(rows.select("doc_id", F.xxhash64("text").alias("tie")), "fingerprint-ids")
    bounds = _bounds(ids, bucket_rows)
    cells = bounds.count()
    heads = _heads(ids, bounds, cells)
    tied = rows.withColumn("tie", F.xxhash64("text"))
    placed = _bucketed(tied, bounds, cells).withColumn("last", F.lit(False))
    # One text for each key that is a head, then one row for each bucket.
    keys = small(heads.select("doc_id", "tie").distinct()).alias("h")
    same = F.col("p.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("p.tie") == F.col("h.tie"))
    texts = tied.alias("p").join(keys, same, "left_semi").dropDuplicates(["doc_id", "tie"])
    appended = texts.alias("p").join(small(heads).alias("h"), same).select(
        "p.doc_id", "p.text", "p.tie", "h.bucket").withColumn("last", F.lit(True))
    order = Window.partitionBy("bucket").orderBy(
        "last", F.desc_nulls_last("doc_id"), F.desc("tie"))
    # What follows is by bucket too and needs no further shuffle. Few buckets a partition
    # keep the cells of all their documents in memory.
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), cells // 2)
    dealt = placed.unionByName(appended).repartition(parts, "bucket")
    dealt = dealt.withColumn("keys", pieces(F.col("text")))
    return dealt.withColumn("follower", F.lead(F.struct("text", "keys")).over(order)) \
        .withColumn("nth", F.row_number().over(order)).where(~F.col("last")).drop("tie", "last")


def _sketched(pairs: DataFrame, attempt: int) -> DataFrame:
    """The cells of the subtracted sketches as rows, and one row with ``info`` per document.

    ``pairs`` is (bucket, nth, info, pairs), where pairs is an array of (left, right).
    """
    total = F.size("p.left") + F.size("p.right")
    width = F.greatest(F.lit(LEAST_CELLS), F.ceil(total * CELLS_PER_DIGEST / 3)) * 2**attempt
    signed = F.concat(
        F.transform("p.left", lambda k: F.struct(k.alias("key"), F.lit(1).alias("n"))),
        F.transform("p.right", lambda k: F.struct(k.alias("key"), F.lit(-1).alias("n"))))
    with_info = F.concat(F.array(F.struct(
        F.lit(None).cast("long").alias("key"), F.lit(0).alias("n"))), signed)
    keyed = pairs.select("bucket", "nth", "info", F.posexplode("pairs").alias("pair", "p")).select(
        "bucket", "nth", "pair", "info", width.cast("int").alias("width"),
        F.explode(with_info).alias("k")).select(
        "bucket", "nth", "pair", "width", F.col("k.key").alias("key"), F.col("k.n").alias("n"),
        F.when(F.col("k.key").isNull(), F.col("info")).alias("info"))
    seed = F.lit(attempt)
    at = F.when(F.col("key").isNull(), F.array(F.lit(_INFO))).otherwise(
        F.array(*[_cell(F.col("key"), row, F.col("width"), seed) for row in range(3)]))
    return keyed.select("bucket", "nth", "pair", "width", "info", F.explode(at).alias("at"),
                        F.lit(0).cast("long").alias("group"), "n",
                        F.coalesce("key", F.lit(0)).alias("key"),
                        F.coalesce(_check(F.col("key")), F.lit(0)).alias("check"))


_GROUP = ("bucket", "nth", "pair", "width", "info", "at", "group")


def _summed(rows: DataFrame) -> DataFrame:
    sums = rows.groupBy(*_GROUP).agg(
        F.sum("n").cast("int").alias("n"), F.bit_xor("key").alias("key"),
        F.bit_xor("check").alias("check"))
    return sums.where("at < 0 OR n <> 0 OR key <> 0")


def _round(rows: DataFrame, attempt: int) -> DataFrame:
    """Take the digests of all cells that hold one out of all their cells."""
    key, seed, width = F.col("key"), F.lit(attempt), F.col("width")
    home = F.floor(F.col("at") / width)
    own = F.pmod(F.xxhash64(key, home.cast("int"), seed), width) + width * home
    alone = (F.col("at") >= 0) & (F.abs("n") == 1) & (F.col("check") == _check(key)) & (
        F.col("at") == own)

    def entry(at: Column, group: Column, n: Column, key: Column, check: Column) -> Column:
        return F.struct(at.cast("int").alias("at"), group.alias("group"),
                        n.cast("int").alias("n"), key.alias("key"), check.alias("check"))

    kept = entry(F.col("at"), F.col("group"), F.col("n"), key, F.col("check"))
    shown = entry(F.lit(_FOUND - 2), key, F.col("n"), F.lit(0).cast("long"), F.lit(0).cast("long"))
    seen = _exploded(_summed(rows), F.when(alone, F.array(kept, shown)).otherwise(F.array(kept)))
    # A digest may be alone in several of its cells: from here on it is one row.
    once = seen.groupBy(*_GROUP).agg(
        F.when(F.col("at") == _FOUND - 2, F.max("n")).otherwise(F.sum("n")).cast("int").alias("n"),
        F.bit_xor("key").alias("key"), F.bit_xor("check").alias("check"))
    digest = F.col("group")
    none = F.lit(0).cast("long")
    taken = F.array(
        entry(F.lit(_FOUND), none, F.lit(1), none, none),
        *[entry(_cell(digest, row, width, seed), none, -F.col("n"), digest, _check(digest))
          for row in range(3)])
    same = F.array(entry(F.col("at"), F.col("group"), F.col("n"), key, F.col("check")))
    return _exploded(once, F.when(F.col("at") == _FOUND - 2, taken).otherwise(same))


def _exploded(rows: DataFrame, entries: Column) -> DataFrame:
    return rows.select("bucket", "nth", "pair", "width", "info",
                       F.explode(entries).alias("e")).select(
        "bucket", "nth", "pair", "width", "info", "e.at", "e.group", "e.n", "e.key", "e.check")


def _peeled(pairs: DataFrame, attempt: int) -> DataFrame:
    """(info, differing, stuck): for each pair the digests recovered and the cells left."""
    rows = _sketched(pairs, attempt)
    for _ in range(ROUNDS):
        rows = _round(rows, attempt)
    rows = _summed(rows)
    by_pair = rows.groupBy("bucket", "nth", "pair").agg(
        F.max("info").alias("info"),
        F.sum(F.when(F.col("at") == _FOUND, F.col("n")).otherwise(0)).alias("differing"),
        F.sum((F.col("at") >= 0).cast("int")).alias("stuck"))
    return by_pair.groupBy("bucket", "nth").agg(
        F.max("info").alias("info"),
        F.array_sort(F.collect_list(F.struct("pair", "differing", "stuck"))).alias("found"))


def _likeness(left: Column, right: Column, differing: Column) -> Column:
    """Common digests over all digests of both; two texts without any are alike."""
    total = F.size(left) + F.size(right)
    return F.when(total == 0, 1.0).otherwise((total - differing) / (total + differing))


def compare(
    docs: DataFrame,
    bucket_rows: int = BUCKET_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, differing_edited, differing_next) for every row of ``docs``.

    The edited text has its last third (whole code points, rounded down) replaced by as
    many first code points, or all, of the next document by descending id; after the last
    comes the first, so a single document is its own next. Likeness is that of the sets
    of piece digests, from what peeling the subtracted sketches recovers. A null text
    counts as empty, and empty texts are alike; rows with equal ids follow one another by a
    hash of their text, null ids come last. Equal texts have equal fingerprints. An empty
    table gives an empty result; other columns are not looked at. Ids are whole numbers.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = _followed(rows, bucket_rows)
    length = F.length("text")
    third = F.floor(length / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), length - third),
                      F.substring("follower.text", F.lit(1), third))
    rows = rows.withColumn("edited", edited).withColumn("edited_keys", pieces(F.col("edited")))
    info = F.struct(
        "doc_id", length.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("sha"),
        fingerprint(F.col("keys")).alias("own"), fingerprint(F.col("edited_keys")).alias("changed"),
        "keys", "edited_keys", F.col("follower.keys").alias("next_keys"))
    prepared = rows.select("bucket", "nth", info.alias("info"), _pairs(
        "keys", "edited_keys", "follower.keys").alias("pairs"))

    done = None
    for attempt in range(ATTEMPTS):
        stuck = F.exists("found", lambda f: f.stuck > 0)
        result = written(_peeled(prepared, attempt).select(
            "bucket", "nth", "found", stuck.alias("again"),
            F.col("info").withField("keys", F.when(stuck, F.col("info.keys")))
            .withField("edited_keys", F.when(stuck, F.col("info.edited_keys")))
            .withField("next_keys", F.when(stuck, F.col("info.next_keys"))).alias("info"),
            *[_likeness(F.col("info.keys"), F.col(f"info.{other}"), F.col("found")[k].differing)
              .alias(f"near_{k}") for k, other in enumerate(("edited_keys", "next_keys"))],
        ), "fingerprint-peeled")
        over = result.where("NOT again")
        done = over if done is None else done.unionByName(over)
        again = result.where("again")
        if again.isEmpty():
            return done.select(
                "info.doc_id", "info.n_chars", F.col("info.sha").alias("edited_sha256"),
                F.col("info.own").alias("fingerprint"),
                F.col("info.changed").alias("edited_fingerprint"),
                F.col("near_0").alias("near_edited"), F.col("near_1").alias("near_next"),
                F.col("found")[0].differing.alias("differing_edited"),
                F.col("found")[1].differing.alias("differing_next"))
        prepared = again.select("bucket", "nth", "info", _pairs(
            "info.keys", "info.edited_keys", "info.next_keys").alias("pairs"))
    raise RuntimeError(f"sketches cannot be peeled after {ATTEMPTS} attempts")


def _pairs(own: str, edited: str, following: str) -> Column:
    return F.array(F.struct(F.col(own).alias("left"), F.col(edited).alias("right")),
                   F.struct(F.col(own).alias("left"), F.col(following).alias("right")))
