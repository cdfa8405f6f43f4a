"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key. Within a source the documents are thought of as
sorted by that key, and the mix takes them in this order until the source's budget is
spent, in several epochs if the budget exceeds the source. The order is never built as a
whole: keys are uniform, so equal ranges of keys hold about equal numbers of documents.
The sizes of these ranges are summed (combined before the shuffle), their prefix sums show
in which range a source's budget ends, and only the documents of that one range are
sorted and summed one by one. No text is shuffled, and a hot source is as many ranges as
it has rows for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retinue.llm.common import small, word_count, written

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
ROWS_PER_RANGE = 50_000


def random_key(doc_id: Column, text: Column, seed: int) -> Column:
    """32 hex digits that look random; equal only for rows with equal id and text."""
    named = F.coalesce(doc_id.cast("string"), F.lit(""))
    digest = F.md5(F.coalesce(text, F.lit("")))
    return F.md5(F.concat(named, F.lit(f":{seed}:"), digest))


def _range(key: Column, ranges: int) -> Column:
    leading = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    return F.shiftright(leading * F.lit(ranges), 32)


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """(source, source_size, target) for ``sizes`` (source, size).

    Sources in code point order, null last, take the weights in turn. The targets share
    the sum of all sizes; none exceeds ``max_epochs`` times its source, and what that
    leaves over goes to the others by weight, until none is above. Closed form: with the
    sources in the order in which they fill up, the share per unit of weight is what the
    full ones leave, over the weight of the others. A source without words gets 0.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    # One row per source from here on: a mixture has few, and they are sums by then.
    shares = per_source.withColumn(
        "weight", F.element_at(cycle, F.pmod(turn, F.lit(len(weights))).cast("int") + 1)
    ).withColumn("cap", F.col("source_size") * F.lit(max_epochs))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy().orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    shares = shares.withColumn("level", left.cast("double") / F.sum("weight").over(after))
    # The level of the first source that does not fill up holds for it and all later ones.
    open_ = F.col("level") * F.col("weight") < F.col("cap")
    shares = shares.withColumn("open_level", F.when(open_, F.col("level")))
    level = F.first("open_level", ignorenulls=True).over(
        filling.rowsBetween(Window.unboundedPreceding, 0))
    target = F.coalesce(level * F.col("weight"), F.col("cap").cast("double"))
    return shares.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = 7,
    rows_per_range: int = ROWS_PER_RANGE,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """All rows of ``docs`` as struct ``row``, with size, source_size, target and taken.

    ``taken`` is the number of words that the mix takes of the document: its size times
    the number of epochs that reach it. Documents are taken whole; the last one of a
    source is the one that brings the sum nearest to the target. Null or empty texts
    have size 0 and are taken 0 words; a null source is a source of its own; rows with
    equal id and text have one key and are taken together; an empty table gives an empty
    result. Other columns, whatever their names, stay inside ``row``.
    """
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        random_key(F.col(doc_id), F.col(text), seed).alias("key"),
    )
    narrow = written(keyed.drop("row"), "mix-sizes")
    ranges = max(1, -(-narrow.count() // rows_per_range))
    narrow = narrow.withColumn("range", _range(F.col("key"), ranges))

    size, rest = F.col("source_size"), F.col("target") - F.col("epochs") * F.col("source_size")
    budgets = source_targets(narrow, weights, max_epochs).withColumn(
        "epochs", F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0)
    ).withColumn("rest", rest)
    budgets = small(written(budgets, "mix-budgets"))

    upto = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    cells = narrow.groupBy("source", "range").agg(F.sum("size").alias("cell_size"))
    cells = cells.withColumn("before", F.coalesce(F.sum("cell_size").over(upto), F.lit(0)))
    reached = (
        _by_source(cells, budgets).where(F.col("before") <= F.col("rest"))
        .groupBy("source").agg(F.max("range").alias("range"), F.max("before").alias("before"),
                               F.first("rest").alias("rest"))
    )
    reached = small(written(reached, "mix-cells"))
    inside = narrow.alias("n").join(
        reached.alias("r"),
        F.col("n.source").eqNullSafe(F.col("r.source")) & (F.col("n.range") == F.col("r.range")),
    ).groupBy("n.source", "n.range", "key").agg(
        F.sum("size").alias("size"), F.first("before").alias("before"),
        F.first("rest").alias("rest"))
    running = Window.partitionBy("source", "range").orderBy("key").rowsBetween(
        Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("size").over(running), F.lit(0))
    cut = (
        inside.withColumn("start", start)
        .where(F.col("start") * 2 + F.col("size") <= F.col("rest") * 2)
        .groupBy("source").agg(F.max("key").alias("cut_key"))
    )
    ends = reached.select("source", F.col("range").alias("cut_range")).alias("a").join(
        cut.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")), "left"
    ).select("a.source", "cut_range", "cut_key")
    plan = small(written(_by_source(budgets, ends).select(
        "source", "source_size", "target", "epochs", "cut_range", "cut_key"), "mix-plan"))

    here = _range(F.col("key"), ranges)
    last = (here < F.col("cut_range")) | (
        (here == F.col("cut_range")) & F.coalesce(F.col("key") <= F.col("cut_key"), F.lit(False)))
    times = F.col("epochs") + last.cast("int")
    return _by_source(keyed, plan).select(
        "row", "size", "source_size", "target",
        (F.col("size") * times).cast("long").alias("taken"), times.cast("int").alias("times"))


def _by_source(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on source, null equal to null."""
    other = right.withColumnRenamed("source", "_source")
    return left.join(other, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: the rows that went into ``mix``, each as often as it is taken."""
    copies = mixed.where("times > 0 AND size > 0")
    return copies.select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")
