"""URL filter: policy rules first, gradient-boosted trees for all other URLs.

DataFrame functions and ``pyspark.ml`` only. URLs that a rule decides are the labelled
ones; trees trained on lexical features of a bounded sample of them judge the rest. What
is known of suffixes and path segments comes from all labelled URLs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retinue.llm.common import ascii_lower, small, written

ALLOW, BLOCK = "allow", "block"
#: (verdict, host, path); the policy of the query.
RULES = (
    (ALLOW, "com", "/"),
    (BLOCK, "example.com", "/en/"),
    (ALLOW, "www.example.com", "/en/"),
    (BLOCK, "net", "/es/"),
    (BLOCK, "net", "/fr/"),
)
#: Distinct labelled URLs that the trees are fitted on, taken by hash from each verdict.
TRAIN_ROWS = 15_000
TREES, DEPTH = 20, 4
FEATURES = (
    "f_length", "f_host_length", "f_path_length", "f_depth", "f_labels", "f_digits", "f_hyphens",
    "f_entropy", "f_params", "f_fragment", "f_suffix_seen", "f_suffix_blocked",
    "f_segment_blocked",
)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Number of the longest rule that fits, the earlier of equally long ones; else null.

    The rules are a policy that people keep by hand, so they are part of the plan.
    """
    longest = sorted(range(len(rules)), key=lambda k: -len(rules[k][1] + rules[k][2]))
    chosen = F.lit(None).cast("int")
    for k in reversed(longest):
        _verdict, on, prefix = rules[k]
        fits = ((host == on) | host.endswith(f".{on}")) & path.startswith(prefix)
        chosen = F.when(fits, F.lit(k)).otherwise(chosen)
    return chosen


def _lexical(urls: DataFrame) -> DataFrame:
    url, size = F.coalesce("url", F.lit("")), F.length(F.coalesce("url", F.lit("")))
    count = lambda pattern, of: F.regexp_count(of, F.lit(pattern)).cast("double")
    seen = lambda c: (size - F.length(F.replace(url, c))) / size
    entropy = F.aggregate(
        F.array_distinct(F.split(url, "")), F.lit(0.0),
        lambda total, c: total - F.when(c == "", 0.0).otherwise(seen(c) * F.log2(seen(c))))
    labels = F.split("host", r"\.")
    return urls.withColumns({
        "f_length": size.cast("double"),
        "f_host_length": F.length("host").cast("double"),
        "f_path_length": F.length("path").cast("double"),
        "f_depth": count("/", F.col("path")),
        "f_labels": F.size(labels).cast("double"),
        "f_digits": F.when(size > 0, count("[0-9]", url) / size).otherwise(0.0),
        "f_hyphens": count("-", url),
        "f_entropy": F.when(size > 0, entropy).otherwise(0.0),
        "f_params": count("[?&][^?&#=]+=", url),
        "f_fragment": (F.instr(url, "#") > 0).cast("double"),
        "segment": F.regexp_extract("path", r"^/([^/]*)", 1),
        "suffix": F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2)),
    })


def _sampled(labelled: DataFrame, classes: dict[float, tuple[int, float]], train_rows: int,
             seed: int) -> DataFrame:
    """At most ``train_rows`` (at least 2) distinct URLs of both classes, with ``weight``.

    Half of them are of each class, or more if the other one has fewer. Weights are the
    numbers of the URLs, scaled so that a class weighs as much as in the whole table.
    """
    each = max(1, train_rows // 2)
    (n0, _), (n1, _) = classes[0.0], classes[1.0]
    most = {0.0: max(each, train_rows - n1), 1.0: max(each, train_rows - n0)}
    drawn = [labelled.where(F.col("label") == label).orderBy(
        F.xxhash64("url", F.lit(seed)), "url").limit(n) for label, n in most.items()]
    sample = written(drawn[0].unionByName(drawn[1]), "url-sample")
    weights = {r["label"]: r["n"] for r in sample.groupBy("label").agg(
        F.sum("n").alias("n")).collect()}
    scale = [classes[label][1] / weights[label] for label in (0.0, 1.0)]
    return sample.withColumn("weight", F.col("n") * F.when(
        F.col("label") == 1.0, scale[1]).otherwise(scale[0]))


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    train_rows: int = TRAIN_ROWS,
    seed: int = 5,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row of ``pages``.

    ``rule`` is the longest fitting rule as ``host/path``, or null; ``verdict`` is the
    rule's, else the trees'; ``score`` is the trees' probability of block. A null URL has
    empty host and path and is judged by the trees. Ties between rules go to the earlier
    one. The trees learn from at most ``train_rows`` distinct labelled URLs, of both
    verdicts; statistics of suffixes and first path segments count all labelled rows. If
    the labelled URLs have one verdict only, the trees' verdict is that one; if there are
    none, it is allow. Repeated rows are judged alike; other columns are not
    looked at.
    """
    host, path = split_url(F.col("url"))
    parsed = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    parsed = parsed.withColumn("host", host).withColumn("path", path)
    parsed = parsed.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    part = lambda get: F.element_at(
        F.array(*[F.lit(get(r)) for r in rules]), F.col("fit") + 1)
    ruled = parsed.withColumns({
        "rule": F.when(F.col("fit").isNotNull(), part(lambda r: r[1] + r[2])),
        "ruled": F.when(F.col("fit").isNotNull(), part(lambda r: r[0])),
    }) if rules else parsed.withColumns({
        "rule": F.lit(None).cast("string"), "ruled": F.lit(None).cast("string")})

    # Every distinct labelled URL once, with its number.
    labelled = ruled.where("ruled IS NOT NULL").groupBy("url", "host", "path").agg(
        (F.first("ruled") == BLOCK).cast("double").alias("label"),
        F.count("*").cast("double").alias("n"))
    labelled = written(_lexical(labelled).select(
        "url", "host", "path", "suffix", "segment", "label", "n"), "url-labelled")
    classes = {r["label"]: (r["urls"], r["rows"]) for r in labelled.groupBy("label").agg(
        F.count("*").alias("urls"), F.sum("n").alias("rows")).collect()}
    rows = sum(c[1] for c in classes.values())
    share = classes.get(1.0, (0, 0.0))[1] / rows if rows else 0.0
    blocked = (F.sum(F.col("label") * F.col("n")) + 10 * share) / (F.sum("n") + 10)
    suffixes = small(written(labelled.groupBy("suffix").agg(
        F.sum("n").alias("f_suffix_seen"), blocked.alias("f_suffix_blocked")), "url-suffixes"))
    segments = small(written(labelled.groupBy("segment").agg(
        blocked.alias("f_segment_blocked")), "url-segments"))

    def with_statistics(rows: DataFrame) -> DataFrame:
        known = rows.join(suffixes, "suffix", "left").join(segments, "segment", "left")
        return known.fillna(0.0, ["f_suffix_seen"]).fillna(
            share, ["f_suffix_blocked", "f_segment_blocked"])

    judged = with_statistics(_lexical(ruled))
    if len(classes) == 2:
        vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        sample = _sampled(labelled, classes, train_rows, seed)
        train = vector.transform(with_statistics(_lexical(sample))).select(
            "features", "label", "weight").coalesce(4)
        trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=64, seed=seed,
                              subsamplingRate=1.0, weightCol="weight").fit(train)
        judged = trees.transform(vector.transform(judged))
        score = vector_to_array("probability")[1]
    else:
        score = F.lit(1.0 if set(classes) == {1.0} else 0.0)
    verdict = F.coalesce("ruled", F.when(F.col("score") >= 0.5, BLOCK).otherwise(ALLOW))
    return judged.withColumn("score", score).select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
