"""Licence scan by canonical digests, with DataFrame functions only.

A text, every line of it and every run of blocks between blank lines are brought to a
canonical form and looked up among the digests of known licence texts in the same form.
"""

from __future__ import annotations

from collections.abc import Sequence
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retinue.llm.common import ascii_lower, small, written

#: Common licence notices and their SPDX identifiers. ``table`` has more.
KNOWN = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only",
     "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
)
#: Spellings that licence texts use for the same word.
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("organisation", "organization"), ("authorised", "authorized"),
    ("acknowledgement", "acknowledgment"), ("v2", "version 2"), ("v3", "version 3"),
    ("noncommercial", "non commercial"), ("copyright holder", "copyright owner"),
)
#: Lines of this form name a holder, not a licence; licence texts also break before these words.
COPYRIGHT = (
    r"(?m)^[ \t]*(?:copyright\b(?!,|[ \t]+(?:notices?|holders?|owners?|laws?|licen[cs]es?|and|or|on|in"
    r"|is|to|of|interests?|rights?|permission|protection|statements?|status|treaty|doctrines)\b)"
    r"|\(c\)(?![ \t]+(?:you|the|a|an|any|all|if|for|in|to|under)\b)|©)[^\n]*$")
#: Lines without a letter or a digit part blocks; ``CONTENT`` is a line that has one.
BLANK = r"\n[\x00-\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\n"
CONTENT = r"(?m)^[^\n]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F][^\n]*"


def canonical(text: Column) -> Column:
    """Lower case, without copyright lines and punctuation, one spelling, single spaces."""
    bare = F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), COPYRIGHT, " ")
    plain = F.concat(F.lit(" "), F.regexp_replace(bare, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+",
                                                  " "), F.lit(" "))
    for spelling, usual in SPELLINGS:
        plain = F.replace(plain, F.lit(f" {spelling} "), F.lit(f" {usual} "))
    return F.trim(F.regexp_replace(plain, " +", " "))


def _digest(text: Column) -> Column:
    """Digest of the canonical form; null if nothing is left in it."""
    form = canonical(text)
    return F.when(form != "", F.md5(form))


def _wrapped(text: Column) -> Column:
    """Whether a text has several lines besides copyright lines."""
    bare = F.regexp_replace(ascii_lower(text), COPYRIGHT, " ")
    return F.contains(F.trim(text), F.lit("\n")) & (F.regexp_count(bare, F.lit(CONTENT)) > 1)


def table() -> list[tuple[str, str]]:
    """(licence, text) of the table that comes along: full texts, standard headers, notices and
    SPDX lines. A text is named after its licence, and after ``__`` by its version."""
    folder = files("retinue.llm") / "licence_table"
    read = lambda path: path.read_text(encoding="utf-8")
    texts = [(f.name.removesuffix(".txt").split("__")[0], read(f))
             for f in (folder / "texts").iterdir() if f.name.endswith(".txt")]
    notices = [tuple(line.split("\t")) for line in read(folder / "notices.tsv").splitlines()]
    spdx = [(name, f"SPDX-License-Identifier: {name}")
            for name in read(folder / "spdx.txt").splitlines()]
    return [*KNOWN, *sorted(texts), *notices, *spdx]


def known_digests(
    spark: SparkSession, known: DataFrame | Sequence[tuple[str, str]] | None = None
) -> DataFrame:
    """(digest, licence, runs) of the known texts; the smallest name if several are alike.

    ``known`` is (licence, text), a table that Spark reads or rows; ``table()`` by default.
    ``runs`` are the digests of the blocks of the texts with that digest: one array for
    each way in which they are cut into blocks.
    """
    rows = known if isinstance(known, DataFrame) else spark.createDataFrame(
        list(table() if known is None else known), "licence string, text string")
    numbered = rows.select("licence", "text", F.monotonically_increasing_id().alias("row"))
    blocks = numbered.select("*", F.posexplode(F.split("text", BLANK)).alias("at", "block"))
    blocks = blocks.withColumn("part", _digest(F.col("block")))
    runs = blocks.groupBy("row", "licence", "text").agg(F.transform(F.array_sort(F.collect_list(
        F.when(F.col("part").isNotNull(), F.struct("at", "part")))), lambda b: b.part).alias("run"))
    digested = runs.withColumn("digest", _digest(F.col("text"))).where("digest IS NOT NULL")
    return digested.groupBy("digest").agg(
        F.min("licence").alias("licence"), F.collect_set("run").alias("runs"))


def scan(
    docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_lines, text_licence, n_notices, notices) for every row of ``docs``.

    ``known`` is (digest, licence, runs), digests unique, as from ``known_digests``.
    ``text_licence`` is the licence whose text the whole document is, else null;
    ``notices`` names the licences that whole lines state, or blocks of several lines
    between blank lines, or several blocks one after the other; sorted, comma-separated, and
    empty without any. ``n_notices`` counts those lines and runs of blocks (a run inside
    a longer one is not counted). Lines without a letter or digit are blank, and copyright
    lines are left out. Null and empty texts have no lines and no licence. A text with
    nothing left in canonical form matches nothing. Repeated rows are reported each;
    other columns are not looked at.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, r"\n"), lambda line: line != "")
    blocks = F.split(body, BLANK)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
        F.concat(F.array(body), lines).alias("units"), blocks.alias("blocks"))
    # A text of one block is that block.
    units = rows.select(
        "doc_id", "row", (F.size("units") - 1).cast("long").alias("n_lines"),
        (F.size("blocks") == 1).alias("one"),
        F.posexplode(F.concat("units", F.when(F.size("blocks") > 1, F.col("blocks")).otherwise(
            F.array().cast("array<string>")))).alias("at", "unit"))
    block = (F.col("at") > F.col("n_lines")) | ((F.col("at") == 0) & F.col("one"))
    digested = units.withColumn("form", canonical(F.col("unit"))).select(
        "doc_id", "row", "n_lines", "at", block.alias("block"),
        F.when(block, _wrapped(F.col("unit"))).alias("wrapped"),
        F.when(F.col("form") != "", F.md5("form")).alias("digest"))

    known = written(known.select("digest", "licence", "runs"), "licences")
    # A run of blocks is looked up by its first block, and then compared.
    begun = known.select("licence", F.explode("runs").alias("run")).groupBy("run").agg(
        F.min("licence").alias("licence")).groupBy(F.get("run", 0).alias("digest")).agg(
        F.collect_list(F.struct("licence", "run")).alias("begun"))
    looked_up = small(written(known.select("digest", "licence").join(
        begun, "digest", "full"), "licences-begun"))
    found = digested.join(looked_up, "digest", "left")
    line = (F.col("at") > 0) & (F.col("at") <= F.col("n_lines"))
    notice = F.when(line, F.col("licence"))
    # All units of a row come from one task, so the shuffle has one row for each document.
    gathered = found.groupBy("row", "doc_id", "n_lines").agg(
        F.max(F.when(F.col("at") == 0, F.col("licence"))).alias("text_licence"),
        F.count(notice).alias("n_stated"), F.collect_set(notice).alias("stated"),
        F.array_sort(F.collect_list(F.when(F.col("block") & F.col("digest").isNotNull(), F.struct(
            "at", "digest", "wrapped")))).alias("parts"),
        F.collect_list(F.when(F.col("block") & F.col("begun").isNotNull(), F.struct(
            "at", "begun"))).alias("anchors"))
    digests = F.transform("parts", lambda p: p.digest)
    first = lambda a: F.array_position(
        F.transform("parts", lambda p: p.at), a.at).cast("int")
    runs = F.flatten(F.transform("anchors", lambda a: F.transform(
        F.filter(a.begun, lambda b: F.slice(F.col("digests"), first(a), F.size(b.run)) == b.run),
        lambda b: F.struct(b.licence.alias("licence"), first(a).alias("low"),
                           (first(a) + F.size(b.run) - 1).alias("high")))))
    # A block of one line is that line, which is counted already.
    several = F.filter("runs", lambda r: (r.low < r.high) | F.element_at(
        "parts", r.low).wrapped)
    outer = F.filter("runs", lambda r: ~F.exists("runs", lambda o: (
        o.low <= r.low) & (o.high >= r.high) & (o.high - o.low > r.high - r.low)))
    return gathered.withColumn("digests", digests).withColumn("runs", runs).withColumn(
        "runs", several).withColumn("runs", outer).select(
        "doc_id", "n_lines", "text_licence",
        (F.col("n_stated") + F.size("runs")).alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("stated", F.transform(
            "runs", lambda r: r.licence)))), ",").alias("notices"))
