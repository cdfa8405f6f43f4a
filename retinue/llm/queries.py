"""One query for each operator, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retinue.llm import (
    alignment,
    fingerprints,
    jaccard,
    katz,
    licences,
    mixing,
    negatives,
    neighbours,
    packing,
    sharding,
    substrings,
    toxicity,
    urls,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its bin: bin, slot, start and length in words."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it."""
    docs = _table(spark, sf_dir, "documents")
    return mixing.mix(docs.select("doc_id", "text", "source")).select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its toxicity score."""
    return toxicity.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its shard, by the law of equal bytes."""
    placed = sharding.shard(_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL with the rule that fits and the verdict."""
    return urls.judge(_table(spark, sf_dir, "pages"))


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its set of word runs and its group."""
    return jaccard.similar(_table(spark, sf_dir, "documents"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint, an edited text's, and how alike they are."""
    return fingerprints.compare(_table(spark, sf_dir, "documents"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every twentieth vector, among all vectors."""
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"))


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the licence it is and the licences its lines state."""
    return licences.scan(_table(spark, sf_dir, "documents"), licences.known_digests(spark))


def op10_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its log probability under the model of nine tenths of them."""
    return katz.judge(_table(spark, sf_dir, "documents"))


def op11_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with how many words repeat earlier windows, and what is left of it."""
    return substrings.repeats(_table(spark, sf_dir, "documents")).drop("removed")


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, with every seventh one's label moved on."""
    rows = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its tokens by two tokenizers, their groups and links."""
    return alignment.align(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_mixing": op2_mixing,
    "op3_toxicity": op3_toxicity,
    "op4_sharding": op4_sharding,
    "op5_urls": op5_urls,
    "op6_jaccard": op6_jaccard,
    "op7_fingerprints": op7_fingerprints,
    "op8_neighbours": op8_neighbours,
    "op9_licences": op9_licences,
    "op10_katz": op10_katz,
    "op11_substrings": op11_substrings,
    "op12_negatives": op12_negatives,
    "op13_alignment": op13_alignment,
}

_OP2 = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '') || ':7:' || md5(coalesce(text, ''))) AS key
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    CASE (row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3
      WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
      / sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
    row_number() OVER f AS n
  FROM sources WINDOW f AS (ORDER BY 3 * source_size / weight, source NULLS LAST)
), first_open AS (
  SELECT min(n) AS n FROM levels WHERE level * weight < 3 * source_size
), budgets AS (
  SELECT source, source_size,
    CASE WHEN l.n >= o.n THEN (SELECT level FROM levels WHERE n = o.n) * weight
         ELSE (3 * source_size)::DOUBLE END AS target
  FROM levels l, first_open o
), ordered AS (
  SELECT s.*, b.source_size, b.target,
    CASE WHEN b.source_size > 0 THEN floor(b.target / b.source_size)::BIGINT ELSE 0 END AS epochs,
    coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target,
  (size * (epochs + CASE WHEN start * 2 + size <= (target - epochs * source_size) * 2 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered
""".replace(' COLLATE "C"', "")


def _sql_canonical(text: str) -> str:
    lowered = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bare = rf"regexp_replace({lowered}, '(?m)^[ \t]*(?:copyright\b|\(c\)|©)[^\n]*$', ' ', 'g')"
    plain = (rf"' ' || regexp_replace({bare}, "
             r"'[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', ' ', 'g') || ' '")
    for spelling, usual in licences.SPELLINGS:
        plain = f"replace({plain}, ' {spelling} ', ' {usual} ')"
    return f"trim(regexp_replace({plain}, ' +', ' ', 'g'))"


_KNOWN = ", ".join(f"('{name}', '{text}')" for name, text in licences.KNOWN)
_OP9 = f"""
WITH known AS (
  SELECT md5({_sql_canonical("text")}) AS digest, min(licence) AS licence
  FROM (VALUES {_KNOWN}) k(licence, text) GROUP BY 1
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents
), lines AS (
  SELECT r, unnest(string_split(body, chr(10))) AS line FROM docs
), found AS (
  SELECT r, count(*) AS n_lines, count(licence) AS n_notices,
    string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices
  FROM (SELECT r, line, {_sql_canonical("line")} AS form FROM lines WHERE line <> '') l
  LEFT JOIN known ON digest = CASE WHEN form <> '' THEN md5(form) END GROUP BY r
)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, licence AS text_licence,
  coalesce(n_notices, 0)::BIGINT AS n_notices, coalesce(notices, '') AS notices
FROM (SELECT *, {_sql_canonical("body")} AS form FROM docs) d LEFT JOIN found USING (r)
LEFT JOIN known ON digest = CASE WHEN form <> '' THEN md5(form) END
"""

_OP11 = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), w AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos, len(words) AS n FROM t
), runs AS (
  SELECT doc_id, pos, n, md5(string_agg(word, ' ') OVER (
    PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)) AS run FROM w
), later AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS nth
    FROM runs WHERE pos + 20 <= n) x
  WHERE nth > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM later
), kept AS (
  SELECT w.doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY w.pos) AS kept
  FROM w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.pos = w.pos WHERE g.doc_id IS NULL
  GROUP BY w.doc_id
)
SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN kept k ON k.doc_id = t.doc_id"""

_OP12 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS nth
  FROM s WHERE same
), n AS (
  SELECT p.anchor_id, positive_id, s.id AS negative_id, positive_score,
    s.score AS negative_score, CAST(row_number() OVER (
      PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id
  WHERE p.nth <= 5 AND NOT s.same AND 50 * positive_score <= 100 * s.score
    AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n
WHERE rank <= 3"""

ORACLE_SQL = {"op2_mixing": _OP2, "op9_licences": _OP9, "op11_substrings": _OP11,
              "op12_negatives": _OP12}
