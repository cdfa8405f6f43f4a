"""Exact similarity join of word n-gram sets by signature trees.

Documents with equal sets are one class. Classes that may link are brought together first:
the hashes of a set fall into parts, more parts than two linked sets can differ in
hashes, so linked sets agree in some of the larger parts, and the digest of such a part with
all its hashes is a very selective key. Classes connected by such keys form a group, which one task can hold.
In a group, a tree is built over the classes: nodes hold the OR of their bitmaps and the
range of their sizes. A dual traversal from the root drops pairs of nodes whose bitmaps
and sizes do not allow enough overlap, and exact intersection decides what is left. Pairs
that are connected already need no test, so a group of near copies costs about a test
for each copy. Large groups are cut into blocks of similar sizes, and the traversal starts
from pairs of blocks.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retinue.llm.common import small, written
from retinue.llm.graph import components

WORDS, PERCENT = 3, 90
LEAF, FANOUT = 32, 8
#: Hashes that one block of a group may hold; a task holds two blocks.
BLOCK_HASHES = 1_000_000
MAX_BITS = 1 << 16
_MULTIPLIERS = np.array(
    [(0x9E3779B97F4A7C15 * (2 * j + 1) ^ (0xBF58476D1CE4E5B9 << j)) % 2**64 | 1
     for j in range(16)], dtype=np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    v = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words; forgets when it is large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, words: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``words`` words, or of the whole if it is less."""
    raw = text.encode("utf-8", "replace").lower().split() if text else []
    if not raw:
        return np.empty(0, dtype=np.uint64)
    hashes = np.array([cache[w] for w in raw], dtype=np.uint64)
    width = min(words, len(hashes))
    runs = len(hashes) - width + 1
    total = np.full(runs, width, dtype=np.uint64)
    for j in range(width):
        total = mixed(total + hashes[j:j + runs] * _MULTIPLIERS[j])
    return np.unique(total)


def most_different(size: int, percent: int) -> int:
    """Hashes in which a set of this size and a linked, not smaller one can differ at most."""
    larger = size * 100 // percent
    return (size + larger) * (100 - percent) // (100 + percent)


def _bands(percent: int) -> list[tuple[int, int]]:
    """(largest size, differences + 1) of each band; band k has 2**k parts."""
    bands = []
    for k in range(40):
        parts = 1 << k
        allowed = parts if parts <= 4 else int(0.85 * parts)
        bands.append(((allowed * (100 + percent) - 1) // (2 * (100 - percent)), allowed))
    return bands


def part_keys(hashes: np.ndarray, percent: int, bands: list[tuple[int, int]]) -> np.ndarray:
    """Keys of which two linked sets share one at least.

    A pair is compared in the band of its larger set, so a set gives keys for its own band
    and for that of the largest set it can link with. Linked sets agree in ``agreeing`` parts
    at least, so the parts that hold fewest hashes, fewer parts than that, are left out: what
    a shared passage makes equal are mostly small parts. Of two thresholds the higher one
    counts, and equal parts are equally large, so a part that both sets keep is left.
    """
    size = len(hashes)
    if not size:
        return np.empty(0, dtype=np.uint64)
    fits = lambda n: next(k for k, (most, _) in enumerate(bands) if n <= most)
    salted = mixed(hashes + np.uint64(0x632BE59BD9B4E019))
    keys = []
    for k in range(fits(size), fits(size * 100 // percent) + 1):
        parts = 1 << k
        part = (hashes >> np.uint64(64 - k) if k else np.zeros(size, np.uint64)).astype(np.int64)
        starts = np.concatenate([[0], np.nonzero(np.diff(part))[0] + 1])
        digests = np.zeros(parts, dtype=np.uint64)
        digests[part[starts]] = np.add.reduceat(salted, starts)
        held = np.bincount(part, minlength=parts)
        agreeing = parts - min(bands[k][1] - 1, most_different(size, percent))
        kept = np.nonzero(held >= np.partition(held, agreeing - 1)[agreeing - 1])[0]
        place = (kept.astype(np.uint64) << np.uint64(8)) + np.uint64(k)
        keys.append(mixed(digests[kept] + mixed(place)))
    return np.concatenate(keys)


class Tree:
    """Signature tree: levels of (OR bitmap, least size, largest size, surplus), leaves first.

    The surplus of a set is its size minus the bits it sets, so the hashes of two sets that
    fall into common bits are at most those bits and the smaller surplus.
    """

    def __init__(self, sets: list[np.ndarray], bits: int):
        self.words = np.zeros((len(sets), bits // 64), dtype=np.uint64)
        for k, hashes in enumerate(sets):
            at = (mixed(hashes) & np.uint64(bits - 1)).astype(np.int64)
            np.bitwise_or.at(self.words[k], at >> 6,
                             np.uint64(1) << (at & 63).astype(np.uint64))
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        surplus = self.sizes - np.bitwise_count(self.words).sum(axis=1, dtype=np.int64)
        level = (self.words, self.sizes, self.sizes, surplus)
        self.levels = []
        width = LEAF
        while True:
            cuts = np.arange(0, len(level[0]), width)
            level = (np.bitwise_or.reduceat(level[0], cuts), np.minimum.reduceat(level[1], cuts),
                     np.maximum.reduceat(level[2], cuts), np.maximum.reduceat(level[3], cuts))
            self.levels.append(level)
            width = FANOUT
            if len(cuts) == 1:
                break

    def may_link(self, level: int, a: int, other: Tree, other_level: int, b: int,
                 percent: int) -> bool:
        bits_a, low_a, high_a, surplus_a = (x[a] for x in self.levels[level])
        bits_b, low_b, high_b, surplus_b = (x[b] for x in other.levels[other_level])
        if high_a * 100 < percent * low_b or high_b * 100 < percent * low_a:
            return False
        common = int(np.bitwise_count(bits_a & bits_b).sum()) + min(surplus_a, surplus_b)
        return min(common, high_a, high_b) * (100 + percent) >= percent * (low_a + low_b)

    def leaf_pairs(self, other: Tree, percent: int) -> Iterator[tuple[int, int]]:
        """Pairs of leaves that the dual traversal cannot rule out; once each if the same."""
        same = self is other
        stack = [(len(self.levels) - 1, 0, len(other.levels) - 1, 0)]
        while stack:
            i, a, j, b = stack.pop()
            if same and i == j and a > b:
                continue
            if not self.may_link(i, a, other, j, b, percent):
                continue
            if i == 0 and j == 0:
                yield a, b
            elif i >= j:  # open the higher node; both of them if they are equally high
                lower = range(a * FANOUT, min((a + 1) * FANOUT, len(self.levels[i - 1][0])))
                if i == j:
                    others = range(b * FANOUT, min((b + 1) * FANOUT, len(other.levels[j - 1][0])))
                    stack.extend((i - 1, x, j - 1, y) for x in lower for y in others)
                else:
                    stack.extend((i - 1, x, j, b) for x in lower)
            else:
                lower = range(b * FANOUT, min((b + 1) * FANOUT, len(other.levels[j - 1][0])))
                stack.extend((i, a, j - 1, y) for y in lower)

    def possible(self, a: int, other: Tree, b: int, percent: int) -> np.ndarray:
        """Pairs of members of two leaves whose bitmaps and sizes allow a link."""
        mine = slice(a * LEAF, min((a + 1) * LEAF, len(self.sizes)))
        theirs = slice(b * LEAF, min((b + 1) * LEAF, len(other.sizes)))
        x, y = self.words[mine], other.words[theirs]
        only_x = np.bitwise_count(x[:, None] & ~y[None]).sum(axis=2, dtype=np.int64)
        only_y = np.bitwise_count(~x[:, None] & y[None]).sum(axis=2, dtype=np.int64)
        m, n = self.sizes[mine][:, None], other.sizes[theirs][None]
        most = np.minimum(m - only_x, n - only_y)
        return np.argwhere(most * (100 + percent) >= percent * (m + n)) + (mine.start,
                                                                            theirs.start)


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def spanning_links(left: dict[str, np.ndarray], right: dict[str, np.ndarray] | None,
                   percent: int) -> list[tuple[str, str]]:
    """Pairs that connect all that links connect, in ``left``, or between it and ``right``: every
    name that has a link with the first one of those it is connected to."""
    def planted(members: dict[str, np.ndarray], bits: int) -> tuple[list[str], Tree]:
        names = sorted(members, key=lambda n: (members[n][:2].tolist(), len(members[n])))
        return names, Tree([members[n] for n in names], bits)

    sizes = [len(s) for part in (left, right or {}) for s in part.values()]
    bits = min(MAX_BITS, max(64, 1 << (8 * max(sizes) - 1).bit_length()))
    names, tree = planted(left, bits)
    others, other = planted(right, bits) if right is not None else (names, tree)
    members = left if right is None else {**left, **right}
    root = {n: n for n in members}

    def find(n: str) -> str:
        while root[n] != n:
            root[n] = n = root[root[n]]
        return n

    for a, b in tree.leaf_pairs(other, percent):
        for i, j in tree.possible(a, other, b, percent):
            x, y = names[i], others[j]
            if (p := find(x)) != (q := find(y)) and linked(members[x], members[y], percent):
                root[p] = q
    # A star, not the links as found, so that no long path is left to follow.
    first: dict[str, str] = {}
    return [(top, n) for n in sorted(root) if (top := first.setdefault(find(n), n)) != n]


def text_key(text: str) -> Column:
    """A hash by which rows of a text find each other; it never decides alone."""
    return F.xxhash64(F.col(text).cast("string"))


def _features(docs: DataFrame, words: int, percent: int, doc_id: str, text: str) -> DataFrame:
    bands = _bands(percent)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordHashes()
        for rows in batches:
            sets = [shingles(t, words, cache) for t in rows["text"]]
            yield pd.DataFrame({
                "doc_id": rows["doc_id"], "key": rows["key"], "n_shingles": [len(s) for s in sets],
                "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest()
                           if len(s) else None for s in sets],
                "parts": [part_keys(s, percent, bands).view(np.int64) for s in sets]})

    # Ids travel as text, since pandas turns whole numbers with nulls into floats.
    narrow = docs.select(F.col(doc_id).cast("long").cast("string").alias("doc_id"),
                         F.col(text).cast("string").alias("text")).withColumn("key", text_key("text"))
    made = narrow.mapInPandas(
        features, "doc_id string, key long, n_shingles long, digest string, parts array<long>")
    return written(made.withColumn("doc_id", F.col("doc_id").cast("long")), "jaccard-features")


def _candidates(classes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all classes which share a key, by two levels of stars.

    A task links the classes that share a key among its own and sends only the first of
    them on, so a key that very many share is one entry for each task. The entries travel
    packed, by ranges of keys.
    """
    ranges = max(12, int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def starred(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        first = np.concatenate([[True], keys[1:] != keys[:-1]])
        leader = nodes[first][np.cumsum(first) - 1]
        other = leader != nodes
        edges = np.unique(np.stack([leader[other], nodes[other]]), axis=1)
        return keys[first], nodes[first], edges

    def rows(at: list[int], keys: list[bytes], nodes: list[bytes]) -> pd.DataFrame:
        return pd.DataFrame({"range": pd.Series(at, dtype="int32"), "keys": keys, "nodes": nodes})

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths = [len(p) for p in batch["parts"]]
            if not sum(lengths):
                continue
            keys = np.concatenate(batch["parts"].tolist()).astype(np.int64).view(np.uint64)
            keys, nodes, edges = starred(keys, np.repeat(batch["node"].to_numpy(), lengths))
            ends = np.searchsorted(keys, (np.arange(1, ranges, dtype=np.float64)
                                          * (2.0**64 / ranges)).astype(np.uint64))
            yield rows([*range(ranges), -1],
                       [*(k.tobytes() for k in np.split(keys, ends)), edges[0].tobytes()],
                       [*(n.tobytes() for n in np.split(nodes, ends)), edges[1].tobytes()])

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _same_keys(batches, ["range"]):
            if part["range"].iloc[0] < 0:
                ends = [np.frombuffer(b"".join(part[c]), dtype=np.int64) for c in ("keys", "nodes")]
            else:
                _, _, ends = starred(
                    np.frombuffer(b"".join(part["keys"]), dtype=np.uint64),
                    np.frombuffer(b"".join(part["nodes"]), dtype=np.int64))
            yield pd.DataFrame({"a": ends[0], "b": ends[1]})

    packed = classes.select("node", "parts").mapInPandas(
        local, "range int, keys binary, nodes binary")
    # Edges found on the spot have no range to meet in; they are dealt at random.
    dealt = F.when(F.col("range") < 0, -1 - F.pmod(F.xxhash64("keys"), F.lit(ranges)).cast("int")
                   ).otherwise(F.col("range"))
    dealt = packed.where(F.octet_length("keys") > 0).withColumn("range", dealt)
    placed = dealt.repartitionById(ranges, F.pmod("range", F.lit(ranges)))
    return placed.sortWithinPartitions("range").mapInPandas(across, "a long, b long")


def _blocks(members: DataFrame, percent: int, block_hashes: int) -> DataFrame:
    """Members (node, digest, doc_id, key, n_shingles, label) for each pair of blocks to compare.

    Groups that fit are one block. Others are dealt to blocks by hash within bands of
    sizes, and two blocks meet only if their ranges of sizes allow a link.
    """
    weight = F.col("n_shingles") + 64
    band = F.floor(F.log(F.col("n_shingles")) / F.log(F.lit(100 / percent))).cast("int")
    banded = members.withColumn("band", band)
    totals = banded.groupBy("label", "band").agg(F.sum(weight).alias("held"))
    whole = totals.groupBy("label").agg(F.sum("held").alias("all"))
    counts = totals.join(whole, "label").select(
        "label", "band", (F.col("all") <= block_hashes).alias("fits"),
        F.ceil(F.col("held") / block_hashes).alias("blocks"))
    cut = written(banded.join(counts, ["label", "band"]).withColumn(
        "block", F.when(F.col("fits"), F.lit(0)).otherwise(
            F.col("band") * (1 << 20) + F.pmod(F.xxhash64("digest"), F.col("blocks")))
    ).select("node", "digest", "doc_id", "key", "n_shingles", "label", "block"),
        "jaccard-members")
    ranges = cut.groupBy("label", "block").agg(
        F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high"))
    one = ranges.select("label", F.col("block").alias("i"), F.col("low").alias("low_i"),
                        F.col("high").alias("high_i"))
    two = ranges.select("label", F.col("block").alias("j"), F.col("low").alias("low_j"),
                        F.col("high").alias("high_j"))
    pairs = one.join(two, "label").where(
        (F.col("i") <= F.col("j")) & (F.col("high_i") * 100 >= F.col("low_j") * percent)
        & (F.col("high_j") * 100 >= F.col("low_i") * percent)).select("label", "i", "j")
    sides = pairs.select("label", "i", "j", F.explode(
        F.array_distinct(F.array("i", "j"))).alias("block"))
    return cut.join(sides, ["label", "block"])


def _same_keys(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of each key, from batches that are sorted by the keys."""
    held: list[pd.DataFrame] = []
    last = None
    for rows in batches:
        for key, part in rows.groupby(keys, sort=True):
            if held and key != last:
                yield pd.concat(held)
                held = []
            held.append(part)
            last = key
    if held:
        yield pd.concat(held)


def similar(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    block_hashes: int = BLOCK_HASHES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    Two documents link if 100 times the size of the intersection of their sets of runs of
    ``words`` words is at least ``percent`` times that of the union; a text with fewer
    words is one run, and ``component_id`` is the least id that links reach, the own one
    included. Null texts and texts without words have no runs and link with nothing. A row is
    judged by its text, so texts that share an id need not be in one component. Any whole
    number is an id; a null id is never the least one, and the component is null if no row in
    it has an id. A very long text is hashed whole by one task. An empty table gives an empty
    result; other columns are not looked at. Sets are compared by 64-bit hashes.
    """
    return _components(docs, words, percent, block_hashes, doc_id, text).select(
        "doc_id", "n_shingles", "component_id")


def _components(
    docs: DataFrame, words: int, percent: int, block_hashes: int, doc_id: str, text: str
) -> DataFrame:
    """(doc_id, key, n_shingles, label, component_id); the label, null without words, is the
    same for all rows of a component, with ids or without."""
    features = _features(docs, words, percent, doc_id, text)
    # Classes of equal sets go by a number of their own; their text is that of the row of
    # least id. The table is written, so the numbers stay.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("least")
    classes = written(
        features.where("digest IS NOT NULL").groupBy("digest").agg(
            least, F.first("n_shingles").alias("n_shingles"), F.first("parts").alias("parts"))
        .select("digest", "least.doc_id", "least.key", "n_shingles", "parts",
                F.monotonically_increasing_id().alias("node")), "jaccard-classes")

    groups = components(_candidates(classes), "jaccard-groups")

    members = classes.drop("parts").join(groups, "node")
    tasks = small(written(_blocks(members, percent, block_hashes).select(
        "doc_id", "key", "digest", "node", "label", "i", "j", "block"), "jaccard-blocks"))
    texts = docs.select(F.col(doc_id).cast("long").alias("own_id"), text_key(text).alias("own_key"),
                        F.col(text).cast("string").alias("text"))
    texts = texts.join(tasks, (F.col("own_key") == F.col("key"))
                       & F.col("own_id").eqNullSafe(F.col("doc_id"))).select(
        "text", "digest", "node", "label", "i", "j", "block")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordHashes()
        for rows in batches:
            made = [shingles(t, words, cache).tobytes() for t in rows["text"]]
            same = [hashlib.blake2b(s, digest_size=16).hexdigest() == d
                    for s, d in zip(made, rows["digest"])]
            yield rows.drop(columns="text").assign(hashes=made)[same]

    hashed = texts.mapInPandas(
        sets, "digest string, node long, label long, i long, j long, block long, hashes binary")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _same_keys(batches, ["label", "i", "j"]):
            node = dict(zip(rows["digest"], rows["node"]))
            sides: dict[int, dict[str, np.ndarray]] = {}
            for block, digest, value in zip(rows["block"], rows["digest"], rows["hashes"]):
                sides.setdefault(block, {})[digest] = np.frombuffer(value, dtype=np.uint64)
            i, j = rows["i"].iloc[0], rows["j"].iloc[0]
            links = spanning_links(sides[i], None if i == j else sides[j], percent)
            yield pd.DataFrame([(node[x], node[y]) for x, y in links], columns=["a", "b"],
                               dtype="int64")

    ordered = hashed.repartition("label", "i", "j").sortWithinPartitions("label", "i", "j")
    links = ordered.mapInPandas(compare, "a long, b long")
    labels = components(links, "jaccard-links")

    grouped = classes.select("digest", "doc_id", "node").join(labels, "node", "left").select(
        "digest", "doc_id", F.coalesce("label", "node").alias("label"))
    first = grouped.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    grouped = grouped.select("digest", "label").join(first, "label")
    result = features.drop("parts").join(grouped, "digest", "left")
    return result.select("doc_id", "key", "n_shingles", "label", F.when(
        F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias(
            "component_id"))


def representatives(docs: DataFrame, words: int, percent: int, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that link to another that stays.

    Of each component the row of least id stays, null ids coming last and texts of one id in
    the order of a hash. Rows without words stay. Of rows that repeat id and text one stays.
    Columns of any name are kept as they are.
    """
    found = written(_components(docs, words, percent, BLOCK_HASHES, doc_id, text), "jaccard-found")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("least")
    kept = found.where("label IS NOT NULL").groupBy("label").agg(least)
    is_kept = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("key") == F.col("least.key"))
    # Names that no column of a caller has.
    own, gone_id, gone_key = (f"{c}_{uuid.uuid4().hex}" for c in ("key", "id", "gone"))
    gone = small(written(
        found.join(kept, "label").where(~is_kept)
        .select(F.col("doc_id").alias(gone_id), F.col("key").alias(gone_key)).distinct(),
        "jaccard-gone"))
    rows = docs.withColumn(own, text_key(text))
    rows = rows.join(gone, (F.col(own) == F.col(gone_key))
                     & F.col(doc_id).cast("long").eqNullSafe(F.col(gone_id)), "left_anti")
    repeated = found.groupBy("doc_id", "key").count().where("count > 1")
    if not repeated.limit(1).isEmpty():
        rows = rows.dropDuplicates([doc_id, own])
    return rows.drop(own)
