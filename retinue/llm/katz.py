"""Language model scoring: a bigram model with Good-Turing discounts and Katz backoff.

P(w | h) is d(c) c(h, w) / c(h) for bigrams in the table and alpha(h) P(w) for all others,
where P(w) = d(c) c(w) / N, and alpha(h) makes the probabilities of all words after h sum to
exactly 1. The log probability of a text is then a sum of three: log P(w) over its tokens,
log alpha(h) over its histories, and a correction for each bigram in the table. The first
two need a table by word, the third one by bigram, and no token needs both at once.

Bigrams are dealt to slices by their history (frequent histories by the bigram), packed by
batches of documents: each distinct bigram of a batch once, with the documents it is in,
as places in a list of the pack's words, compressed.
Counting sums each slice's packs and keeps the counts packed, by slice. A word that is not
frequent is a history of one slice, which knows its count: a slice asks there, once for all
its distinct words, and what it is told makes probabilities, weights and corrections of its
bigrams in place. Only frequent histories need a sum over slices. Scoring reads the counts of
a slice and then one pack after the other, and returns a sum per document. No bigram is ever
a row. Words are told apart by 48 bits of their hash.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retinue.llm.common import WORD, ascii_lower, written

FOLDS = 10
#: Counts up to this one are discounted; bigrams below MIN_COUNT are left to backoff, so none.
DISCOUNTED, MIN_COUNT = 5, 1
START, END = 0, 1
#: Tokens of a pack that is counted and of one that is scored, which bound a task's memory.
COUNT_TOKENS, SCORE_TOKENS = 1_500_000, 600_000
#: Words with more than 1 in FREQUENT * slices of the tokens are frequent.
FREQUENT = 8
#: A slice for so many bytes of training text, MIN_SLICES at least; its tables are in one task.
SLICE_BYTES, MIN_SLICES = 24_000_000, 12
#: Bigrams of a row of the counts.
TABLE_ROW = 1_000_000
ZSTD_LEVEL = 1
#: Kinds of rows; within a slice they come in this order.
_HISTORIES, _TABLE, _HOT_TABLE, _WANTED, _ANSWER, _PACK, _HEAD = range(7)
_TIMES, _WORD_TIMES, _TOKENS, _DISTINCT, _HOT = range(7, 12)


class Codes(dict):
    """Words to 48-bit numbers above END; forgets when it is large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = code = max(END + 1, xxhash.xxh3_64_intdigest(word) >> 16)
        return code

    def of(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "replace").lower().split() if text else []
        return np.array([self[w] for w in words], dtype=np.int64)


def _planes(values: np.ndarray) -> bytes:
    """Numbers as bytes, one significance after the other, so that small ones compress."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _numbers(data: bytes, dtype: type = np.uint32) -> np.ndarray:
    """The inverse of ``_planes``."""
    planes = np.frombuffer(data, dtype=np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def _pack_numbers(values: np.ndarray) -> bytes:
    return zstandard.compress(_planes(values.astype(np.int64)), ZSTD_LEVEL)


def _unpack_numbers(data: bytes) -> np.ndarray:
    return _numbers(zstandard.decompress(data), np.int64)


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack_numbers(np.diff(values, prepend=0))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack_numbers(data))


def _pack_codes(values: np.ndarray) -> bytes:
    """The distinct codes, the most frequent first, and which of them each value is."""
    names, at, n = np.unique(values, return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")
    rank = np.empty(len(names), dtype=np.uint32)
    rank[order] = np.arange(len(names), dtype=np.uint32)
    return zstandard.compress(np.int64(len(names)).tobytes() + _planes(names[order]) + _planes(
        rank[at]), ZSTD_LEVEL)


def _unpack_codes(data: bytes) -> np.ndarray:
    data = zstandard.decompress(data)
    n = int(np.frombuffer(data, dtype=np.int64, count=1)[0])
    return _numbers(data[8:8 + 8 * n], np.int64)[_numbers(data[8 + 8 * n:])]


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination of the sorted columns begins."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.nonzero(new)[0]


@dataclass
class Slicing:
    """Slices by history; by the bigram for the histories in ``hot`` (sorted)."""

    slices: int
    hot: np.ndarray

    def of(self, history: np.ndarray, word: np.ndarray) -> np.ndarray:
        frequent = np.isin(history, self.hot)
        return np.where(frequent, history ^ word, history) % self.slices


def _bigrams(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(history, word, number of the text) of all tokens, sorted."""
    lengths = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(lengths)
    words = np.full(ends[-1], END, dtype=np.int64)
    inside = np.ones(ends[-1], dtype=bool)
    inside[ends - 1] = False
    words[inside] = np.concatenate(texts)
    history = np.concatenate([[START], words[:-1]])
    history[ends[:-1]] = START
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), lengths)
    order = np.lexsort((owner, words, history))
    return history[order], words[order], owner[order]


def _packs(texts: list[np.ndarray], slicing: Slicing, owners: bool) -> Iterator[tuple]:
    """(slice, histories, bigrams per history, words, tokens per bigram, owners) as bytes."""
    history, word, owner = _bigrams(texts)
    first = _runs(history, word)
    times = np.diff(np.append(first, len(word)))
    at = slicing.of(history[first], word[first])
    order = np.argsort(at, kind="stable")
    bounds = np.searchsorted(at[order], np.arange(slicing.slices + 1))
    for s in range(slicing.slices):
        mine = order[bounds[s]:bounds[s + 1]]
        if not len(mine):
            continue
        held = b""
        if owners:
            starts, n = first[mine], times[mine]
            picked = np.repeat(starts - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(
                n.sum())
            held = _pack_numbers(owner[picked])
        yield s, *_packed(history[first[mine]], word[first[mine]], times[mine]), held


def _packed(history: np.ndarray, word: np.ndarray, times: np.ndarray) -> tuple[bytes, ...]:
    """(histories, bigrams per history, words, times) of bigrams sorted by history."""
    new = _runs(history)
    return (_pack_codes(history[new]), _pack_numbers(np.diff(np.append(new, len(history)))),
            _pack_codes(word), _pack_numbers(times))


def _unpacked(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    histories = np.repeat(_unpack_codes(row.histories), _unpack_numbers(row.runs))
    return histories, _unpack_codes(row.words), _unpack_numbers(row.times)


_PACKED = ("slice int, kind int, base long, n long, histories binary, runs binary, "
           "words binary, times binary, owners binary")
_BLANK = (b"",) * 5


def _batches(rows: Iterator[pd.DataFrame], most: int) -> Iterator[tuple]:
    """Texts as codes with their rows, in batches of about ``most`` tokens."""
    cache = Codes()
    for frame in rows:
        held, begun, tokens = [], 0, 0
        for k, text in enumerate(frame["text"]):
            held.append(cache.of(text))
            tokens += len(held[-1]) + 1
            if tokens >= most or k + 1 == len(frame):
                yield held, frame.iloc[begun:k + 1]
                held, begun, tokens = [], k + 1, 0


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


def _good_turing(times: dict[int, int], total: int, least: int = 1) -> list[float]:
    """Discounts of the counts 1 to DISCOUNTED (Katz); 0 below ``least``.

    Where a count of counts is missing, or the estimate is no discount, there is none.
    """
    n = [0.0, *(float(times.get(r, 0)) for r in range(1, DISCOUNTED + 2))]
    common = (DISCOUNTED + 1) * n[-1] / n[1] if n[1] else 1.0
    out = []
    for r in range(1, DISCOUNTED + 1):
        d = 1.0
        if n[r] and n[r + 1] and common < 1:
            d = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common)
        out.append(0.0 if r < least else d if 0 < d < 1 else 1.0)
    return out


@dataclass
class Laws:
    """Discounts by count, and the frequent words (sorted) with what is known of each.

    The end of text stands for the start among histories. ``share`` and ``log_alpha`` are
    what a frequent history gives its bigrams and all other words.
    """

    words: np.ndarray
    bigrams: np.ndarray
    total: int
    scale: float
    names: np.ndarray
    counts: np.ndarray
    share: np.ndarray
    log_alpha: np.ndarray

    def p(self, n: np.ndarray) -> np.ndarray:
        return n * self.words[np.minimum(n, DISCOUNTED + 1)] * (self.scale / max(1, self.total))

    def held(self, n: np.ndarray) -> np.ndarray:
        return n * self.bigrams[np.minimum(n, DISCOUNTED + 1)]


@dataclass
class Model:
    """Counts packed by slice, counts of the words that each slice asked for, and the laws."""

    counts: DataFrame
    answers: DataFrame
    slicing: Slicing
    laws: Laws
    distinct: int
    log_unknown: float


def _as_word(history: np.ndarray) -> np.ndarray:
    """Histories as the words they are; the start of a text is named by the end."""
    return np.where(history == START, END, history)


def _joined(arrays: list[np.ndarray], dtype: type = np.int64) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype), *arrays])


def _sums(values: np.ndarray, begun: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, begun) if len(begun) else values[:0]


def _weights(held: np.ndarray, p: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(share, log alpha) of histories from the sums of their bigrams and their counts."""
    # What the bigrams of a history leave; a history seen with nothing else leaves something.
    left = np.maximum(1 - held / seen, 1 / (seen + 1))
    return (1 - left) / held, np.log10(left / (1 - p))


def _followers(part: pd.DataFrame, laws: Laws) -> tuple[np.ndarray, ...]:
    """(history, word, discounted count, P(word)) of the bigrams in the rows of a slice, sorted."""
    answers = part[part["kind"] == _ANSWER]
    names = _joined([laws.names, *map(_unpack_sorted, answers["words"])])
    n = _joined([laws.counts, *map(_unpack_numbers, answers["times"])])
    order = np.argsort(names)
    names, n = names[order], n[order]
    tables = [_unpacked(r) for r in part[part["kind"].isin([_TABLE, _HOT_TABLE])].itertuples()]
    history, word, times = (_joined([t[k] for t in tables]) for k in range(3))
    order = np.lexsort((word, history))
    history, word, times = history[order], word[order], times[order]
    return history, word, laws.held(times), laws.p(n[np.searchsorted(names, word)])


def _counted(part: pd.DataFrame, slicing: Slicing, min_count: int) -> Iterator[tuple]:
    """Rows of ``_PACKED``: what the packs of a slice add up to and which words it asks for."""
    at = int(part["slice"].iloc[0])
    history, word, times = (
        np.concatenate(c) for c in zip(*[_unpacked(r) for r in part.itertuples()]))
    order = np.lexsort((word, history))
    history, word, times = history[order], word[order], times[order]
    first = _runs(history, word)
    times = np.add.reduceat(times, first)
    history, word = history[first], word[first]
    begun = _runs(history)
    names, n = history[begun], np.add.reduceat(times, begun)
    hot = np.isin(names, slicing.hot)
    yield at, _HISTORIES, 0, 0, _pack_sorted(names[~hot]), b"", b"", _pack_numbers(n[~hot]), b""
    for kind, values in ((_TIMES, times), (_WORD_TIMES, n[~hot])):
        for r, k in zip(*np.unique(values[values <= DISCOUNTED + 1], return_counts=True)):
            yield at, kind, int(r), int(k), *_BLANK
    yield at, _TOKENS, 0, int(n[~hot].sum()), *_BLANK
    yield at, _DISTINCT, 0, int(np.sum(~hot)), *_BLANK
    for name, k in zip(names[hot], n[hot]):
        yield at, _HOT, int(name), int(k), *_BLANK
    kept, of_hot = times >= min_count, np.isin(history, slicing.hot)
    for kind, mine in ((_TABLE, kept & ~of_hot), (_HOT_TABLE, kept & of_hot)):
        places = np.nonzero(mine)[0]
        for begin in range(0, len(places), TABLE_ROW):
            row = places[begin:begin + TABLE_ROW]
            yield at, kind, 0, 0, *_packed(history[row], word[row], times[row]), b""
    asked = np.unique(word[kept])
    asked = asked[~np.isin(asked, _as_word(slicing.hot))]
    to = asked % slicing.slices
    for s in np.unique(to):
        yield int(s), _WANTED, at, 0, b"", b"", _pack_sorted(asked[to == s]), b"", b""


def _frequent(docs: DataFrame, n: int, slices: int, seed: int = 17) -> np.ndarray:
    """Words that are frequent in a sample of about 16 of ``n`` texts a slice; only sends them
    apart."""
    share = min(1.0, 16 * slices / max(1, n))
    drawn = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1_000_000)) < int(share * 1_000_000) + 1
    words = docs.where(drawn).select(F.explode(F.regexp_extract_all(
        ascii_lower(F.coalesce("text", F.lit(""))), F.lit(f"({WORD})"))).alias("word"))
    counts = words.groupBy("word").count()
    limit = (counts.agg(F.sum("count")).first()[0] or 0) / (FREQUENT * slices)
    found = counts.where(F.col("count") > limit).orderBy(F.desc("count")).limit(
        FREQUENT * slices).collect()  # shares above 1 in 8 slices: there are no more
    codes = Codes()
    return np.array(sorted({START, *(codes[r["word"].encode()] for r in found)}), dtype=np.int64)


def fit(docs: DataFrame, slicing: Slicing, min_count: int = MIN_COUNT) -> Model:
    """The model of all ``docs`` (key, text)."""
    slices = slicing.slices

    def pack(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for texts, _ in _batches(rows, COUNT_TOKENS):
            packs = [(p[0], _PACK, 0, 0, *p[1:]) for p in _packs(texts, slicing, False)]
            yield _frame(packs, _PACKED)

    def count(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _grouped(rows, "slice"):
            yield _frame(list(_counted(part, slicing, min_count)), _PACKED)

    def answer(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = n = None
        for frame in rows:
            out = []
            for r in frame.itertuples():
                if r.kind == _HISTORIES:
                    names, n = _unpack_sorted(r.histories), _unpack_numbers(r.times)
                else:
                    found = n[np.searchsorted(names, _unpack_sorted(r.words))]
                    out.append((r.base, _ANSWER, r.slice, 0, b"", b"", r.words,
                                _pack_numbers(found), b""))
            yield _frame(out, _PACKED)

    counts = written(_sliced(docs.select("text").mapInPandas(pack, _PACKED), slices).mapInPandas(
        count, _PACKED), "katz-counts")
    answers = written(_sliced(counts.where(F.col("kind").isin(_HISTORIES, _WANTED)), slices)
                      .mapInPandas(answer, _PACKED), "katz-answers")

    # Every word is a history once each time it occurs; the end of text occurs once a text.
    found = counts.where(F.col("kind") >= _TIMES).groupBy("kind", "base").agg(
        F.sum("n").alias("n")).collect()  # FREQUENT * slices
    of = {k: {r["base"]: r["n"] for r in found if r["kind"] == k} for k in range(_TIMES, _HOT + 1)}
    hot = sorted((END if h == START else h, n) for h, n in of[_HOT].items())
    total = of[_TOKENS].get(0, 0) + sum(n for _, n in hot)
    distinct = of[_DISTINCT].get(0, 0) + len(hot)
    times = {r: of[_WORD_TIMES].get(r, 0) + sum(n == r for _, n in hot)
             for r in range(1, DISCOUNTED + 2)}
    discounts = _good_turing(times, total)
    known = sum(times[r] * r * (discounts[r - 1] - 1) for r in range(1, DISCOUNTED + 1))
    mass = (total + known) / total if total else 0.0
    # An unknown word gets what the discounts leave, and something in any case.
    unknown = max(1 - mass, 1 / (total + 1))
    laws = Laws(
        np.array([1.0, *discounts, 1.0]),
        np.array([1.0, *_good_turing(of[_TIMES], total, min_count), 1.0]),
        total, (1 - unknown) / mass if mass else 0.0,
        np.array([h for h, _ in hot], dtype=np.int64), np.array([n for _, n in hot], dtype=np.int64),
        np.zeros(len(hot)), np.zeros(len(hot)))

    def hot_sums(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _grouped(rows, "slice"):
            history, _, held, p = _followers(part, laws)
            begun = _runs(history)
            yield pd.DataFrame({"name": _as_word(history[begun]), "held": _sums(held, begun),
                                "p": _sums(p, begun)})

    sums = _sliced(counts.where(F.col("kind") == _HOT_TABLE).unionByName(answers), slices)
    for r in sums.mapInPandas(hot_sums, "name long, held double, p double").groupBy("name").agg(
            F.sum("held").alias("held"), F.sum("p").alias("p")).collect():  # FREQUENT * slices
        k = np.searchsorted(laws.names, r["name"])
        laws.share[k], laws.log_alpha[k] = _weights(r["held"], r["p"], laws.counts[k])
    return Model(counts, answers, slicing, laws, distinct, float(np.log10(unknown)))


def _sliced(rows: DataFrame, slices: int) -> DataFrame:
    """Each slice in a task of its own, its rows by kind."""
    return rows.repartitionById(slices, F.col("slice")).sortWithinPartitions("slice", "kind")


def _grouped(rows: Iterator[pd.DataFrame], column: str) -> Iterator[pd.DataFrame]:
    """The rows of each value, from frames sorted by the column."""
    held: list[pd.DataFrame] = []
    for frame in rows:
        for at, part in frame.groupby(column, sort=True):
            if held and held[0][column].iloc[0] != at:
                yield pd.concat(held)
                held = []
            held.append(part)
    if held:
        yield pd.concat(held)


class _Lookup:
    """The tables of a slice, made of its counts, as sorted arrays."""

    def __init__(self, part: pd.DataFrame, laws: Laws):
        own = part[part["kind"] == _HISTORIES]
        names = _joined([laws.names, *map(_unpack_sorted, own["histories"])])
        n = _joined([laws.counts, *map(_unpack_numbers, own["times"])])
        order = np.argsort(names)
        names, n = names[order], n[order]
        frequent = np.searchsorted(names, laws.names)
        share, log_alpha = np.zeros(len(names)), np.zeros(len(names))

        history, word, held, p = _followers(part, laws)
        begun = _runs(history)
        runs = np.diff(np.append(begun, len(history)))
        at = np.searchsorted(names, _as_word(history[begun]))
        # A frequent history is in several slices: its sums here are parts, replaced next.
        share[at], log_alpha[at] = _weights(_sums(held, begun), _sums(p, begun), n[at])
        share[frequent], log_alpha[frequent] = laws.share, laws.log_alpha
        at = np.repeat(at, runs)
        self.gamma = np.log10(held * share[at]) - log_alpha[at] - np.log10(p)
        self.words = names, n, np.log10(laws.p(n)), log_alpha
        # A bigram's key: the places of its words among the distinct ones, in one number.
        self.history, (self.word, place) = history[begun], np.unique(word, return_inverse=True)
        self.key = np.repeat(np.arange(len(begun)), runs) * len(self.word) + place

    def word_values(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(count, log P or NaN, log alpha) of words, which are in the slice or frequent."""
        n, p, a = np.zeros(len(words)), np.full(len(words), np.nan), np.zeros(len(words))
        names, *values = self.words
        if len(names):
            at = np.minimum(np.searchsorted(names, words), len(names) - 1)
            found = names[at] == words
            for to, value in zip((n, p, a), values):
                to[found] = value[at[found]]
        return n, p, a

    def gammas(self, history: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Corrections of bigrams; 0 for one that is not in the table."""
        out = np.zeros(len(history))
        if len(self.key):
            h = np.minimum(np.searchsorted(self.history, history), len(self.history) - 1)
            w = np.minimum(np.searchsorted(self.word, word), len(self.word) - 1)
            key = h * len(self.word) + w
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            found = (self.history[h] == history) & (self.word[w] == word) & (self.key[at] == key)
            out[found] = self.gamma[at[found]]
        return out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_sum, log_p) for the rows of ``docs`` (key, doc_id, text).

    Ids are strings. Keys tell rows apart and only need to hold while this runs; those of
    ``monotonically_increasing_id`` do, as every pack brings along what it is keyed by.
    """
    slicing, laws, unknown = model.slicing, model.laws, model.log_unknown

    def pack(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for texts, frame in _batches(rows, SCORE_TOKENS):
            base = int(frame["key"].iloc[0])
            out = [(p[0], _PACK, base, 0, *p[1:]) for p in _packs(texts, slicing, True)]
            lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64).tobytes()
            ids = json.dumps(frame["doc_id"].tolist()).encode()
            head = (base % slicing.slices, _HEAD, base, 0, lengths, b"", ids, b"", b"")
            yield _frame([*out, head], _PACKED)

    def add(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lookup, tables, at = None, [], None
        for frame in rows:
            for (slice_, kind), part in frame.groupby(["slice", "kind"], sort=True):
                if slice_ != at:
                    lookup, tables, at = None, [frame.iloc[:0]], slice_
                if kind < _PACK:
                    tables.append(part)
                    continue
                if lookup is None:
                    lookup, tables = _Lookup(pd.concat(tables), laws), []
                yield pd.DataFrame(
                    [(r.base, slice_, kind, r.histories, r.words) if kind == _HEAD else
                     (r.base, slice_, kind, summed(r, lookup), None) for r in part.itertuples()],
                    columns=["base", "slice", "kind", "values", "ids"])

    def summed(row, lookup: _Lookup) -> bytes:
        """(text, known tokens, base, log P) of what a pack adds to each of its texts."""
        history, word, times = _unpacked(row)
        owner = _unpack_numbers(row.owners)
        # The word that a history is counts as a token; the end of text does for the start.
        began = _runs(history)
        token = np.where(history[began] == START, END, history[began])
        n, log_p, log_alpha = lookup.word_values(token)
        runs = np.diff(np.append(began, len(history)))
        value = np.where(np.isnan(log_p), unknown, log_p) + log_alpha
        per_bigram = np.repeat(np.stack([n > 0, np.log10(n + 0.1), value]), runs, axis=1)
        per_bigram[2] += lookup.gammas(history, word)
        per_token = np.repeat(per_bigram, times, axis=1)
        texts, inverse = np.unique(owner, return_inverse=True)
        sums = [np.bincount(inverse, weights=v, minlength=len(texts)) for v in per_token]
        known = np.rint(sums[0]).astype(np.uint32)
        return texts.astype(np.uint32).tobytes() + known.tobytes() + np.concatenate(
            sums[1:]).tobytes()

    def gather(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _grouped(rows, "base"):
            head = part[part["kind"] == _HEAD].iloc[0]
            lengths = np.frombuffer(head["values"], dtype=np.int64)
            sums = np.zeros((3, len(lengths)))
            for value in part[part["kind"] == _PACK].sort_values("slice")["values"]:
                n = len(value) // 24
                texts, known = np.frombuffer(value, dtype=np.uint32, count=2 * n).reshape(2, n)
                sums[0, texts] += known
                sums[1:, texts] += np.frombuffer(value, offset=8 * n).reshape(2, n)
            yield pd.DataFrame({
                "doc_id": json.loads(head["ids"]), "n_tokens": lengths,
                "n_known": np.rint(sums[0]).astype(np.int64), "base_sum": sums[1],
                "log_p": sums[2]})

    packed = docs.select("key", "doc_id", "text").mapInPandas(pack, _PACKED)
    tables = model.counts.where(F.col("kind").isin(_HISTORIES, _TABLE, _HOT_TABLE))
    parts = _sliced(tables.unionByName(model.answers).unionByName(packed), slicing.slices).mapInPandas(
            add, "base long, slice int, kind int, values binary, ids binary")
    return parts.repartition("base").sortWithinPartitions("base").mapInPandas(
        gather, "doc_id string, n_tokens long, n_known long, base_sum double, log_p double")


def judge(
    docs: DataFrame,
    folds: int = FOLDS,
    slices: int | None = None,
    min_count: int = MIN_COUNT,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Texts whose id has CRC 0 mod ``folds`` are held out of learning (a null id is not).
    ``score`` is the log10 probability of the text's words and its end; ``base_score``
    that of additively smoothed single words. Null and empty texts are one token, the
    end. If there is nothing to learn from, every token is unknown, with probability 1.
    Repeated rows are learnt from and scored each; an empty table gives an empty result;
    other columns are not looked at. A very long text is counted and scored as a whole, in a
    pack of its own. ``slices`` defaults to one for each ``SLICE_BYTES`` of training text; a task
    holds a slice of the tables and one pack.
    """
    held = F.coalesce(F.pmod(F.crc32("doc_id"), F.lit(folds)) == 0, F.lit(False))
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"),
                       F.col(text).cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("key"))
    training = rows.where(~held)
    n, size = training.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    slices = slices or max(MIN_SLICES, (size or 0) // SLICE_BYTES)
    slicing = Slicing(slices, _frequent(training, n, slices))
    model = fit(training, slicing, min_count)
    total = model.laws.total
    norm = float(np.log10(total + 0.1 * (model.distinct + 1)))
    return score(rows, model).select(
        F.col("doc_id").cast(docs.schema[doc_id].dataType).alias("doc_id"),
        held.alias("held_out"), "n_tokens", "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base_sum") - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        F.col("log_p").alias("score"))
