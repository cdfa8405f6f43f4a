"""Toxicity: a convolutional text classifier over hashed word embeddings, in numpy.

A word is two embeddings, one found by the hash of the word and one by the hash of its
first letters, so that inflected forms share what they learn. Filters one, two and three
words wide run over the text, each keeps its maximum, and a logistic layer reads these.
Thresholds are calibrated by the language that a text's function words show; they are
part of the score, so 0.5 is the threshold everywhere.

All labelled documents are learnt from. They are dealt to shards, and in each round every
shard goes on from the same weights; the next round starts from the mean of what they found.
Only weights, of fixed size, reach the driver. The model is applied to whole texts by tasks.
Very long texts are looked at in pieces that overlap, in learning too.
"""

from __future__ import annotations

import copy
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retinue.llm.common import small, written

#: Documents and characters of a shard, about, and the documents it has at least on average.
SHARD_DOCS, SHARD_CHARS, LEAST_DOCS = 4_000, 24_000_000, 256
FOLDS = 5
#: One part in CALIBRATION of the documents sets the thresholds instead of the weights.
CALIBRATION = 5
BUCKETS, DIMENSION, FILTERS, WIDTHS = 1 << 16, 8, 8, (1, 2, 3)
PREFIX, SEEN_IN = 4, 4
#: Hashes of known words are kept as bits; bits of a chunk are packed by one task.
SLOTS, CHUNK = 1 << 24, 1 << 19
#: Embeddings whose means one task takes.
PART = 1 << 13
EPOCHS, STEPS, BATCH, RATE = 6, 450, 32, 0.1
#: Words of a piece that one task looks at in one go.
PIECE = 200_000
#: Logits are counted in steps of 1 / STEPS_OF_LOGIT up to FURTHEST for the thresholds.
STEPS_OF_LOGIT, FURTHEST = 256, 64
PUNCTUATION = b".,;:!?|()[]{}<>\"'*_-"
#: Frequent function words of each language.
FUNCTION_WORDS = {
    "en": "the of and to in is that it for was with as be on are this",
    "de": "der die und das ist zu den mit sich auf nicht ein von dem im",
    "fr": "le les des et est un une du que qui dans pour sur pas au",
    "es": "el los las y que se del un por con para una es lo al",
}
LANGUAGES = ("", *FUNCTION_WORDS)


def _words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split() if text else []


def _languages_of_words() -> dict[bytes, int]:
    """Number of the one language a function word belongs to."""
    found: dict[bytes, int] = {}
    for number, words in enumerate(FUNCTION_WORDS.values(), 1):
        for word in words.encode().split():
            found[word] = 0 if word in found else number
    return found


class _Codes(dict):
    """Word to (word row, prefix row, language) as one number; forgets when it is large."""

    def __init__(self, known_words: bytes, known_prefixes: bytes):
        super().__init__()
        self.known_words, self.known_prefixes = known_words, known_prefixes
        self.languages = _languages_of_words()

    def __missing__(self, raw: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        word, prefix = _hashes(raw)
        row = word % BUCKETS if _is_known(word, self.known_words) else BUCKETS
        prefix_row = prefix % BUCKETS if _is_known(prefix, self.known_prefixes) else BUCKETS
        code = (row << 32) | (prefix_row << 8) | self.languages.get(raw.strip(PUNCTUATION), 0)
        self[raw] = code
        return code


def _hashes(raw: bytes) -> tuple[int, int]:
    word = raw.strip(PUNCTUATION)
    prefix = word.decode("utf-8", "ignore")[:PREFIX].encode()
    return zlib.crc32(word), zlib.crc32(b"\0" + prefix)


def _is_known(value: int, bits: bytes) -> int:
    slot = value % SLOTS
    return bits[slot >> 3] >> (slot & 7) & 1


def _rows(hashes: np.ndarray, bits: bytes) -> np.ndarray:
    """The embedding of each hash; that of unknown words for those whose bit is not set."""
    slots = hashes.astype(np.int64) % SLOTS
    known = np.frombuffer(bits, np.uint8)[slots >> 3] >> (slots & 7).astype(np.uint8) & 1
    return np.where(known == 1, slots % BUCKETS, BUCKETS)


@dataclass
class Model:
    """Weights; row ``BUCKETS`` of the embeddings is 0 and stands for unknown words. Known
    words and prefixes are bits by hash."""

    known_words: bytes
    known_prefixes: bytes
    words: np.ndarray
    prefixes: np.ndarray
    filters: list[np.ndarray]
    offsets: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray
    thresholds: np.ndarray

    def codes(self) -> _Codes:
        return _Codes(self.known_words, self.known_prefixes)

    def embedded(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        word, prefix = codes >> 32, (codes >> 8) & 0xFFFFFF
        return np.concatenate([self.words[word], self.prefixes[prefix]], axis=1), word, prefix

    def convolved(self, inputs: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        """The filters' responses at each word; those that cross texts are very low."""
        ends = np.append(starts[1:], len(inputs))
        responses = []
        for weights, offset in zip(self.filters, self.offsets):
            width = len(weights)
            m = len(inputs) - width + 1
            response = inputs[:m] @ weights[0]
            for j in range(1, width):
                response += inputs[j:m + j] @ weights[j]
            response += offset
            for j in range(1, width):
                crossing = ends - j
                response[crossing[crossing < m]] = -1e9
            responses.append(response)
        return responses

    def pooled(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        inputs = self.embedded(codes)[0]
        return np.concatenate(
            [np.maximum.reduceat(r, starts, axis=0) for r in self.convolved(inputs, starts)], 1)

    def logits(self, coded: Iterable[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
        """Logit and language of each of ``n`` texts, given as codes. Texts are packed into
        pieces; long ones are cut into several, which overlap by the widest filter, and maxima
        are taken over them."""
        features = np.full((n, FILTERS * len(WIDTHS)), -np.inf, dtype=np.float32)
        spoken = np.zeros((n, len(LANGUAGES)), dtype=np.int64)
        held: list[np.ndarray] = []
        owners: list[int] = []

        def flush() -> None:
            if held:
                lengths = np.array([len(h) for h in held])
                starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                np.maximum.at(features, owners, self.pooled(np.concatenate(held), starts))
                held.clear()
                owners.clear()

        waiting = 0
        for k, codes in enumerate(coded):
            spoken[k] = np.bincount(codes & 0xFF, minlength=len(LANGUAGES))
            for at in range(0, max(1, len(codes) - max(WIDTHS) + 1), PIECE):
                part = codes[at:at + PIECE + max(WIDTHS) - 1]
                held.append(part)
                owners.append(k)
                waiting += len(part)
                if waiting >= PIECE:
                    flush()
                    waiting = 0
        flush()
        spoken[:, 0] = 0
        language = np.where(spoken.max(axis=1) > 0, spoken.argmax(axis=1), 0)
        return np.maximum(features, 0) @ self.out + self.bias[0], language

    def scores(self, texts: list[str | None], cache: _Codes) -> np.ndarray:
        logits, language = self.logits((_coded(t, cache) for t in texts), len(texts))
        shifted = np.clip(logits - self.thresholds[language], -30, 30).astype(np.float64)
        return 1.0 / (1.0 + np.exp(-shifted))


def _coded(text: str | None, cache: _Codes) -> np.ndarray:
    """Codes of all words, filled up with unknown words to the widest filter."""
    return _filled_up(np.array([cache[w] for w in _words(text)], dtype=np.int64))


def _filled_up(codes: np.ndarray) -> np.ndarray:
    missing = max(WIDTHS) - len(codes)
    unknown = (BUCKETS << 32) | (BUCKETS << 8)
    return np.concatenate([codes, np.full(missing, unknown)]) if missing > 0 else codes


class _Adagrad:
    """Sums of squared gradients by which steps get smaller; they are carried from round to round."""

    def __init__(self, model: Model) -> None:
        self.dense = [np.full_like(w, 1e-3) for w in _dense(model)]
        self.tables = [np.full(BUCKETS, 1e-3, np.float32) for _ in range(2)]

    def step(self, at: int, weights: np.ndarray, gradient: np.ndarray) -> None:
        self.dense[at] += gradient * gradient
        weights -= RATE * gradient / np.sqrt(self.dense[at])

    def rows(self, table: int, weights: np.ndarray, at: np.ndarray, gradient: np.ndarray) -> None:
        used, where = np.unique(at, return_inverse=True)
        summed = np.zeros((len(used), weights.shape[1]), dtype=np.float32)
        np.add.at(summed, where, gradient)
        used, summed = used[used < BUCKETS], summed[used < BUCKETS]
        total = self.tables[table]
        total[used] += (summed * summed).mean(axis=1)
        weights[used] -= RATE * summed / np.sqrt(total[used])[:, None]


def _dense(model: Model) -> list[np.ndarray]:
    """All weights but the embeddings; a filter and its offset follow each other."""
    pairs = zip(model.filters, model.offsets)
    return [*(w for pair in pairs for w in pair), model.out, model.bias]


def _constant(label: int) -> Model:
    """The model of documents with one class, or none."""
    size = FILTERS * len(WIDTHS)
    zeros = np.zeros((BUCKETS + 1, DIMENSION), dtype=np.float32)
    return Model(bytes(SLOTS // 8), bytes(SLOTS // 8), zeros, zeros,
                 [np.zeros((w, 2 * DIMENSION, FILTERS), np.float32) for w in WIDTHS],
                 [np.zeros(FILTERS, np.float32) for _ in WIDTHS], np.zeros(size, np.float32),
                 np.array([4.0 if label else -4.0], np.float32), np.zeros(len(LANGUAGES)))


def _start(known_words: bytes, known_prefixes: bytes, seed: int) -> Model:
    rng = np.random.default_rng(seed)

    def start(*shape: int, scale: float = 0.1) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    model = Model(known_words, known_prefixes, start(BUCKETS + 1, DIMENSION),
                  start(BUCKETS + 1, DIMENSION),
                  [start(w, 2 * DIMENSION, FILTERS, scale=0.3) for w in WIDTHS],
                  [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
                  start(FILTERS * len(WIDTHS)), np.zeros(1, np.float32), np.zeros(len(LANGUAGES)))
    model.words[BUCKETS] = model.prefixes[BUCKETS] = 0
    return model


#: A shard in one row: hashes and languages of its distinct words; of its texts the places of
#: their words among these, their number, the label, and whether a text is set aside.
SHARD = {"words": "<u4", "prefixes": "<u4", "languages": "u1", "places": "<i4",
         "lengths": "<i8", "toxic": "u1", "aside": "u1"}
SHARD_SCHEMA = "shard int, " + ", ".join(f"{c} binary" for c in SHARD)


def packed(shard: int, rows: pd.DataFrame) -> dict:
    """The texts (_id, text, toxic, aside) of a shard, in the order of their ids."""
    rows = rows.sort_values("_id")
    places: dict[bytes, int] = {}
    texts = [np.array([places.setdefault(w, len(places)) for w in _words(t)], np.int32)
             for t in rows["text"]]
    languages = _languages_of_words()
    hashed = np.array([_hashes(w) for w in places], np.uint32).reshape(-1, 2)
    columns = {
        "words": hashed[:, 0], "prefixes": hashed[:, 1],
        "languages": [languages.get(w.strip(PUNCTUATION), 0) for w in places],
        "places": np.concatenate(texts), "lengths": [len(t) for t in texts],
        "toxic": rows["toxic"], "aside": rows["aside"]}
    return {"shard": shard, **{c: np.asarray(v).astype(SHARD[c]).tobytes()
                               for c, v in columns.items()}}


class _Shard:
    def __init__(self, row: dict):
        for name, kind in SHARD.items():
            setattr(self, name, np.frombuffer(row[name], kind))

    def texts_with(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each slot of these hashes of the words, and the number of texts that hold it."""
        slots, at = np.unique(hashes.astype(np.int64) % SLOTS, return_inverse=True)
        owner = np.repeat(np.arange(len(self.lengths)), self.lengths)
        held = np.unique(owner * max(1, len(slots)) + at[self.places])
        return slots, np.bincount(held % max(1, len(slots)), minlength=len(slots))

    def coded(self, model: Model) -> list[np.ndarray]:
        codes = (_rows(self.words, model.known_words) << 32
                 | _rows(self.prefixes, model.known_prefixes) << 8 | self.languages)
        ends = np.cumsum(self.lengths)
        return [_filled_up(codes[self.places[e - n:e]]) for e, n in zip(ends, self.lengths)]


def _shards(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, _Shard]]:
    for batch in batches:
        for row in batch.to_dict("records"):
            yield row["shard"], _Shard(row)


def _known(shards: DataFrame, least: int) -> list[bytes]:
    """Bits of the words, and of the prefixes, that at least so many texts hold."""
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, shard in _shards(batches):
            for kind, hashes in enumerate((shard.words, shard.prefixes)):
                slots, texts = shard.texts_with(hashes)
                yield pd.DataFrame({"kind": kind, "slot": slots, "texts": texts})

    def bits(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        held = np.zeros(CHUNK, np.uint8)
        held[rows["slot"].to_numpy() % CHUNK] = 1
        return pd.DataFrame({"kind": [key[0]], "chunk": [key[1]],
                             "bits": [np.packbits(held, bitorder="little").tobytes()]})

    counts = shards.mapInPandas(counted, "kind int, slot long, texts long")
    seen = counts.groupBy("kind", "slot").agg(F.sum("texts").alias("texts")).where(
        F.col("texts") >= least).select("kind", "slot", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    chunks = {(r["kind"], r["chunk"]): bytes(r["bits"]) for r in seen.groupBy("kind", "chunk")
              .applyInPandas(bits, "kind int, chunk long, bits binary").collect()}
    return [b"".join(chunks.get((kind, c), bytes(CHUNK // 8)) for c in range(SLOTS // CHUNK))
            for kind in range(2)]


def _round(shards: DataFrame, model: Model, adagrad: _Adagrad, epochs: int, everything: bool,
           share: float, seed: tuple[int, ...]) -> None:
    """Each shard learns from the same weights; these become the mean of what shards found.

    Means are taken in the order of the shards, so that a rerun agrees. An embedding's is
    that of the shards which changed it.
    """
    shared = shards.sparkSession.sparkContext.broadcast((model, adagrad))

    def learnt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for number, shard in _shards(batches):
            own, sums = copy.deepcopy(shared.value)
            coded, truth = shard.coded(own), shard.toxic.astype(np.float32)
            order = np.nonzero((shard.aside == 0) | everything)[0]
            weight = np.where(truth > 0, 0.5 / share, 0.5 / (1 - share))
            rng = np.random.default_rng((*seed, number))
            for _ in range(epochs):
                rng.shuffle(order)
                for at in range(0, len(order), BATCH):
                    batch = order[at:at + BATCH]
                    _learn(own, sums, [coded[i] for i in batch], truth[batch], weight[batch])
            if len(order):
                yield from changes(number, own, sums)

    def changes(number: int, own: Model, sums: _Adagrad) -> Iterator[pd.DataFrame]:
        flat = np.concatenate([w.ravel() for w in (*_dense(own), *sums.dense)])
        yield change(number, -1, np.arange(1), flat[None])
        for table, (new, old) in enumerate(
                ((own.words, shared.value[0].words), (own.prefixes, shared.value[0].prefixes))):
            used = np.nonzero((new != old).any(axis=1))[0]
            values = np.concatenate([new[used], sums.tables[table][used, None]], axis=1)
            used += table * BUCKETS
            for part in np.unique(used // PART):
                yield change(number, part, used[used // PART == part], values[used // PART == part])

    def change(number: int, part: int, used: np.ndarray, values: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"shard": [number], "part": [part],
                             "used": [used.astype("<i8").tobytes()],
                             "found": [values.astype("<f4").tobytes()]})

    def mean(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total: np.ndarray | None = None
        first = max(0, key[0]) * PART
        times = np.zeros(PART if key[0] >= 0 else 1)
        for _, used, found in sorted(zip(rows["shard"], rows["used"], rows["found"])):
            used = np.frombuffer(used, "<i8") - first
            found = np.frombuffer(found, "<f4").reshape(len(used), -1)
            if total is None:
                total = np.zeros((len(times), found.shape[1]))
            total[used] += found
            times[used] += 1
        used = np.nonzero(times)[0]
        return change(0, key[0], used + first, total[used] / times[used, None])

    found = shards.mapInPandas(learnt, "shard int, part int, used binary, found binary")
    means = found.groupBy("part").applyInPandas(
        mean, "shard int, part int, used binary, found binary").collect()
    for row in means:
        used = np.frombuffer(row["used"], "<i8")
        values = np.frombuffer(row["found"], "<f4").reshape(len(used), -1)
        if row["part"] < 0:
            at = 0
            for weights in (*_dense(model), *adagrad.dense):
                weights[:] = values[0, at:at + weights.size].reshape(weights.shape)
                at += weights.size
        else:
            table, rows = int(used[0]) // BUCKETS, used % BUCKETS
            (model.words, model.prefixes)[table][rows] = values[:, :-1]
            adagrad.tables[table][rows] = values[:, -1]
    shared.destroy()


def _peaks(model: Model, batch: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The highest response of each filter in each text, and the word, counted over the whole
    batch, where it is reached first. Long texts are cut as in scoring."""
    size = FILTERS * len(WIDTHS)
    high = np.full((len(batch), size), -np.inf, np.float32)
    place = np.zeros((len(batch), size), np.int64)
    held: list[tuple[int, int, np.ndarray]] = []

    def flush() -> None:
        owners, begins = np.array([h[0] for h in held]), np.array([h[1] for h in held])
        lengths = np.array([len(h[2]) for h in held])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        of = np.repeat(np.arange(len(held)), lengths)
        inputs = model.embedded(np.concatenate([h[2] for h in held]))[0]
        for k, response in enumerate(model.convolved(inputs, starts)):
            peak = np.maximum.reduceat(response, starts, axis=0)
            at, which = np.nonzero(response == peak[of[:len(response)]])
            key, first = np.unique(of[at] * FILTERS + which, return_index=True)
            at, piece, column = at[first], key // FILTERS, k * FILTERS + key % FILTERS
            reached, owner = peak[piece, key % FILTERS], owners[piece]
            higher = reached > high[owner, column]
            owner, column = owner[higher], column[higher]
            high[owner, column] = reached[higher]
            place[owner, column] = (begins[piece] + at - starts[piece])[higher]
        held.clear()

    waiting, begin = 0, 0
    for k, codes in enumerate(batch):
        for at in range(0, len(codes) - max(WIDTHS) + 1, PIECE):
            part = codes[at:at + PIECE + max(WIDTHS) - 1]
            held.append((k, begin + at, part))
            waiting += len(part)
            if waiting >= PIECE:  # no text has two pieces in one go
                flush()
                waiting = 0
        begin += len(codes)
    if held:
        flush()
    return high, place


def _learn(model: Model, adagrad: _Adagrad, batch: list[np.ndarray], truth: np.ndarray,
           weight: np.ndarray) -> None:
    """One step; the gradient of a maximum goes to the words where it was reached."""
    high, place = _peaks(model, batch)
    codes = np.concatenate(batch)
    hidden = np.maximum(high, 0)
    guess = 1 / (1 + np.exp(-np.clip(hidden @ model.out + model.bias[0], -30, 30)))
    error = ((guess - truth) * weight / len(batch)).astype(np.float32)
    back = np.outer(error, model.out) * (high > 0)
    at_words, at_gradients, steps = [], [], []
    for k, weights in enumerate(model.filters):
        owner, which = np.nonzero(back[:, k * FILTERS:(k + 1) * FILTERS])
        gradient, at = (x[owner, k * FILTERS + which] for x in (back, place))
        step, offset = np.zeros_like(weights), np.zeros_like(model.offsets[k])
        np.add.at(offset, which, gradient)
        for j in range(len(weights)):
            np.add.at(step[j].T, which, model.embedded(codes[at + j])[0] * gradient[:, None])
            at_words.append(at + j)
            at_gradients.append(weights[j].T[which] * gradient[:, None])
        steps += [step, offset]
    steps += [hidden.T @ error, np.array([error.sum()], dtype=np.float32)]
    at, gradients = codes[np.concatenate(at_words)], np.concatenate(at_gradients)
    for k, (weights, step) in enumerate(zip(_dense(model), steps)):
        adagrad.step(k, weights, step)
    if len(at):
        adagrad.rows(0, model.words, at >> 32, gradients[:, :DIMENSION])
        adagrad.rows(1, model.prefixes, (at >> 8) & 0xFFFFFF, gradients[:, DIMENSION:])


def _calibrate(shards: DataFrame, model: Model, everything: bool, toxic_share: float) -> None:
    """For each language the threshold with the fewest errors; of equal ones, nearest to the
    middle of the best gap. Languages with few texts take the threshold of all texts.

    Texts are counted by steps of their logit, of which the least and the largest logit are
    kept; thresholds lie between two steps.
    """
    shared = shards.sparkSession.sparkContext.broadcast(model)

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, shard in _shards(batches):
            coded = shard.coded(shared.value)
            rows = np.nonzero((shard.aside == 1) | everything)[0]
            logits, language = shared.value.logits((coded[i] for i in rows), len(rows))
            logits = logits.astype(np.float64)
            step = np.floor(np.clip(logits, -FURTHEST, FURTHEST) * STEPS_OF_LOGIT).astype(np.int64)
            yield pd.DataFrame({"language": language, "step": step, "logit": logits,
                                "toxic": shard.toxic[rows].astype(np.int64)})

    counts = shards.mapInPandas(judged, "language long, step long, logit double, toxic long").groupBy(
        "language", "step").agg(F.min("logit").alias("low"), F.max("logit").alias("high"),
                                F.sum("toxic").alias("toxic"),
                                F.sum(1 - F.col("toxic")).alias("clean")).collect()
    counts = pd.DataFrame([r.asDict() for r in counts])
    shared.destroy()
    share = counts["toxic"].sum() / (counts["toxic"] + counts["clean"]).sum()
    of_toxic, of_clean = toxic_share / share, (1 - toxic_share) / (1 - share)

    def best(rows: pd.DataFrame) -> float:
        rows = rows.groupby("step", sort=True).agg(
            {"low": "min", "high": "max", "toxic": "sum", "clean": "sum"})
        low, high = rows["low"].to_numpy(), rows["high"].to_numpy()
        missed = np.concatenate([[0], np.cumsum(rows["toxic"] * of_toxic)])
        alarms = np.concatenate([[0], np.cumsum(rows["clean"] * of_clean)])
        wrong = missed + alarms[-1] - alarms
        cuts = np.concatenate([[low[0] - 1], (low[1:] + high[:-1]) / 2, [high[-1] + 1]])
        gaps = np.concatenate([[1], low[1:] - high[:-1], [1]])
        ties = np.nonzero(wrong <= wrong.min() + 1e-9 * max(1, alarms[-1]))[0]
        # Few toxic texts say little about the threshold: it is drawn towards 0.
        toxic = rows["toxic"].sum()
        return float(cuts[ties[np.argmax(gaps[ties])]] * toxic / (toxic + 20))

    model.thresholds[:] = best(counts)
    for number in range(1, len(LANGUAGES)):
        rows = counts[counts["language"] == number]
        if min(rows["toxic"].sum(), rows["clean"].sum()) >= 10:
            model.thresholds[number] = best(rows)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    train_docs: int = SHARD_DOCS,
    train_chars: int = SHARD_CHARS,
    folds: int = FOLDS,
    seed: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
) -> Model:
    """The model learnt from ``labels`` (doc_id, toxic) of ids whose CRC is not 0 mod ``folds``.

    Every such id with a text is learnt from, by its whole text, or helps to set the
    thresholds. ``train_docs`` and ``train_chars`` say how many documents and characters, about,
    a shard learns from, whatever the partitions are; they leave nothing out. Rows with null
    id or label are not learnt from; an id with several labels is toxic if one says so, of an
    id with several texts the least counts.
    """
    in_fold = lambda c: F.pmod(F.crc32(F.col(c).cast("string")), F.lit(folds)) != 0
    usable = labels.where(F.col("toxic").isNotNull() & in_fold("doc_id")).groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"))
    usable = written(usable.select(F.col("doc_id").alias("_id"), "toxic"), "toxic-labels")
    total, toxic = usable.agg(F.count("*"), F.sum(F.col("toxic"))).first()
    picked = small(usable.where(F.col("toxic").isin(0, 1)))
    texts = docs.where(in_fold(doc_id)).select(
        F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    joined = texts.join(picked, "_id")
    rows, chars = joined.agg(F.count("*"), F.sum(F.length("text").cast("long"))).first()
    if not rows:
        return _constant(0)
    wanted = max(-(-rows // train_docs), -(-chars // train_chars))
    number = max(1, min(wanted, rows // LEAST_DOCS))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[pd.DataFrame]] = {}
        for batch in batches:
            for shard, part in batch.groupby("shard"):
                held.setdefault(int(shard), []).append(part)
        for shard, parts in held.items():
            yield pd.DataFrame([packed(shard, pd.concat(parts))])

    part = lambda salt, parts: F.pmod(F.xxhash64("_id", F.lit(seed + salt)), F.lit(parts))
    dealt = joined.groupBy("_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    dealt = dealt.select("_id", "text", "toxic", part(0, number).cast("int").alias("shard"),
                         (part(1, CALIBRATION) == 0).cast("int").alias("aside"))
    shards = written(dealt.repartitionById(number, F.col("shard")).mapInPandas(pack, SHARD_SCHEMA),
                     "toxic-shards")
    return _fitted(shards, number, toxic / total, seed)


def _fitted(shards: DataFrame, number: int, toxic_share: float, seed: int) -> Model:
    """``toxic_share`` is the share of label 1 where the model will be used."""
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, shard in _shards(batches):
            yield pd.DataFrame({"aside": shard.aside, "toxic": shard.toxic})

    classes = {(r["aside"], r["toxic"]): r["count"] for r in shards.mapInPandas(
        counted, "aside int, toxic int").groupBy("aside", "toxic").count().collect()}
    found = {label for _, label in classes}
    if len(found) < 2:
        return _constant(found.pop())
    everything = len(classes) < 4
    learning = {label: sum(n for (aside, other), n in classes.items()
                           if other == label and (everything or not aside)) for label in found}
    documents = sum(learning.values())
    least = min(SEEN_IN, max(1, sum(classes.values()) // 100))
    model = _start(*_known(shards, least), seed)
    adagrad = _Adagrad(model)
    epochs = max(EPOCHS, -(-STEPS * BATCH // documents))
    rounds = 1 if number == 1 else EPOCHS
    for k in range(rounds):
        _round(shards, model, adagrad, -(-epochs // rounds), everything, learning[1] / documents,
               (seed, k))
    _calibrate(shards, model, everything, toxic_share)
    return model


def score(spark, model: Model, text: Column) -> Column:
    """The score of each whole text, from 0 to 1; null counts as empty."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache = shared.value.codes()
        for texts in batches:
            yield pd.Series(shared.value.scores(texts.tolist(), cache))

    return scores(text)


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    ``held_out`` says that the id took no part in learning by the fold rule (a null id has
    no fold: false). Null and empty texts get the score of a text without known words.
    Without labels every score is low; with one class of label every score is that class.
    Repeated rows get equal scores; an empty table gives an empty result; other columns
    are not looked at.
    """
    model = fit(docs, labels, doc_id=doc_id, text=text, **options)
    folds = options.get("folds", FOLDS)
    held = F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(folds)) == 0
    scored = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held_out"),
        score(docs.sparkSession, model, F.col(text)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
