"""Toxicity scores from bags of subwords: a linear softmax over the mean of subword vectors, both learned together.

A word is its bounded form ``<word>`` and the character n-grams of that form, each hashed to a row of the vector table.
Misspellings that were never seen share most of their n-grams with words that were.  Vectors and classifier are fitted
in numpy, in one task, on a bounded sample of labelled rows; scoring needs one number per table row and runs on all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strainwise.llm.ragged import chunks, gather, offsets_of

CHUNK_CHARS = 1 << 18
#: Words a task remembers; when there are more, it starts anew.  Bounds memory, does not change results.
CACHE_ENTRIES = 1 << 18


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` and ``sample_chars`` bound what is fitted on: so many labelled keys, the first by their hash, and of their texts
    those up to that length.  Everything else holds for texts of any length."""

    sample_rows: int = 6000
    sample_chars: int = 20_000
    shortest: int = 3
    longest: int = 6
    buckets: int = 1 << 20
    least_share: float = 1 / 300
    dimensions: int = 8
    steps: int = 720
    selecting: int = 360
    batch: int = 256
    rate: float = 0.05
    scale: float = 400.0
    shrink: float = 2.0
    seed: int = 11


_BREAKS = bytes.maketrans(b".,;:!?()[]{}\"'", b" " * 14)


def words_of(text: str) -> list[bytes]:
    """Lower-case words between white space and sentence punctuation."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_BREAKS).split()


class Subwords:
    """Rows of the vector table for words, found for many words at once."""

    def __init__(self, settings: Settings):
        self.settings = settings
        self.powers = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(1 << 10)], np.uint64)

    def rows(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(table rows, number of the word of each), in no order; n-grams are of characters of the bounded form."""
        forms = [b"<" + w + b">" for w in words]
        sizes = np.fromiter(map(len, forms), np.int64, len(forms))
        flat = np.frombuffer(b"".join(forms), np.uint8)
        place = np.arange(len(flat)) - np.repeat(offsets_of(sizes)[:-1], sizes)
        codes = (flat.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        codes ^= codes >> np.uint64(32)
        # Words as a whole: a polynomial of their bytes; words beyond 1024 bytes use its powers again.
        whole = np.add.reduceat(codes * self.powers[place & 1023], offsets_of(sizes)[:-1]) ^ np.uint64(0x5555)
        # Character by character for the n-grams.
        heads = np.flatnonzero((flat & 0xC0) != 0x80)
        owner = np.repeat(np.arange(len(forms)), sizes)[heads]
        chars = np.add.reduceat(codes * self.powers[(np.arange(len(flat)) - np.repeat(heads, np.diff(np.r_[heads, len(flat)]))) & 7], heads)
        last = offsets_of(np.bincount(owner, minlength=len(forms)))[1:][owner]
        at = np.arange(len(heads))
        value = np.zeros(len(heads), np.uint64)
        found, owners = [whole], [np.arange(len(forms))]
        for n in range(1, self.settings.longest + 1):
            at = at[at + n <= last[at]]
            value = (value[: len(at)] if n == 1 else value[kept(at, before)]) * np.uint64(0x9E3779B97F4A7C15) + chars[at + n - 1]
            before = at
            if n >= self.settings.shortest:
                found.append(value)
                owners.append(owner[at])
        values = np.concatenate(found)
        values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        rows = (values >> np.uint64(40)) % np.uint64(self.settings.buckets)
        return rows.astype(np.int64), np.concatenate(owners)


def kept(at: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Positions in ``before`` of the values that are still in ``at`` (both ascending)."""
    return np.searchsorted(before, at)


@dataclass
class Model:
    """What scoring needs of the fitted vectors and classifier: the difference of the two classes' logits for every table row."""

    settings: Settings
    logits: np.ndarray
    bias: float


def fit(texts: list[str], labels: list[int], settings: Settings = Settings()) -> Model:
    """Learn subword vectors and classifier together by Adam on the log loss.  Without rows the score is a half everywhere; with
    one label only it leans to that label.

    The logits of a document are ``settings.scale`` times the mean of its subwords' vectors, times the classifier.  As both
    steps are linear, each batch multiplies vectors and classifier first and sums numbers, not vectors, over subwords.
    """
    if not texts:
        return Model(settings, np.zeros(settings.buckets, np.float32), 0.0)
    rng = np.random.default_rng(settings.seed)
    number: dict[bytes, int] = {}
    bags = []
    for text in texts:
        words, counts = np.unique([number.setdefault(w, len(number)) for w in words_of(text)], return_counts=True)
        bags.append((words.astype(np.int32), counts.astype(np.int32)))
    rows, sizes = _rows_of(list(number), Subwords(settings))
    del number
    first = offsets_of(sizes)
    spread = np.zeros((2, settings.buckets), np.int32)  # documents by label and table row
    for label, (words, _) in zip(labels, bags):
        spread[label, np.unique(rows[gather(first[words], sizes[words])])] += 1
    # Rows of few documents of either label would only be learned by heart; their vectors stay zero.  A label's documents count by
    # themselves, so words of a rare label are learned.
    least = np.maximum(3, settings.least_share * np.bincount(labels, minlength=2))
    used = np.flatnonzero((spread >= least[:, None]).any(axis=0))
    del spread
    place = np.full(settings.buckets, -1, np.int32)
    place[used] = np.arange(len(used))
    rows = place[rows]
    entries = []  # of each document: its table rows, and their part in its mean
    for words, counts in bags:
        at, inverse = np.unique(rows[gather(first[words], sizes[words])], return_inverse=True)
        mass = np.bincount(inverse, np.repeat(counts, sizes[words]), len(at))
        mass = (settings.scale * mass / max(1.0, mass.sum())).astype(np.float32)
        entries.append((at[at >= 0], mass[at >= 0]))
    del bags, rows
    target = np.eye(2, dtype=np.float32)[np.array(labels, np.int64)]
    vectors = rng.normal(0, 0.1, (len(used), settings.dimensions)).astype(np.float32)
    matrix = rng.normal(0, 1, (settings.dimensions, 2)).astype(np.float32)
    offset = np.log((target.sum(axis=0) + 1) / (len(target) + 2)).astype(np.float32)
    state = [(np.zeros_like(x), np.zeros_like(x)) for x in (vectors, matrix, offset)]
    step = 0
    size = settings.batch
    rounds = -(-len(texts) // size)
    selecting, epochs = (max(1, round(n / rounds)) for n in (settings.selecting, settings.steps))
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        if epoch == selecting:  # only the rows left are fitted on, now without shrinking
            alive = np.flatnonzero(np.abs(vectors).sum(axis=1) > 0)
            place = np.full(len(used), -1, np.int32)
            place[alive] = np.arange(len(alive))
            used, vectors = used[alive], vectors[alive]
            state[0] = (state[0][0][alive], state[0][1][alive])
            entries = [(place[at][place[at] >= 0], mass[place[at] >= 0]) for at, mass in entries]
        phase = selecting if epoch < selecting else epochs
        rate = settings.rate * (1 - epoch / phase)
        for begin in range(0, len(order), size):
            part = order[begin:begin + size]
            doc = np.repeat(np.arange(len(part)), [len(entries[i][0]) for i in part])
            at = np.concatenate([entries[i][0] for i in part])
            mass = np.concatenate([entries[i][1] for i in part])
            product = vectors @ matrix
            logit = np.stack([np.bincount(doc, product[at, k] * mass, len(part)) for k in (0, 1)], 1) + offset
            chance = np.exp(logit - logit.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            error = (chance - target[part]) / len(part)
            flow = np.stack([np.bincount(at, error[doc, k] * mass, len(used)) for k in (0, 1)], 1).astype(np.float32)
            step += 1
            grads = (flow @ matrix.T, vectors.T @ flow, error.sum(axis=0).astype(np.float32))
            for value, grad, moments in zip((vectors, matrix, offset), grads, state):
                _adam(value, grad, moments, rate, step)
            if epoch < selecting:
                # Rows whose gradient keeps no direction shrink to zero, so that chance occurrences do not score.
                norm = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
                vectors *= np.maximum(0, 1 - settings.shrink * rate / np.maximum(norm, 1e-12))[:, None]
    logits = np.zeros(settings.buckets, np.float32)
    logits[used] = settings.scale * vectors @ (matrix[:, 1] - matrix[:, 0])
    return Model(settings, logits, float(offset[1] - offset[0]))


def _rows_of(words: list[bytes], subwords: Subwords) -> tuple[np.ndarray, np.ndarray]:
    """(table rows of all words one after the other, number of rows of each word), a part of the words at a time."""
    parts, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for begin in range(0, len(words), 1 << 15):
        part = words[begin:begin + (1 << 15)]
        found, owners = subwords.rows(part)
        parts.append(found[np.argsort(owners, kind="stable")].astype(np.int32))
        counts.append(np.bincount(owners, minlength=len(part)))
    return np.concatenate(parts), np.concatenate(counts)


def _adam(value: np.ndarray, grad: np.ndarray, moments: tuple[np.ndarray, np.ndarray], rate: float, step: int) -> None:
    mean, square = moments
    mean += 0.1 * (grad - mean)
    square += 0.01 * (grad * grad - square)
    value -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)


class Scorer:
    """Scores lists of texts; made once per task.  A word's sum of logits and its number of subwords are remembered."""

    def __init__(self, model: Model):
        self.model = model
        self.subwords = Subwords(model.settings)
        self._forget()

    def _forget(self) -> None:
        self.cache: dict[bytes, int] = {}
        self.sums = np.zeros(0)
        self.sizes = np.zeros(0, np.int64)

    def _learn(self, words: list[bytes]) -> None:
        rows, owners = self.subwords.rows(words)
        self.sums = np.r_[self.sums, np.bincount(owners, self.model.logits[rows], len(words))]
        self.sizes = np.r_[self.sizes, np.bincount(owners, minlength=len(words))]

    def score(self, texts: list[str]) -> np.ndarray:
        if len(self.cache) > CACHE_ENTRIES:
            self._forget()
        bags = [words_of(t) for t in texts]
        words = [w for bag in bags for w in bag]
        known = len(self.cache)
        codes = list(map(self.cache.get, words))
        if None in codes:
            number, seen = self.cache.setdefault, self.cache
            codes = [number(w, len(seen)) if c is None else c for w, c in zip(words, codes)]
            self._learn(list(islice(seen, known, None)))
        codes = np.array(codes, np.int64)
        doc = np.repeat(np.arange(len(texts)), [len(bag) for bag in bags])
        total = np.bincount(doc, self.sums[codes], len(texts))
        count = np.bincount(doc, self.sizes[codes], len(texts))
        logit = total / np.maximum(1, count) + self.model.bias
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def held_out(key: Column, folds: int = 5) -> Column:
    """Rows that are never learned from: the CRC-32 of the key's text divides by ``folds``.  A null key is held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == 0, F.lit(True))


def learn(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, settings: Settings = Settings()) -> Model:
    """Fit on at most ``settings.sample_rows`` labelled rows outside the held-out fold.

    Rows with a null label or text, and keys labelled both ways, are left out; repeated rows count once.
    """
    named = (
        labels.filter(F.col(label).isNotNull()).groupBy(F.col(f"`{key}`").alias("__key"))
        .agg(F.min(label).alias("label"), F.max(label).alias("other")).filter("label = other")
    )
    # Keys are chosen first; only the texts of the chosen ones travel.
    sample = (
        named.filter(~held_out(F.col("__key"))).orderBy(F.xxhash64("__key"), "__key").limit(settings.sample_rows).select("__key", "label")
    )
    chosen = (
        docs.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("text"))
        .filter(F.length("text") <= settings.sample_chars)
        .join(sample, "__key").distinct()
    )

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, marks = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            marks += batch.column(1).to_pylist()
        model = fit(texts, marks, settings)
        yield pa.RecordBatch.from_arrays([pa.array([model.logits.tobytes()]), pa.array([model.bias])], ["logits", "bias"])

    # A task holds the bounded sample and the fit; the driver gets the numbers that scoring needs.
    ordered = chosen.repartition(1).sortWithinPartitions("__key", "text").select("text", F.col("label").cast("int").alias("label"))
    made = ordered.mapInArrow(fitted, "logits binary, bias double").first()
    if made is None:  # the planner leaves out what would read no rows
        return fit([], [], settings)
    return Model(settings, np.frombuffer(made["logits"], np.float32), made["bias"])


def score_toxicity(df: DataFrame, text: str, model: Model, score: str = "score", predicted: str = "predicted") -> DataFrame:
    """Add a score from 0 to 1 and ``predicted``, 1 where it is at least a half.

    Null, empty and wordless texts get the score of the classifier's bias.  Texts of any length are scored whole; other columns stay;
    columns called like an output are replaced.
    """

    @F.arrow_udf("double")
    def rate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model)
        for batch in batches:
            done = [scorer.score(part) for part in chunks([t or "" for t in batch.to_pylist()], CHUNK_CHARS)]
            yield pa.array(np.concatenate(done) if done else np.zeros(0))

    return df.withColumn(score, rate(F.col(f"`{text}`"))).withColumn(predicted, (F.col(score) >= 0.5).cast("int"))
