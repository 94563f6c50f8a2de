"""Quality scores from learned embeddings: hashed vectors of words, word pairs and character n-grams, averaged per document.

A softmax over the mean vector gives the score.  Vectors and softmax are trained together by stochastic gradient descent in numpy on a
bounded sample of labelled rows; the sample takes as many rows of either label, and the softmax's offsets are then moved to the shares
the labels have in all rows to learn from.  Words keep their case and their signs, as these tell quality.  After training
a document's logit is the mean of one number per feature, so scoring runs on whole texts with a table of numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strainwise.llm.ragged import chunks, gather, offsets_of
from strainwise.llm.toxicity import Subwords

CHUNK_CHARS = 1 << 18
#: Characters of the words a task remembers; when there are more, it starts anew.  Bounds memory, does not change results.
CACHE_CHARS = 1 << 21
#: Row of a word that follows itself.
SAME = 1


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` labelled rows of either label are learned from at most, and of each text ``runs`` evenly spread runs of ``run_chars``
    characters (the whole text, if they cover it).  Everything else holds for all rows and whole texts."""

    sample_rows: int = 2000
    runs: int = 10
    run_chars: int = 300
    shortest: int = 3
    longest: int = 5
    buckets: int = 1 << 19
    support: int = 4
    dimensions: int = 8
    epochs: int = 6
    least_steps: int = 600
    batch: int = 32
    rate: float = 4.0
    decay: float = 1e-4
    seed: int = 5


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


class Features:
    """Rows of the vector table for words (the word and its character n-grams) and for pairs of neighbours."""

    def __init__(self, settings: Settings):
        self.subwords = Subwords(settings)
        self.buckets = np.uint64(settings.buckets)

    def of_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(rows of all words one after the other, number of rows of each)."""
        parts, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for begin in range(0, len(words), 1 << 15):
            part = words[begin:begin + (1 << 15)]
            rows, owners = self.subwords.rows(part)
            parts.append(rows[np.argsort(owners, kind="stable")].astype(np.int32))
            counts.append(np.bincount(owners, minlength=len(part)))
        return np.concatenate(parts), np.concatenate(counts)

    def of_pairs(self, codes: np.ndarray) -> np.ndarray:
        """Row of every two neighbours among word codes; a word that follows itself is the same pair whatever the word."""
        mixed = codes[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[1:]
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        rows = ((mixed >> np.uint64(40)) % self.buckets).astype(np.int64)
        rows[codes[1:] == codes[:-1]] = SAME
        return rows

    @staticmethod
    def codes(words: list[bytes]) -> np.ndarray:
        """A number for every word that does not change from run to run."""
        import xxhash

        return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


@dataclass
class Model:
    """The difference of the two labels' logits for every row of the table, and their offset."""

    settings: Settings
    logits: np.ndarray = field(repr=False)
    bias: float


def _bags(texts: list[str], settings: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text: its rows, and their parts in its mean."""
    features = Features(settings)
    number: dict[bytes, int] = {}
    said = [np.array([number.setdefault(w, len(number)) for w in words_of(t)], np.int64) for t in texts]
    rows, sizes = features.of_words(list(number))
    codes, first = features.codes(list(number)), offsets_of(sizes)
    bags = []
    for words in said:
        found = np.concatenate([rows[gather(first[words], sizes[words])], features.of_pairs(codes[words])])
        at, counts = np.unique(found, return_counts=True)
        bags.append((at, (counts / max(1, len(found))).astype(np.float32)))
    return bags


def fit(texts: list[str], labels: list[int], shares: tuple[float, float] | None = None, settings: Settings = Settings()) -> Model:
    """Train on the texts; ``shares`` are the labels' shares where the model will be used (those of ``labels``, if not given).

    Without texts the score is a half everywhere; with one label only it leans to that label.
    """
    if not texts:
        return Model(settings, np.zeros(settings.buckets, np.float32), 0.0)
    rng = np.random.default_rng(settings.seed)
    bags = _bags(texts, settings)
    spread = np.bincount(np.concatenate([at for at, _ in bags]), minlength=settings.buckets)
    used = np.flatnonzero(spread >= min(settings.support, len(texts)))
    place = np.full(settings.buckets, -1, np.int64)
    place[used] = np.arange(len(used))
    bags = [(place[at][place[at] >= 0], mass[place[at] >= 0]) for at, mass in bags]
    vectors = rng.uniform(-1, 1, (len(used), settings.dimensions)).astype(np.float32) / settings.dimensions
    matrix = rng.normal(0, 0.1, (settings.dimensions, 2)).astype(np.float32)
    counts = np.bincount(labels, minlength=2) + 1.0
    offset = np.log(counts / counts.sum()).astype(np.float32)
    target = np.eye(2, dtype=np.float32)[np.array(labels, np.int64)]
    batches = -(-len(texts) // settings.batch)
    epochs = max(settings.epochs, -(-settings.least_steps // batches))  # small samples are gone through more often
    rounds, done = epochs * batches, 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for begin in range(0, len(order), settings.batch):
            part = order[begin:begin + settings.batch]
            rate = settings.rate * (1 - done / rounds)
            done += 1
            sizes = [len(bags[i][0]) for i in part]
            at = np.concatenate([bags[i][0] for i in part])
            mass = np.concatenate([bags[i][1] for i in part])
            doc = np.repeat(np.arange(len(part)), sizes)
            rows, inverse = np.unique(at, return_inverse=True)
            held = vectors[rows]
            mean = np.zeros((len(part), settings.dimensions), np.float32)
            for k in range(settings.dimensions):
                mean[:, k] = np.bincount(doc, held[inverse, k] * mass, len(part))
            logit = mean @ matrix + offset
            chance = np.exp(logit - logit.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            error = (chance - target[part]) / len(part)
            flow = error @ matrix.T  # of each document's mean
            matrix -= rate * 0.1 * (mean.T @ error + settings.decay * matrix)
            offset -= rate * 0.1 * error.sum(axis=0)
            step = np.empty_like(held)
            for k in range(settings.dimensions):
                step[:, k] = np.bincount(inverse, flow[doc, k] * mass, len(rows))
            # A row's part in a mean is small: steps are scaled up to the number of rows of a mean.
            vectors[rows] = held * (1 - rate * settings.decay) - rate * 100 * step
    logits = np.zeros(settings.buckets, np.float32)
    logits[used] = vectors @ (matrix[:, 1] - matrix[:, 0])
    bias = float(offset[1] - offset[0])
    if shares:
        bias += float(np.log((shares[1] + 1e-9) / (shares[0] + 1e-9)) - np.log(counts[1] / counts[0]))
    return Model(settings, logits, bias)


class Scorer:
    """Scores lists of whole texts; made once per task.  A word's sum of logits, number of rows and code are remembered."""

    def __init__(self, model: Model):
        self.model = model
        self.features = Features(model.settings)
        self._forget()

    def _forget(self) -> None:
        self.cache: dict[bytes, int] = {}
        self.held = 0
        self.sums, self.sizes, self.codes = np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def _learn(self, words: list[bytes]) -> None:
        rows, sizes = self.features.of_words(words)
        owner = np.repeat(np.arange(len(words)), sizes)
        self.sums = np.r_[self.sums, np.bincount(owner, self.model.logits[rows], len(words))]
        self.sizes = np.r_[self.sizes, sizes]
        self.codes = np.r_[self.codes, self.features.codes(words)]
        self.held += sum(map(len, words))

    def score(self, texts: list[str]) -> np.ndarray:
        if self.held > CACHE_CHARS:
            self._forget()
        bags = [words_of(t) for t in texts]
        words = [w for bag in bags for w in bag]
        known = len(self.cache)
        at = list(map(self.cache.get, words))
        if None in at:
            number, seen = self.cache.setdefault, self.cache
            at = [number(w, len(seen)) if n is None else n for w, n in zip(words, at)]
            self._learn(list(islice(seen, known, None)))
        at = np.array(at, np.int64)
        doc = np.repeat(np.arange(len(texts)), [len(bag) for bag in bags])
        total = np.bincount(doc, self.sums[at], len(texts))
        count = np.bincount(doc, self.sizes[at], len(texts))
        if len(at) > 1:
            within = doc[1:] == doc[:-1]
            pairs = self.model.logits[self.features.of_pairs(self.codes[at])[within]]
            total += np.bincount(doc[1:][within], pairs, len(texts))
            count += np.bincount(doc[1:][within], minlength=len(texts))
        logit = total / np.maximum(1, count) + self.model.bias
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def in_fold(key: Column, folds: int, fold: int) -> Column:
    """Whether the CRC-32 of the key's text leaves ``fold`` when divided by ``folds``.  A null key does, so it is never learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(True))


def sampled_text(text: Column, settings: Settings = Settings()) -> Column:
    """The text, or evenly spread runs of it where it is longer than they are together."""
    length, kept = F.length(text), settings.runs * settings.run_chars
    gap = (length - settings.run_chars) / max(1, settings.runs - 1)
    runs = [F.substring(text, (F.floor(gap * i) + 1).cast("int"), F.lit(settings.run_chars)) for i in range(settings.runs)]
    return F.when(length <= kept, text).otherwise(F.concat_ws(" ", *runs))


def learn(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, folds: int, fold: int, settings: Settings = Settings()
) -> Model:
    """Fit on at most ``settings.sample_rows`` rows of either label (0 or 1) outside the held-out fold, the first by the hash of their keys.

    Rows with a null label or text, and keys labelled both ways, are left out; of a key with several texts, one is taken.
    """
    named = (
        labels.filter(F.col(f"`{label}`").isin(0, 1)).groupBy(F.col(f"`{key}`").alias("__key"))
        .agg(F.min(f"`{label}`").alias("label"), F.max(f"`{label}`").alias("other")).filter("label = other")
        .filter(~in_fold(F.col("__key"), folds, fold)).select("__key", "label")
    )
    counts = {r["label"]: r["n"] for r in named.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("__key"), F.col("__key")]
    # Keys are chosen first; only runs of the texts of the chosen ones travel, one text a key.
    sample = reduce(DataFrame.union, [named.filter(F.col("label") == v).orderBy(*order).limit(settings.sample_rows) for v in (0, 1)])
    body = F.col(f"`{text}`")
    chosen = (
        docs.select(F.col(f"`{key}`").alias("__key"), body.alias("text")).filter(F.col("text").isNotNull()).join(sample, "__key")
        .groupBy("__key", "label").agg(F.min(F.struct(F.xxhash64("text"), sampled_text(F.col("text"), settings).alias("text"))).alias("one"))
        .orderBy("__key").select("one.text", "label").collect()
    )
    total = max(1, sum(counts.values()))
    shares = (counts.get(0, 0) / total, counts.get(1, 0) / total) if chosen else None
    return fit([r["text"] for r in chosen], [int(r["label"]) for r in chosen], shares, settings)


def score_quality(
    df: DataFrame, text: str, model: Model, score: str = "score", predicted: str = "predicted", least: float = 0.7
) -> DataFrame:
    """Add a score from 0 to 1, higher for label 1, and ``predicted``, 1 where it is at least ``least``.

    Null, empty and wordless texts get the score of the model's offset.  Texts of any length are scored whole; rows, repeated ones too, and
    other columns stay; columns called like an output are replaced.
    """

    @F.arrow_udf("double")
    def rate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model)
        for batch in batches:
            done = [scorer.score(part) for part in chunks([t or "" for t in batch.to_pylist()], CHUNK_CHARS)]
            yield pa.array(np.concatenate(done) if done else np.zeros(0))

    return df.withColumn(score, rate(F.col(f"`{text}`"))).withColumn(predicted, (F.col(score) >= least).cast("int"))
