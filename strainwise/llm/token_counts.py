"""Token counts of whole texts under a word-level BPE vocabulary, without producing the tokens.

The text is normalised as the vocabulary's file says (composed form, lower case), cut by :mod:`segmentation`, and the
pre-tokens of a chunk are held as one ragged array of symbols.  In every round each pre-token applies its own lowest-rank
pair (:mod:`merging`); what is counted is how many symbols survive.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strainwise.llm.merging import PairTable
from strainwise.llm.ragged import chunks, offsets_of
from strainwise.llm.segmentation import CodepointClasses, Segmenter, every_codepoint, slices

CHUNK_CHARS = 1 << 18
#: Pre-tokens a task remembers; when there are more, it starts anew.  Bounds memory, does not change results.
CACHE_ENTRIES = 1 << 19


@dataclass
class WordVocabulary:
    """Merge rules, the symbols of the bytes inside and at the end of a word, and the library's codepoint tables."""

    rules: np.ndarray  # left, right, merged; in order of rank
    inside: np.ndarray
    final: np.ndarray
    specials: list[str]
    classes: CodepointClasses
    lower: dict[int, str]  # where the library's lower case differs from str.lower


def _visible_bytes() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself where printable, else the next of 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


@lru_cache(maxsize=4)
def load_word_vocabulary(path: str) -> WordVocabulary:
    """Read the vocabulary file on the driver; its size is that of the file.  Character classes and lower case are asked
    of the library once for every codepoint."""
    from tokenizers import Regex, normalizers, pre_tokenizers

    with open(path, encoding="utf-8") as lines:
        described = json.load(lines)
    model = described["model"]
    ids, end = model["vocab"], model["end_of_word_suffix"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    rules = np.array([(ids[a], ids[b], ids[a + b]) for a, b in pairs], np.int64)
    shown = _visible_bytes()
    text = every_codepoint()

    def found(pattern: str) -> list[int]:
        split = pre_tokenizers.Split(Regex(pattern), behavior="removed", invert=True)
        return [ord(c) for piece, _ in split.pre_tokenize_str(text) for c in piece]

    lowered = normalizers.Lowercase().normalize_str("\n".join(text.replace("\n", " "))).split("\n")
    return WordVocabulary(
        rules,
        np.array([ids[c] for c in shown], np.int32),
        np.array([ids[c + end] for c in shown], np.int32),
        [t["content"] for t in described["added_tokens"]],
        CodepointClasses.of(found(r"\p{L}"), found(r"\p{N}"), found(r"\s")),
        {ord(c): low for c, low in zip(text, lowered) if c != "\n" and c.lower() != low},
    )


class Counter:
    """Counts tokens of lists of texts; made once per task."""

    def __init__(self, vocabulary: WordVocabulary):
        self.segmenter = Segmenter(vocabulary.classes, byte_level=False)
        left, right, merged = vocabulary.rules.T
        self.table = PairTable(left, right, np.arange(len(left)), merged)
        self.inside, self.final = vocabulary.inside, vocabulary.final
        self.special = re.compile("|".join(map(re.escape, vocabulary.specials)) or r"(?!)")
        # str.lower looks at neighbours for the final sigma only; the library never does.
        self.own = {ord("Σ"): "σ"} | vocabulary.lower
        self.odd = re.compile("[" + "".join(map(re.escape, map(chr, self.own))) + "]")
        self._forget()

    def _forget(self) -> None:
        self.cache: dict[str, int] = {}
        self.sizes = np.zeros(0, np.int64)

    def _normal(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        return (text.translate(self.own) if self.odd.search(text) else text).lower()

    def _learn(self, pieces: list[str]) -> None:
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inside[flat]
        last = offsets_of(lengths)[1:] - 1
        symbols[last] = self.final[flat[last]]
        _, survivors = self.table.merge(symbols, lengths)
        self.sizes = np.r_[self.sizes, survivors]

    def count(self, texts: list[str]) -> np.ndarray:
        if len(self.cache) > CACHE_ENTRIES:
            self._forget()
        parts: list[str] = []
        owner: list[int] = []
        out = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            found = self.special.split(text)
            out[i] = len(found) - 1  # each special string is one token
            parts += map(self._normal, found)
            owner += [i] * len(found)
        points, starts, ends, first = self.segmenter.segments(parts)
        real = ~self.segmenter.is_white(points, starts)
        pieces = slices(points, starts[real], ends[real])
        known = len(self.cache)
        rows = list(map(self.cache.get, pieces))
        if None in rows:
            number, seen = self.cache.setdefault, self.cache
            rows = [number(p, len(seen)) if r is None else r for p, r in zip(pieces, rows)]
            self._learn(list(islice(seen, known, None)))
        sizes = np.zeros(len(starts), np.int64)
        sizes[real] = self.sizes[np.array(rows, np.int64)]
        np.add.at(out, owner, np.diff(offsets_of(sizes)[first]))
        return out


def count_tokens(df: DataFrame, text: str, vocabulary: WordVocabulary, n_tokens: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of the whole text.

    A null or empty text, or one of white space only, has none.  Rows, repeated ones too, and the other columns stay as they
    are; a column called like the output is replaced.
    """

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = Counter(vocabulary)
        for batch in batches:
            done = [counter.count(part) for part in chunks([t or "" for t in batch.to_pylist()], CHUNK_CHARS)]
            yield pa.array(np.concatenate(done) if done else np.zeros(0, np.int64))

    return df.withColumn(n_tokens, count(F.col(f"`{text}`")))
