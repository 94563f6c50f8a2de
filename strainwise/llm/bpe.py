"""Byte-level BPE encoding and decoding of whole texts.

Pre-tokens are cut out by :mod:`segmentation` (no regular expression), looked up in a cache by their text, and the unknown ones
of a chunk are merged together by :mod:`merging`.  The start of every token in the text's UTF-8 bytes is kept, so any run of
tokens can be decoded and placed.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strainwise.llm.merging import PairTable
from strainwise.llm.ragged import Arena, chunks, gather, list_array, offsets_of, unused
from strainwise.llm.segmentation import CodepointClasses, Segmenter, every_codepoint, slices

CHUNK_CHARS = 1 << 18
#: Characters of the pre-tokens a task remembers; when there are more, it starts anew.  Bounds memory, does not change results.
CACHE_CHARS = 1 << 21


@dataclass
class Vocabulary:
    """Byte strings by id (ranks are ids), with the classes of codepoints as the tokenizer's library has them."""

    pieces: list[bytes]
    classes: CodepointClasses

    def merger(self) -> tuple[PairTable, np.ndarray]:
        """Rules for every way to split a token in two tokens, and the id of every single byte."""
        ids = {piece: i for i, piece in enumerate(self.pieces) if piece}
        rules = [
            (ids[piece[:k]], ids[piece[k:]], i)
            for piece, i in ids.items()
            for k in range(1, len(piece))
            if piece[:k] in ids and piece[k:] in ids
        ]
        left, right, merged = np.array(rules, np.int64).reshape(-1, 3).T
        return PairTable(left, right, merged, merged), np.array([ids[bytes([b])] for b in range(256)], np.int32)

    def bytes_of(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pieces one after the other, the start of each, the length of each."""
        lengths = np.array([len(p) for p in self.pieces], np.int64)
        return np.frombuffer(b"".join(self.pieces), np.uint8), offsets_of(lengths)[:-1], lengths


@lru_cache(maxsize=4)
def load_vocabulary(path: str) -> Vocabulary:
    """Read a rank file (base64 of the bytes, then the rank) on the driver; its size is that of the file.

    Letters, numbers and white space are those that the library itself finds, asked once for every codepoint.
    """
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    pieces = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    plain = {bytes([b]): b for b in range(256)}
    text = every_codepoint()

    def found(pattern: str) -> list[int]:
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=plain, special_tokens={})
        return list(map(ord, bytes(probe.encode_ordinary(text)).decode()))

    return Vocabulary(pieces, CodepointClasses.of(found(r"\p{L}"), found(r"\p{N}"), found(r"\s")))


class Encoder:
    """Encodes lists of texts; made once per task."""

    def __init__(self, vocabulary: Vocabulary):
        self.segmenter = Segmenter(vocabulary.classes, byte_level=True)
        self.table, self.of_byte = vocabulary.merger()
        self.whole = {piece: i for i, piece in enumerate(vocabulary.pieces) if piece}
        self.lengths = np.array([len(p) for p in vocabulary.pieces], np.int64)
        self._forget()

    def _forget(self) -> None:
        self.cache: dict[str, int] = {}
        self.held = 0
        self.arena = Arena(np.int32)

    def _learn(self, pieces: list[str]) -> None:
        """Merge pre-tokens not met before.  A pre-token that is a token as a whole is that token."""
        self.held += sum(map(len, pieces))
        raw = [piece.encode("utf-8", "surrogatepass") for piece in pieces]
        known = [self.whole.get(b, -1) for b in raw]
        mixed = [i for i, k in enumerate(known) if k < 0]
        part = np.frombuffer(b"".join([raw[i] for i in mixed]), np.uint8)
        flat, lengths = self.table.merge(self.of_byte[part], np.fromiter((len(raw[i]) for i in mixed), np.int64, len(mixed)))
        counts = np.ones(len(pieces), np.int64)
        counts[mixed] = lengths
        out = np.empty(int(counts.sum()), np.int32)
        starts = offsets_of(counts)[:-1]
        single = np.ones(len(pieces), bool)
        single[mixed] = False
        out[starts[single]] = np.array(known, np.int32)[single]
        out[gather(starts[mixed], lengths)] = flat
        self.arena.extend(out, counts)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text)."""
        if self.held > CACHE_CHARS:
            self._forget()
        points, starts, ends, first = self.segmenter.segments(texts)
        pieces = slices(points, starts, ends)
        known = len(self.cache)
        rows = list(map(self.cache.get, pieces))
        if None in rows:
            number, seen = self.cache.setdefault, self.cache
            rows = [number(p, len(seen)) if r is None else r for p, r in zip(pieces, rows)]
            self._learn(list(islice(seen, known, None)))
        ids, lengths = self.arena.read(np.array(rows, np.int64))
        bounds = offsets_of(lengths)[first]
        return ids, np.diff(bounds)

    def starts(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Byte at which each token starts in its text."""
        before = offsets_of(self.lengths[ids])
        return (before[:-1] - np.repeat(before[offsets_of(counts)[:-1]], counts)).astype(np.int32)


#: Outputs of :func:`encode_bpe` and their types.
OUTPUTS = {
    "ids": pa.list_(pa.int32()), "starts": pa.list_(pa.int32()), "n_tokens": pa.int64(), "ids_sha256": pa.string(),
    "decoded_sha256": pa.string(),
}
_DDL = {"ids": "array<int>", "starts": "array<int>", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}


class Decoder:
    """Bytes of runs of ids; made once per task."""

    def __init__(self, vocabulary: Vocabulary):
        self.flat, self.first, self.lengths = vocabulary.bytes_of()

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all runs one after the other, where each run starts, and the end).  An id without a piece is an error."""
        ids = ids.astype(np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.lengths) or not self.lengths[ids].all()):
            raise ValueError("token id without a piece")
        sizes = self.lengths[ids]
        return self.flat[gather(self.first[ids], sizes)], offsets_of(sizes)[offsets_of(counts)]


def _encoded(batch: pa.Array, encoder: Encoder, decoder: Decoder, numerals: list[str], wanted: list[str]) -> pa.StructArray:
    parts: dict[str, list[pa.Array]] = {name: [] for name in wanted}
    for texts in chunks([t or "" for t in batch.to_pylist()], CHUNK_CHARS):
        ids, counts = encoder.encode(texts)
        ends = offsets_of(counts).tolist()
        for name, found in parts.items():
            if name == "ids":
                made = list_array(ids.astype(np.int32), counts)
            elif name == "starts":
                made = list_array(encoder.starts(ids, counts), counts)
            elif name == "n_tokens":
                made = pa.array(counts.astype(np.int64))
            elif name == "ids_sha256":
                said = list(map(numerals.__getitem__, ids.tolist()))
                made = pa.array([sha256(" ".join(said[a:b]).encode()).hexdigest() for a, b in zip(ends, ends[1:])], pa.string())
            else:
                data, bounds = decoder.decode(ids, counts)
                view, cuts = memoryview(data), bounds.tolist()
                made = pa.array([sha256(view[a:b]).hexdigest() for a, b in zip(cuts, cuts[1:])], pa.string())
            found.append(made)
    return pa.StructArray.from_arrays([pa.concat_arrays(parts[n]) if parts[n] else pa.array([], OUTPUTS[n]) for n in wanted], wanted)


def encode_bpe(df: DataFrame, text: str, vocabulary: Vocabulary, **outputs: str) -> DataFrame:
    """Add what is asked for of the whole text's encoding, as ``output=column``: by default ``ids="ids"``, the token ids, and
    ``starts="token_starts"``, the byte at which each token starts; also ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by one
    space) and ``decoded_sha256`` (of the bytes that the ids decode to).  One worker makes all of them.

    A null or empty text has no tokens (empty arrays, digests of nothing).  All other columns and all rows, repeated ones too, stay as
    they are; columns called like an output are replaced.
    """
    outputs = outputs or {"ids": "ids", "starts": "token_starts"}
    wanted = list(outputs)
    fields = ", ".join(f"{name}: {_DDL[name]}" for name in wanted)

    @F.arrow_udf(f"struct<{fields}>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, decoder, numerals = Encoder(vocabulary), Decoder(vocabulary), list(map(str, range(len(vocabulary.pieces))))
        for batch in batches:
            yield _encoded(batch, encoder, decoder, numerals, wanted)

    kept = [c for c in df.columns if c not in outputs.values()]
    held = unused("__encoded", df.columns)
    return df.withColumn(held, encode(F.col(f"`{text}`"))).select(
        *[F.col(f"`{c}`") for c in kept], *[F.col(held)[name].alias(column) for name, column in outputs.items()]
    )


def decode_bpe(ids: Column, vocabulary: Vocabulary) -> Column:
    """The bytes that token ids stand for.  A null array gives no bytes (an empty value); an id without a piece is an error."""

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = Decoder(vocabulary)
        for batch in batches:
            values = batch.flatten().to_numpy(zero_copy_only=False)
            counts = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            data, ends = decoder.decode(values, counts)
            yield pa.Array.from_buffers(
                pa.large_binary(), len(batch), [None, pa.py_buffer(ends), pa.py_buffer(data)]
            ).cast(pa.binary())

    return decode(ids)
