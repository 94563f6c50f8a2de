"""Alignment of two tokenizers' tokens over the same bytes, and how telling each pair of linked ids is in the whole corpus.

Tokens of both sides are intervals of bytes.  All of them are sorted together by start (``lexsort``), ends are accumulated by
``maximum``, and a group breaks where a start reaches the running maximum; inside the groups, every pair of overlapping tokens is
expanded to a link.

Both tokenizers cut a text where a space follows something that is not white space, whatever stands around, so a text
is a run of segments that are tokenized independently.  A task tokenizes and aligns every distinct segment once and remembers it.
Documents are packed into blocks of bounded size that name their segments by number; only the distinct pairs of ids
of a block travel to be counted, and the counts come back to the block's pairs, never to single links.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strainwise.llm.bpe import Encoder, Vocabulary
from strainwise.llm.ragged import Arena, gather, offsets_of
from strainwise.llm.segmentation import CodepointClasses, every_codepoint
from strainwise.llm.token_counts import _visible_bytes
from strainwise.session import cut_lineage, work_area

#: Characters of the documents of a block (a longer document is a block of its own).  Sets memory and how often a pair travels.
BLOCK_CHARS = 1 << 21
#: Characters of the segments a task remembers; when there are more, it starts anew.  Bounds memory, does not change results.
CACHE_CHARS = 1 << 21
#: Distinct segments tokenized in one call.
CALL = 1 << 13


@dataclass
class Tokenizers:
    """A byte-level vocabulary (A) and a piece model that puts a space first (B).  What their files hold
    travels to the tasks (a few MB, fixed by the files), so executors need no copy."""

    a: Vocabulary
    b_model: bytes
    #: White space of either the library or Python, as members of a pattern's class: cutting less is always right.
    white: str

    @classmethod
    def load(cls, a_path: str, b_path: str) -> Tokenizers:
        from tokenizers import Regex, pre_tokenizers

        every = every_codepoint()

        def found(pattern: str) -> list[int]:
            split = pre_tokenizers.Split(Regex(pattern), behavior="removed", invert=True)
            return [ord(c) for piece, _ in split.pre_tokenize_str(every) for c in piece]

        with open(a_path, encoding="utf-8") as lines:
            model = json.load(lines)["model"]
        of_char = {c: b for b, c in enumerate(_visible_bytes())}
        pieces = [b""] * (max(model["vocab"].values()) + 1)
        for token, i in model["vocab"].items():
            if all(c in of_char for c in token):
                pieces[i] = bytes(of_char[c] for c in token)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        order = [model["vocab"][a + b] for a, b in pairs]
        if order != sorted(order):
            raise ValueError("ids are not in the order of the merges")
        reachable = {i for i, piece in enumerate(pieces) if len(piece) == 1} | set(order)
        pieces = [piece if i in reachable else b"" for i, piece in enumerate(pieces)]
        white = found(r"\s")
        classes = CodepointClasses.of(found(r"\p{L}"), found(r"\p{N}"), white)
        uncut = {chr(c) for c in white} | {c for c in every if c.isspace()} | {"▁"}
        with open(b_path, "rb") as b:
            return cls(Vocabulary(pieces, classes), b.read(), "".join(map(re.escape, sorted(uncut))))


def _piece_bytes(model) -> list[bytes]:
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
        if re.search("[^▁]▁", piece):
            raise ValueError("a piece goes on after a space: texts cannot be cut before spaces")
    return out


def coalesce(
    a_sizes: np.ndarray, b_sizes: np.ndarray, a_counts: np.ndarray, b_counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups and links of texts that both sides cover with the same bytes, laid one after the other.

    ``sizes`` are bytes of the tokens, ``counts`` tokens of each text.  Returns (group of every A token, group of every B token,
    number of groups of each text, A token of every link, B token of every link); links are in order of A, then B.
    """
    n_a = len(a_sizes)
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    starts = np.concatenate([a_ends - a_sizes, b_ends - b_sizes])
    ends = np.concatenate([a_ends, b_ends])
    side = np.concatenate([np.zeros(n_a, np.int8), np.ones(len(b_sizes), np.int8)])
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    of_a, of_b = group[:n_a], group[n_a:]
    # Of a text's tokens, the last one's group tells how many groups there are up to its end.
    upto = np.zeros(len(a_counts) + 1, np.int64)
    last = offsets_of(a_counts)[1:]
    upto[1:][last > 0] = of_a[last[last > 0] - 1] + 1
    low = np.searchsorted(b_ends, starts[:n_a], "right")
    high = np.searchsorted(starts[n_a:], a_ends, "left")
    spans = high - low
    return of_a, of_b, np.diff(upto), np.repeat(np.arange(n_a), spans), gather(low, spans)


class Aligner:
    """Tokenizes and aligns segments; made once per task."""

    def __init__(self, files: Tokenizers):
        import sentencepiece

        self.encoder = Encoder(files.a)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.b_model)
        self.bytes = [files.a.pieces, _piece_bytes(self.b)]
        self.sizes = [np.array([len(x) for x in side], np.int64) for side in self.bytes]
        self.space = self.b.piece_to_id("▁")
        # Decimal ids with what may follow: another token of the side, the other side (of A) or a group (of B).
        said = [[f"{i}{mark}" for mark in marks for i in range(len(side))] for marks, side in zip((",|", ",;"), self.bytes)]
        self.said, self.first_b = said[0] + said[1], len(said[0])
        self.odd = re.compile(f"[{files.white}] ")
        self.cut = re.compile(f"(?<=[^{files.white}])(?= )")
        self._forget()

    def _forget(self) -> None:
        self.encoder._forget()
        self.known: dict[str, int] = {}
        self.held = 0
        self.links = Arena(np.int64)
        self.shape = np.zeros((0, 3), np.int64)  # tokens of A, tokens of B, groups; minus one where bytes differ
        self.texts: list[str] = []

    def segments(self, text: str) -> list[str]:
        """The runs of ``space + text``, without their first space."""
        if not self.odd.search(text) and not text.startswith(" "):
            return text.split(" ")
        return [run[1:] for run in self.cut.split(" " + text)]

    def _tokens(self, part: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(A's ids, A's tokens of each segment, B's ids, B's tokens of each segment)."""
        as_a, n_a = self.encoder.encode([" " + s for s in part])
        # The model puts the space first, but not to an empty text.
        ids_b = [ids or [self.space] for ids in self.b.encode(part, num_threads=1)]
        n_b = np.fromiter(map(len, ids_b), np.int64, len(part))
        return as_a.astype(np.int64), n_a, np.fromiter(chain.from_iterable(ids_b), np.int64, int(n_b.sum())), n_b

    def _learn(self, fresh: list[str]) -> None:
        for begin in range(0, len(fresh), CALL):
            self._learn_part(fresh[begin:begin + CALL])

    def _learn_part(self, part: list[str]) -> None:
        as_a, n_a, as_b, n_b = self._tokens(part)
        joined = [b"".join(map(side.__getitem__, ids.tolist())) for side, ids in zip(self.bytes, (as_a, as_b))]
        ends_a, ends_b = (offsets_of(size[ids])[offsets_of(n)] for size, ids, n in zip(self.sizes, (as_a, as_b), (n_a, n_b)))
        good = np.ones(len(part), bool)
        raw = "".join([" " + s for s in part]).encode()
        if joined[0] != raw or joined[1] != raw or not np.array_equal(ends_a, ends_b):
            good = np.array([
                joined[0][ends_a[i]:ends_a[i + 1]] == joined[1][ends_b[i]:ends_b[i + 1]] == b" " + s.encode() for i, s in enumerate(part)
            ])
            as_a, as_b = as_a[np.repeat(good, n_a)], as_b[np.repeat(good, n_b)]
            n_a, n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
        of_a, of_b, n_groups, link_a, link_b = coalesce(self.sizes[0][as_a], self.sizes[1][as_b], n_a, n_b)
        n_links = np.bincount(np.repeat(np.arange(len(part)), n_a)[link_a], minlength=len(part))
        self.links.extend((as_a[link_a] << 32) | as_b[link_b], n_links)
        shape = np.stack([n_a, n_b, n_groups], 1)
        shape[~good] = -1
        self.shape = np.concatenate([self.shape, shape])
        # Groups in order, in each A's tokens, then B's.
        order = np.lexsort((np.repeat([0, 1], [len(of_a), len(of_b)]), np.concatenate([of_a, of_b])))
        codes = np.concatenate([
            as_a + np.append(np.diff(of_a) > 0, True)[: len(of_a)] * len(self.bytes[0]),
            as_b + np.append(np.diff(of_b) > 0, True)[: len(of_b)] * len(self.bytes[1]) + self.first_b,
        ])[order]
        words = list(map(self.said.__getitem__, codes.tolist()))
        bounds = offsets_of(n_a + n_b).tolist()
        self.texts += ["".join(words[a:b])[:-1] for a, b in zip(bounds, bounds[1:])]
        self.held += sum(map(len, part))

    def _numbers(self, parts: list[str]) -> list[int]:
        rows = list(map(self.known.get, parts))
        if None in rows:
            number, seen, before = self.known.setdefault, self.known, len(self.known)
            rows = [number(p, len(seen)) if r is None else r for p, r in zip(parts, rows)]
            self._learn(list(islice(seen, before, None)))
        return rows

    def read(self, texts: list[str]) -> list[np.ndarray]:
        """Numbers of the segments of each text; none where the text is empty or either side does not give its bytes back."""
        if self.held > CACHE_CHARS:
            self._forget()
        cut = [self.segments(t) if t else [] for t in texts]
        flat = np.array(self._numbers([s for parts in cut for s in parts]), np.int64)
        out = np.split(flat, offsets_of(np.fromiter(map(len, cut), np.int64, len(cut)))[1:-1]) if cut else []
        for i in np.flatnonzero([len(rows) > 0 and self.shape[rows, 0].min() < 0 for rows in out]):
            # Bytes of a segment differ: what counts is whether those of the whole text do.
            whole = np.array(self._numbers([texts[i]]), np.int64)
            out[i] = whole if self.shape[whole[0], 0] >= 0 else whole[:0]
        return out


PACKED = """block long, keys array<{key}>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>,
 groups_sha256 array<string>, n_segments array<int>, segments array<int>, spans array<int>, links array<int>,
 pairs array<long>, totals array<long>"""


def _pack(aligner: Aligner, keys: pa.Array, texts: list[str], block: int) -> pa.RecordBatch:
    """One row: the documents' results so far, and which of the block's segments, and of its pairs, they hold."""
    found = aligner.read(texts)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    at, distinct = pd.factorize(np.concatenate([*found, np.zeros(0, np.int64)]))
    flat, spans = aligner.links.read(distinct)
    link, pairs = pd.factorize(flat)
    times = np.bincount(at, minlength=len(distinct))
    totals = np.bincount(link, np.repeat(times, spans), len(pairs)).astype(np.int64)
    doc = np.repeat(np.arange(len(found)), sizes)
    shape = aligner.shape[distinct]
    sums = [np.bincount(doc, x[at], len(found)).astype(np.int64) for x in (*shape.T, spans)]
    said = [aligner.texts[i] for i in distinct.tolist()]
    digests = [
        hashlib.sha256(";".join([said[i] for i in part.tolist()]).encode()).hexdigest() if len(part) else ""
        for part in np.split(at, offsets_of(sizes)[1:-1])
    ] if len(found) else []

    def one(values) -> pa.Array:
        values = pa.array(values) if not isinstance(values, pa.Array) else values
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    columns = {
        "block": pa.array([block], pa.int64()), "keys": one(keys), "n_a": one(sums[0]), "n_b": one(sums[1]), "n_groups": one(sums[2]),
        "n_links": one(sums[3]), "groups_sha256": one(pa.array(digests, pa.string())), "n_segments": one(sizes.astype(np.int32)),
        "segments": one(at.astype(np.int32)), "spans": one(spans.astype(np.int32)), "links": one(link.astype(np.int32)),
        "pairs": one(pairs.astype(np.int64)), "totals": one(totals),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _written(df: DataFrame) -> DataFrame:
    """As ``cut_lineage``, for few and wide rows: the writer looks at its memory after every row."""
    path = work_area(df.sparkSession, "blocks")
    options = {"parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1", "parquet.block.size": str(1 << 24)}
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pack_blocks(df: DataFrame, key: str, text: str, files: Tokenizers, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Documents tokenized, aligned and packed, a row for every block (see :data:`PACKED`), written to the shared folder."""
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    key_type = rows.schema["key"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner, number = Aligner(files), 0
        part = TaskContext.get().partitionId()
        keys: list[pa.Array] = []
        texts: list[str] = []
        size = 0

        def done() -> pa.RecordBatch:
            return _pack(aligner, pa.concat_arrays(keys), texts, (part << 32) | number)

        for batch in batches:
            column, begin = batch.column(0), 0
            for i, value in enumerate(batch.column(1)):
                value = value.as_py() or ""
                if texts and size + len(value) > block_chars:
                    keys.append(column.slice(begin, i - begin))
                    yield done()
                    keys, texts, size, begin, number = [], [], 0, i, number + 1
                texts.append(value)
                size += len(value)
            keys.append(column.slice(begin))
        if texts:
            yield done()

    return _written(rows.mapInArrow(pack, PACKED.format(key=key_type)))


def pair_counts(packed: DataFrame) -> DataFrame:
    """(pair, count, best): links of the corpus that hold the pair of ids (A's in the upper half), and whether no pair of its B id
    has more.  The maxima by B id are as many as B has ids, so they are broadcast."""
    pairs = packed.select(F.explode(F.arrays_zip("pairs", "totals")).alias("p")).select("p.pairs", "p.totals")
    counts = cut_lineage(pairs.groupBy(F.col("pairs").alias("pair")).agg(F.sum("totals").alias("count")))
    of_b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    highest = counts.groupBy(of_b.alias("b")).agg(F.max("count").alias("highest"))
    return counts.join(F.broadcast(highest), of_b == F.col("b")).select(
        "pair", "count", (F.col("count") == F.col("highest")).alias("best")
    )


def align_tokens(df: DataFrame, key: str, text: str, files: Tokenizers, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``df``.

    Null and empty texts, and texts whose bytes one of the tokenizers does not give back, have no tokens: zeros, and an empty
    ``groups_sha256``.  A document is never cut.  Repeated rows count as often as they stand there; keys are of any type, null
    too.  Only key and text are read, so further columns do not matter.
    """
    packed = pack_blocks(df, key, text, files, block_chars)
    met = packed.select("block", F.posexplode("pairs").alias("at", "pair")).join(pair_counts(packed), "pair")
    told = met.groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("at", "count", "best"))).alias("told")
    ).select("block", F.col("told.count").alias("counts"), F.col("told.best").alias("bests"))
    needed = [
        "keys", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_segments", "segments", "spans", "links", "counts", "bests",
    ]
    whole = packed.join(told, "block", "left").select(*needed)
    out = T.StructType([
        T.StructField("key", packed.schema["keys"].dataType.elementType),
        *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
        T.StructField("groups_sha256", T.StringType()),
    ])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                held = {name: batch.column(name).slice(i, 1) for name in needed}

                def values(name: str) -> np.ndarray:
                    return held[name].flatten().to_numpy(zero_copy_only=False)

                spans, links = values("spans").astype(np.int64), values("links").astype(np.int64)
                segment = np.repeat(np.arange(len(spans)), spans)
                counts, bests = values("counts").astype(np.int64), values("bests").astype(bool)
                sums, best = np.zeros(len(spans), np.int64), np.zeros(len(spans), np.int64)
                np.add.at(sums, segment, counts[links])
                np.add.at(best, segment, bests[links])
                sizes, at = values("n_segments").astype(np.int64), values("segments").astype(np.int64)
                ends = offsets_of(sizes)
                per_doc = [np.diff(offsets_of(x[at])[ends]) for x in (best, sums)]
                plain = [held[c].flatten() for c in ("keys", "n_a", "n_b", "n_groups", "n_links")]
                yield pa.RecordBatch.from_arrays(
                    [*plain, *map(pa.array, per_doc), held["groups_sha256"].flatten()], names=out.names
                )

    return whole.mapInArrow(finish, out)
