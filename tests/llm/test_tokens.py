"""Byte-level BPE and token counts against the libraries whose vocabularies they read."""

import base64
import hashlib
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strainwise.llm import bpe, token_counts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "  ", "a  ", "\n\n x", "it's  a 'test' 're  \n\n x", "'s's're'll x 'rx ' ''s !'s", " 's", "\n's 1'd", "a" * 5000, "=" * 5000,
    "　 x 漢字かな ΑΒΓΣ Σ ½²³ ٣٤ é İ ẞ é", "<|endoftext|>a <|startoftext|><|ENDOFTEXT|> <|endof", "\x00\x01 a\x00", "🙂🙂 né́",
]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load_vocabulary(RANKS)


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder(vocabulary):
    return bpe.Encoder(vocabulary)


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(token_counts.load_word_vocabulary(WORDS))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORDS)


def encoded(encoder, texts):
    ids, counts = encoder.encode(texts)
    out, at = [], 0
    for n in counts.tolist():
        out.append(ids[at:at + n].tolist())
        at += n
    return out


def random_texts(seed, alphabet, n=300):
    draw = random.Random(seed)
    return ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 60))) for _ in range(n)]


MIXED = "aabcstmdrevlΣİé́''' \n\t  1290.,!ßí漢　 ²'"


def test_encoding_is_that_of_the_library(encoder, library):
    for texts in (ODD, random_texts(1, MIXED), random_texts(2, [chr(c) for c in range(0x250)])):
        assert encoded(encoder, texts) == [library.encode_ordinary(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(), max_size=4))
def test_encoding_of_any_text(texts):
    vocabulary = bpe.load_vocabulary(RANKS)
    encoder = test_encoding_of_any_text.__dict__.setdefault("encoder", bpe.Encoder(vocabulary))
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    with open(RANKS, "rb") as lines:
        library = test_encoding_of_any_text.__dict__.setdefault("library", tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN,
            mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, special_tokens={},
        ))
    assert encoded(encoder, texts) == [library.encode_ordinary(t) for t in texts]


def test_a_full_cache_changes_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_CHARS", 5)
    encoder = bpe.Encoder(vocabulary)
    for text in random_texts(3, MIXED, 50):
        assert encoded(encoder, [text]) == [library.encode_ordinary(text)]


def test_encode_and_decode_in_spark(spark, vocabulary, library):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(100, None, "y"), (0, ODD[1], "z"), (0, ODD[1], "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.encode_bpe(df, "text", vocabulary).withColumn("back", bpe.decode_bpe(F.col("ids"), vocabulary)).collect()
    assert len(out) == len(rows)
    for row in out:
        text = row["text"] or ""
        assert row["ids"] == library.encode_ordinary(text)
        assert bytes(row["back"]) == text.encode()
        pieces = [library.decode_single_token_bytes(i) for i in row["ids"]]
        assert row["token_starts"] == [sum(map(len, pieces[:k])) for k in range(len(pieces))]


def test_digests_from_one_worker(spark, vocabulary, library):
    """A text column whose name needs quotes, a column called like the helper, and a text of a million characters."""
    texts = [*ODD, None, "long and 12 longer, " * 50_000]
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "n int, `a.text` string, __encoded string")
    out = bpe.encode_bpe(df, "a.text", vocabulary, n_tokens="n_tokens", ids_sha256="said", decoded_sha256="back").orderBy("n").collect()
    for row, text in zip(out, texts):
        ids = library.encode_ordinary(text or "")
        assert row["n_tokens"] == len(ids) and row["__encoded"] == "kept"
        assert row["said"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["back"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_decoding_refuses_unknown_ids(spark, vocabulary):
    df = spark.createDataFrame([([10**6],)], "ids array<int>")
    with pytest.raises(Exception, match="token id without a piece"):
        df.select(bpe.decode_bpe(F.col("ids"), vocabulary)).collect()


def test_empty_table(spark, vocabulary):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode_bpe(df, "text", vocabulary).count() == 0
    assert token_counts.count_tokens(df, "text", token_counts.load_word_vocabulary(WORDS)).count() == 0


def test_counts_are_those_of_the_library(counter, tokenizer):
    for texts in (ODD, random_texts(4, MIXED), random_texts(5, [chr(c) for c in range(0x500)])):
        assert counter.count(texts).tolist() == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_counts_in_spark(spark, tokenizer):
    rows = [(i, t, 7) for i, t in enumerate(ODD)] + [(None, None, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out = token_counts.count_tokens(df, "text", token_counts.load_word_vocabulary(WORDS)).collect()
    assert [r["n_tokens"] for r in sorted(out, key=lambda r: (r["doc_id"] is None, r["doc_id"]))] == [
        len(tokenizer.encode(t or "", add_special_tokens=False).ids) for _, t, _ in rows
    ]


def test_queries_on_documents(spark, library, tokenizer):
    from strainwise.llm import queries

    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for row in queries.op1_byte_bpe(spark, folder).collect():
        ids = library.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
    for row in queries.op3_token_counts(spark, folder).collect():
        n = len(tokenizer.encode(texts[row["doc_id"]], add_special_tokens=False).ids)
        assert (row["n_tokens"], row["over_limit"], row["n_bytes"]) == (n, n > 2048, len(texts[row["doc_id"]].encode()))
