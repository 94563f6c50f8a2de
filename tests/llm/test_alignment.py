"""Cross-tokenizer alignment against the tokenizers' own libraries and a plain double loop."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from strainwise.llm import alignment, queries

SMALL = "/root/testdata/sf0.001"
A_PATH, B_PATH = public_tokenizers.path(queries.BYTE_VOCABULARY), public_tokenizers.path(queries.PIECE_MODEL)
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def files():
    return alignment.Tokenizers.load(A_PATH, B_PATH)


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def brute(texts, libraries):
    """Rows in order of ``texts``: whole texts through the libraries, links by looking at every pair of tokens nearby."""
    a, b = libraries
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    byte_of = {chr(x) if x in shown else chr(next(hidden)): x for x in range(256)}

    def spans(ids, pieces):
        at, out = 0, []
        for i, piece in zip(ids, pieces):
            out.append((at, at + len(piece), i))
            at += len(piece)
        return out

    held = []
    for text in texts:
        text = text or ""
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or not b"".join(raw_a) == b"".join(raw_b) == b" " + text.encode():
            held.append(None)
            continue
        on_a, on_b = spans(ids_a, raw_a), spans(ids_b, raw_b)
        cuts = sorted({e for _, e, _ in on_a} & {e for _, e, _ in on_b})
        groups, before = [], 0
        for cut in cuts:
            side = [",".join(str(i) for s, e, i in tokens if before <= s and e <= cut) for tokens in (on_a, on_b)]
            groups.append("|".join(side))
            before = cut
        links = [(x, y) for s, e, x in on_a for u, v, y in on_b if s < v and u < e]
        held.append((len(ids_a), len(ids_b), groups, links))
    counts = Counter(link for h in held if h for link in h[3])
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [
        (h[0], h[1], len(h[2]), len(h[3]), sum(counts[x] == best[x[1]] for x in h[3]), sum(counts[x] for x in h[3]),
         hashlib.sha256(";".join(h[2]).encode()).hexdigest()) if h else (0, 0, 0, 0, 0, 0, "")
        for h in held
    ]


def odd_texts():
    rng = random.Random(7)
    parts = [
        " ", "  ", "\n", "\t", "\r\n", "a", "the", "it's", "we'll", "'s", "12", "345", "é", "é", "日本", "語", "😀", "<|endoftext|>",
        "<s>", "<0x41>", " ", "　", " ", "\x1c", "\x85", "᠎", "...", "!?", "ß", "ﬁ", "½", "\x00", "word", "tokenization", "_",
    ]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(250)]
    return texts + [" ", "  ", "a ", " a", "a  b ", "\n", "\n \n  x", "a▁b", "▁", " ▁ x", "x" * 300, "a b " * 40]


def test_whole_texts_of_any_kind(spark, files, libraries):
    texts = odd_texts() + [None, "", "again", "again"]
    rows = spark.createDataFrame([(i, t, "z", 1) for i, t in enumerate(texts)], "doc_id long, `a.text` string, key string, block int")
    found = alignment.align_tokens(rows, "doc_id", "a.text", files, block_chars=97).collect()
    assert [tuple(r[c] for c in COLUMNS) for r in sorted(found, key=lambda r: r["key"])] == brute(texts, libraries)
    assert sum(r["n_a"] == 0 for r in found) >= 5  # both empty ones, and those with the model's own space sign


def test_query_equals_brute_force(spark, libraries):
    docs = queries.table(spark, SMALL, "documents").select("doc_id", "text").orderBy("doc_id").limit(40).collect()
    texts = [r["text"][:1500] if r["text"] else r["text"] for r in docs]
    frame = spark.createDataFrame([(r["doc_id"], t) for r, t in zip(docs, texts)], "doc_id long, text string").repartition(3)
    found = alignment.align_tokens(frame, "doc_id", "text", alignment.Tokenizers.load(A_PATH, B_PATH)).collect()
    assert [tuple(r[c] for c in COLUMNS) for r in sorted(found, key=lambda r: r["key"])] == brute(texts, libraries)


def test_block_size_and_cache_change_nothing(spark, files, monkeypatch):
    rows = queries.table(spark, SMALL, "documents")
    whole = sorted(alignment.align_tokens(rows, "doc_id", "text", files).collect())
    monkeypatch.setattr(alignment, "CACHE_CHARS", 100)
    assert sorted(alignment.align_tokens(rows, "doc_id", "text", files, block_chars=5000).collect()) == whole
    assert len(whole) == rows.count()


def test_every_token_of_a_by_itself(files, libraries):
    a, _ = libraries
    texts = [a.decode([i]) for i in range(0, 50256, 7)]
    texts = [t for t in texts if "�" not in t]
    ids, counts = alignment.Encoder(files.a).encode(texts)
    assert ids.tolist() == [i for e in a.encode_batch(texts, add_special_tokens=False) for i in e.ids]
    assert len(counts) == len(texts)


def test_long_text_null_keys_and_no_rows(spark, files):
    long = "several words, some 12 numbers;\n" * 20_000
    found = alignment.align_tokens(
        spark.createDataFrame([(None, long), ("k", long), ("k", long), ("k", None)], "k string, t string"), "k", "t", files
    ).collect()
    assert [r["n_a"] > 100_000 for r in sorted(found, key=lambda r: -r["n_a"])] == [True, True, True, False]
    assert len({tuple(r)[1:] for r in found}) == 2 and sum(r["key"] is None for r in found) == 1
    empty = alignment.align_tokens(spark.createDataFrame([], "k string, t string"), "k", "t", files)
    assert empty.columns == ["key", *COLUMNS] and empty.count() == 0
