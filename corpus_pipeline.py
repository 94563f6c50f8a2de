"""The corpus pipeline: documents go through the stages one after the other, each written and read again by the next.

1. toxicity: documents that the classifier rejects go (labels are learned from the documents that reach the stage).
2. line dedup: of equal and nearly equal lines the first stays.
3. SimHash near-duplicates: of each group of similar documents the first stays.
4. mixing: one row for every document and pass of which the mix takes words, with those words.
5. byte-level BPE: token ids, where they start, and a check that they decode to the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strainwise.llm import bpe, line_dedup, mixing, queries, simhash, toxicity
from strainwise.session import Stages, cut_lineage


def _counted(docs: DataFrame) -> DataFrame:
    """The number of characters follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = queries.toxicity_model(docs, queries.table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, "text", model, "__score", "__toxic")
    return scored.filter("__toxic = 0").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies go whatever their length; blank lines are no copies."""
    return _counted(line_dedup.dedup_lines(docs, "doc_id", "text", shortest=1))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_of_each(docs, "doc_id", "text")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(docs, "doc_id", "text", "source")
    return _counted(mixing.drawn_documents(mixed, "text", docs.columns))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row: its columns but the text, the ids, and digests of the ids and of the bytes they decode to."""
    vocabulary = bpe.load_vocabulary(public_tokenizers.path(queries.BYTE_RANKS))
    encoded = bpe.encode_bpe(docs, "text", vocabulary, ids="ids", n_tokens="n_tokens", decoded_sha256="decoded_sha256")
    return encoded.drop("text")


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", dedup_lines),
    ("simhash", dedup_documents),
    ("mixing", mix_sources),
    ("byte_bpe", tokenize),
]
#: No stage but the filters around them can be said in SQL; the tests hold single stages against
#: brute force, and of the whole only row counts and the decoding; run() has no brute-force counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``.  What a stage has written goes when the next one has been; the last one reads what stays."""
    docs = queries.table(spark, sf_dir, "documents")
    with Stages(spark) as stages:
        for name, stage in STAGES[:-1]:
            done = stage(spark, docs, sf_dir)
            kept = cut_lineage(done) if name == STAGES[-2][0] else stages.cut(done)
            stages.drop(docs)
            docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
