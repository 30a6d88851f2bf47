"""A corpus cleaned and encoded in five stages; each is written before the next one reads it.

Each stage takes the documents that the one before it kept, in the columns of ``documents``, and
gives the same columns; the last gives the encoded corpus.
"""

from __future__ import annotations

from feedloom.llm.decontaminate import drop_contaminated
from feedloom.llm.language import keep_identified
from feedloom.llm.repeats import without_repeats
from feedloom.llm.sentence_pieces import piece_digests
from feedloom.llm.simhash import keep_first
from feedloom.session import materialise, tune

MODEL = "piece_bpe_32k.model"


def language(spark, docs, sf_dir):
    """Documents whose language is known; the labels are those of the documents themselves."""
    tune(spark)
    return keep_identified(docs, docs.select("text", "lang"))


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near-duplicates: the one with the smallest id."""
    tune(spark)
    return keep_first(docs)


def repeated_passages(spark, docs, sf_dir):
    """All documents, without the passages that an earlier one holds already."""
    tune(spark)
    return without_repeats(docs)


def benchmark_texts(spark, docs, sf_dir):
    """Documents in which no window of a benchmark item occurs."""
    tune(spark)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pieces(spark, docs, sf_dir):
    """Tokens of each document, their checksum, and whether they decode to its text."""
    tune(spark)
    return piece_digests(docs, MODEL)


STAGES = [("language_identification", language), ("simhash_near_duplicates", near_duplicates),
          ("substring_dedup", repeated_passages), ("benchmark_decontamination", benchmark_texts),
          ("sentence_pieces", pieces)]

#: SQL has no fingerprints of this kind and no pieces; the tests hold a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
