"""Corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.llm import jaccard_join, line_dedup, mixing, toxicity, trie_bpe
from lendspark.llm.frames import documents, stored
from lendspark.llm.queries import TARGETS, quality_domains

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model marks go; labels are learned from 4 of 5 labelled documents.

    An id is one document: all its rows go if one of its texts is marked. Rows with a NULL id stay.
    """
    marked = toxicity.toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("predicted = 1").select("doc_id").distinct()
    return docs.join(marked, "doc_id", "left_anti").select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 or more characters in three or more documents stay in the last one only; every row stays.

    Each text of a repeated id keeps its own lines. A text that loses nothing is as it was, NULL included.
    """
    out = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    text = F.when(F.col("dedup.n_dropped") > 0, F.col("dedup.kept_text")).otherwise(F.col("row.text"))
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return out.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 over five-word shingles stays: the smallest id.

    An id is one document: its rows stay or go together. Rows with a NULL id and texts without words stay.
    """
    gone = jaccard_join.jaccard_components(docs).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture's rates say: token totals by quality domain meet TARGETS in expectation.

    An id has one number of copies, the most that one of its rows has; 0 leaves it out. An empty table stays empty.
    """
    return mixing.mixed(docs, quality_domains(spark, sf_dir), TARGETS).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of ids and of their decoding, one row for each row of the mixture; NULL counts as empty."""
    return trie_bpe.encoded_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("mixing", mix_to_targets),
    ("bpe_trie", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
