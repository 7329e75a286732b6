"""Corpus preparation, stage by stage: documents -> token ids.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps,
with their columns; the last returns the encoded documents.  ``run`` writes
every stage's result in the shared folder and reads it back as the next
one's input, so a lost executor repeats one stage at most.

1. toxicity      documents scored as toxic go; the lexicon is learned from labels
2. exact dedup   of equal texts (A-Z lower-cased) the one with the largest doc_id stays
3. near dedup    of documents linked by 5-word shingles at 0.8 the smallest doc_id stays
4. mixing        documents are repeated or left out to meet each source's target
5. byte BPE      ids of every document, and the digest of what they decode to

Null texts count as empty throughout; an empty table passes every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foodgrid.llm import byte_bpe, exact_dedup, mixing, near_dedup, queries, toxicity
from foodgrid.llm.base import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs, width=5, similarity=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat_by_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(docs, queries.vocabulary(queries.BYTE_VOCABULARY), keep_ids=True)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("mixing", mix_sources), ("byte_bpe", encode)]

#: Scores, links, rounded copies and merges have no SQL: tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
