"""The registered queries of the corpus operators: ``opN_<name>``, each over
the whole ``documents`` (op11: ``pages``) table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (byte_bpe, exact_dedup, fill_in_middle, mixing, near_dedup, packed_ids, sharding, source_divergence,
               subtree_dedup, suffix_dedup, syncmers, toxicity, url_rules)
from .base import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

WORD_VOCABULARY, WORD_IDS, END_ID = "word_bpe_49k.json", 49_408, 2
BYTE_VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_syncmer_fingerprints(spark, d):
    return syncmers.with_edited(table(spark, d, "documents"))


@query
def op2_packed_ids(spark, d):
    folder = packed_ids.encode_to_files(table(spark, d, "documents"), vocabulary(WORD_VOCABULARY),
                                        WORD_IDS, END_ID)
    return packed_ids.read_digests(spark, folder)


@query
def op3_suffix_dedup(spark, d):
    return suffix_dedup.remove_repeats(table(spark, d, "documents"), keep_text=False)


@query
def op4_toxicity(spark, d):
    docs = table(spark, d, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, d, "labels")))


@query
def op5_exact_dedup(spark, d):
    return exact_dedup.exact_dedup(table(spark, d, "documents"))


@query
def op6_subtree_dedup(spark, d):
    return subtree_dedup.remove_repeats(table(spark, d, "documents"), keep_text=False)


@query
def op7_sharding(spark, d):
    return sharding.shard_by_bytes(table(spark, d, "documents"))


@query
def op8_byte_bpe(spark, d):
    return byte_bpe.round_trip(table(spark, d, "documents"), vocabulary(BYTE_VOCABULARY))


@query
def op9_mixing(spark, d):
    return mixing.mix(table(spark, d, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "rate", "copies")


@query
def op10_minhash_bayes(spark, d):
    return near_dedup.groups(table(spark, d, "documents"), width=2, similarity=0.8).drop("rid")


@query
def op11_url_rules(spark, d):
    return url_rules.judge(table(spark, d, "pages"), url_rules.rule_table(spark, url_rules.RULES))


@query
def op12_fill_in_middle(spark, d):
    return fill_in_middle.digests(table(spark, d, "documents"))


@query
def op13_source_divergence(spark, d):
    return source_divergence.audit(table(spark, d, "documents"))
