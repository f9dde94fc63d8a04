"""The registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from cvlens.llm import (anchor_simhash, bpe, chosen_path, exact_dedup, importance, packing, projection_search, ptolemy_clusters, sharding, suffix_dedup,
                        token_files, toxicity, url_filter)
from cvlens.llm.common import table

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip_digests(docs, BYTE_RANKS, public_tokenizers.PATTERN)


def op2_noisy_channel_toxicity(spark, sf_dir):
    return toxicity.toxicity_scores(spark, sf_dir)


def op3_bin_completion(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), WORD_BPE)


def op4_suffix_dedup(spark, sf_dir):
    return suffix_dedup.repeat_digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_token_frames(spark, sf_dir):
    return token_files.token_file_digests(table(spark, sf_dir, "documents").select("doc_id", "text"), WORD_BPE)


def op6_exact_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.exact_groups(docs, keep="max").drop("rid")


def op7_projected_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return projection_search.nearest(vectors, F.col("vec_id") % 20 == 0, k=20)


def op8_two_pass_shuffle(spark, sf_dir):
    return sharding.shard_digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_url_vocabulary(spark, sf_dir):
    return (url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
            .select("page_id", "host", "path", "rule", "verdict"))


def op10_chosen_path_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return chosen_path.near_duplicates(docs).select("doc_id", "class_id", "n_links")


def op11_ptolemaic_clusters(spark, sf_dir):
    return ptolemy_clusters.cluster_digests(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op12_importance_resampling(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance.resample(docs, table(spark, sf_dir, "benchmark").select("text"))


def op13_anchor_simhash(spark, sf_dir):
    return anchor_simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {f.__name__: f for f in (op1_byte_bpe, op2_noisy_channel_toxicity, op3_bin_completion, op4_suffix_dedup, op5_token_frames, op6_exact_dedup,
                                  op7_projected_neighbours, op8_two_pass_shuffle, op9_url_vocabulary, op10_chosen_path_join,
                                  op11_ptolemaic_clusters, op12_importance_resampling, op13_anchor_simhash)}

ORACLES = {
    "op6_exact_dedup": exact_dedup.ORACLE_SQL,
    "op9_url_vocabulary": url_filter.oracle_sql(),
    "op11_ptolemaic_clusters": ptolemy_clusters.oracle_sql(),
    "op12_importance_resampling": importance.oracle_sql(),
}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
