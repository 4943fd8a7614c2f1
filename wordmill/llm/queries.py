"""One query per corpus operator, over whole tables and whole texts, and the SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wordmill.llm import gam, html, jaccard, lm, mixing, packing, pii, quality, repair, secrets, tokens, topk, trie
from wordmill.llm.sql import MIXING_SQL, REPAIR_SQL, TOP_K_SQL, TRIE_SQL

# Exponent of the rows of a source in its target weight: large sources are held back.
MIX_EXPONENT = 0.7
MIX_SEED = 42
PACK_CAPACITY = 2048
TOKEN_LIMIT = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    weights = mixing.temperature_weights(docs, "source", MIX_EXPONENT)
    return mixing.mix(docs, weights, seed=MIX_SEED)


def op2_pack_best_fit(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), PACK_CAPACITY)


def op3_scan_secrets(spark, sf_dir):
    return secrets.scan_digest(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.assess(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op5_jaccard_join(spark, sf_dir):
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op6_score_texts(spark, sf_dir):
    return lm.score_corpus(table(spark, sf_dir, "documents"))


def op7_count_tokens(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return tokens.count_tokens(docs, tokenizer_path("byte_bpe_50k.json"), TOKEN_LIMIT)


def op8_extract_html(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages"))


def op9_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op10_personal_data(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pii.scan_digest(docs, pii.train(docs))


def op11_repair_conversations(spark, sf_dir):
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")))


def op12_prefix_trie(spark, sf_dir):
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_classify_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return gam.score(docs, gam.train(docs, table(spark, sf_dir, "labels")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_pack_best_fit, op3_scan_secrets, op4_quality_rules, op5_jaccard_join, op6_score_texts,
        op7_count_tokens, op8_extract_html, op9_top_k, op10_personal_data, op11_repair_conversations,
        op12_prefix_trie, op13_classify_quality,
    )
}

ORACLE = {
    "op1_mix_sources": MIXING_SQL, "op9_top_k": TOP_K_SQL, "op11_repair_conversations": REPAIR_SQL, "op12_prefix_trie": TRIE_SQL,
}
