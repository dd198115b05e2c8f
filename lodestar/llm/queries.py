"""Registered digest queries of the llm operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.llm import fingerprints, hard_negatives, html_text, jaccard, language, lexical, mixing, packing, pii, \
    sharding, substrings, suffix_dedup, topk
from lodestar.llm.tables import table


def op6_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op5_fingerprints(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = fingerprints.fingerprint_edits(docs).drop("tree", "edited_tree")
    return found.withColumn("differing", F.array_join(F.transform(
        "differing", lambda p: F.concat_ws(".", p["section"], p["paragraph"])), ","))


def op10_sharding(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_topk(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings", "vec_id", F.col("embedding").alias("vec"))
    return topk.top_k(v, v.where(F.col("vec_id") % 20 == 0))


def packed(docs):
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("byte_bpe_50k.tiktoken"),
                        public_tokenizers.PATTERN)


def op3_packing(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op2_html(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op1_substrings(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return substrings.remove_repeats(docs, with_text=False)


def op9_suffix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return suffix_dedup.remove_repeats(docs, with_text=False)


def op4_jaccard(spark, sf_dir):
    return jaccard.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_hard_negatives(spark, sf_dir):
    flipped = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings", "vec_id", flipped.alias("label"), F.col("embedding").alias("vec"))
    return hard_negatives.mine(rows, rows.where(F.col("vec_id") % 100 == 0))


def op13_lexical(spark, sf_dir):
    return lexical.rank(table(spark, sf_dir, "documents", "doc_id", "text"),
                        table(spark, sf_dir, "benchmark", "item_id", "text"))


def _listed(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _of_kind(spans, kind):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def op12_pii(spark, sf_dir):
    found = pii.find(table(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id", *[_of_kind(base, k).cast("long").alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


QUERIES = {
    "op12_pii": op12_pii,
    "op13_lexical": op13_lexical,
    "op11_hard_negatives": op11_hard_negatives,
    "op4_jaccard": op4_jaccard,
    "op9_suffix": op9_suffix,
    "op1_substrings": op1_substrings,
    "op2_html": op2_html,
    "op7_language": op7_language,
    "op3_packing": op3_packing,
    "op8_topk": op8_topk,
    "op10_sharding": op10_sharding,
    "op5_fingerprints": op5_fingerprints,
    "op6_mixing": op6_mixing,
}
