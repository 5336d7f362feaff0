"""Registered queries of the training-data operators: thin digests of the operators' results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm.ship import prepared
from candela.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"),
             ("org/fr/", "allow")]


def query(name: str):
    def register(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return register


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op5_token_counts")
def q_token_counts(spark, d):
    from candela.llm.token_counts import count_tokens
    docs = table(prepared(spark), d, "documents").select("doc_id", "text")
    return (count_tokens(docs, vocabulary("byte_bpe_50k.json"))
            .select("doc_id", "n_bytes", "n_tokens", "over_limit"))


@query("op9_decontaminate")
def q_decontaminate(spark, d):
    from candela.llm.decontaminate import contaminated, scan
    docs = table(prepared(spark), d, "documents").select("doc_id", "text")
    found = scan(docs, table(spark, d, "benchmark"), unnamed=True)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        contaminated().alias("contaminated"))


@query("op10_url_filters")
def q_url_filters(spark, d):
    from candela.llm.urls import judge_urls
    pages = table(prepared(spark), d, "pages").select("page_id", "url")
    return judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op1_best_fit_packing")
def q_packing(spark, d):
    from candela.llm.packing import pack_documents
    docs = table(prepared(spark), d, "documents").select("doc_id", "text")
    return (pack_documents(docs, vocabulary("byte_bpe_50k.json"))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))


@query("op3_quality_classifier")
def q_quality(spark, d):
    from candela.llm.quality import held_out, score, train
    docs = table(prepared(spark), d, "documents").select("doc_id", "text")
    labels = table(spark, d, "labels").filter(~held_out())
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query("op2_line_dedup")
def q_line_dedup(spark, d):
    from candela.llm.lines import dedup_lines
    docs = table(prepared(spark), d, "documents").select("doc_id", "source", "text")
    return dedup_lines(docs)


@query("op8_embedding_near_dedup")
def q_embeddings(spark, d):
    from candela.llm.embeddings import near_duplicates
    vectors = table(prepared(spark), d, "embeddings").select("vec_id", "embedding")
    return near_duplicates(vectors)


@query("op6_token_files")
def q_token_files(spark, d):
    from candela.llm.token_files import read_tokens, write_tokens
    from candela.session import scratch_path
    docs = table(prepared(spark), d, "documents").select("doc_id", "text")
    path = scratch_path(spark, "token-files")
    write_tokens(docs, path, vocabulary("word_bpe_49k.json"))
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op4_ngram_jaccard_join")
def q_jaccard(spark, d):
    from candela.llm.jaccard import link_documents
    docs = table(prepared(spark), d, "documents").select("doc_id", "text")
    return link_documents(docs)


@query("op7_suffix_array_dedup")
def q_suffix(spark, d):
    from candela.llm.suffix import remove_repeats
    docs = table(prepared(spark), d, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("pipeline")
def q_pipeline(spark, d):
    import corpus_pipeline
    return corpus_pipeline.run(spark, d)


@query("op11_merkle_manifest")
def q_merkle(spark, d):
    from candela.llm.merkle import manifest
    docs = table(prepared(spark), d, "documents")
    every_fifth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return manifest(docs, "doc_id", "source", ["doc_id", "source", "lang", "n_chars", "text"],
                    tampered={"text": F.translate("text", upper, lower)}, where=every_fifth)


@query("op13_toxicity")
def q_toxicity(spark, d):
    from candela.llm.quality import held_out
    from candela.llm.toxicity import score, train
    docs = table(prepared(spark), d, "documents").select("doc_id", "text")
    labels = table(spark, d, "labels").filter(~held_out())
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query("op12_spelling_variants")
def q_spelling(spark, d):
    from candela.llm.spelling import count_words, group_variants
    docs = table(prepared(spark), d, "documents").select("doc_id", "text")
    return group_variants(count_words(docs, slips=199))
