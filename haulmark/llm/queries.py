"""The registered queries of the operators and the SQL of those that SQL can express."""

from __future__ import annotations

from haulmark.llm import (chat, chat_repair, decontaminate, embeddings, licenses, ngram_join, passages, pieces, secrets,
                          token_files, toxicity, url_filter, whitening)
from haulmark.llm.common import read
from haulmark.llm.oracles import ORACLES  # noqa: F401


def piece_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op1_toxicity(spark, sf_dir):
    scored = toxicity.toxicity(read(spark, sf_dir, "documents", "doc_id", "text"),
                               read(spark, sf_dir, "labels", "doc_id", "toxic"))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", "toxic_tokens", "spans")


def op2_secret_scan(spark, sf_dir):
    return secrets.report(read(spark, sf_dir, "documents", "doc_id", "text"))


def op3_ngram_join(spark, sf_dir):
    return ngram_join.report(read(spark, sf_dir, "documents", "doc_id", "text"))


def op4_sentencepiece(spark, sf_dir):
    return pieces.encode(read(spark, sf_dir, "documents", "doc_id", "text"), piece_model()).drop("text")


def op5_substring_dedup(spark, sf_dir):
    return passages.report(read(spark, sf_dir, "documents", "doc_id", "text"))


def op6_embedding_dedup(spark, sf_dir):
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op7_decontaminate(spark, sf_dir):
    found = decontaminate.report(read(spark, sf_dir, "documents", "doc_id", "text"),
                                 read(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.drop("spans")  # offsets of characters, which the SQL beside it does not give


def op8_license_scan(spark, sf_dir):
    return licenses.scan(read(spark, sf_dir, "documents", "doc_id", "text"))


def op9_token_files(spark, sf_dir):
    import public_tokenizers
    return token_files.report(read(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


def op10_chat_format(spark, sf_dir):
    return chat.collapse_and_render(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op11_embedding_whitening(spark, sf_dir):
    return whitening.whiten(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op12_chat_repair(spark, sf_dir):
    talks = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return chat_repair.report(chat_repair.damage(talks), talks.select("conv_id"))


def op13_url_filter(spark, sf_dir):
    return url_filter.judge(read(spark, sf_dir, "pages", "page_id", "url")).drop("pattern")


QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("op")}
