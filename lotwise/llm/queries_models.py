"""Queries of the operators that score or encode single texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.llm import language, pieces, toxicity
from lotwise.llm.registry import query, table


def tokenizer_path() -> str:
    """Place of the public 32k model; the file is read where the query is built."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@query("op1_toxicity")
def toxicity_scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = language.held_out("doc_id", 5, 0)
    labels = table(spark, sf_dir, "labels").where(~out)
    model = toxicity.fit(docs.where(~out), labels)
    scored = toxicity.score(docs, model, keep=["doc_id"])
    return scored.select("row.doc_id", "score", "predicted", "spans").select(
        "doc_id", out.alias("held_out"), "score", "predicted",
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["stop"])), ",").alias("spans"))


@query("op5_language_id")
def language_ids(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = language.held_out("doc_id", 4, 2)
    model = language.fit(docs.where(~out))
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("row.doc_id", "lang_pred", "score", "ambiguous").withColumn("held_out", out)


@query("op8_sentencepiece")
def sentencepiece_ids(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pieces.encode_documents(docs, tokenizer_path())
    return out.select("row.doc_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
