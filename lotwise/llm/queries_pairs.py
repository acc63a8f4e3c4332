"""Queries of the operators on pairs and neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.llm import hamming, ngram_join, vectors
from lotwise.llm.registry import query, table


@query("op6_ngram_jaccard_join")
def ngram_jaccard_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = ngram_join.jaccard_join(docs, keep=["doc_id"])
    return out.select("row.doc_id", "class_id", "copies", "n_links", "component_id", "kept")


@query("op7_embedding_near_dedup")
def embedding_near_dedup(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    out = vectors.cosine_links(rows, keep=["vec_id"])
    return out.select("row.vec_id", "n_links", "component_id", "kept")


TOP = 10


@query("op10_exact_top_k", f"""
with c as (select vec_id, array_to_string(list_transform(embedding, lambda x: case when x >= 0 then '1' else '0' end), '') code
   from embeddings where embedding is not null),
p as (select q.vec_id query_id, c.vec_id neighbour_id, cast(hamming(q.code, c.code) as int) distance
   from c q join c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0),
r as (select *, cast(row_number() over (partition by query_id order by distance, neighbour_id) as int) rank from p)
select query_id, rank, neighbour_id, distance from r where rank <= {TOP}""")
def exact_top_k(spark, sf_dir):
    coded = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), hamming.sign_code(F.col("embedding")).alias("code"))
    return hamming.top_k(coded, coded.where("id % 100 = 0"), TOP)
