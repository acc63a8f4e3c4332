"""Average-linkage clustering (cosine) of free-typed texts, all groups at once.

With vectors of length one the average similarity of two clusters is the dot
product of their mean vectors, so a cluster is one sparse vector and no table
of pairs is kept.  In every round all pairs that are each other's nearest
cluster merge together; for average linkage this ends in the same clusters as
merging one pair at a time.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from lotwise import fixed_values as fx
from lotwise.operators.relational import best_row
from lotwise.operators.similarity import SLACK, grams
from lotwise.operators.stats import cluster_labels
from lotwise.session import materialize, materialize_counted


@F.arrow_udf(DoubleType())
def _dot(grams_a: pa.Array, weights_a: pa.Array, grams_b: pa.Array, weights_b: pa.Array) -> pa.Array:
    """Dot products of sparse vectors given as gram names and weights, one row per pair."""
    both = pa.concat_arrays([grams_a.flatten(), grams_b.flatten()])
    codes = pc.dictionary_encode(both).indices.to_numpy().astype(np.int64)
    split = len(grams_a.flatten())

    def rows(lists):
        return np.repeat(np.arange(len(lists), dtype=np.int64), np.diff(lists.offsets.to_numpy())) << 32

    keys_a, keys_b = rows(grams_a) | codes[:split], rows(grams_b) | codes[split:]
    values_a, values_b = weights_a.flatten().to_numpy(), weights_b.flatten().to_numpy()
    if len(keys_a) == 0 or len(keys_b) == 0:
        return pa.array(np.zeros(len(grams_a)))
    order = np.argsort(keys_b)
    keys_b, values_b = keys_b[order], values_b[order]
    at = np.minimum(np.searchsorted(keys_b, keys_a), len(keys_b) - 1)
    hit = keys_b[at] == keys_a
    return pa.array(np.bincount(keys_a[hit] >> 32, weights=values_a[hit] * values_b[at[hit]], minlength=len(grams_a)))


def _packed(vectors: DataFrame, keys: list[str]) -> DataFrame:
    """One row per cluster: grams in a fixed order (rare first), weights, weight in rows."""
    return vectors.groupBy(*keys, "id").agg(
        F.array_sort(F.collect_list(F.struct("texts", "gram", "w"))).alias("g"), F.first("n").alias("n"))


def _close_pairs(packed: DataFrame, keys: list[str], limit: float) -> DataFrame:
    """Cluster pairs with a mean similarity above ``limit``: joined on leading grams only."""
    floor = limit * limit - SLACK
    start = F.struct(F.lit(0).alias("kept"), F.aggregate("g", F.lit(0.0), lambda a, x: a + x["w"] * x["w"]).alias("rest"))
    kept = F.aggregate("g", start, lambda a, x: F.when(a["rest"] >= floor, F.struct(
        (a["kept"] + 1).alias("kept"), (a["rest"] - x["w"] * x["w"]).alias("rest"))).otherwise(a))["kept"]
    lead = packed.select(*keys, F.explode(F.slice("g", F.lit(1), kept)).alias("e"),
                         F.struct("id", F.col("g.gram").alias("grams"), F.col("g.w").alias("ws")).alias("c"))
    side = lead.select(*keys, F.col("e.gram").alias("gram"), "c")
    met = side.withColumnRenamed("c", "l").join(side.withColumnRenamed("c", "r"), keys + ["gram"])
    met = met.where((F.col("l.id") < F.col("r.id"))
                    & (F.col("gram") == F.element_at(F.array_intersect("l.grams", "r.grams"), 1)))
    return (met.select(*keys, F.col("l.id").alias("a"), F.col("r.id").alias("b"),
                       F.round(_dot("l.grams", "l.ws", "r.grams", "r.ws"), 12).alias("score"))
            .where(F.col("score") > limit))


def linkage_clusters(texts: DataFrame, keys: list[str], distance: float = fx.LINKAGE_DISTANCE,
                     low: int = 3, high: int = 5) -> DataFrame:
    """(keys, text, cluster): cluster is the least text of the cluster, null for texts too short for a gram.

    ``texts`` holds keys, distinct clean texts and their row count ``n``.
    Vectors are TF-IDF of 3-5-grams within the group, of length one.
    """
    texts = materialize(texts, "texts", wide=True)
    counts = (texts.select(*keys, "text", "n", F.explode(grams(F.col("text"), low, high)).alias("gram"))
              .groupBy(*keys, "text", "n", "gram").agg(F.count("*").alias("tf")))
    counts = materialize(counts, "counts", wide=True)
    df = counts.groupBy(*keys, "gram").agg(F.sum("n").alias("df"), F.count("*").alias("texts"))
    rows = texts.groupBy(*keys).agg(F.sum("n").alias("rows"))
    weighted = counts.join(df, keys + ["gram"]).join(rows, keys).withColumn(
        "w", F.col("tf") * (F.log((1 + F.col("rows")) / (1 + F.col("df"))) + 1))
    length = weighted.groupBy(*keys, "text").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    vectors = weighted.join(length, keys + ["text"]).select(
        *keys, F.col("text").alias("id"), "n", "gram", "texts", (F.col("w") / F.col("length")).alias("w"))
    packed = materialize(_packed(vectors, keys), "clusters", wide=True)
    member = materialize(packed.select(*keys, F.col("id").alias("text"), "id"), "member", wide=True)

    while True:
        pairs = materialize(_close_pairs(packed, keys, 1 - distance), "pairs", wide=True)
        ends = pairs.select(*keys, F.col("a").alias("me"), "a", "b", "score").unionByName(
            pairs.select(*keys, F.col("b").alias("me"), "a", "b", "score"))
        nearest = best_row(ends, keys + ["me"], [-F.col("score"), F.col("a"), F.col("b")], ["a", "b"])
        agreed = nearest.groupBy(*keys, "a", "b").agg(F.count("*").alias("sides")).where("sides = 2")
        merges, merged = materialize_counted(agreed.select(*keys, F.col("b").alias("id"), F.col("a").alias("into")), "merges", wide=True)
        if merged == 0:
            break
        moved = packed.join(merges, keys + ["id"], "left").withColumn("into", F.coalesce("into", "id"))
        flat = moved.select(*keys, F.col("into").alias("id"), "n", F.explode("g").alias("e"))
        sizes = moved.groupBy(*keys, F.col("into").alias("id")).agg(F.sum("n").alias("total"))
        means = (flat.groupBy(*keys, "id", F.col("e.texts").alias("texts"), F.col("e.gram").alias("gram"))
                 .agg(F.sum(F.col("n") * F.col("e.w")).alias("w")).join(sizes, keys + ["id"])
                 .select(*keys, "id", F.col("total").alias("n"), "gram", "texts", (F.col("w") / F.col("total")).alias("w")))
        packed = materialize(_packed(means, keys), "clusters", wide=True)
        member = materialize(member.join(merges, keys + ["id"], "left").select(
            *keys, "text", F.coalesce("into", "id").alias("id")), "member", wide=True)
    return texts.select(*keys, "text").join(
        member.withColumnRenamed("id", "cluster"), keys + ["text"], "left")


def linkage_labels(values: DataFrame, keys: list[str], value: str, distance: float = fx.LINKAGE_DISTANCE) -> DataFrame:
    """(keys, value, cluster, canon): canon is the cluster's most frequent value; ``values`` has value, text, n."""
    usable = materialize(values.where("text <> ''"), "usable", wide=True)
    texts = usable.groupBy(*keys, "text").agg(F.sum("n").alias("n"))
    clusters = linkage_clusters(texts, keys, distance)
    placed = usable.join(clusters, keys + ["text"]).withColumn("group", F.coalesce("cluster", F.lit("")))
    labels = cluster_labels(placed, keys + ["group"], value, "n").drop("size")
    return placed.join(labels, keys + ["group"]).select(*keys, value, "n", "cluster", F.col("label").alias("canon"))
