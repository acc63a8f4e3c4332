"""Density clustering (DBSCAN, cosine) of weighted distinct texts inside groups.

Rows are collapsed to distinct texts with a weight, so copies cost nothing.
Dense regions are not compared pair by pair either: the heaviest texts of a
group lead balls of half the radius.  All members of a ball lie within the
radius of each other, so a ball that reaches the minimum weight is one set of
core texts that hang together.  Only texts outside such balls look for their
neighbours, and two balls only compare members when their leaders are apart.
Neighbours are never listed as pairs: blocks of texts are compared at a time,
and each gives a weight, a link or a least cluster per text.
"""

import math

from pyspark.sql import DataFrame, functions as F

from lotwise.fixed_values import DENSITY_SIMILARITY
from lotwise.operators.components import connected_components
from lotwise.operators.relational import top_per_group
from lotwise.operators.similarity import best_matches, profiles, similar_least, similar_links, similar_pairs, similar_weight
from lotwise.operators.stats import cluster_labels
from lotwise.session import materialize, materialize_counted

LEADERS = 32


def dense_clusters(points: DataFrame, keys: list[str], similarity: float, leaders: int = LEADERS) -> DataFrame:
    """(keys, text, cluster): cluster is the least core text of the cluster, null for noise.

    ``points`` holds keys, text, its profile, ``weight`` and the group's
    minimum weight ``least``.  A border text goes to the least of the clusters
    it touches.
    """
    points = materialize(points, "points", wide=True)
    half = math.sqrt((1 + similarity) / 2) + 1e-9
    own = keys + ["text"]
    profile = own + ["codes", "tfs", "nsq"]

    heads = top_per_group(points, keys, [F.desc("weight"), F.col("text")], leaders)
    heads = heads.select(*profile, F.col("text").alias("name"))
    balls = best_matches(points.select(*profile), heads, keys, half)
    members = points.join(balls.select(*own, F.col("name").alias("ball")), own)
    heavy = (members.groupBy(*keys, "ball").agg(F.sum("weight").alias("w"), F.max("least").alias("least"))
             .where(F.col("w") >= F.col("least")).select(*keys, "ball"))
    dense = materialize(members.join(heavy, keys + ["ball"]).select(*profile, "weight", "least", "ball"), "dense", wide=True)
    loose = materialize(points.join(dense.select(*own), own, "left_anti"), "loose", wide=True)

    # weight within the radius of texts outside dense balls, themselves included
    around = similar_weight(loose, points, keys, similarity)
    loose_core = (loose.join(around, own, "left").where(F.coalesce("total", "weight") >= F.col("least"))
                  .select(*profile, F.col("text").alias("node")))
    loose_core = materialize(loose_core, "loosecore", wide=True)
    # every core text with the node it belongs to: its ball, or itself
    cores = materialize(dense.select(*profile, F.col("ball").alias("node")).unionByName(loose_core), "cores", wide=True)
    links = similar_links(loose_core, cores, keys, similarity)
    # balls: leaders within the radius settle it; otherwise members decide
    led = heads.join(heavy.withColumnRenamed("ball", "text"), own, "left_semi").select(*profile)
    close = materialize(similar_pairs(led, led, keys, similarity, self_join=True).select(*keys, "a", "b"), "close", wide=True)
    crossing = _crossing_balls(dense, heavy, close, keys, similarity)
    edges = links.unionByName(close).unionByName(crossing).where("a <> b").distinct()

    roots = connected_components(cores.select(*keys, F.col("node").alias("id")), edges, keys)
    placed = cores.join(roots.withColumnRenamed("id", "node"), keys + ["node"])
    names = placed.groupBy(*keys, "root").agg(F.min("text").alias("cluster"))
    core_cluster = materialize(placed.join(names, keys + ["root"]).select(*profile, "cluster"), "clusters", wide=True)
    outside = loose.join(loose_core.select(*own), own, "left_anti")
    border = similar_least(outside, core_cluster, keys, similarity, "cluster").withColumnRenamed("cluster", "touch")
    return (points.select(*own).join(core_cluster.select(*own, "cluster"), own, "left").join(border, own, "left")
            .select(*own, F.coalesce("cluster", "touch").alias("cluster")))


def _crossing_balls(dense: DataFrame, heavy: DataFrame, close: DataFrame, keys: list[str],
                    similarity: float) -> DataFrame:
    """Ball pairs joined by members although their leaders are apart.

    A group has at most ``leaders`` balls, so its ball pairs are few.  Members
    are compared across such a pair only, never inside a ball.
    """
    pairs = (heavy.withColumnRenamed("ball", "a").join(heavy.withColumnRenamed("ball", "b"), keys)
             .where("a < b").join(close, keys + ["a", "b"], "left_anti"))
    pairs, rows = materialize_counted(pairs, "ballpairs", wide=True)
    if rows == 0:
        return pairs
    profile = ["text", "codes", "tfs", "nsq"]
    across = keys + ["ball_a", "ball_b"]
    named = pairs.select(*keys, F.col("a").alias("ball_a"), F.col("b").alias("ball_b"))
    left = dense.withColumnRenamed("ball", "ball_a").join(named, keys + ["ball_a"]).select(*across, *profile)
    right = dense.withColumnRenamed("ball", "ball_b").join(named, keys + ["ball_b"]).select(*across, *profile)
    touching = similar_links(left.withColumn("node", F.col("ball_a")), right.withColumn("node", F.col("ball_b")), across, similarity)
    return touching.select(*keys, "a", "b").distinct()


def label_clusters(members: DataFrame, clusters: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Canonical name per member: the cluster's most frequent value, ties to the least; noise keeps its own.

    ``members`` holds keys, text, the raw ``value`` and its row count ``n``.
    """
    placed = members.join(clusters, keys + ["text"])
    labels = cluster_labels(placed.where("cluster is not null"), keys + ["cluster"], value, "n")
    return (placed.join(labels.drop("size"), keys + ["cluster"], "left")
            .withColumn("canon", F.coalesce("label", F.col(f"`{value}`"))).drop("label"))


def cluster_versions(versions: DataFrame, keys: list[str], value: str, codes: DataFrame,
                     similarity: float = DENSITY_SIMILARITY, share: int = 10) -> DataFrame:
    """DBSCAN of free-typed values per group: (keys, value, text, n, cluster, canon).

    ``versions`` holds keys, the raw value, its clean ``text`` and its row count
    ``n``.  A cluster needs max(2, rows // share) rows.  Values whose clean text
    is empty are left out; a text without a known gram is always noise.
    """
    usable = materialize(versions.where("text <> ''"), "usable", wide=True)
    least = usable.groupBy(*keys).agg(F.greatest(F.lit(2), F.floor(F.sum("n") / share)).alias("least"))
    known = profiles(usable.select("text"), codes)
    points = (usable.groupBy(*keys, "text").agg(F.sum("n").alias("weight"))
              .join(least, keys).join(known, "text"))
    clusters = dense_clusters(points, keys, similarity)
    every = usable.select(*keys, "text").distinct().join(clusters, keys + ["text"], "left")
    return label_clusters(usable, every, keys, value)
