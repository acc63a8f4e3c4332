"""Connected components by joins: least labels spread along edges, with pointer jumping."""

from pyspark.sql import DataFrame, functions as F

from lotwise.session import join_lookup, materialize, materialize_counted


def connected_components(nodes: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, id, root): root is the least id of the node's component.

    ``edges`` holds (keys, a, b), in any direction.  Every round is written
    out, so a lost executor costs one round at most; rounds go on until no
    label changes.
    """
    both, rows = materialize_counted(edges.select(*keys, "a", "b")
                       .unionByName(edges.select(*keys, F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges", wide=True)
    labels = nodes.select(*keys, "id", F.col("id").alias("root")).distinct()
    if rows == 0:
        return labels
    labels = materialize(labels, "labels", wide=True)
    while True:
        sent = (both.join(labels.select(*keys, F.col("id").alias("b"), "root"), keys + ["b"])
                .groupBy(*keys, F.col("a").alias("id")).agg(F.min("root").alias("least")))
        spread = materialize(labels.join(sent, keys + ["id"], "left").select(
            *keys, "id", F.col("root").alias("old"),
            F.coalesce(F.least("root", "least"), F.col("root")).alias("root")), "spread", wide=True)
        if spread.where("root <> old").isEmpty():
            return labels
        parents = spread.select(*keys, F.col("id").alias("root"), F.col("root").alias("up"))
        labels = materialize(join_lookup(spread.drop("old"), parents, keys + ["root"])
                             .select(*keys, "id", F.least("root", "up").alias("root")), "labels", wide=True)
