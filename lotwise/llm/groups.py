"""Block pairs of large groups, and linked components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from lotwise.operators.blocks import group_starts, map_groups  # noqa: F401
from lotwise.session import join_lookup, materialize, materialize_counted

HUB = 512               # rows of one key that go to one part of a join


def in_block_pairs(rows: DataFrame, group: str, key: str, size: str, limit: int) -> DataFrame:
    """``rows`` with (i, j, block): groups above ``limit`` rows are cut into blocks by the key's hash.

    A row goes to every pair of blocks that has its own, so any two rows of a
    group meet in exactly one pair (i, j), or in (i, i).  Groups up to the
    limit are one block.  No pair of rows is formed here.
    """
    blocks = F.ceil(F.col(size) / limit).cast("int")
    block = F.pmod(F.xxhash64(key, group), F.greatest(blocks, F.lit(1))).cast("int")
    rows = rows.withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.greatest(blocks, F.lit(1)) - 1)))
    return rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other")


def local_roots(linked: np.ndarray) -> np.ndarray:
    """Least index of each row's component in a symmetric boolean matrix."""
    root = np.full(len(linked), -1)
    for i in range(len(linked)):
        if root[i] >= 0:
            continue
        root[i] = i
        front = np.array([i])
        while len(front):
            reached = linked[front].any(0) & (root < 0)
            root[reached] = i
            front = np.flatnonzero(reached)
    return root


def roots_of_pairs(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least index of each of ``n`` rows' component under the given pairs."""
    root = np.arange(n)
    while True:
        before = root.copy()
        least = np.minimum(root[left], root[right])
        np.minimum.at(root, left, least)
        np.minimum.at(root, right, least)
        root = root[root]
        if (root == before).all():
            return root


def join_split(large: DataFrame, small: DataFrame, key: list[str], by: str) -> DataFrame:
    """Inner join on the columns ``key``; ``small`` has one row per key with the ``rows`` of ``large`` that bear it.

    A key of more than ``HUB`` rows is dealt to parts by the hash of ``by``, and its
    row of ``small`` goes to each of them.  The parts are a table of at most one row
    per ``HUB`` rows of ``large``.
    """
    parts = small.where(F.col("rows") > HUB).select(*key, F.ceil(F.col("rows") / HUB).alias("parts"))
    if parts.isEmpty():
        return large.join(small.drop("rows"), key)
    dealt = join_lookup(large, parts, key).withColumn("part", F.pmod(F.xxhash64(by), F.coalesce("parts", F.lit(1)))).drop("parts")
    sent = small.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("rows") / HUB) - 1))).drop("rows")
    return dealt.join(sent, [*key, "part"]).drop("part")


def components(edges: DataFrame, name: str = "stars") -> DataFrame:
    """(id, root) of every node of ``edges`` (a, b): the least id that links lead to.

    Two steps take turns until only stars are left: every node hands its larger
    neighbours to the least one, then its smaller ones.  Degrees are reduced by
    aggregation, and every step is written out.
    """
    now, n = materialize_counted(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while n and not _stars_only(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = now.select(F.col("b").alias("a"), F.col("b").alias("m")).unionByName(
            now.select("a", F.col("b").alias("m"))).groupBy("a").agg(F.min("m").alias("m"), F.count("*").alias("rows"))
        large = materialize(join_split(both, least, ["a"], "b").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), name)
        small = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("rows"))
        now = materialize(join_split(large, small, ["a"], "b").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                          .unionByName(small.select("a", F.col("m").alias("b"))).distinct(), name)
    return now.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("id"), F.col("b").alias("root"))).distinct()


def _stars_only(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and only nodes without one are such neighbours."""
    ends = edges.select("a", "b", F.lit(0).alias("centre")).unionByName(
        edges.select(F.col("b").alias("a"), F.lit(None).cast(edges.schema["b"].dataType).alias("b"), F.lit(1).alias("centre")))
    # A node with a smaller neighbour must not be a centre, and all its smaller neighbours must be one.
    wrong = F.col("least").isNotNull() & ((F.col("centre") == 1) | (F.col("least") != F.col("most")))
    return ends.groupBy("a").agg(F.min("b").alias("least"), F.max("b").alias("most"), F.max("centre").alias("centre")).where(wrong).isEmpty()
