"""Exact nearest neighbours of binary codes by incremental multi-index hashing.

A code is cut into segments of 16 bits.  Two codes at distance ``d`` agree up to
``d // segments`` bits in one segment at least, so a query looks up, segment by
segment, all values within a radius of its own and verifies what it finds.  The
radii grow one segment at a time until the distance of the k-th verified code
is covered: with radius ``r_i`` searched in segment ``i``, every code up to
``sum(r_i + 1) - 1`` has been seen.

Codes lie in blocks, each with its own index, and queries in packs; a task has
one pack and one block.  A first pass searches one block per query.  The distance of
its k-th code there bounds the k-th distance of all, so in the other blocks a
search ends once that bound is covered, which is sooner than their own k-th code.
Equal codes are one entry with its least ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise.session import materialize

WORD = 64
SEGMENT = 16
BLOCK_CODES = 16_384
PACK_QUERIES = 2_048


def sign_code(vector: Column) -> Column:
    """The signs of all components as an array of 64-bit words, the first one in the highest bit; the last word ends in zeros.

    Null for vectors that are null or empty, or hold null or not-a-number components.
    """
    def word(k: Column) -> Column:
        part = F.slice(vector, k * WORD + 1, F.lit(WORD))
        bits = F.aggregate(part, F.lit(0).cast("bigint"), lambda acc, x: F.shiftleft(acc, 1).bitwiseOR((x >= 0).cast("bigint")))
        filled = F.call_function("shiftleft", bits, (F.lit(WORD) - F.size(part)).cast("int"))
        return F.when(F.size(part) < WORD, filled).otherwise(bits)

    words = F.transform(F.sequence(F.lit(0), F.floor((F.size(vector) - 1) / WORD).cast("int")), word)
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x))
    return F.when((F.size(vector) > 0) & ~F.coalesce(bad, F.lit(False)), words)


def _masks(bits: int) -> list[np.ndarray]:
    """All values of ``bits`` bits, by number of ones."""
    values = np.arange(2 ** bits, dtype=np.uint32)
    ones = np.bitwise_count(values)
    return [values[ones == r] for r in range(bits + 1)]


class MultiIndex:
    """Segment tables over the rows of an array of distinct codes (codes x words)."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.words = codes, codes.shape[1]
        self.segments, self.masks = self.words * (WORD // SEGMENT), _masks(SEGMENT)
        self.orders, self.starts = [], []
        for s in range(self.segments):
            values = self.segment(codes, s)
            self.orders.append(np.argsort(values, kind="stable"))
            self.starts.append(np.concatenate([[0], np.cumsum(np.bincount(values, minlength=2 ** SEGMENT))]))

    @staticmethod
    def segment(codes: np.ndarray, s: int) -> np.ndarray:
        word, place = divmod(s, WORD // SEGMENT)
        return ((codes[..., word] >> np.uint64(SEGMENT * place)) & np.uint64(2 ** SEGMENT - 1)).astype(np.int64)

    def nearest(self, query: np.ndarray, want: int, limit: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(places, distances) of all codes up to the distance of the ``want``-th nearest, or up to ``limit`` if that is less."""
        bits = self.words * WORD
        limit = bits if limit is None else limit
        seen = np.zeros(len(self.codes), dtype=bool)
        places, distances = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        counts = np.zeros(bits + 1, dtype=np.int64)
        covered = -1
        for radius in range(SEGMENT + 1):
            for s in range(self.segments):
                values = int(self.segment(query, s)) ^ self.masks[radius].astype(np.int64)
                begin, size = self.starts[s][values], self.starts[s][values + 1] - self.starts[s][values]
                hit = size > 0
                begin, size = begin[hit], size[hit]
                at = self.orders[s][np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())]
                at = at[~seen[at]]
                seen[at] = True
                apart = np.bitwise_count(self.codes[at] ^ query).sum(1, dtype=np.int64)
                places.append(at)
                distances.append(apart)
                counts += np.bincount(apart, minlength=bits + 1)
                covered += 1
                total = np.cumsum(counts)
                enough = min(int(np.searchsorted(total, want)), limit)
                if enough <= covered or total[-1] == len(self.codes):
                    at, apart = np.concatenate(places), np.concatenate(distances)
                    near = apart <= enough
                    return at[near], apart[near]
        return np.concatenate(places), np.concatenate(distances)


def _codes_of(column: pa.ChunkedArray) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.int64).view(np.uint64)


def top_k(codes: DataFrame, queries: DataFrame, k: int, block_codes: int = BLOCK_CODES, pack_queries: int = PACK_QUERIES) -> DataFrame:
    """(query_id, rank, neighbour_id, distance): the k nearest other ids of every query, ties to the smaller id.

    ``codes`` and ``queries`` have (id, code), a code being an array of 64-bit words.
    Codes of another number of words than a query has are no neighbours of it.
    Rows without id or code take no part; rows alike count once.  An id with several
    codes among the k nearest rows is listed once, with its nearest, so that fewer
    than k ids are left.  Fewer than k others give fewer rows; empty tables give an
    empty one.  Other columns are ignored.  Codes of any length are compared whole.
    """
    known = codes.where("id is not null and code is not null").select("id", "code").distinct()
    asked = queries.where("id is not null and code is not null").select(F.col("id").alias("query_id"), F.col("code").alias("query")).distinct()
    # Of many equal codes the k + 1 least ids can matter; the limit applies in every task before the shuffle.
    first = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    entries = materialize(known.withColumn("_n", first).where(F.col("_n") <= k + 1).groupBy("code").agg(
        F.sort_array(F.collect_list("id")).alias("ids")), "hamming-codes")
    asked = materialize(asked, "hamming-queries")
    blocks = max(1, -(-entries.count() // block_codes))
    packs = max(1, -(-asked.count() // pack_queries))
    # A block holds codes of one length.
    block = F.pmod(F.xxhash64("code"), F.lit(blocks)).cast("int")
    held = entries.select("code", "ids", F.size("code").alias("words"), block.alias("block"))
    sent = asked.select("query_id", "query", F.size("query").alias("words"), F.pmod(F.xxhash64("query_id", "query"), F.lit(packs)).cast("int").alias("pack"))
    id_type = known.schema["id"].dataType.simpleString()
    keys = ["words", "block", "pack"]

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        asked_ids, limits = right.column("query_id").to_pylist(), right.column("limit").to_pylist()
        out: list[tuple] = []
        if left.num_rows and len(asked_ids):
            index, ids = MultiIndex(_codes_of(left.column("code"))), left.column("ids").to_pylist()
            for query_id, query, limit in zip(asked_ids, _codes_of(right.column("query")), limits, strict=True):
                at, apart = index.nearest(query, k + 1, limit)
                found = sorted((d, x) for p, d in zip(at.tolist(), apart.tolist(), strict=True) for x in ids[p] if x != query_id)
                out += [(query_id, x, d) for d, x in found[:k]]
        kind = right.schema.field("query_id").type
        return pa.table({"query_id": pa.array([o[0] for o in out], kind), "neighbour_id": pa.array([o[1] for o in out], kind),
                         "distance": pa.array([o[2] for o in out], pa.int32())})

    own = F.pmod(F.col("pack"), F.lit(blocks)).cast("int")
    every_pack = held.withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(packs - 1))))

    def answers(part: DataFrame, left: DataFrame, tasks: int) -> DataFrame:
        """Best of every pack of ``part`` (query_id, query, words, pack, block, limit) in the blocks of ``left`` that it meets."""
        return left.repartition(tasks, *keys).groupBy(*keys).cogroup(part.repartition(tasks, *keys).groupBy(*keys)).applyInArrow(
            search, f"query_id {id_type}, neighbour_id {id_type}, distance int")

    none = F.lit(None).cast("int")
    mine = sent.withColumn("block", own).withColumn("limit", none)
    near = materialize(answers(mine, every_pack.where(F.col("block") == own), packs), "hamming-near")
    # The k-th other id of one block bounds the k-th of all.
    kth = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "neighbour_id"))
    bounds = near.withColumn("n", kth).where(F.col("n") == k).select("query_id", F.col("distance").alias("limit"))
    others = sent.join(bounds, "query_id", "left").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).where(F.col("block") != own)
    others = others.select("query_id", "query", "words", "pack", "block", "limit")
    every = near if blocks == 1 else near.unionByName(answers(others, every_pack.where(F.col("block") != own), min(packs * blocks, 10_000)))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "neighbour_id"))
    # An id with several codes among the k nearest rows is listed once, with its nearest.
    best = every.withColumn("n", rank).where(F.col("n") <= k).groupBy("query_id", "neighbour_id").agg(F.min("distance").alias("distance"))
    return best.select("query_id", rank.alias("rank"), "neighbour_id", "distance")
