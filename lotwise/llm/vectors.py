"""Embedding near-dedup by cross-polytope hashing.

A vector is turned by three rounds of random signs and a fast Hadamard
transform; its hash is the axis it then lies closest to, with its sign.  A
bucket is the hash of several turns.  Besides its own bucket a vector visits
those of the next best axes (multiprobe).  Pairs that meet in a bucket are
verified in double precision.

A bucket gives only a spanning star of its verified links; within the
components that come of it every pair is verified, in pairs of blocks, so that
link counts miss nothing inside a component and no row per pair is made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lotwise.llm.groups import components, in_block_pairs, local_roots
from lotwise.operators.blocks import map_groups
from lotwise.session import materialize

COSINE = 0.9
TABLES = 10
TURNS = 4               # axes per bucket
PROBES = 8              # buckets a vector visits per table
BLOCK = 256
SEED = 17


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of the rows; their length is a power of two."""
    n, size = x.shape
    x = x.copy()
    h = 1
    while h < size:
        y = x.reshape(n, size // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, size)
        h *= 2
    return x / np.sqrt(size)


def turned(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Rows after three rounds of signs (3, size) and transform."""
    for s in signs:
        x = hadamard(x * s)
    return x


def buckets(vectors: np.ndarray, tables: int = TABLES, turns: int = TURNS, probes: int = PROBES) -> np.ndarray:
    """(rows, tables * probes) bucket numbers of unit vectors, own bucket first."""
    n, dims = vectors.shape
    size = 1 << max(dims - 1, 1).bit_length()
    padded = np.zeros((n, size))
    padded[:, :dims] = vectors
    draw = np.random.default_rng([SEED, size])
    rows = np.arange(n)[:, None]
    out = np.empty((n, tables * probes), dtype=np.uint64)
    for table in range(tables):
        # The two best axes of each turn and what it costs to take the second.
        best, gaps = [], []
        for _ in range(turns):
            y = turned(padded, draw.choice([-1.0, 1.0], (3, size)))
            near = np.argpartition(-np.abs(y), 1, axis=1)[:, :2] if size > 2 else np.argsort(-np.abs(y), axis=1)[:, :2]
            values = np.take_along_axis(y, near, axis=1)
            swap = np.abs(values[:, 0]) < np.abs(values[:, 1])
            near[swap], values[swap] = near[swap][:, ::-1], values[swap][:, ::-1]
            best.append(2 * near + (values < 0))
            gaps.append(np.abs(values[:, 0]) - np.abs(values[:, 1]))
        # A probe takes the first or second axis in every turn; the cheapest ones are visited.
        choices = np.array([[(c >> t) & 1 for t in range(turns)] for c in range(2 ** turns)])
        cost = np.stack(gaps, axis=1) @ choices.T
        order = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        codes = np.full((n, len(choices)), table + 1, dtype=np.uint64)
        for t in range(turns):
            codes = codes * np.uint64(2 * size + 1) + best[t][:, choices[:, t]].astype(np.uint64)
        visited = codes[rows, order]
        if visited.shape[1] < probes:
            visited = np.concatenate([visited, np.repeat(visited[:, :1], probes - visited.shape[1], axis=1)], axis=1)
        mixed = (visited ^ (visited >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(dims)
        out[:, table * probes:(table + 1) * probes] = mixed
    return out


def usable(vector: np.ndarray | None) -> bool:
    if vector is None or not len(vector):
        return False
    return bool(np.isfinite(vector).all() and np.abs(vector).max() > 0)


def unit(vector: np.ndarray) -> np.ndarray:
    """Unit length in double precision; scaled first, so that no square overflows or vanishes."""
    scaled = vector / np.abs(vector).max()
    return scaled / np.sqrt((scaled * scaled).sum())


def _doubles(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors in double precision; one with a null component counts as none."""
    out: list[np.ndarray | None] = []
    for scalar in column:
        if not scalar.is_valid or scalar.values.null_count:
            out.append(None)
        else:
            out.append(scalar.values.to_numpy(zero_copy_only=False).astype(np.float64))
    return out


def prepare(vectors: DataFrame, tables: int, turns: int, probes: int) -> DataFrame:
    """(row struct, key, dims, vector, buckets) of ``vectors`` (row, vector); key is null if it links with nothing."""
    row = vectors.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parsed = _doubles(batch.column("vector"))
            good = [usable(v) for v in parsed]
            units = [unit(v) if g else None for v, g in zip(parsed, good, strict=True)]
            keys = [hashlib.blake2b(v.tobytes(), digest_size=16).digest() if g else None for v, g in zip(parsed, good, strict=True)]
            found: list[list[int] | None] = [None] * len(parsed)
            for dims in {len(u) for u in units if u is not None}:
                at = [i for i, u in enumerate(units) if u is not None and len(u) == dims]
                codes = buckets(np.stack([units[i] for i in at]), tables, turns, probes)
                for i, c in zip(at, codes, strict=True):
                    found[i] = np.unique(c).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(keys, pa.binary()), pa.array([0 if u is None else len(u) for u in units], pa.int32()),
                 pa.array([None if u is None else u.tobytes() for u in units], pa.binary()), pa.array(found, pa.list_(pa.int64()))],
                names=["row", "key", "dims", "vector", "buckets"])

    return vectors.mapInArrow(run, f"row {row}, key binary, dims int, vector binary, buckets array<bigint>")


def _linked(vectors: list[bytes], cosine: float) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), dtype=np.float64).reshape(len(vectors), -1)
    linked = x @ x.T >= cosine
    np.fill_diagonal(linked, False)
    return linked


def _stars(cosine: float):
    def work(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, vectors = table.column("key").to_pylist(), table.column("vector").to_pylist()
        edges = set()
        for s, e in zip(starts.tolist(), np.append(starts[1:], table.num_rows).tolist(), strict=True):
            if e - s < 2:
                continue
            root = local_roots(_linked(vectors[s:e], cosine))
            edges |= {(keys[s + r], keys[s + i]) for i, r in enumerate(root.tolist()) if r != i}
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in edges], pa.binary()), pa.array([b for _, b in edges], pa.binary())],
                                         names=["a", "b"])
    return work


def _counts(cosine: float):
    def work(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, vectors = table.column("key").to_pylist(), table.column("vector").to_pylist()
        copies, block = table.column("copies").to_numpy(), table.column("block").to_numpy()
        i, j = table.column("i").to_numpy(), table.column("j").to_numpy()
        links = np.zeros(len(keys), dtype=np.int64)
        for s, e in zip(starts.tolist(), np.append(starts[1:], len(keys)).tolist(), strict=True):
            linked = _linked(vectors[s:e], cosine)
            if i[s] != j[s]:
                linked &= block[s:e, None] != block[None, s:e]
            links[s:e] = linked @ copies[s:e]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(links)], names=["key", "links"])
    return work


def cosine_links(table: DataFrame, cosine: float = COSINE, tables: int = TABLES, turns: int = TURNS, probes: int = PROBES,
                 id_column: str = "vec_id", vector_column: str = "embedding", keep: list[str] | None = None) -> DataFrame:
    """(row, n_links, component_id, kept) of every row; ``row`` has the ``keep`` columns, or all.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing, and so do vectors of different lengths.  Equal vectors
    are one class and link with each other.  Rows alike in id and vector count
    as two vectors with one id.  An empty table gives an empty one.
    """
    keep = table.columns if keep is None else keep
    rows = table.select(F.struct(F.col(f"`{id_column}`").alias("id"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("all")).alias("row"),
                        F.col(f"`{vector_column}`").alias("vector"))
    prepared = materialize(prepare(rows, tables, turns, probes), "vectors")
    classes = materialize(prepared.where("key is not null").groupBy("key").agg(
        F.min("row.id").alias("class_id"), F.count("*").alias("copies"),
        F.first(F.struct("dims", "vector", "buckets")).alias("v")).select("key", "class_id", "copies", "v.*"), "vector-classes")
    visits = classes.select("key", "dims", F.explode("buckets").alias("bucket"))
    sizes = visits.groupBy("dims", "bucket").agg(F.count("*").alias("size")).where("size > 1")
    cut = in_block_pairs(visits.join(sizes, ["dims", "bucket"]), "bucket", "key", "size", BLOCK)
    met = cut.select("dims", "bucket", "i", "j", "key").join(classes.select("key", "vector"), "key")
    stars = map_groups(met, ["dims", "bucket", "i", "j"], _stars(cosine), "a binary, b binary")
    together = materialize(components(stars, "vector-stars"), "vector-components")
    counts = together.groupBy("root").agg(F.count("*").alias("size"))
    members = together.withColumnRenamed("id", "key").join(counts, "root").join(classes, "key")
    blocks = in_block_pairs(members.select("root", "size", "key", "copies", "vector"), "root", "key", "size", BLOCK)
    links = map_groups(blocks, ["root", "i", "j"], _counts(cosine), "key binary, links bigint").groupBy("key").agg(
        F.sum("links").alias("links"))
    least = members.groupBy("root").agg(F.min("class_id").alias("component_id"))
    found = members.select("root", "key").join(least, "root").select("key", "component_id")
    of_class = materialize(classes.select("key", "class_id", "copies").join(links, "key", "left").join(found, "key", "left").select(
        "key", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component_id", "class_id").alias("component_id")),
        "vector-result")
    joined = prepared.select("row", "key").join(of_class, "key", "left")
    own = F.col("row.id")
    component = F.when(F.col("key").isNull(), own).otherwise(F.col("component_id"))
    return joined.select(
        F.col("row.all").alias("row"),
        F.when(F.col("key").isNull(), F.lit(0)).otherwise(F.col("copies") - 1 + F.col("links")).cast("bigint").alias("n_links"),
        component.alias("component_id"), own.eqNullSafe(component).alias("kept"))
