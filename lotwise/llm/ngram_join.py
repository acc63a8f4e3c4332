"""Jaccard join of documents on word shingles by chosen paths.

Documents with equal shingle sets are one class.  A set draws some of its
shingles at random; each opens a bucket that every set with this shingle draws
as well, since the draw depends on the shingle alone.  Large buckets are split
again by a fresh draw among the set's shingles, and so on; small ones are
compared by brute force.  Several runs with other draws reach the target recall.

Two sets of Jaccard similarity ``s`` or more share at least ``s`` of the larger
one.  With a chance of ``1 / (s n)`` per shingle of a set of ``n`` they share one
chosen path or more on average at every level, whatever their sizes.

Buckets compare bottom-k sketches and only say which classes belong together.
After the first runs a bucket whose classes are all known to belong together is
not opened again, so that a large group of near copies costs a few runs only.
Inside the components that come of it all pairs are compared exactly, on whole
shingle sets, in pairs of blocks.  No row per pair is ever made: a block yields
link counts per class and a spanning star per component.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lotwise.llm.groups import components, in_block_pairs, local_roots, roots_of_pairs
from lotwise.operators.blocks import map_groups
from lotwise.session import forget, materialize

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.995
LEVELS = 3
FIRST_RUNS = 3          # after these, buckets that lie inside one component are left out
BUCKET = 64             # a bucket up to this size is compared by brute force
BLOCK = 256             # whole sets in one block of a large component
SKETCH_BLOCK = 1024     # sketches in one block of a large bucket
SKETCH = 64
#: A sketch of two sets at the limit shares four fifths of its entries, give or take a twentieth.
LEAST_SHARED = 0.6
CACHED_WORDS = 500_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                    0x589965CC75374CC3], dtype=np.uint64)


def runs_for(recall: float = RECALL, levels: int = LEVELS) -> int:
    """Runs until a pair at the limit is found with the given chance.

    A pair at the limit shares one path per level on average, so its paths die
    out like a branching process: the chance to live through ``levels``.
    """
    alive = 1.0
    for _ in range(levels):
        alive = 1 - math.exp(-alive)
    return math.ceil(math.log(1 - recall) / math.log(1 - alive))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Sorted distinct 64-bit hashes of a text's runs of ``WORDS`` lower-cased words.

    Words are what white space separates.  A text of fewer words is one
    shingle, a text without words has none.
    """

    def __init__(self):
        self.words: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        known = self.words
        if len(known) > CACHED_WORDS:
            known.clear()
        try:
            codes = [known[w] for w in words]
        except KeyError:
            for w in set(words):
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
            codes = [known[w] for w in words]
        codes = np.array(codes, dtype=np.uint64)
        if len(codes) < WORDS:
            return _mixed((codes * _POWERS[:len(codes)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(codes)))
        n = len(codes) - WORDS + 1
        total = np.zeros(n, dtype=np.uint64)
        for k in range(WORDS):
            total += codes[k:k + n] * _POWERS[k]
        return np.unique(_mixed(total))


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def run_starts(runs: int) -> np.ndarray:
    """The empty path of every run, as it stands above the paths of the first level."""
    return _mixed(np.arange(1, runs + 1, dtype=np.uint64) * _MIX)


def chosen_paths(shingles: np.ndarray, runs: int, levels: int, similarity: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level (parents, paths): what the set chooses below each path it has chosen."""
    share = 1 / (similarity * len(shingles))
    limit = np.uint64(min(share, 1.0) * (2**64 - 2**12)) if share < 1 else np.uint64(2**64 - 1)
    paths = run_starts(runs)
    out = []
    for _ in range(levels):
        drawn = _mixed(paths[:, None] + shingles[None, :] * _MIX)
        at, token = np.nonzero(drawn <= limit)
        parents, paths = paths[at], _mixed(drawn[at, token] ^ _MIX)
        out.append((parents.view(np.int64), paths.view(np.int64)))
    return out


def prepare(docs: DataFrame, runs: int, levels: int, similarity: float) -> DataFrame:
    """(row struct, tk, key, n, sketch, parents, paths) of ``docs`` (row, tk, text); without words key is null."""
    arrays = ", ".join(f"up{k} array<bigint>, path{k} array<bigint>" for k in range(1, levels + 1))
    row = docs.schema["row"].dataType.simpleString()
    schema = f"row {row}, tk bigint, key binary, n int, sketch binary, {arrays}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            keys, sizes, sketches = [], [], []
            tree: list[list] = [[] for _ in range(2 * levels)]
            for text in batch.column("text").to_pylist():
                shingles = shingler(text)
                sizes.append(len(shingles))
                if not len(shingles):
                    keys.append(None)
                    sketches.append(None)
                    for x in tree:
                        x.append([])
                    continue
                keys.append(set_key(shingles))
                sketches.append(shingles[:SKETCH].astype("<u4").tobytes())
                for k, (up, path) in enumerate(chosen_paths(shingles, runs, levels, similarity)):
                    tree[2 * k].append(up)
                    tree[2 * k + 1].append(path)
            names = ["row", "tk", "key", "n", "sketch"] + [x for k in range(1, levels + 1) for x in (f"up{k}", f"path{k}")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("tk"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()),
                 pa.array(sketches, pa.binary()), *[pa.array(x, pa.list_(pa.int64())) for x in tree]], names=names)

    return docs.mapInArrow(run, schema)


def _sketch_matrix(column: pa.ChunkedArray) -> tuple[list[np.ndarray], np.ndarray]:
    parts = [np.frombuffer(x, "<u4") for x in column.to_pylist()]
    return parts, np.array([len(p) for p in parts])


def overlap_matrix(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all intersections, from entries that two sets or more have."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    fresh = np.concatenate([[True], flat[1:] != flat[:-1]]) if len(flat) else np.zeros(0, dtype=bool)
    number = np.cumsum(fresh) - 1
    shared = np.bincount(number)[number] > 1 if len(flat) else fresh
    owner, number = owner[shared], number[shared]
    number = np.unique(number, return_inverse=True)[1]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for start in range(0, int(number.max(initial=-1)) + 1, width):
        a, b = np.searchsorted(number, [start, start + width])
        has = np.zeros((len(sets), width), dtype=np.float32)
        has[owner[a:b], number[a:b] - start] = 1
        out += has @ has.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def _bucket_links(similarity: float):
    """Work on buckets: a star of edges for every set of classes whose sketches agree."""
    def small(table: pa.Table, starts: np.ndarray, sizes: np.ndarray, n: np.ndarray, sketches, counts):
        """All pairs of all small buckets of the table, in slices."""
        left = np.concatenate([s + np.repeat(np.arange(k), np.arange(k)[::-1]) for s, k in zip(starts, sizes, strict=True)] or [np.zeros(0, int)])
        right = np.concatenate([s + np.concatenate([np.arange(i + 1, k) for i in range(k)]) if k > 1 else np.zeros(0, int)
                                for s, k in zip(starts, sizes, strict=True)] or [np.zeros(0, int)])
        left, right = left.astype(np.int64), right.astype(np.int64)
        near = np.minimum(n[left], n[right]) >= similarity * np.maximum(n[left], n[right]) - 1e-9
        left, right = left[near], right[near]
        used = np.unique(np.concatenate([left, right]))
        place = np.zeros(table.num_rows, dtype=np.int64)
        place[used] = np.arange(len(used))
        padded = np.full((len(used), SKETCH), 0, dtype=np.uint64)
        filler = np.uint64(2**32) + np.arange(SKETCH, dtype=np.uint64) * np.uint64(2)
        for k, u in enumerate(used.tolist()):
            padded[k] = filler
            padded[k, :counts[u]] = sketches[u]
        keep = np.zeros(len(left), dtype=bool)
        for s in range(0, len(left), 20_000):
            a, b = padded[place[left[s:s + 20_000]]], padded[place[right[s:s + 20_000]]].copy()
            b[b >= np.uint64(2**32)] += np.uint64(1)
            both = np.sort(np.concatenate([a, b], axis=1), axis=1)
            shared = (both[:, 1:] == both[:, :-1]).sum(1)
            most = np.minimum(SKETCH, np.maximum(n[left[s:s + 20_000]], n[right[s:s + 20_000]]))
            keep[s:s + 20_000] = shared >= LEAST_SHARED * most
        return left[keep], right[keep]

    def work(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = table.column("n").to_numpy()
        keys = table.column("key").to_pylist()
        sketches, counts = _sketch_matrix(table.column("sketch"))
        sizes = np.diff(np.append(starts, table.num_rows))
        few = sizes <= BUCKET
        left, right = small(table, starts[few], sizes[few], n, sketches, counts)
        lefts, rights = [left], [right]
        for s, k in zip(starts[~few].tolist(), sizes[~few].tolist(), strict=True):
            shared = overlap_matrix(sketches[s:s + k])
            m = n[s:s + k]
            most = np.minimum(SKETCH, np.maximum(m[:, None], m[None, :]))
            linked = (shared >= LEAST_SHARED * most) & (np.minimum(m[:, None], m[None, :]) >= similarity * np.maximum(m[:, None], m[None, :]) - 1e-9)
            root = local_roots(linked)
            moved = np.flatnonzero(root != np.arange(k))
            lefts.append(s + root[moved])
            rights.append(s + moved)
        left, right = np.concatenate(lefts), np.concatenate(rights)
        root = roots_of_pairs(table.num_rows, left, right)
        moved = np.flatnonzero(root != np.arange(table.num_rows)).tolist()
        edges = {(keys[root[i]], keys[i]) for i in moved}
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in edges], pa.binary()), pa.array([b for _, b in edges], pa.binary())],
                                         names=["a", "b"])

    return work


def candidate_edges(classes: DataFrame, starts: np.ndarray, levels: int, similarity: float,
                    known: DataFrame | None = None) -> DataFrame:
    """(a, b) between class keys: stars over the classes whose sketches agree in some bucket.

    ``starts`` are the runs to look at.  With ``known`` (id, root), buckets of
    classes that all have one root are left out.
    """
    chosen = [int(x) for x in starts.view(np.int64)]
    step = F.filter(F.arrays_zip(F.col("up1").alias("up"), F.col("path1").alias("path")), lambda x: x["up"].isin(chosen))
    rows = classes.select("key", step.alias("step"))
    if known is None:
        rows = rows.withColumn("root", F.col("key"))
    else:
        rows = rows.join(known.withColumnRenamed("id", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    active = rows.select("key", "root", F.explode("step").alias("x")).select("key", "root", "x.path")
    leaves = None
    for level in range(1, levels + 1):
        counts = (active.groupBy("path").agg(F.count("*").alias("size"), F.min("root").alias("low"), F.max("root").alias("high"))
                  .where("size > 1 and low <> high").select("path", "size"))
        sized = materialize(active.join(counts, "path"), f"paths{level}")
        part = sized if level == levels else sized.where(F.col("size") <= BUCKET)
        leaves = part if leaves is None else leaves.unionByName(part)
        large = sized.where(F.col("size") > BUCKET)
        if level == levels or large.isEmpty():
            break
        below = F.arrays_zip(F.col(f"up{level + 1}").alias("up"), F.col(f"path{level + 1}").alias("path"))
        active = (large.select("key", "root", F.col("path").alias("parent"))
                  .join(classes.select("key", below.alias("below")), "key")
                  .select("key", "root", F.explode(F.filter("below", lambda x: x["up"] == F.col("parent"))).alias("x"))
                  .select("key", "root", F.col("x.path").alias("path")))
    cut = in_block_pairs(leaves, "path", "key", "size", SKETCH_BLOCK)
    rows = cut.select("path", "i", "j", "key").join(classes.select("key", "n", "sketch"), "key")
    return map_groups(rows, ["path", "i", "j"], _bucket_links(similarity), "a binary, b binary")


def _verified(similarity: float):
    """Work on pairs of blocks of a component: links per class and a star of edges."""
    def work(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys = np.array(table.column("key").to_pylist(), dtype=object)
        copies, block = table.column("copies").to_numpy(), table.column("block").to_numpy()
        sets = [np.frombuffer(x, "<u8") for x in table.column("shingles").to_pylist()]
        n = np.array([len(s) for s in sets], dtype=np.float64)
        i, j = table.column("i").to_numpy(), table.column("j").to_numpy()
        links, root = np.zeros(len(keys), dtype=np.int64), np.arange(len(keys))
        for s, e in zip(starts.tolist(), np.append(starts[1:], len(keys)).tolist(), strict=True):
            shared = overlap_matrix(sets[s:e]).astype(np.float64)
            union = n[s:e, None] + n[None, s:e] - shared
            linked = shared >= similarity * union - 1e-9
            np.fill_diagonal(linked, False)
            if i[s] != j[s]:
                linked &= block[s:e, None] != block[None, s:e]
            links[s:e] = linked @ copies[s:e]
            root[s:e] = s + local_roots(linked)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.tolist(), pa.binary()), pa.array(links), pa.array(keys[root].tolist(), pa.binary())],
            names=["key", "links", "root"])

    return work


def jaccard_join(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, levels: int = LEVELS,
                 id_column: str = "doc_id", text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, tk, class_id, copies, n_links, component_id, kept, component) of every row of ``docs``.

    * ``class_id``: least id among rows with the same shingle set; ``copies`` of them.
    * ``n_links``: other rows at ``similarity`` or more, equal sets included.
    * ``component_id``: least id that links lead to; ``kept`` marks its rows.
    * ``component``: key of the component, also where ids repeat; null without shingles.
    * ``tk``: hash of the text, which with the id names the row.

    Null and empty texts, and texts without words, have no shingles: no links,
    a class and component of their own, and they are kept.  Null ids lose
    against any other.  Rows alike in id and text are copies of each other and
    all bear the same values.  An empty table gives an empty one; the ``keep``
    columns, whatever their names, travel in the struct ``row``.
    """
    runs = runs_for(recall, levels)
    keep = docs.columns if keep is None else keep
    row = F.struct(F.col(f"`{id_column}`").alias("id"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("all"))
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    texts = docs.select(row.alias("row"), F.xxhash64(text).alias("tk"), text.alias("text"))
    prepared = materialize(prepare(texts, runs, levels, similarity), "ngram-sets")
    tree = [x for k in range(1, levels + 1) for x in (f"up{k}", f"path{k}")]
    same = prepared.where("key is not null").groupBy("key").agg(
        F.min("row.id").alias("class_id"), F.count("*").alias("copies"), F.min("tk").alias("tk"),
        F.first(F.struct("n", "sketch", *tree)).alias("set"))
    classes = materialize(same.select("key", "class_id", "copies", "tk", "set.*"), "ngram-classes")
    # The sketches and paths of single rows are not needed any more.
    sets, prepared = prepared, materialize(prepared.select("row", "tk", "key"), "ngram-rows")
    forget(docs.sparkSession, sets)

    starts = run_starts(runs)
    near = materialize(components(candidate_edges(classes, starts[:FIRST_RUNS], levels, similarity), "ngram-near"), "ngram-near")
    if runs > FIRST_RUNS:
        more = candidate_edges(classes, starts[FIRST_RUNS:], levels, similarity, near)
        stars = near.select(F.col("id").alias("a"), F.col("root").alias("b"))
        near = materialize(components(stars.unionByName(more), "ngram-near"), "ngram-near")
        del stars, more
    paths, classes = classes, materialize(classes.select("key", "class_id", "copies", "tk"), "ngram-named")
    forget(docs.sparkSession, paths)
    sizes = near.groupBy("root").agg(F.count("*").alias("size"))
    nodes = (near.withColumnRenamed("id", "key").join(sizes, "root")
             .join(classes.select("key", "tk", "copies"), "key"))
    found = texts.select("tk", "text").join(nodes, "tk")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            shingles = [shingler(t) for t in batch.column("text").to_pylist()]
            match = np.array([set_key(s) == k for s, k in zip(shingles, batch.column("key").to_pylist(), strict=True)], dtype=bool)
            kept_rows = pa.array(match)
            columns = [batch.column(c).filter(kept_rows) for c in ("key", "root", "size", "copies")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([s.astype("<u8").tobytes() for s, m in zip(shingles, match, strict=True) if m], pa.binary())],
                names=["key", "root", "size", "copies", "shingles"])

    whole = (found.mapInArrow(sets, "key binary, root binary, size bigint, copies bigint, shingles binary")
             .groupBy("key").agg(*[F.first(c).alias(c) for c in ("root", "size", "copies", "shingles")]))
    cut = in_block_pairs(whole, "root", "key", "size", BLOCK).withColumnRenamed("root", "near")
    linked = materialize(map_groups(cut, ["near", "i", "j"], _verified(similarity), "key binary, links bigint, root binary"),
                         "ngram-links")
    together = components(linked.select(F.col("root").alias("a"), F.col("key").alias("b")), "ngram-components")
    named = together.withColumnRenamed("id", "key").join(classes.select("key", "class_id"), "key")
    least = named.groupBy("root").agg(F.min("class_id").alias("component_id"), F.min("key").alias("first"))
    member = named.join(least, "root").select("key", "component_id", "first")
    counted = linked.groupBy("key").agg(F.sum("links").alias("links"))
    of_class = materialize(
        classes.select("key", "class_id", "copies").join(counted, "key", "left").join(member, "key", "left").select(
            "key", "class_id", "copies", F.coalesce("links", F.lit(0)).alias("links"),
            F.coalesce("component_id", "class_id").alias("component_id"), F.coalesce("first", "key").alias("component"),
            # Without any id in the component the class of least key stands for it.
            F.when(F.col("component_id").isNull(), F.coalesce(F.col("first") == F.col("key"), F.lit(True)))
            .otherwise(F.col("class_id") == F.col("component_id")).alias("chosen")), "ngram-result")
    own = F.col("row.id")
    joined = prepared.select("row", "tk", "key").join(of_class, "key", "left")
    empty = F.col("key").isNull()
    return joined.select(
        F.col("row.all").alias("row"), "tk", F.when(empty, own).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("copies", F.lit(1)).cast("bigint").alias("copies"),
        F.when(empty, F.lit(0)).otherwise(F.col("copies") - 1 + F.col("links")).cast("bigint").alias("n_links"),
        F.when(empty, own).otherwise(F.col("component_id")).alias("component_id"),
        F.when(empty, F.lit(True)).otherwise(F.col("chosen") & own.eqNullSafe(F.col("class_id"))).alias("kept"),
        "component")


def one_per_group(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each linked group, the one of least id, and all rows without words.

    Null and empty texts stay, rows alike in id and text are one, and texts of
    any length are compared whole.  An empty table gives an empty one.
    """
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tk"))
    marked = jaccard_join(docs, similarity, keep=["doc_id"])
    kept = marked.where("kept").groupBy(F.col("row.doc_id").alias("_id"), "tk").agg(F.lit(1).alias("_one"))
    stay = rows.join(kept, rows["row.doc_id"].eqNullSafe(kept["_id"]) & (rows["tk"] == kept["tk"]), "left_semi")
    # Rows alike in id and text are one document.
    once = stay.groupBy(F.col("row.doc_id").alias("_id"), "tk").agg(F.first("row").alias("row"))
    return once.select("row.*")
