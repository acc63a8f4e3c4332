"""Merkle manifest of a dataset by ranks in bitmaps.

The ids of every group of rows are a bitmap in chunks of 2**15 ids.  Partial bitmaps
merge by aggregation, and a directory of popcounts over the chunks, in steps of
1024, says how many rows lie before each chunk.  The rank of a row, its leaf's
coordinate, is what the directory says and a popcount inside the chunk, so rows
are never sorted.  Leaves then go to slot arrays keyed by group and rank / 1024; a
slot array is reduced to one node, ten levels at a time.  The siblings on the way to
the root come down the same arrays, and every leaf is folded along them again.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise.operators.blocks import map_groups
from lotwise.session import join_lookup, materialize

CHUNK = 15              # ids of one bitmap, as a power of two: what bitmap_construct_agg holds
STEP = 10               # chunks under one entry of the directory, and slots of an array, as a power of two
CROWD = 1 << 17         # rows of one chunk that go to one task; more are possible only if ids repeat
#: The chunk of rows without an id lies before all others.
NO_ID = -(1 << 48) - 1

# A path is a string of steps from a node to the root; a step is a byte, and a sibling's digest if there is one.
ALONE, RIGHT, LEFT = 0, 1, 2


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: list[Column]) -> Column:
    """32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256))


def before_in_chunk(bits: Column, place: Column) -> Column:
    """Bits set below ``place``: whole bytes by a popcount, and what is left of the next one."""
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
    mask = F.pow(F.lit(2), place.bitwiseAND(F.lit(7))).cast("bigint") - 1
    return F.bitmap_count(F.substring(bits, F.lit(1), F.shiftright(place, 3).cast("int"))) + F.bit_count(byte.bitwiseAND(mask))


def directory(sized: DataFrame) -> DataFrame:
    """(g, c, before): the rows of the group's chunks before chunk ``c``, for ``sized`` (g, c, rows).

    Sums go up in steps of 1024 chunks and come down again, so that no window holds more.
    """
    levels = [sized.select("g", "c", "rows")]
    while not levels[-1].groupBy("g").count().where(F.col("count") > (1 << STEP)).isEmpty():
        levels.append(materialize(levels[-1].groupBy("g", F.shiftright("c", STEP).alias("c")).agg(F.sum("rows").alias("rows")), "merkle-sums"))
    order = Window.orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("rows").over(order.partitionBy("g")), F.lit(0))
    known = levels.pop().select("g", "c", earlier.alias("before"))
    while levels:
        inside = F.coalesce(F.sum("rows").over(order.partitionBy("g", "up")), F.lit(0))
        below = levels.pop().withColumn("up", F.shiftright("c", STEP)).withColumn("inside", inside)
        known = materialize(below.join(known.withColumnsRenamed({"c": "up"}), ["g", "up"])
                            .select("g", "c", (F.col("before") + F.col("inside")).alias("before")), "merkle-directory")
    return known


def _repeated(leaves: DataFrame, crowded: DataFrame) -> DataFrame:
    """Distinct rows of the chunks in which ids repeat: how many, and the rows before them that no bitmap shows."""
    keys = ["g", "c", "p", "id", "leaf", "forged"]
    one = materialize(leaves.join(crowded, ["g", "c"], "left_semi").groupBy(*keys).agg(F.count("*").alias("copies")), "merkle-repeats")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    ids = one.groupBy("g", "c", "p").agg((F.sum("copies") - 1).alias("more"))
    ids = ids.select("g", "c", "p", F.coalesce(F.sum("more").over(before.partitionBy("g", "c").orderBy("p")), F.lit(0)).alias("others"))
    # Rows of one id are in order of their leaves: sums over the first two bytes, then inside them.
    head = F.hex(F.substring("leaf", 1, 2))
    heads = one.groupBy("g", "c", "p", head.alias("head")).agg(F.sum("copies").alias("n"))
    heads = heads.select("g", "c", "p", "head", F.coalesce(F.sum("n").over(before.partitionBy("g", "c", "p").orderBy("head")), F.lit(0)).alias("lower"))
    inside = F.coalesce(F.sum("copies").over(before.partitionBy("g", "c", "p", "head").orderBy("leaf")), F.lit(0))
    placed = one.withColumn("head", head).withColumn("inside", inside)
    ids = ids.join(heads, ["g", "c", "p"]).select("g", "c", "p", "head", (F.col("others") + F.col("lower")).alias("shift"))
    return placed.join(ids, ["g", "c", "p", "head"]).select(*keys, "copies", (F.col("shift") + F.col("inside")).alias("shift"))


def ranked(leaves: DataFrame) -> DataFrame:
    """(g, n, place, id, leaf, forged) of ``leaves`` (g, c, p, id, leaf, forged): rank in the group of ``n`` rows."""
    bits = materialize(leaves.groupBy("g", "c").agg(F.bitmap_construct_agg("p").alias("bits"), F.count("*").alias("rows")), "merkle-bitmaps")
    sized = bits.select("g", "c", "rows")
    totals = sized.groupBy("g").agg(F.sum("rows").alias("n"))
    index = bits.join(directory(sized), ["g", "c"]).join(totals, "g").drop("rows")
    # Where every id stands once, the bitmap says all.  In other chunks rows stand before a row that no bit shows.
    crowded = bits.where(F.col("rows") > F.bitmap_count("bits")).select("g", "c")
    plain = {"copies": F.lit(1).cast("bigint"), "shift": F.lit(0).cast("bigint")}
    if crowded.isEmpty():
        every = leaves.withColumns(plain)
    else:
        once = leaves.join(crowded, ["g", "c"], "left_anti").withColumns(plain)
        every = once.unionByName(_repeated(leaves, crowded))
    # A chunk may have many different rows of one id: such chunks are dealt to several tasks.
    parts = sized.where(F.col("rows") > CROWD).select("g", "c", F.ceil(F.col("rows") / CROWD).alias("parts"))
    if parts.isEmpty():
        found = every.join(index, ["g", "c"])
    else:
        every = join_lookup(every, parts, ["g", "c"]).withColumn("part", F.pmod(F.xxhash64("leaf"), F.coalesce("parts", F.lit(1)))).drop("parts")
        index = index.join(parts, ["g", "c"], "left").withColumn(
            "part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
        found = every.join(index, ["g", "c", "part"])
    rank = F.col("before") + before_in_chunk(F.col("bits"), F.col("p")) + F.col("shift")
    placed = found.select("g", "n", rank.alias("rank"), "id", "leaf", "forged", "copies")
    return placed.select("g", "n", F.explode(F.sequence("rank", F.col("rank") + F.col("copies") - 1)).alias("place"), "id", "leaf", "forged")


# ------------------------------------------------------------------ slot arrays
def joined_digest(nodes: list[bytes]) -> bytes:
    return sha256("".join(x.hex() for x in nodes).encode()).digest()


def climb(nodes: list[bytes], total: int) -> list[list[bytes]]:
    """All levels above ``nodes``, one slot array of a level of ``total`` nodes, up to its top."""
    levels = [nodes]
    while total > 1 and len(levels) <= STEP:
        now = levels[-1]
        levels.append([joined_digest(now[i:i + 2]) for i in range(0, len(now), 2)])
        total = (total + 1) // 2
    return levels


def path_in(levels: list[list[bytes]], slot: int) -> bytes:
    """Steps from a slot to the top of its array."""
    steps = []
    for nodes in levels[:-1]:
        other = slot ^ 1
        steps.append(bytes([ALONE]) if other >= len(nodes) else bytes([RIGHT if other > slot else LEFT]) + nodes[other])
        slot >>= 1
    return b"".join(steps)


def siblings(path: bytes) -> Iterator[tuple[int, bytes]]:
    at = 0
    while at < len(path):
        if path[at] == ALONE:
            yield ALONE, b""
            at += 1
        else:
            yield path[at], path[at + 1:at + 33]
            at += 33


def fold(node: bytes, path: bytes) -> bytes:
    """The root that a node and its path lead to."""
    for side, other in siblings(path):
        node = joined_digest([node] if side == ALONE else [node, other] if side == RIGHT else [other, node])
    return node


def proof_digest(path: bytes) -> str:
    return sha256("".join(other.hex() for _, other in siblings(path)).encode()).hexdigest()


def slot_arrays(nodes: DataFrame, name: str) -> DataFrame:
    """(g, n, block, nodes, carried, top) of ``nodes`` (g, n, place, node, carried): 1024 of them to a row."""
    carried = nodes.schema["carried"].dataType.simpleString()

    def work(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        node = table.column("node").to_pylist()
        total = table.column("n").to_numpy()[starts]
        ends = np.append(starts[1:], table.num_rows)
        tops = [climb(node[a:b], n)[-1][0] for a, b, n in zip(starts.tolist(), ends.tolist(), total.tolist(), strict=True)]
        of = pa.array(np.append(starts, table.num_rows).astype(np.int32))
        lists = [pa.ListArray.from_arrays(of, table.column(c).combine_chunks()) for c in ("node", "carried")]
        at = pa.array(starts)
        yield pa.RecordBatch.from_arrays(
            [table.column("g").combine_chunks().take(at), pa.array(total), table.column("block").combine_chunks().take(at), *lists, pa.array(tops, pa.binary())],
            names=["g", "n", "block", "nodes", "carried", "top"])

    rows = nodes.withColumn("block", F.shiftright("place", STEP)).select("g", "block", "place", "n", "node", "carried")
    return materialize(map_groups(rows, ["g", "block"], work,
                                  f"g string, n bigint, block bigint, nodes array<binary>, carried array<{carried}>, top binary",
                                  within=["place"]), name)


def tree(nodes: DataFrame) -> list[DataFrame]:
    """Slot arrays of all levels, ten levels of nodes apart, until every group has one top."""
    levels = [slot_arrays(nodes, "merkle-slots")]
    while not levels[-1].where(F.col("n") > (1 << STEP)).isEmpty():
        up = levels[-1].select("g", F.ceil(F.col("n") / (1 << STEP)).alias("n"), F.col("block").alias("place"),
                               F.col("top").alias("node"), F.lit(None).cast("int").alias("carried"))
        levels.append(slot_arrays(up, "merkle-slots"))
    return levels


def paths(level: DataFrame, above: DataFrame) -> DataFrame:
    """(g, place, node, carried, path, subroot) of every slot; ``above`` has (g, block, path, subroot) of the arrays' tops."""
    carried = level.schema["carried"].dataType.elementType.simpleString()
    rows = level.join(above, ["g", "block"]).select("g", "n", "block", "nodes", "carried", "path", "subroot")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):         # an array of 1024 slots at a time
                g, n, block, path, subroot = (batch.column(c)[k].as_py() for c in ("g", "n", "block", "path", "subroot"))
                nodes = batch.column("nodes")[k].as_py()
                levels, m = climb(nodes, n), len(nodes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g] * m, pa.string()), pa.array(np.arange(m) + (block << STEP)), pa.array(nodes, pa.binary()),
                     batch.column("carried")[k].values, pa.array([path_in(levels, s) + path for s in range(m)], pa.binary()),
                     pa.array([subroot] * m, pa.binary())],
                    names=["g", "place", "node", "carried", "path", "subroot"])

    return rows.mapInArrow(run, f"g string, place bigint, node binary, carried {carried}, path binary, subroot binary")


def unfold(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """Paths of the lowest level's slots; ``above`` has (g, path, subroot) of the groups' tops."""
    now = above.select("g", F.lit(0).cast("bigint").alias("block"), "path", "subroot")
    for level in reversed(levels[1:]):
        now = materialize(paths(level, now).select("g", F.col("place").alias("block"), "path", "subroot"), "merkle-paths")
    return paths(levels[0], now)


def in_order(groups: DataFrame) -> DataFrame:
    """(g, n, place, node, carried) of ``groups`` (g, subroot): places by range sort, counted per range."""
    ranged = groups.repartitionByRange("g").sortWithinPartitions("g").withColumn("m", F.monotonically_increasing_id())
    marked = materialize(ranged, "merkle-groups")
    part = F.shiftright("m", 33)
    sizes = dict(marked.groupBy(part.alias("part")).count().collect())          # one row per range
    starts, total = {}, 0
    for k in sorted(sizes):
        starts[k], total = total, total + sizes[k]
    start = F.create_map(*[x for k, v in starts.items() for x in (F.lit(k).cast("bigint"), F.lit(v).cast("bigint"))])
    return marked.select(F.lit("").alias("g"), F.lit(total).cast("bigint").alias("n"),
                         (start[part] + F.col("m").bitwiseAND(F.lit((1 << 33) - 1))).alias("place"),
                         F.col("subroot").alias("node"), F.col("g").alias("carried"))


RESULT = ("leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def manifest(docs: DataFrame, columns: list[str], tampered: dict[str, Column] | None = None, where: Column | None = None,
             id_column: str = "doc_id", group_column: str = "lang") -> DataFrame:
    """(id, group, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of ``docs``.

    A leaf is the digest of ``columns``; leaves of a group ascend by id, and every
    two nodes become one until one is left.  Groups ascend by their bytes, the null
    group first.  ``folded_root`` comes from the leaf and its siblings; where
    ``where`` holds the columns ``tampered`` replace their own in the leaf that is folded.

    * Null ids come first; rows of one id are in order of their leaves, and rows
      alike in all ``columns`` are interchangeable.  A null value differs from every text.
    * An empty text is a value of no bytes.  A text of any length is read once,
      where it is hashed; no later step holds it.
    * An empty table gives an empty one.  Columns outside ``columns`` do not travel.
    * The id is an integer of 64 bits; id and group are among ``columns``.
    """
    spark = docs.sparkSession
    if not {id_column, group_column} <= set(columns):
        raise ValueError("the id and the group are part of a leaf")
    own = [F.col(f"`{c}`") for c in columns]
    changed = [(tampered or {}).get(c, F.col(f"`{c}`")) for c in columns]
    forged = F.when(F.coalesce(where, F.lit(False)), leaf_digest(changed)) if tampered and where is not None else F.lit(None).cast("binary")
    ident = F.col(f"`{id_column}`").cast("bigint")
    leaves = materialize(docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(f"`{group_column}`").cast("string")), F.lit("")).alias("g"),
        F.coalesce(F.shiftright(ident, CHUNK), F.lit(NO_ID)).alias("c"),
        F.coalesce(ident.bitwiseAND(F.lit((1 << CHUNK) - 1)), F.lit(0)).alias("p"),
        ident.alias("id"), leaf_digest(own).alias("leaf"), forged.alias("forged")), "merkle-leaves")
    about = {id_column: docs.schema[id_column].dataType, group_column: docs.schema[group_column].dataType}
    if leaves.isEmpty():
        return spark.createDataFrame([], f"`{id_column}` {about[id_column].simpleString()}, `{group_column}` {about[group_column].simpleString()}, {RESULT}")
    nodes = ranked(leaves).select("g", "n", "place", F.col("leaf").alias("node"), F.struct("id", "forged").alias("carried"))
    levels = tree(nodes)
    subroots = levels[-1].select("g", F.col("top").alias("subroot"))
    whole = tree(in_order(subroots))
    root = whole[-1].first()["top"]
    groups = unfold(whole, spark.createDataFrame([("", b"", root)], "g string, path binary, subroot binary"))
    above = materialize(groups.select(F.col("carried").alias("g"), "path", F.col("node").alias("subroot")), "merkle-tops")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, path, fake = (batch.column(c).to_pylist() for c in ("leaf", "path", "forged"))
            folded = [fold(node if other is None else other, p) for node, other, p in zip(leaf, fake, path, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("g"), batch.column("leaf"), batch.column("subroot"),
                 pa.array([proof_digest(p) for p in path]), pa.array(folded, pa.binary())],
                names=["id", "g", "leaf", "subroot", "proof_sha256", "folded"])

    out = unfold(levels, above).select("carried.id", "g", F.col("node").alias("leaf"), "carried.forged", "path", "subroot").mapInArrow(
        finish, "id bigint, g string, leaf binary, subroot binary, proof_sha256 string, folded binary")
    return out.select(
        F.col("id").cast(about[id_column]).alias(id_column),
        F.when(F.col("g") != "", F.substring("g", 2, 2**31 - 1)).cast(about[group_column]).alias(group_column),
        F.lower(F.hex("leaf")).alias("leaf"), F.lower(F.hex("subroot")).alias("subroot"), F.lit(root.hex()).alias("root"),
        "proof_sha256", F.lower(F.hex("folded")).alias("folded_root"), (F.col("folded") == F.lit(root)).alias("verified"))
