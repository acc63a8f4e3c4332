"""Similarity joins on character n-gram counts, without comparing all pairs.

A text becomes a sorted list of gram codes, rare grams first, with counts.
For a cosine threshold t only the leading grams matter: once the grams left
over carry less than t of a vector's length, a pair whose first common gram
lies there cannot reach t.  Both sides are therefore joined on leading grams
only, a pair is kept at its first common gram (so it appears once and needs
no de-duplication), and its exact cosine is computed there.

A search for the best match, and folds over similar pairs that need no list of
them, compare blocks of texts by products of count matrices instead, since short
texts of one group nearly all share a leading gram.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType

from lotwise.functions.text import ascii_words
from lotwise.operators.blocks import map_groups
from lotwise.operators.relational import best_row
from lotwise.session import join_lookup, materialize, materialize_counted

BLOCK = 512                # texts of one block of a best-match search
SLACK = 1e-9


def grams(text: Column, low: int = 2, high: int = 3) -> Column:
    """All character n-grams of the text, runs of white space taken as one space."""
    squeezed = F.regexp_replace(text, r"\s+", " ")

    def of_length(s: Column, n: int) -> Column:
        starts = F.when(F.length(s) >= n, F.sequence(F.lit(1), F.length(s) - (n - 1)))
        return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.substring(s, i, F.lit(n)))

    # the outer lambda binds the squeezed text: it is worked out once, not once per gram
    return F.transform(F.array(squeezed), lambda s: F.concat(*[of_length(s, n) for n in range(low, high + 1)]))[0]


def vocabulary(texts: DataFrame, low: int = 2, high: int = 3) -> DataFrame:
    """Grams of distinct texts with a code that rises with how many texts hold them.

    Cleaned text has 37 letters, so 2-3-grams are at most 52,022 rows: the
    numbering window and any broadcast of this table have that fixed bound.
    """
    seen = (texts.select("text").distinct()
            .select(F.explode(F.array_distinct(grams(F.col("text"), low, high))).alias("gram"))
            .groupBy("gram").agg(F.count("*").alias("texts")))
    return seen.select("gram", F.row_number().over(Window.orderBy("texts", "gram")).alias("code"))


def profiles(texts: DataFrame, codes: DataFrame, low: int = 2, high: int = 3) -> DataFrame:
    """Distinct texts with their sorted codes, counts and squared length; grams without a code are ignored."""
    apart = texts.select("text").distinct().repartition("text")
    counts = (apart.select("text", F.explode(grams(F.col("text"), low, high)).alias("gram"))
              .groupBy("text", "gram").agg(F.count("*").cast("int").alias("tf"))
              .join(F.broadcast(codes), "gram"))
    packed = counts.groupBy("text").agg(F.array_sort(F.collect_list(F.struct("code", "tf"))).alias("g"),
                                        F.sum(F.col("tf") * F.col("tf")).alias("nsq"))
    return packed.select("text", F.col("g.code").alias("codes"), F.col("g.tf").alias("tfs"), "nsq")


def leading(codes: Column, tfs: Column, nsq: Column, threshold: float) -> Column:
    """Codes up to where the rest carries less than ``threshold`` of the length."""
    limit = F.lit(threshold * threshold - SLACK) * nsq
    start = F.struct(F.lit(0).alias("kept"), nsq.cast("double").alias("rest"))
    end = F.aggregate(tfs, start, lambda acc, x: F.when(
        acc["rest"] >= limit, F.struct((acc["kept"] + 1).alias("kept"), (acc["rest"] - x * x).alias("rest"))).otherwise(acc))
    return F.slice(codes, F.lit(1), end["kept"])


@F.arrow_udf(DoubleType())
def sparse_dot(codes_a: pa.Array, tfs_a: pa.Array, codes_b: pa.Array, tfs_b: pa.Array) -> pa.Array:
    """Dot products of sorted sparse count vectors, one row per pair."""
    def flat(codes, tfs):
        sizes = np.diff(codes.offsets.to_numpy())
        rows = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
        return rows, (rows << 32) | codes.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy().astype(np.int64)

    rows_a, keys_a, values_a = flat(codes_a, tfs_a)
    _, keys_b, values_b = flat(codes_b, tfs_b)
    if len(keys_b) == 0 or len(keys_a) == 0:
        return pa.array(np.zeros(len(codes_a)))
    at = np.minimum(np.searchsorted(keys_b, keys_a), len(keys_b) - 1)
    both = keys_b[at] == keys_a
    return pa.array(np.bincount(rows_a[both], weights=values_a[both] * values_b[at[both]], minlength=len(codes_a)))


def similar_pairs(left: DataFrame, right: DataFrame, keys: list[str], threshold: float,
                  self_join: bool = False) -> DataFrame:
    """Pairs of the same keys whose cosine reaches ``threshold``: (keys, a, b, score).

    ``left`` and ``right`` hold keys, text and profile columns.  With
    ``self_join`` each unordered pair of different texts appears once.
    """
    def side(df, name):
        # each leading code comes with the rarer codes before it
        lead = leading(F.col("codes"), F.col("tfs"), F.col("nsq"), threshold)
        return (df.select(*keys, "text", "codes", "tfs", "nsq", F.posexplode(lead).alias("place", "code"))
                .select(*keys, "code", F.struct("text", "codes", "tfs", "nsq",
                                                F.slice("codes", F.lit(1), F.col("place")).alias("before")).alias(name)))

    joined = side(left, "l").join(side(right, "r"), keys + ["code"])
    if self_join:
        joined = joined.where(F.col("l.text") < F.col("r.text"))
    joined = joined.where(~F.arrays_overlap("l.before", "r.before"))       # no earlier gram in common
    dot = sparse_dot("l.codes", "l.tfs", "r.codes", "r.tfs")
    scored = joined.select(*keys, F.col("l.text").alias("a"), F.col("r.text").alias("b"),
                           dot.alias("dot"), (F.col("l.nsq") * F.col("r.nsq")).alias("size"))
    return (scored.select(*keys, "a", "b", (F.col("dot") / F.sqrt("size")).alias("score"))
            .where(F.col("score") >= threshold))


def _dense(codes: pa.ListArray, tfs: pa.ListArray) -> np.ndarray:
    """Count vectors over the codes that occur, one row per entry."""
    rows = np.repeat(np.arange(len(codes)), np.diff(codes.offsets.to_numpy()))
    _, place = np.unique(codes.flatten().to_numpy(), return_inverse=True)
    out = np.zeros((len(codes), int(place.max(initial=-1)) + 1), dtype=np.float32)
    out[rows, place] = tfs.flatten().to_numpy()
    return out


def _block_rows(left: DataFrame, right: DataFrame, keys: list[str], extra: list[str], block: int = BLOCK) -> DataFrame:
    """Both sides cut into blocks of about ``block`` texts per key, one copy of a text for every block it meets.

    Columns of ``extra`` that a side lacks are null there.
    """
    def blocks(df, column):
        return df.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias(column))

    sizes, n = materialize_counted(blocks(left, "_nl").join(blocks(right, "_nr"), keys), "blocks")
    kinds = dict(left.dtypes) | dict(right.dtypes)

    def side(df, number, own, other, own_size, other_size):
        cut = join_lookup(df, sizes, keys, n, "inner").withColumn(own, F.pmod(F.xxhash64("text"), F.col(own_size)).cast("int"))
        cut = cut.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_size) - 1)))
        more = [F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in extra]
        return cut.select(*keys, "_i", "_j", F.lit(number).alias("_side"), "text", "codes", "tfs", F.col("nsq").cast("bigint").alias("nsq"), *more)

    return side(left, 0, "_i", "_j", "_nl", "_nr").unionByName(side(right, 1, "_j", "_i", "_nr", "_nl"))


def _block_scores(table: pa.Table, starts: np.ndarray):
    """(first left row, first right row, end, cosines) of every pair of blocks with texts on both sides."""
    which, length = table.column("_side").to_numpy(), table.column("nsq").to_numpy().astype(np.float64)
    codes, tfs = (table.column(c).combine_chunks() for c in ("codes", "tfs"))
    for s, e in zip(starts.tolist(), np.append(starts[1:], table.num_rows).tolist()):
        m = s + int(np.searchsorted(which[s:e], 1))
        if s == m or m == e:
            continue
        counts = _dense(codes.slice(s, e - s), tfs.slice(s, e - s))
        size = np.sqrt(length[s:m, None] * length[None, m:e])
        yield s, m, e, (counts[:m - s] @ counts[m - s:].T).astype(np.float64) / np.where(size > 0, size, 1.0)


def best_matches(left: DataFrame, right: DataFrame, keys: list[str], threshold: float,
                 order: list[str] | None = None, name: str = "name") -> DataFrame:
    """For each left text the right row of highest cosine, if it reaches ``threshold``.

    ``right`` also holds ``name`` and the tie-break columns ``order`` (rising);
    equal scores go to the least of those, then to the least name.  Both sides
    are cut into blocks of ``BLOCK`` texts per key; a task compares a left block
    with a right one by one product of count matrices and gives the best right
    row of each left text.  So rows grow with texts times blocks, never with
    pairs, and a key that holds much of a side is spread over its blocks.
    """
    order = order or []
    # one row per right text: the one that wins its ties
    names = best_row(right, keys + ["text"], [F.col(o) for o in order] + [F.col(name)], order + [name])
    vectors = right.select(*keys, "text", "codes", "tfs", "nsq").dropDuplicates(keys + ["text"]).join(names, keys + ["text"])
    given = order + [name]
    rows = _block_rows(left.select(*keys, "text", "codes", "tfs", "nsq"), vectors, keys, given)
    kinds = dict(rows.dtypes)

    def work(table: pa.Table, starts: np.ndarray):
        length = table.column("nsq").to_numpy()
        lefts, rights, scores = [], [], []
        for s, m, _, score in _block_scores(table, starts):
            best = score.argmax(axis=1)         # right rows come in the order that decides ties
            reached = score[np.arange(m - s), best]
            ok = np.flatnonzero((reached >= threshold) & (length[s:m] > 0))
            lefts.append(s + ok)
            rights.append(m + best[ok])
            scores.append(reached[ok])
        lefts, rights = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (lefts, rights))
        score = np.concatenate(scores) if scores else np.zeros(0)
        columns = [table.column(c).take(lefts) for c in keys + ["text"]] + [pa.array(score)] + [table.column(c).take(rights) for c in given]
        yield from pa.table(columns, names=keys + ["text", "score"] + given).combine_chunks().to_batches()

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keys + ["text"]) + ", score double, " + ", ".join(f"`{c}` {kinds[c]}" for c in given)
    best = map_groups(rows, keys + ["_i", "_j"], work, schema, ["_side", *given])
    return materialize(best_row(best, keys + ["text"], [-F.col("score")] + [F.col(o) for o in order] + [F.col(name)], [name, "score"]), "matches", wide=True)


# ------------------------------------------------------------------ folds over similar pairs
def _over_blocks(left: DataFrame, right: DataFrame, keys: list[str], threshold: float, value: str,
                 fold, kinds: str, names: list[str], block: int) -> DataFrame:
    """``fold(table, s, m, hits)`` -> columns ``names`` of every pair of blocks, after its keys; right rows rise by ``value``."""
    rows = _block_rows(left, right, keys, [value], block)
    types = dict(rows.dtypes)

    def work(table: pa.Table, starts: np.ndarray):
        for s, m, _, score in _block_scores(table, starts):
            found = fold(table, s, m, score >= threshold)
            if len(found[0]):
                columns = [pa.array([table.column(k)[s].as_py()] * len(found[0]), table.schema.field(k).type) for k in keys]
                yield from pa.table(columns + found, names=keys + names).combine_chunks().to_batches()

    return map_groups(rows, keys + ["_i", "_j"], work, ", ".join(f"`{k}` {types[k]}" for k in keys) + f", {kinds}", ["_side", value])


def similar_weight(left: DataFrame, right: DataFrame, keys: list[str], threshold: float, block: int = 2 * BLOCK) -> DataFrame:
    """(keys, text, total): the ``weight`` of all right texts whose cosine reaches ``threshold``, the text itself included.

    A pair of blocks yields one row per left text, so rows never grow with pairs.
    """
    def fold(table, s, m, hits):
        weight = table.column("weight").to_numpy(zero_copy_only=False)[m:m + hits.shape[1]].astype(np.int64)
        met = np.flatnonzero(hits.any(axis=1))
        total = np.array([weight[row].sum() for row in hits[met]], dtype=np.int64)
        return [table.column("text").take(s + met), pa.array(total)]

    parts = _over_blocks(left.select(*keys, "text", "codes", "tfs", "nsq"), right.select(*keys, "text", "codes", "tfs", "nsq", F.col("weight").cast("bigint").alias("weight")),
                         keys, threshold, "weight", fold, "text string, total bigint", ["text", "total"], block)
    return parts.groupBy(*keys, "text").agg(F.sum("total").alias("total"))


def similar_least(left: DataFrame, right: DataFrame, keys: list[str], threshold: float, value: str, block: int = 2 * BLOCK) -> DataFrame:
    """(keys, text, value): the least ``value`` of the right texts whose cosine reaches ``threshold``, where there is one."""
    def fold(table, s, m, hits):
        met = np.flatnonzero(hits.any(axis=1))
        return [table.column("text").take(s + met), table.column(value).take(m + hits[met].argmax(axis=1))]

    parts = _over_blocks(left.select(*keys, "text", "codes", "tfs", "nsq"), right.select(*keys, "text", "codes", "tfs", "nsq", value),
                         keys, threshold, value, fold, f"text string, `{value}` string", ["text", value], block)
    return parts.groupBy(*keys, "text").agg(F.min(value).alias(value))


def similar_links(left: DataFrame, right: DataFrame, keys: list[str], threshold: float, block: int = 2 * BLOCK) -> DataFrame:
    """(keys, a, b): links between the ``node`` of texts whose cosine reaches ``threshold``.

    They join exactly the nodes that all such pairs join, but a pair of blocks
    yields a star per set of nodes that hang together, not every pair.
    """
    def fold(table, s, m, hits):
        ends = table.column("node").slice(s, hits.shape[0] + hits.shape[1]).combine_chunks().dictionary_encode()
        place = ends.indices.to_numpy().astype(np.int64)
        a, b = np.nonzero(hits)
        root = _least_reachable(place[a], place[b + (m - s)], len(ends.dictionary))
        moved = np.flatnonzero(root != np.arange(len(root)))
        return [ends.dictionary.take(pa.array(moved)), ends.dictionary.take(pa.array(root[moved]))]

    found = _over_blocks(left.select(*keys, "text", "codes", "tfs", "nsq", "node"), right.select(*keys, "text", "codes", "tfs", "nsq", "node"),
                         keys, threshold, "node", fold, "a string, b string", ["a", "b"], block)
    return found.distinct()


def _least_reachable(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least number each of 0 .. n - 1 reaches over the links a - b."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        lower = root.copy()
        np.minimum.at(lower, root[a], least)
        np.minimum.at(lower, root[b], least)
        lower = lower[lower]
        if (lower == root).all():
            return root
        root = lower


# ------------------------------------------------------------------ catalogue match
def match_catalogue(versions: DataFrame, catalogue: DataFrame, keys: list[str], version: str,
                    threshold: float, codes: DataFrame, quantity: str | None = None,
                    clean=ascii_words) -> DataFrame:
    """Distinct versions with the catalogue name of highest similarity (null below the threshold).

    ``catalogue`` has the same keys, the column ``name`` and maybe a quantity;
    equal scores go to the larger quantity, then to the smaller name.
    """
    left = versions.select(*keys, version, clean(F.col(version)).alias("text"))
    amount = F.lit(0) if quantity is None else -F.coalesce(F.col(quantity), F.lit(0))
    right = (catalogue.where("name is not null")
             .select(*keys, "name", amount.alias("_order"), clean(F.col("name")).alias("text")))
    known = materialize(profiles(left.select("text").unionByName(right.select("text")), codes), "profiles", wide=True)
    found = best_matches(left.select(*keys, "text").distinct().join(known, "text"),
                         right.join(known, "text"), keys, threshold, ["_order"])
    return left.join(found, keys + ["text"], "left").select(*keys, version, "text", "name", "score")


# ------------------------------------------------------------------ vectors
def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                      lambda acc, x: acc + x)
    return dot / (norm(a) * norm(b))


def vector_summary(df: DataFrame, vector: str) -> DataFrame:
    return df.withColumns({"lowest": F.array_min(vector).cast("double"),
                           "highest": F.array_max(vector).cast("double"), "length": norm(F.col(vector))})
