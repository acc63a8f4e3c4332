"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, the source's
rate ``target / size``.  The expected copies are summed up along the documents
of the source, one random offset per source is added, and a document is emitted
once for each whole number its interval crosses.

The documents of a source lie in order of size class, then of a hash of their
id.  Neighbours have like sizes, so the words taken differ from the target by
about one document at most.  The running sum comes in three levels (size class,
hash part, place in the part), so no task holds the rows of a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix"


def word_count(text: Column) -> Column:
    """Number of runs without white space; null counts as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target, rate, offset) of every source of ``sized`` (source, size).

    Sources in code point order, null last, take the weights in turn.  The
    targets share the sum of all sizes by weight; none goes beyond ``cap``
    times its source, and what is left over is shared again by weight.  With
    the sources in order of cap over weight, the capped ones come first, so
    running sums give the final share without rounds.  The windows have one
    row per source.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weighted = totals.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), place + 1).cast("bigint"))
    weighted = weighted.withColumn("most", F.lit(cap).cast("bigint") * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    shared = (weighted.withColumn("total", F.sum("source_size").over(everything))
              .withColumn("taken", F.coalesce(F.sum("most").over(before), F.lit(0)))
              .withColumn("left", F.sum("weight").over(onward)))
    share = (F.col("total") - F.col("taken")).cast("double") / F.col("left").cast("double")
    shared = shared.withColumn("full", F.col("most").cast("double") <= F.col("weight").cast("double") * share)
    used = F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(everything), F.lit(0))
    free = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    level = (F.col("total") - used).cast("double") / free.cast("double")
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(F.col("weight").cast("double") * level)
    named = F.md5(F.concat(F.lit(SEED), F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))).cast("binary"))
    offset = F.conv(F.substring(named, 1, 8), 16, 10).cast("bigint").cast("double") / F.lit(4294967296.0)
    return (shared.withColumn("target", target)
            .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double"))
                        .otherwise(F.lit(0.0)))
            .select("source", "source_size", "target", "rate", offset.alias("offset")))


def size_class(size: str) -> Column:
    """Sizes to about 3 %, in order: the six leading binary digits and how many follow."""
    spare = f"greatest(length(bin({size})) - 6, 0)"
    return F.expr(f"cast({spare} * 64 + shiftright({size}, {spare}) as bigint)")


def planned_copies(docs: DataFrame, size: Column, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP,
                   id_column: str = "doc_id", source_column: str = "source") -> DataFrame:
    """(row struct, size, source_size, target, copies) of every row of ``docs``.

    * Null text, empty text: size 0; it may be copied but takes no words.
    * Null source: a source of its own, the last one.  Null ids sort first.
    * Rows that are alike in id and size are interchangeable: as a set, reruns
      give the same rows.
    * An empty table gives an empty one.  Other columns, whatever their names,
      travel in the struct.
    """
    key = F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(F.struct("*").alias("row"), F.col(source_column).alias("source"), size.alias("size"),
                       F.col(id_column).alias("id"), key.alias("key"))
    rows = rows.withColumn("part", F.substring("key", 1, 2)).withColumn("class", size_class("size"))
    parts = materialize(rows.groupBy("source", "class", "part").agg(
        F.count("*").alias("rows"), F.sum("size").alias("size")), "mix-parts")
    targets = materialize(source_targets(parts.select("source", "size"), weights, cap), "mix-targets")
    classes = parts.groupBy("source", "class").agg(F.sum("rows").alias("rows"))
    ahead = Window.partitionBy("source").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.select("source", "class", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("class_start"))
    inside = Window.partitionBy("source", "class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("part_start", F.coalesce(F.sum("rows").over(inside), F.lit(0)))

    def same(a, b, *names):
        out = F.lit(True)
        for name in names:
            out = out & a[name].eqNullSafe(b[name])
        return out

    starts = (parts.join(classes, same(parts, classes, "source", "class"))
              .join(targets, same(parts, targets, "source"))
              .select(parts["source"], parts["class"], parts["part"],
                      (F.col("class_start") + F.col("part_start")).alias("start"),
                      "source_size", "target", "rate", "offset"))
    placed = rows.join(starts, same(rows, starts, "source", "class", "part")).select(
        "row", rows["source"].alias("source"), rows["class"].alias("class"), rows["part"].alias("part"),
        rows["size"].alias("size"), "key", "id", "start", "source_size", "target", "rate", "offset")
    order = Window.partitionBy("source", "class", "part").orderBy("key", "id", "size")
    rank = (F.col("start") + F.row_number().over(order)).cast("double")
    sums = placed.withColumn("upto", rank * F.col("rate")).withColumn("from", (rank - 1) * F.col("rate"))
    copies = F.floor(F.col("upto") + F.col("offset")) - F.floor(F.col("from") + F.col("offset"))
    return sums.select("row", "size", "source_size", "target",
                       F.least(F.lit(cap), copies).cast("bigint").alias("copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The mixed documents: each row of ``docs`` as often as its interval crosses a whole number."""
    plan = planned_copies(docs, word_count(F.col("text")), weights, cap).where("copies > 0")
    return plan.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
