"""Exact random shares of every stratum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise.session import join_lookup, materialize

BITS = 60               # of the hash that orders the rows of a stratum
STEP = 10               # bits that one round of the search settles


def split_hash(key: str, seed: str) -> Column:
    """60 bits of the row key; a null key counts as empty text."""
    text = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(F.concat(text, F.lit("|" + seed))), 1, 15), 16, 10).cast("bigint")


def stratified_split(df: DataFrame, key: str, strata: list[str], share: float = 0.2, seed: str = "42") -> DataFrame:
    """Adds ``is_test`` to exactly ceil(share * n) of the n rows of every stratum: those with the least hashes of the key.

    All strata are searched together.  A round counts rows by stratum and the next
    ten bits of the hash, with sums inside each task, finds the cell of each stratum
    that holds its cut, and goes on inside it.  No task holds a stratum's
    rows and nothing is sorted but the counts, at most 1024 of a stratum.

    Rows that share the cut's hash are rows of one key, or nearly so.  They are numbered
    in the order of their places in written files, and as many are taken as the
    count lacks.  Null values make a stratum of their own; every row is in one; without
    ``strata`` all rows are one.  An empty table gives an empty one.
    """
    rows = materialize(df.withColumns({"_h": split_hash(key, seed), "_s": F.xxhash64(*[F.col(f"`{c}`") for c in strata]) if strata else F.lit(0).cast("bigint"),
                                       "_i": F.monotonically_increasing_id()}), "strata")
    total = rows.groupBy("_s").agg(F.count("*").alias("n"))
    # ``low``: the bits settled so far; ``left``: rows to take from the cell they name.
    cuts = total.select("_s", F.lit(0).cast("bigint").alias("low"), F.ceil(F.lit(share) * F.col("n")).cast("bigint").alias("left"))
    for shift in range(BITS - STEP, -1, -STEP):
        cuts = materialize(cuts, "strata-cuts")
        inside = join_lookup(rows.select("_s", "_h"), cuts, ["_s"], how="inner").where(
            F.shiftright("_h", shift + STEP) == F.shiftright("low", shift + STEP))
        cells = inside.groupBy("_s", "low", "left", F.shiftright("_h", shift).alias("cell")).agg(F.count("*").alias("n"))
        order = Window.partitionBy("_s").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        before = cells.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
        cuts = before.where((F.col("before") < F.col("left")) & (F.col("before") + F.col("n") >= F.col("left"))).select(
            "_s", F.shiftleft("cell", shift).alias("low"), (F.col("left") - F.col("before")).alias("left"), "n")
        cuts = cuts if shift == 0 else cuts.drop("n")
    # Of the rows at the cut all go, or the first ``left`` of ``n`` by their places.
    cuts = materialize(cuts.withColumnRenamed("low", "_cut"), "strata-cuts")
    tied = join_lookup(rows.select("_s", "_h", "_i"), cuts.where(F.col("left") < F.col("n")).drop("n"), ["_s"], how="inner").where("_h = _cut")
    part = F.shiftright("_i", 33)
    counts = tied.groupBy("_s", "left", part.alias("part")).agg(F.count("*").alias("n"))
    order = Window.partitionBy("_s").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Whole parts go before the one in which the count is reached; only that one is numbered.
    reached = counts.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
    edge = materialize(reached.where((F.col("before") < F.col("left")) & (F.col("before") + F.col("n") >= F.col("left")))
                       .select("_s", "part", (F.col("left") - F.col("before")).alias("few")), "strata-edges")
    number = F.row_number().over(Window.partitionBy("_s").orderBy("_i"))
    last = (join_lookup(tied.withColumn("part", part), edge, ["_s", "part"], how="inner").withColumn("number", number)
            .where(F.col("number") == F.col("few")).select("_s", F.col("_i").alias("_last")))
    known = join_lookup(rows, cuts.select("_s", "_cut").join(last, "_s", "left"), ["_s"])
    taken = (F.col("_h") < F.col("_cut")) | ((F.col("_h") == F.col("_cut")) & (F.col("_last").isNull() | (F.col("_i") <= F.col("_last"))))
    return known.withColumn("is_test", F.coalesce(taken, F.lit(False))).select(*df.columns, "is_test")
