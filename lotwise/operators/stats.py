"""Profiles, counts, modes, histograms and error metrics."""

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.operators.quantiles import exact_percentiles, grouped_median
from lotwise.operators.relational import best_row, numeric_columns, top_per_group


# ------------------------------------------------------------------ counts
def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value, nulls left out."""
    return df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count("*").alias("n"))


def share_of_total(counts: DataFrame, out: str = "pct", digits: int = 2) -> DataFrame:
    """Percent of the summed counts.  The total is a scalar subquery, not a one-task window."""
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.withColumn(out, F.bround(F.col("n") * 100.0 / total, digits))


def share_of_rows(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """Percent of all rows, null rows counted in the total."""
    total = df.agg(F.count("*").alias("t")).scalar()
    return value_counts(df, column).withColumn("pct", F.bround(F.col("n") * 100.0 / total, digits))


def groups_with_many(df: DataFrame, group: list[str], item: str) -> DataFrame:
    """Distinct items per group, groups with more than one."""
    per_item = value_counts(df, *group, item)
    return per_item.groupBy(*group).agg(F.count("*").alias("items")).where(F.col("items") > 1)


def distinct_report(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column, one row per column."""
    if approximate:
        wide = df.agg(*[F.approx_count_distinct(f"`{c}`").alias(c) for c in columns])
        return wide.unpivot([], columns, "column", "n_distinct")
    # one (column, value) pass: the expanded single-plan form of count(distinct) on many columns
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns]
    )).alias("p")).select("p.*")
    seen = pairs.groupBy("column", "v").agg(F.count("*").alias("n"))
    return seen.groupBy("column").agg(F.count("v").alias("n_distinct"))


def null_profile(df: DataFrame, columns: list[str] | None = None, only_present: bool = True) -> DataFrame:
    """Null count and ratio per column in one pass."""
    columns = columns or df.columns
    wide = df.agg(F.count("*").alias("_n"), *[
        F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns])
    long = wide.unpivot(["_n"], columns, "column", "nulls")
    out = long.select("column", "nulls", (F.col("nulls") / F.col("_n")).alias("ratio"))
    return out.where(F.col("nulls") > 0) if only_present else out


def column_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, nulls, mean, spread, ends and quartiles of numeric columns, one row per column."""
    quartiles = exact_percentiles(df, columns, [0.25, 0.5, 0.75])
    stats = [F.struct(
        F.lit(c).alias("column"), F.count(f"`{c}`").alias("n"),
        F.count_if(F.col(f"`{c}`").isNull()).alias("nulls"), F.avg(f"`{c}`").alias("mean"),
        F.stddev_samp(f"`{c}`").alias("std"), F.min(f"`{c}`").cast("double").alias("min"),
        *[F.lit(q).cast("double").alias(name) for name, q in zip(("q1", "median", "q3"), quartiles[c])],
        F.max(f"`{c}`").cast("double").alias("max")) for c in columns]
    return df.agg(F.array(*stats).alias("s")).select(F.explode("s").alias("r")).select("r.*")


def catalogue_report(catalogue: DataFrame) -> DataFrame:
    """Rows, distinct levels and summed quantity of a flat catalogue."""
    def known(c):
        return F.when(F.col(c) != "N/A", F.col(c))
    return catalogue.agg(F.count("*").alias("n_rows"), F.countDistinct("brand").alias("n_brands"),
                         F.countDistinct(known("model")).alias("n_models"),
                         F.countDistinct(known("version")).alias("n_versions"),
                         F.sum("quantity").alias("quantity"))


# ------------------------------------------------------------------ modes
def mode_per_group(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Most frequent value, ties to the smallest, groups without a value left out.

    Two aggregations that both combine map-side; no task ever holds the values
    of one group, unlike the ``mode`` aggregate.
    """
    counts = value_counts(df, *group, value)
    return best_row(counts, group, [-F.col("n"), F.col(f"`{value}`")], [value])


def cluster_labels(members: DataFrame, cluster: list[str], value: str, weight: str | None = None) -> DataFrame:
    """Most frequent member of each cluster and the cluster's size."""
    size = F.count("*") if weight is None else F.sum(weight)
    counts = members.groupBy(*cluster, value).agg(size.alias("n"))
    labels = counts.groupBy(*cluster).agg(
        F.min(F.struct(-F.col("n"), F.col(f"`{value}`").alias("label"))).alias("b"),
        F.sum("n").alias("size"))
    return labels.select(*cluster, F.col("b.label").alias("label"), "size")


# ------------------------------------------------------------------ top-n
def top_in_top_groups(df: DataFrame, group: str, item: str, groups: int, items: int) -> DataFrame:
    """Top items of the top groups, by row count."""
    leading = value_counts(df, group).orderBy(F.desc("n"), group).limit(groups).select(group)
    counts = value_counts(df, group, item).join(leading, group, "left_semi")
    return top_per_group(counts, [group], [F.desc("n"), F.col(item)], items)


# ------------------------------------------------------------------ histograms
def histogram(df: DataFrame, value: str, bins: int, by: list[str] | None = None,
              low: float | None = None, high: float | None = None) -> DataFrame:
    """Equal-width bins over [min, max] of each population, last bin closed."""
    by = by or []
    rows = df.dropna(subset=[value] + by)
    if low is None or high is None:
        ends = rows.groupBy(*by).agg(F.min(value).alias("_a"), F.max(value).alias("_z"))
        if by:
            rows = rows.join(ends, by)
        else:
            ends = ends.first()
            rows = rows.withColumn("_a", F.lit(ends["_a"])).withColumn("_z", F.lit(ends["_z"]))
    else:
        rows = rows.where(F.col(value).between(low, high)) \
                   .withColumn("_a", F.lit(float(low))).withColumn("_z", F.lit(float(high)))
    spot = F.floor((F.col(value) - F.col("_a")) / ((F.col("_z") - F.col("_a")) / bins)) + 1
    bin_no = F.when(F.col("_a") == F.col("_z"), F.lit(1)).otherwise(F.least(spot, F.lit(bins)))
    return (rows.withColumn("bin", bin_no.cast("bigint")).groupBy(*by, "bin")
            .agg(F.count("*").alias("n"), F.min("_a").alias("low"), F.max("_z").alias("high")))


# ------------------------------------------------------------------ flags
def flag_summary(df: DataFrame, flags: list[str]) -> DataFrame:
    """Sum and percent per flag and for any of them, one row each."""
    any_flag = F.greatest(*[F.coalesce(F.col(f), F.lit(0)) for f in flags])
    wide = df.agg(F.count("*").alias("rows"), *[F.sum(f).alias(f) for f in flags],
                  F.sum(any_flag).alias("any"))
    long = wide.unpivot(["rows"], flags + ["any"], "flag", "n")
    return long.select("flag", "n", F.bround(F.col("n") * 100.0 / F.col("rows"), 1).alias("pct"))


def flag_combinations(df: DataFrame, cosmetic: str, functional: str, severe: str) -> DataFrame:
    text = F.format_string("C:%d F:%d S:%d", F.col(cosmetic), F.col(functional), F.col(severe))
    counts = df.withColumn("damage_combination", text).groupBy("damage_combination").agg(F.count("*").alias("n"))
    return share_of_total(counts, digits=1)


# ------------------------------------------------------------------ errors
def residuals(df: DataFrame, target: str, prediction: str = "prediction") -> DataFrame:
    gap = F.col(f"`{target}`") - F.col(f"`{prediction}`")
    return df.withColumn("residual", gap).withColumn("abs_error", F.abs(gap))


def regression_metrics(df: DataFrame, target: str, prediction: str = "prediction",
                       split: str = "split") -> DataFrame:
    """MSE, RMSE, R2, MAE, explained variance, largest and median absolute error per split."""
    rows = residuals(df, target, prediction).dropna(subset=["residual"])
    y, e = F.col(f"`{target}`").cast("double"), F.col("residual")
    base = rows.groupBy(split).agg(
        F.count("*").alias("n"), F.avg(e * e).alias("mse"), F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - F.sum(e * e) / (F.count("*") * F.var_pop(y))).alias("r2"),
        F.avg(F.abs(e)).alias("mae"), (1 - F.var_pop(e) / F.var_pop(y)).alias("evs"),
        F.max(F.abs(e)).alias("max_err"))
    medians = grouped_median(rows, split, "abs_error").withColumnRenamed("median", "medae")
    return base.join(medians, split, "left")


def error_by_group(df: DataFrame, group: str, k: int = 10) -> DataFrame:
    """Groups with the largest mean absolute error."""
    means = df.dropna(subset=[group]).groupBy(group).agg(
        F.avg("abs_error").alias("mae"), F.sqrt(F.avg("abs_error")).alias("sqrt_mae"),
        F.count("*").alias("n"))
    return means.orderBy(F.desc("mae"), group).limit(k)


def largest_groups_error(df: DataFrame, group: str, k: int = 10) -> DataFrame:
    """Same figures for the groups with the most rows."""
    means = df.dropna(subset=[group]).groupBy(group).agg(
        F.sqrt(F.avg("abs_error")).alias("sqrt_mae"), F.count("*").alias("n"))
    return means.orderBy(F.desc("n"), group).limit(k)


def straight_line(df: DataFrame, y: str, x: str) -> DataFrame:
    yc, xc = F.col(f"`{y}`"), F.col(f"`{x}`")
    return df.agg(F.regr_slope(yc, xc).alias("slope"), F.regr_intercept(yc, xc).alias("intercept"),
                  F.regr_r2(yc, xc).alias("r2"))
