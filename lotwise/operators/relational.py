"""Filters, joins, ordering and set helpers where the built-in needs care."""

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import NumericType

from lotwise.session import join_lookup


def first_columns(df: DataFrame, order: list[str]) -> DataFrame:
    """Listed columns first (absent ones skipped), the others after them."""
    head = [c for c in order if c in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in head + [c for c in df.columns if c not in head]])


def sorted_by(df: DataFrame, columns: list[str]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.orderBy(*[F.col(f"`{c}`") for c in present]) if present else df


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def feature_columns(df: DataFrame, target: str) -> list[str]:
    """Feature names; raises when the target is absent or a feature is not numeric."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} is missing")
    numeric = set(numeric_columns(df))
    wrong = [c for c in df.columns if c != target and c not in numeric]
    if wrong:
        raise ValueError(f"features must be numeric: {wrong}")
    return [c for c in df.columns if c != target]


def is_standardized(df: DataFrame, tolerance: float = 0.2) -> DataFrame:
    """One row: are all column means near 0 and all standard deviations near 1."""
    checks = [(F.abs(F.avg(f"`{c}`")) < tolerance) & (F.abs(F.stddev_samp(f"`{c}`") - 1) < tolerance)
              for c in numeric_columns(df)]
    ok = checks[0]
    for check in checks[1:]:
        ok = ok & check
    return df.agg(F.coalesce(ok, F.lit(False)).alias("standardized"))


def stable_hash(*key: Column, seed: str = "42") -> Column:
    """32-bit number from a row key, equal on every engine that has md5."""
    return F.conv(F.substring(F.md5(F.concat(*key, F.lit("|" + seed))), 1, 8), 16, 10).cast("bigint")


def sample_rows(df: DataFrame, key: str, n: int, seed: str = "42") -> DataFrame:
    """n rows in hash order: a random-looking sample that is the same on every run."""
    order = stable_hash(F.col(key).cast("string"), seed=seed)
    return df.orderBy(order, F.col(key)).limit(n)


# ------------------------------------------------------------------ joins
def attach(df: DataFrame, other: DataFrame, key: str, suffix: str = "_raw", how: str = "left") -> DataFrame:
    """Left join on a row id; clashing names on the right get a suffix."""
    clash = {c: c + suffix for c in other.columns if c != key and c in df.columns}
    return df.join(other.withColumnsRenamed(clash), key, how)


def only_in(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return df.join(keys.select(*on), on, "left_semi")


def not_in(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return df.join(keys.select(*on), on, "left_anti")


def is_subset(df: DataFrame, other: DataFrame, on: list[str]) -> bool:
    return not_in(df.select(*on).distinct(), other, on).isEmpty()


def map_values(df: DataFrame, table: DataFrame, column: str, default=None,
               out: str | None = None, rows: int | None = None) -> DataFrame:
    """Value map from a two-column table (value, mapped) with a default."""
    lookup = table.select(F.col("value").alias(column), F.col("mapped").alias("_mapped"))
    joined = join_lookup(df, lookup, [column], rows)
    value = F.col("_mapped") if default is None else F.coalesce("_mapped", F.lit(default))
    out = out or column
    order = df.columns if out in df.columns else [*df.columns, out]
    return joined.withColumn(out, value).select(*[F.col(f"`{c}`") for c in order])


# ------------------------------------------------------------------ order
def top_rows(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """First k rows of each group; Spark cuts every partition to k before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("place", place).where(F.col("place") <= k)


def best_row(df: DataFrame, key: list[str], order: list[Column], keep: list[str]) -> DataFrame:
    """One row per key, the least by ``order``: an aggregation with map-side combine, no sort.

    The order columns must decide every tie.
    """
    ranked = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)],
                      *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)])
    best = df.groupBy(*key).agg(F.min(ranked).alias("_best"))
    return best.select(*key, *[F.col(f"_best.k{i}").alias(c) for i, c in enumerate(keep)])


def frequency_order(df: DataFrame, column: str) -> DataFrame:
    """Adds ``n_same``, the frequency of the row's value, and sorts by it (ties by value).

    The order of the categories is carried by the sort keys themselves, so no
    category has to be numbered in one task.
    """
    from lotwise.operators.stats import value_counts
    table = value_counts(df, column).withColumnRenamed("n", "n_same")
    joined = join_lookup(df, table, [column], how="inner").select(*[F.col(f"`{c}`") for c in [*df.columns, "n_same"]])
    return joined.orderBy(F.desc("n_same"), column)
