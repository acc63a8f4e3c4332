"""Fitted encoders and scalers, and the plain steps between them."""

import math

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame, functions as F

from lotwise import fixed_values as fx
from lotwise.functions.price import in_local_currency
from lotwise.operators.fitted import FitStep, FittedModel, PlainStep
from lotwise.operators.quantiles import order_statistic
from lotwise.operators.relational import first_columns, numeric_columns, sorted_by, stable_hash
from lotwise.operators.strata import split_hash, stratified_split
from lotwise.session import join_lookup, materialize


def _present(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def _by_value(df: DataFrame, columns: list[str], *extra) -> DataFrame:
    """Long form (column, value, extras), nulls left out: one scan serves every column."""
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
               for c in columns]
    return (df.select(F.explode(F.array(*entries)).alias("e"), *extra)
            .select("e.*", *[x for x in df.select(*extra).columns] if extra else [])
            .where("value is not null"))


# ------------------------------------------------------------------ mean encodings
class TargetMean(FitStep):
    """Category -> smoothed mean of the target; unseen and null -> the overall mean.

    ``smoothing=None`` gives the plain mean, and null for unseen values.
    """

    def __init__(self, columns=fx.ENCODED_COLUMNS, target: str = fx.PRICE, smoothing: float | None = fx.SMOOTHING):
        super().__init__(columns=list(columns), target=target, smoothing=smoothing)

    def _fit(self, df):
        s = self.settings
        if s["target"] not in df.columns:
            raise ValueError(f"target column {s['target']!r} is missing")
        columns = _present(df, s["columns"])
        target = F.col(f"`{s['target']}`").cast("double").alias("_y")
        overall = df.agg(F.avg(target).alias("m")).first()["m"]
        if overall is None:
            raise ValueError(f"target column {s['target']!r} has no values to learn from")
        stats = (_by_value(df, columns, target).groupBy("column", "value")
                 .agg(F.avg("_y").alias("mean"), F.count("_y").alias("n")))
        m = s["smoothing"]
        code = F.col("mean") if m is None else (
            (F.col("n") * F.col("mean") + F.lit(m * overall)) / (F.col("n") + F.lit(m)))
        codes = stats.select("column", "value", code.alias("code"))
        tables = {f"codes{i}": codes.where(F.col("column") == c).select(F.col("value").alias(c), F.col("code").alias("_code"))
                  for i, c in enumerate(columns)}
        return TargetMeanModel(s | {"columns": columns, "overall": overall}, tables)


class TargetMeanModel(FittedModel):
    def apply(self, df):
        s = self.settings
        for i, c in enumerate(s["columns"]):
            if c not in df.columns:
                continue
            order = df.columns
            joined = self.lookup(df.withColumn(c, F.col(f"`{c}`").cast("string")), f"codes{i}", [c])
            code = F.col("_code") if s["smoothing"] is None else F.coalesce("_code", F.lit(s["overall"]))
            df = joined.withColumn(c, code).select(*[F.col(f"`{x}`") for x in order])
        return df


# ------------------------------------------------------------------ scaling
class Standardize(FitStep):
    """(x - mean) / population deviation; nulls stay; a constant column is only centred."""

    def __init__(self, columns: list[str] | None = None):
        super().__init__(columns=columns)

    def _fit(self, df):
        numeric = numeric_columns(df)
        columns = [c for c in (self.settings["columns"] or numeric) if c in numeric]
        row = df.agg(*[F.struct(F.avg(f"`{c}`").alias("m"), F.stddev_pop(f"`{c}`").alias("s")).alias(f"c{i}")
                       for i, c in enumerate(columns)]).first()
        scale = {c: [row[f"c{i}"]["m"], row[f"c{i}"]["s"] or 1.0] for i, c in enumerate(columns)}
        return StandardizeModel({"scale": scale})


class StandardizeModel(FittedModel):
    def apply(self, df):
        return df.withColumns({c: (F.col(f"`{c}`") - F.lit(m)) / F.lit(s)
                               for c, (m, s) in self.settings["scale"].items()
                               if c in df.columns and m is not None})


# ------------------------------------------------------------------ categories
def numbered(values: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, place): the distinct values of each column in order, from 0.

    The values are sorted in ranges and numbered within each range; only the
    number of rows per range and the first place per column are gathered, so
    there is no limit to the values.
    """
    entries = _by_value(values, columns).distinct()
    ranged = entries.repartitionByRange("column", "value").sortWithinPartitions("column", "value")
    marked = materialize(ranged.withColumn("_m", F.monotonically_increasing_id()), "numbered")
    part, inside = F.shiftright("_m", 33), F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = marked.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()       # one row per range
    starts, total = {}, 0
    for row in sorted(sizes, key=lambda r: r["part"]):
        starts[row["part"]] = total
        total += row["n"]
    if not starts:
        return entries.withColumn("place", F.lit(0).cast("bigint"))
    start = F.create_map(*[x for k, v in starts.items() for x in (F.lit(k).cast("bigint"), F.lit(v).cast("bigint"))])
    placed = marked.select("column", "value", (start[part] + inside).alias("at"))
    firsts = {r["column"]: r["at"] for r in placed.groupBy("column").agg(F.min("at").alias("at")).collect()}
    first = F.create_map(*[x for k, v in firsts.items() for x in (F.lit(k), F.lit(v).cast("bigint"))])
    return placed.select("column", "value", (F.col("at") - first[F.col("column")]).alias("place"))


def categories(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted values per column, for forms in which every value becomes a column of its own."""
    found: dict[str, list[str]] = {c: [] for c in columns}
    if columns:
        for row in _by_value(df, columns).distinct().toLocalIterator():
            found[row["column"]].append(row["value"])
    return {c: sorted(values) for c, values in found.items()}


class OneHot(FitStep):
    """One 0/1 column per category seen in fit, and ``<column>_Unknown`` for unseen values.

    ``unknown=False`` is the dummy form: unseen values are all zero, and the
    columns of any later table are those of the fit.  ``sparse=True`` is the
    form for any number of categories: one sparse vector ``<column>_vector``
    per column, whose last place stands for unseen values; null is all zero.
    """

    def __init__(self, columns=fx.ONE_HOT_COLUMNS, unknown: bool = True, sparse: bool = False):
        super().__init__(columns=list(columns), unknown=unknown, sparse=sparse)

    def _fit(self, df):
        s = self.settings
        columns = _present(df, s["columns"])
        if s.get("sparse"):
            code = OrdinalCode(columns).fit(df)
            sizes = {r["column"]: r["n"] for r in code.tables["places"].groupBy("column").agg(F.count("*").alias("n")).collect()}
            return SparseOneHotModel({"columns": columns, "sizes": [sizes.get(c, 0) for c in columns]}, code.tables)
        return OneHotModel({"categories": categories(df, columns), "unknown": s["unknown"]})


class OneHotModel(FittedModel):
    def apply(self, df):
        made = []
        for c, values in self.settings["categories"].items():
            if c not in df.columns:
                continue
            value = F.col(f"`{c}`").cast("string")
            made += [F.coalesce((value == v).cast("int"), F.lit(0)).alias(f"{c}_{v}") for v in values]
            if self.settings["unknown"]:
                unseen = value.isNotNull() & ~value.isin(*values) if values else value.isNotNull()
                made.append(unseen.cast("int").alias(f"{c}_Unknown"))
        kept = [F.col(f"`{c}`") for c in df.columns if c not in self.settings["categories"]]
        return df.select(*kept, *made)


class OrdinalCode(FitStep):
    """Place of the value among the sorted categories of fit, from 0; unseen -1; null stays null."""

    def __init__(self, columns: list[str]):
        super().__init__(columns=list(columns))

    def _fit(self, df):
        columns = _present(df, self.settings["columns"])
        return OrdinalCodeModel({"columns": columns}, {"places": numbered(df, columns)} if columns else {})


class OrdinalCodeModel(FittedModel):
    def apply(self, df):
        for c in self.settings["columns"]:
            if c not in df.columns:
                continue
            order = df.columns
            table = self.tables["places"].where(F.col("column") == c).select(F.col("value").alias(c), F.col("place").alias("_place"))
            joined = join_lookup(df.withColumn(c, F.col(f"`{c}`").cast("string")), table, [c], self.rows["places"])
            code = F.when(F.col(f"`{c}`").isNotNull(), F.coalesce("_place", F.lit(-1)).cast("double"))
            df = joined.withColumn(c, code).select(*[F.col(f"`{x}`") for x in order])
        return df


class SparseOneHotModel(FittedModel):
    def apply(self, df):
        s = self.settings
        for c, size in zip(s["columns"], s["sizes"]):
            if c not in df.columns:
                continue
            coder = OrdinalCodeModel.__new__(OrdinalCodeModel)
            coder._base_init()
            coder.settings, coder.tables, coder.rows = {"columns": [c]}, self.tables, self.rows
            coded = coder.apply(df)
            place = F.when(F.col(f"`{c}`") < 0, float(size)).when(F.col(f"`{c}`").isNull(), float(size + 1)).otherwise(F.col(f"`{c}`"))
            # The encoder only needs the number of places; the last one, for null, is dropped.
            encoder = OneHotEncoder(inputCols=["_place"], outputCols=[f"{c}_vector"], dropLast=True).fit(
                df.sparkSession.range(size + 1, size + 2).select(F.col("id").cast("double").alias("_place")))
            df = encoder.transform(coded.withColumn("_place", place)).drop("_place", c)
        return df


# ------------------------------------------------------------------ plain steps
class DropColumns(PlainStep):
    def __init__(self, columns: list[str]):
        super().__init__(columns=list(columns))

    def _transform(self, df):
        return df.drop(*self.settings["columns"])


class OrderColumns(PlainStep):
    """Listed columns first; rows sorted only when asked, as a sink may want it."""

    def __init__(self, first=fx.FIRST_COLUMNS, sort=(fx.BRAND, fx.MODEL), sort_rows: bool = False):
        super().__init__(first=list(first), sort=list(sort), sort_rows=sort_rows)

    def _transform(self, df):
        s = self.settings
        out = first_columns(df, s["first"])
        return sorted_by(out, s["sort"]) if s["sort_rows"] else out


class ConvertCurrency(PlainStep):
    def __init__(self, rate: float = fx.RATE_PIPELINE, price: str = fx.PRICE, currency: str = fx.CURRENCY):
        super().__init__(rate=rate, price=price, currency=currency)

    def _transform(self, df):
        s = self.settings
        return df.withColumn(s["price"], in_local_currency(F.col(s["price"]), F.col(s["currency"]), s["rate"]))


class Checkpoint(PlainStep):
    """Writes the rows and reads them back, so later fits do not redo the steps before."""

    def __init__(self):
        super().__init__()

    def _transform(self, df):
        from lotwise.session import materialize
        return materialize(df, "stage")


# ------------------------------------------------------------------ split
def hash_split(df: DataFrame, key: str, share: int = 20, seed: str = "42") -> DataFrame:
    """Adds ``split``: test, then validation out of the rest, else train.

    Membership depends on the row key alone: no sort, no shuffle, the same
    under any partitioning.
    """
    h = stable_hash(F.col(key).cast("string"), seed=seed)
    return df.withColumn("split", F.when(h % 100 < share, "test")
                         .when(F.floor(h / 100) % 100 < share, "validation").otherwise("train"))


def exact_split(df: DataFrame, key: str, share: float = 0.2, seed: str = "42") -> DataFrame:
    """Adds ``is_test`` to exactly ceil(share * rows) rows: the least hashes of the row keys.

    The cut is found by rank selection on the hash, not by sorting the rows.  A
    null key counts as empty text.  Rows that share the cut's key are numbered in
    written files, and as many of them are taken as the count lacks.
    """
    hashed = df.withColumn("_h", split_hash(key, seed))
    rows = df.count()
    wanted = math.ceil(share * rows)
    if wanted == 0:
        return df.withColumn("is_test", F.lit(False))
    cut = order_statistic(hashed, "_h", wanted - 1, rows)
    if hashed.where(F.col("_h") <= cut).count() == wanted:
        return hashed.withColumn("is_test", F.col("_h") <= F.lit(cut)).drop("_h")
    return stratified_split(df, key, [], share, seed)
