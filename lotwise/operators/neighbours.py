"""Nearest-neighbour imputation over numeric columns with missing values, exact and without all pairs.

Rows are collapsed to distinct vectors with a weight.  Donors of one pattern
of present columns are placed in cells around pivot vectors, by the columns
they share with the receivers' pattern.  A receiver bounds the distance of its
k-th donor from the cells' own nearest members, visits only the cells and
rings that can hold a donor inside the bound, and compares distances there.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from lotwise import fixed_values as fx
from lotwise.operators.fitted import FitStep, FittedModel
from lotwise.operators.relational import top_per_group
from lotwise.session import join_lookup, materialize, materialize_counted

PIVOTS = 128
RINGS = 16


class KnnImputer(FitStep):
    """Missing values become the mean of the k nearest training rows that have the column.

    Distance of two rows is sqrt(columns / shared * sum of squared gaps over
    shared columns).  A row that shares no column with any donor gets the
    training mean.  Equal distances go to the smaller donor vector.
    """

    def __init__(self, columns: list[str], k: int = fx.NEIGHBOURS, pivots: int = PIVOTS):
        super().__init__(columns=list(columns), k=k, pivots=pivots)

    def _fit(self, df):
        columns = self.settings["columns"]
        means = df.agg(*[F.avg(f"`{c}`").alias(f"m{i}") for i, c in enumerate(columns)]).first()
        donors = _vectors(df, columns).groupBy("x", "mask").agg(F.count("*").alias("w")).where(F.contains("mask", F.lit("1")))
        return KnnImputerModel(self.settings | {"means": list(means)}, {"donors": donors})


def _vectors(df: DataFrame, columns: list[str]) -> DataFrame:
    values = [F.col(f"`{c}`").cast("double") for c in columns]
    mask = F.concat(*[F.when(v.isNotNull(), "1").otherwise("0") for v in values])
    return df.select(F.array(*values).alias("x"), mask.alias("mask"))


def _shared(vector: str, space: str):
    """The vector with every column outside the space blanked."""
    return F.transform(vector, lambda v, i: F.when(F.substring(F.col(space), i + 1, F.lit(1)) == "1", v))


def _bits(mask: str) -> list[int]:
    return [i for i, flag in enumerate(mask) if flag == "1"]


def _both(a: str, b: str) -> str:
    """Flags of the columns that two patterns share; one flag per column, for any number of columns."""
    return "".join("1" if x == y == "1" else "0" for x, y in zip(a, b))


class KnnImputerModel(FittedModel):
    def apply(self, df):
        s = self.settings
        columns, k = s["columns"], s["k"]
        asked, rows = materialize_counted(_vectors(df, columns).where(F.contains("mask", F.lit("0"))).distinct(), "receivers")
        if rows == 0:
            return df
        donors = self.tables["donors"]
        receiver_masks = sorted(r[0] for r in asked.select("mask").distinct().collect())
        donor_masks = sorted(r[0] for r in donors.select("mask").distinct().collect())
        # donor patterns a receiver pattern can use: a shared column and one the receiver lacks
        uses = {rm: [dm for dm in donor_masks if "1" in _both(rm, dm) and _both(rm, dm) != dm] for rm in receiver_masks}
        filled = self._fill(asked, donors, uses, k, len(columns))

        values = [F.coalesce(F.element_at("x", i + 1), F.element_at("f", i + 1), F.lit(s["means"][i]))
                  for i in range(len(columns))]
        table = (asked.join(filled, "x", "left")
                 .select(F.to_json("x", {"ignoreNullFields": "false"}).alias("_key"), F.array(*values).alias("_filled")))
        table, rows = materialize_counted(table, "filled")
        missing = F.lit(False)
        for c in columns:
            missing = missing | F.col(f"`{c}`").isNull()
        key = F.to_json(F.array(*[F.col(f"`{c}`").cast("double") for c in columns]), {"ignoreNullFields": "false"})
        done = join_lookup(df.where(missing).withColumn("_key", key), table, ["_key"], rows)
        done = done.withColumns({c: F.element_at("_filled", i + 1) for i, c in enumerate(columns)})
        whole = df.where(~missing).withColumns({c: F.col(f"`{c}`").cast("double") for c in columns})
        return whole.unionByName(done.drop("_key", "_filled"))

    def _fill(self, asked, donors, uses, k, width):
        """(x, f): the values found for each receiver vector, null where no donor has any."""
        spaces: dict[str, set[str]] = {}
        for rm, masks in uses.items():
            for dm in masks:
                spaces.setdefault(dm, set()).add(_both(rm, dm))
        if not spaces:
            return asked.select("x", F.lit(None).cast("array<double>").alias("f"))
        space_of = F.lit(None).cast("array<string>")
        for dm, found in spaces.items():
            space_of = F.when(F.col("mask") == dm, F.array(*[F.lit(v) for v in sorted(found)])).otherwise(space_of)
        spread = donors.select("x", F.col("mask").alias("dm"), "w", F.explode(space_of).alias("space"))
        # donors alike on the shared columns are equally far from everyone: the first k of them are enough
        spread = materialize(top_per_group(spread.withColumn("p", _shared("x", "space")), ["dm", "space", "p"],
                                           [F.col("x")], k).select("x", "dm", "w", "space"), "spread")

        # pivots: a fixed number of donors per pattern and space, chosen by hash
        heads = top_per_group(spread, ["dm", "space"], [F.xxhash64("x"), F.col("x")], self.settings["pivots"]).collect()
        pivots: dict[tuple, np.ndarray] = {}
        for dm, space in {(h["dm"], h["space"]) for h in heads}:
            bits = _bits(space)
            pivots[dm, space] = np.unique(np.array(
                [[h["x"][b] for b in bits] for h in heads if h["dm"] == dm and h["space"] == space]), axis=0)

        def place(batches):
            for batch in batches:
                batch["cell"], batch["reach"] = 0, 0.0
                for (dm, space), part in batch.groupby(["dm", "space"]):
                    gaps = _gaps(part["x"], space, pivots[dm, space])
                    nearest = gaps.argmin(axis=1)
                    batch.loc[part.index, "cell"] = nearest
                    batch.loc[part.index, "reach"] = gaps[np.arange(len(part)), nearest]
                yield batch

        placed = materialize(spread.mapInPandas(
            place, "x array<double>, dm string, w bigint, space string, cell bigint, reach double"), "placed")
        # per cell: radius, weight and the reach of its first k donors (all bounded by pivots and patterns)
        cell = ["dm", "space", "cell"]
        sizes = placed.groupBy(*cell).agg(F.max("reach").alias("radius"), F.sum("w").alias("weight"))
        firsts = (top_per_group(placed, cell, [F.col("reach"), F.col("x")], k)
                  .groupBy(*cell).agg(F.sort_array(F.collect_list(F.struct("reach", "w"))).alias("near")))
        stats: dict[tuple, dict[int, tuple]] = {}
        rows = sizes.join(firsts, cell).collect()
        for r in rows:
            total, kth = 0, r["radius"]
            for near in r["near"]:
                total += near["w"]
                if total >= k:
                    kth = near["reach"]
                    break
            stats.setdefault((r["dm"], r["space"]), {})[r["cell"]] = (r["radius"], r["weight"], kth)

        def visit(batches):
            for batch in batches:
                out = []
                for (dm, space), part in batch.groupby(["dm", "space"]):
                    out.append(_visits(part, space, pivots[dm, space], stats[dm, space], k))
                if out:
                    yield pd.concat(out, ignore_index=True)

        use_of = F.array().cast("array<struct<dm:string,space:string>>")
        for rm, masks in uses.items():
            pairs = F.array(*[F.struct(F.lit(v).alias("dm"), F.lit(_both(rm, v)).alias("space")) for v in masks])
            use_of = F.when(F.col("mask") == rm, pairs.cast("array<struct<dm:string,space:string>>")).otherwise(use_of)
        wanted = (asked.withColumn("use", F.explode(use_of)).select("x", "use.*")
                  .select("x", "dm", "space", _shared("x", "space").alias("p")))
        # receivers alike on the shared columns search once
        searched = wanted.select(F.col("p").alias("x"), "dm", "space").distinct()
        visits = searched.mapInPandas(visit, "x array<double>, dm string, space string, cell bigint, ring int, gap double, bound double")
        radius = sizes.select(*cell, "radius")
        ringed = join_lookup(placed, radius, cell, len(rows)).withColumn("ring", F.when(F.col("radius") > 0, F.least(
            F.floor(F.col("reach") / F.col("radius") * RINGS), F.lit(RINGS - 1))).otherwise(0).cast("int")).drop("radius")
        met = visits.join(ringed.withColumnRenamed("x", "y"), cell + ["ring"])
        met = met.where(F.abs(F.col("reach") - F.col("gap")) <= F.col("bound"))
        shared = F.aggregate(F.zip_with("x", "y", lambda a, b: F.coalesce((a - b) * (a - b), F.lit(0.0))),
                             F.lit(0.0), lambda acc, v: acc + v)
        met = met.withColumn("d2", shared * F.lit(float(width)) / F.length(F.replace("space", F.lit("0"), F.lit(""))))
        near = top_per_group(met, ["x", "dm", "space"], [F.col("d2"), F.col("y")], k)
        near = near.select(F.col("x").alias("p"), "dm", "space", "y", "w", "d2").join(wanted, ["p", "dm", "space"])

        lacking = F.filter(F.sequence(F.lit(0), F.lit(width - 1)),
                           lambda i: F.element_at("y", i + 1).isNotNull() & F.element_at("x", i + 1).isNull())
        votes = near.select("x", "y", "w", "d2", F.explode(lacking).alias("feature"))
        order = Window.partitionBy("x", "feature").orderBy("d2", "y")
        before = F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("w")
        taken = votes.withColumn("take", F.least(F.col("w"), F.lit(k) - before)).where("take > 0")
        means = taken.groupBy("x", "feature").agg(
            (F.sum(F.col("take") * F.element_at("y", F.col("feature") + 1)) / F.sum("take")).alias("value"))
        picks = [F.max(F.when(F.col("feature") == i, F.col("value"))) for i in range(width)]
        return means.groupBy("x").agg(F.array(*picks).alias("f"))


def _gaps(vectors: pd.Series, space: str, pivots: np.ndarray) -> np.ndarray:
    values = np.stack(vectors.to_numpy())[:, _bits(space)].astype(float)
    return np.sqrt(((values[:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2))


def _visits(part: pd.DataFrame, space: str, pivots: np.ndarray, stats: dict, k: int) -> pd.DataFrame:
    """Cells and rings that can hold one of the k nearest donors of each receiver."""
    cells = np.array(sorted(stats))
    radius, weight, kth = (np.array([stats[c][i] for c in cells], dtype=float) for i in range(3))
    gaps = _gaps(part["x"], space, pivots)[:, cells]
    # k donors lie within gap + kth of a cell that holds k; smaller cells are added up by their far side
    whole = np.where(weight >= k, gaps + kth, np.inf).min(axis=1)
    far = np.argsort(gaps + radius, axis=1, kind="stable")
    enough = (np.cumsum(weight[far], axis=1) >= k)
    last = np.where(enough.any(axis=1), enough.argmax(axis=1), len(cells) - 1)
    added = np.take_along_axis(gaps + radius, far, axis=1)[np.arange(len(part)), last]
    added = np.where(enough.any(axis=1), added, np.inf)
    bound = np.minimum(whole, added) * (1 + 1e-9) + 1e-9

    at, which = np.nonzero(gaps - radius[None, :] <= bound[:, None])
    step = np.where(radius[which] > 0, radius[which] / RINGS, 1.0)
    gap, limit = gaps[at, which], bound[at]
    low = np.clip(np.floor((gap - limit) / step), 0, RINGS - 1)
    high = np.clip(np.floor(np.minimum((gap + limit) / step, RINGS)), 0, RINGS - 1)
    high = np.where(radius[which] > 0, high, 0)
    low = np.where(radius[which] > 0, low, 0)
    low = np.maximum(low - 1, 0)                     # a ring edge may round either way
    high = np.where(radius[which] > 0, np.minimum(high + 1, RINGS - 1), 0)
    counts = (high - low + 1).astype(int)
    rows = np.repeat(np.arange(len(at)), counts)
    ring = np.concatenate([np.arange(a, b + 1) for a, b in zip(low.astype(int), high.astype(int))]) if len(at) else []
    base = part.iloc[at[rows]].reset_index(drop=True)
    return base.assign(cell=cells[which[rows]], ring=np.array(ring, dtype=np.int32), gap=gap[rows], bound=limit[rows])
