"""Outlier removal: isolation forest, and the plain percentile rule."""

import math

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from lotwise import fixed_values as fx
from lotwise.operators.fitted import FitStep, FittedModel
from lotwise.operators.quantiles import exact_percentiles
from lotwise.operators.relational import top_per_group

NODE = "tree int, node int, feature int, threshold double, left int, right int, length double"


def _expected_depth(n):
    n = np.asarray(n, dtype=float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1),
                    np.where(n == 2, 1.0, 0.0))


def _grow(values: np.ndarray, rng, limit: int) -> list[tuple]:
    """Nodes of one random tree over a sample of fixed size: (feature, threshold, left, right, path length)."""
    nodes, open_ = [None], [(0, values, 0)]
    while open_:
        place, rows, depth = open_.pop()
        low, high = rows.min(axis=0), rows.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or len(usable) == 0:
            nodes[place] = (-1, 0.0, -1, -1, float(depth + _expected_depth(len(rows))))
            continue
        feature = int(rng.choice(usable))
        threshold = float(rng.uniform(low[feature], high[feature]))
        goes_left = rows[:, feature] <= threshold
        left, right = len(nodes), len(nodes) + 1
        nodes += [None, None]
        nodes[place] = (feature, threshold, left, right, 0.0)
        open_ += [(left, rows[goes_left], depth + 1), (right, rows[~goes_left], depth + 1)]
    return nodes


class Forest:
    """The grown trees as arrays; scores any number of rows at once."""

    def __init__(self, rows, sample: int):
        self.trees = []
        frame = pd.DataFrame(rows, columns=["tree", "node", "feature", "threshold", "left", "right", "length"])
        for _, tree in frame.sort_values("node").groupby("tree"):
            self.trees.append(tuple(tree[c].to_numpy() for c in ("feature", "threshold", "left", "right", "length")))
        self.scale = float(_expected_depth(sample)) or 1.0

    def score(self, values: np.ndarray) -> np.ndarray:
        """Higher is more ordinary, as in -2 ** (-mean path / expected path)."""
        total = np.zeros(len(values))
        every = np.arange(len(values))
        for feature, threshold, left, right, length in self.trees:
            at = np.zeros(len(values), dtype=int)
            while True:
                inner = feature[at] >= 0
                if not inner.any():
                    break
                x = values[every, np.maximum(feature[at], 0)]
                at = np.where(inner, np.where(x <= threshold[at], left[at], right[at]), at)
            total += length[at]
        return -np.power(2.0, -total / len(self.trees) / self.scale)


class IsolationForest(FitStep):
    """Removes rows whose isolation score lies under the training rows' contamination percentile.

    Every tree grows from its own few rows, picked by the hash of the row key,
    so the sample has a fixed size whatever the table's.  Rows with a null in
    the columns are kept.
    """

    def __init__(self, columns: list[str] = (fx.KM,), contamination: float = fx.OUTLIER_SHARE, key: str = fx.ROW_ID,
                 trees: int = fx.ISOLATION_TREES, sample: int = fx.ISOLATION_SAMPLE, seed: int = 42):
        super().__init__(columns=list(columns), contamination=contamination, key=key, trees=trees, sample=sample, seed=seed)

    def _fit(self, df):
        s = self.settings
        rows = df.select(F.xxhash64(F.col(s["key"]).cast("string"), F.lit(s["seed"])).alias("h"),
                         F.array(*[F.col(f"`{c}`").cast("double") for c in s["columns"]]).alias("x")).dropna()
        rows = rows.where(~F.exists("x", lambda v: v.isNull()))
        n = rows.count()
        if n == 0:
            raise ValueError("no rows without nulls to fit on")
        sample = min(s["sample"], n)
        picked = _sample(rows, n, s["trees"], sample)

        def grow(key, part):
            tree = int(key[0])
            nodes = _grow(np.array(part["x"].tolist()), np.random.default_rng([s["seed"], tree]),
                          max(1, math.ceil(math.log2(sample))) if sample > 1 else 1)
            return pd.DataFrame([(tree, i, *node) for i, node in enumerate(nodes)],
                                columns=["tree", "node", "feature", "threshold", "left", "right", "length"])

        trees = picked.groupBy("tree").applyInPandas(grow, NODE)
        model = IsolationForestModel(s | {"sample": sample, "cut": None}, {"trees": trees})
        if len(s["columns"]) == 1:
            model.settings["cut"] = model.cut_of_one_column(rows.select(F.element_at("x", 1).alias("x")), s["contamination"])
        else:
            scored = rows.select(model.score_udf()("x").alias("score"))
            model.settings["cut"] = exact_percentiles(scored, ["score"], [s["contamination"]])["score"][0]
        return model


def _sample(rows: DataFrame, n: int, trees: int, sample: int) -> DataFrame:
    """(tree, x): ``sample`` rows for each tree, those of least hash of row and tree.

    Each tree looks only at rows whose hash lies under a bound that a few more
    than ``sample`` rows are expected to meet, so about that many rows per tree
    are ordered, whatever the table's size.  Rows with the same key and values
    share their hash.
    """
    expected = sample + 6 * math.sqrt(sample) + 20
    bound = int(min(expected / n, 1.0) * (2 ** 63 - 1))
    drawn = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)),
                     lambda t: F.xxhash64("h", "x", t).bitwiseAND(F.lit(2 ** 63 - 1)) <= F.lit(bound))
    each = rows.select("h", "x", F.explode(drawn).alias("tree"))
    order = [F.xxhash64("h", "x", "tree").bitwiseAND(F.lit(2 ** 63 - 1)), F.col("x")]
    return top_per_group(each, ["tree"], order, sample).select("tree", "x")


class IsolationForestModel(FittedModel):
    def forest(self) -> Forest:
        # at most trees * (2 * sample - 1) rows
        return Forest([tuple(r) for r in self.tables["trees"].collect()], self.settings["sample"])

    def score_udf(self):
        forest = self.forest()

        @F.pandas_udf(DoubleType())
        def score(x: pd.Series) -> pd.Series:
            if len(x) == 0:
                return pd.Series([], dtype=float)
            return pd.Series(forest.score(np.stack(x.to_numpy())))
        return score

    def cut_of_one_column(self, rows: DataFrame, share: float) -> float:
        """Percentile of the scores of ``rows`` (x), from counts of rows between thresholds.

        The score is constant between thresholds, and there are at most
        trees * sample of them, so the counts fit on the driver.
        """
        forest = self.forest()
        ends = np.unique(np.concatenate([t[1][t[0] >= 0] for t in forest.trees] or [np.zeros(0)]))
        scores = forest.score(np.append(ends, np.inf).reshape(-1, 1))
        # Intervals are open below and closed above: x <= end is x < the number after it.
        splits = [-math.inf, *np.nextafter(ends, np.inf).tolist(), math.inf]
        placed = Bucketizer(splits=splits, inputCol="x", outputCol="interval").transform(rows) if len(ends) else rows.withColumn("interval", F.lit(0.0))
        counts = np.zeros(len(scores), dtype=np.int64)
        for row in placed.groupBy("interval").count().collect():
            counts[int(row["interval"])] = row["count"]
        order = np.argsort(scores, kind="stable")
        upto = np.cumsum(counts[order])
        spot = share * (int(upto[-1]) - 1)
        low, high = (float(scores[order[np.searchsorted(upto, r, side="right")]]) for r in (math.floor(spot), math.ceil(spot)))
        return low + (high - low) * (spot - math.floor(spot))

    def outlier_ranges(self) -> list[tuple[float | None, float | None]]:
        """One column: the score is constant between thresholds, so the outliers are a few ranges (low, high]."""
        forest = self.forest()
        ends = np.unique(np.concatenate([t[1][t[0] >= 0] for t in forest.trees]))
        scores = forest.score(np.append(ends, np.inf).reshape(-1, 1))
        ranges, start = [], None
        for i, out in enumerate(scores < self.settings["cut"]):
            if out and start is None:
                start = i
            if not out and start is not None:
                ranges.append((None if start == 0 else float(ends[start - 1]), float(ends[i - 1])))
                start = None
        if start is not None:
            ranges.append((None if start == 0 else float(ends[start - 1]), None))
        return ranges

    def apply(self, df):
        columns = self.settings["columns"]
        if len(columns) == 1:
            value, out = F.col(f"`{columns[0]}`").cast("double"), F.lit(False)
            for low, high in self.outlier_ranges():
                inside = F.lit(True)
                if low is not None:
                    inside = inside & (value > low)
                if high is not None:
                    inside = inside & (value <= high)
                out = out | inside
            return df.where(~F.coalesce(out & value.isNotNull(), F.lit(False)))
        values = F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in columns])
        has_null = F.lit(False)
        for c in columns:
            has_null = has_null | F.col(f"`{c}`").isNull()
        scored = df.withColumn("_score", self.score_udf()(values))
        return scored.where(has_null | (F.col("_score") >= self.settings["cut"])).drop("_score")


class PercentileCut(FitStep):
    """Drops rows above a percentile of the training rows; null rows are kept."""

    def __init__(self, column: str = fx.KM, share: float = 0.9):
        super().__init__(column=column, share=share)

    def _fit(self, df):
        s = self.settings
        return PercentileCutModel(s | {"cut": exact_percentiles(df, [s["column"]], [s["share"]])[s["column"]][0]})


class PercentileCutModel(FittedModel):
    def apply(self, df):
        value = F.col(f"`{self.settings['column']}`")
        return df.where(value.isNull() | (value <= self.settings["cut"]))
