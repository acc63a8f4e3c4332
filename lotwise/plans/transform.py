"""Stage two: the fitted feature pipeline in its default order."""

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.sql import DataFrame, functions as F

from lotwise import fixed_values as fx
from lotwise.operators.embed import DescriptionScores
from lotwise.operators.encoders import (
    Checkpoint, ConvertCurrency, DropColumns, OneHot, OrderColumns, Standardize, TargetMean)
from lotwise.operators.impute import FillFromHierarchy, FillVersion
from lotwise.operators.outliers import IsolationForest
from lotwise.plans.versions import HarmonizeVersions


def feature_pipeline(catalogue: DataFrame | None, components: int = fx.EMBED_COMPONENTS,
                     rate: float = fx.RATE_PIPELINE, currency_first: bool = False,
                     outliers=None, trees: int = fx.ISOLATION_TREES) -> Pipeline:
    """The steps from cleaned listings to numeric features.

    Encoding comes before filling and before currency conversion, as the
    default results need it; ``currency_first`` puts conversion up front.  Two
    written checkpoints keep later fits from redoing the name matching.
    """
    convert = [ConvertCurrency(rate)]
    embed = [DescriptionScores(components)] if components else []
    scaled = fx.SCALED_COLUMNS + [f"embed_{i}" for i in range(1, components + 1)]
    return Pipeline(stages=[
        *(convert if currency_first else []),
        HarmonizeVersions(catalogue, fx.MATCH_THRESHOLD), Checkpoint(),
        *embed, FillVersion(), TargetMean(), FillFromHierarchy(), Checkpoint(),
        outliers or IsolationForest(trees=trees),
        Standardize(scaled),
        *([] if currency_first else convert),
        OneHot(), DropColumns(fx.DROPPED_COLUMNS), OrderColumns(),
    ])


def fit_features(parts: DataFrame, pipeline: Pipeline, train: str = "train") -> tuple[PipelineModel, dict[str, DataFrame]]:
    """Fit on the training part, transform every part with the same state.

    ``parts`` has a ``split`` column; the result holds one frame per split,
    all with the columns fixed at fit.  All parts go through a step together, so
    the training rows are transformed once and checkpoints hold every row once.
    """
    def part(name):
        return rows.where(F.col("split") == name).drop("split")

    rows, steps = parts, []
    for step in pipeline.getStages():
        if isinstance(step, Estimator):
            step = step.fit(part(train))
        steps.append(step)
        rows = step.transform(rows)
    return PipelineModel(steps), {n: part(n) for n in ("train", "validation", "test")}
