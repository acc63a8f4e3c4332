"""Base for fitted steps: an Estimator that learns tables, a Model that joins them.

A model keeps plain settings and named tables.  Tables are written when they
are fitted, so a transform starts from files and never recomputes the fit, and
their counted rows decide how they are joined.
"""

import json

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from lotwise.session import join_lookup, materialize_counted


class _StepWriter(MLWriter):
    def __init__(self, step):
        super().__init__()
        self.step = step

    def saveImpl(self, path: str) -> None:
        tables = getattr(self.step, "tables", {})
        extra = {"settings": self.step.settings, "tables": sorted(tables),
                 "rows": getattr(self.step, "rows", {})}
        DefaultParamsWriter.saveMetadata(self.step, path, self.sparkSession, extraMetadata=extra)
        for name, table in tables.items():
            table.write.parquet(f"{path}/tables/{name}")


class _StepReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        spark = SparkSession.active()
        step = self.cls.__new__(self.cls)
        self.cls._base_init(step)
        step.settings = metadata["settings"]
        if metadata["tables"] or hasattr(self.cls, "apply"):
            step.tables = {n: spark.read.parquet(f"{path}/tables/{n}") for n in metadata["tables"]}
            step.rows = metadata["rows"]
        step._resetUid(metadata["uid"])
        return step


class _Saved(MLWritable, MLReadable):
    settings: dict

    def write(self):
        return _StepWriter(self)

    @classmethod
    def read(cls):
        return _StepReader(cls)


class FittedModel(Model, _Saved):
    """Settings and tables of a fitted step; subclasses define ``apply``."""

    def __init__(self, settings: dict, tables: dict[str, DataFrame] | None = None):
        self._base_init()
        json.dumps(settings)
        self.settings = settings
        self.tables, self.rows = {}, {}
        for name, table in (tables or {}).items():
            self.tables[name], self.rows[name] = materialize_counted(table, name)

    def _base_init(self):
        super().__init__()

    def _transform(self, df: DataFrame) -> DataFrame:
        if not hasattr(self, "settings"):
            raise RuntimeError(f"{type(self).__name__} must be fitted before transform")
        return self.apply(df)

    def lookup(self, df: DataFrame, name: str, keys: list[str], how: str = "left") -> DataFrame:
        return join_lookup(df, self.tables[name], keys, self.rows[name], how)


class FitStep(Estimator, _Saved):
    """A step to fit; settings are plain values."""

    def __init__(self, **settings):
        self._base_init()
        self.settings = settings

    def _base_init(self):
        super().__init__()

    def transform(self, df: DataFrame):
        raise RuntimeError(f"{type(self).__name__} must be fitted before transform")


class PlainStep(Transformer, _Saved):
    """A step without fitted state."""

    def __init__(self, **settings):
        self._base_init()
        self.settings = settings

    def _base_init(self):
        super().__init__()
