"""Saved models and the run table."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

RUN_SCHEMA = "run_name string, params map<string,string>, metrics map<string,double>, ts timestamp"


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str, cls=PipelineModel):
    return cls.load(path)


def log_run(spark: SparkSession, path: str, name: str, params: dict, metrics: dict) -> None:
    """Append one run; the table is a folder of Parquet files that any session can add to."""
    row = (name, {k: str(v) for k, v in params.items()}, {k: float(v) for k, v in metrics.items()})
    table = spark.createDataFrame([row], "run_name string, params map<string,string>, metrics map<string,double>")
    table.withColumn("ts", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)
