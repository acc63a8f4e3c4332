"""Scans and sinks at the edges: CSV with missing-value words, catalogue, Parquet between stages."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructType

from lotwise import fixed_values as fx

CSV_ROWS = 200_000         # of one file


def read_csv(spark: SparkSession, path: str, schema: StructType, na_words: list[str] | None = None) -> DataFrame:
    """CSV with a header.  Fields are read as text, missing-value words become
    null, then every column is cast to its type (a bad cast gives null)."""
    words = fx.NA_WORDS if na_words is None else na_words
    text = StructType([f.__class__(f.name, StringType(), True) for f in schema])
    raw = (spark.read.schema(text).option("header", True).option("multiLine", True)
           .option("quote", '"').option("escape", '"').csv(path))
    def known(name):
        return F.when(~F.col(f"`{name}`").isin(*words), F.col(f"`{name}`"))
    return raw.select(*[known(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


CATALOGUE_SCHEMA = (StructType().add("Brand", StringType()).add("Model", StringType())
                    .add("Version", StringType()).add("Quantity", LongType()))


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(brand, model, version, quantity) of catalogue rows that name a version.

    Read once for all brands and models; a join on both takes the place of one
    scan per group.
    """
    rows = read_csv(spark, path, CATALOGUE_SCHEMA)
    return rows.toDF("brand", "model", "version", "quantity").where("version is not null")


def write_csv(df: DataFrame, path: str, rows: int = CSV_ROWS) -> None:
    """CSV files of at most ``rows`` rows: a file whose fields may hold line ends is read by one task."""
    (df.write.mode("overwrite").option("maxRecordsPerFile", rows).option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).option("quote", '"').option("escape", '"').csv(path))


def write_stage(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Parquet between stages, partitioned by low-cardinality columns such as ``split``."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)
