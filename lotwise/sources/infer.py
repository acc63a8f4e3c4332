"""CSV files without a given schema: headers merged, types found in one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lotwise import fixed_values as fx

WHOLE = r"^[+-]?[0-9]+$"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?[Ii]nf(inity)?$"
TRUTHS, FALSEHOODS = ["True", "TRUE", "true"], ["False", "FALSE", "false"]


def known(name: str, words: list[str]) -> Column:
    """The field, or null for a word that stands for a missing value."""
    value = F.col(f"`{name}`")
    return F.when(~value.isin(*words), value)


def found_types(df: DataFrame, words: list[str] | None = None) -> DataFrame:
    """(place, column, type, filled, missing) of the text columns of ``df``, from counts taken in one pass.

    The types form a lattice: nothing lies below all; whole numbers (``bigint``) lie
    below numbers (``double``), and these, like ``boolean``, below ``string``.  A
    column's type is the least one that holds all its values.  A column without
    values is ``double``, as a column of missing numbers; whole numbers beyond
    64 bits are numbers.
    """
    words = fx.NA_WORDS if words is None else words
    counts = []
    for i, name in enumerate(df.columns):
        value = known(name, words)
        bare = F.btrim(value)
        counts += [F.count(value).alias(f"n{i}"), F.count_if(bare.rlike(WHOLE) & bare.try_cast("bigint").isNotNull()).alias(f"w{i}"),
                   F.count_if(bare.rlike(NUMBER)).alias(f"d{i}"), F.count_if(value.isin(*TRUTHS, *FALSEHOODS)).alias(f"b{i}")]
    counted = df.agg(F.count("*").alias("rows"), *counts)
    entries = [F.struct(F.lit(i).alias("place"), F.lit(name).alias("column"),
                        F.when(F.col(f"w{i}") == F.col(f"n{i}"), F.when(F.col(f"n{i}") == 0, "double").otherwise("bigint"))
                        .when(F.col(f"d{i}") == F.col(f"n{i}"), "double").when(F.col(f"b{i}") == F.col(f"n{i}"), "boolean")
                        .otherwise("string").alias("type"),
                        F.col(f"n{i}").alias("filled"), (F.col("rows") - F.col(f"n{i}")).alias("missing"))
               for i, name in enumerate(df.columns)]
    return counted.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def with_types(df: DataFrame, types: dict[str, str], words: list[str] | None = None) -> DataFrame:
    """Text columns cast to the given types, missing-value words as null."""
    words = fx.NA_WORDS if words is None else words

    def cast(name: str) -> Column:
        value = known(name, words)
        if types[name] == "boolean":
            return F.when(value.isin(*TRUTHS), F.lit(True)).when(value.isin(*FALSEHOODS), F.lit(False))
        return value if types[name] == "string" else F.btrim(value).try_cast(types[name])

    return df.select(*[cast(c).alias(c) for c in df.columns])


def headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Header line -> files that begin with it.

    Lines keep their order inside a task, and a file begins in the task that reads
    its first block, so the header is the first line seen there.  Only that block of a
    file is read.  A header is one line, without a line break in a name.
    """
    lines = (spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
             .where("file_block_start = 0").withColumn("line", F.monotonically_increasing_id()))
    first = lines.groupBy("file_path").agg(F.min_by("value", "line").alias("header"))
    out: dict[str, list[str]] = {}
    for row in first.groupBy("header").agg(F.sort_array(F.collect_list("file_path")).alias("files")).orderBy("header").collect():
        out[row["header"]] = row["files"]       # names only; Spark's own list of a reader's files holds them as well
    return out


def column_names(spark: SparkSession, header: str) -> list[str]:
    """Names in a header line; empty ones are numbered, repeated ones get a number at their end."""
    fields = spark.range(1).select(F.from_csv(F.lit(header), ", ".join(f"c{i} string" for i in range(header.count(",") + 1)),
                                              {"quote": '"', "escape": '"'}).alias("f")).first()["f"]
    last = max((i for i, f in enumerate(fields) if f is not None), default=-1)
    # A comma inside quotes parts no names: what is too many is null at the end.
    wanted, seen, names = fields[:last + 1] if '"' in header else fields, set(), []
    for i, name in enumerate(wanted):
        base = name if name else f"Unnamed: {i}"
        unique, k = base, 0
        while unique in seen:
            k += 1
            unique = f"{base}.{k}"
        seen.add(unique)
        names.append(unique)
    return names


def read_text_columns(spark: SparkSession, path: str) -> DataFrame:
    """All columns of all files as text; a column that a file lacks is null there.

    Columns come in the order of the first header (by its text) that has them.
    """
    parts = []
    for header, files in headers(spark, path).items():
        schema = StructType([StructField(n, StringType()) for n in column_names(spark, header)])
        parts.append(spark.read.schema(schema).option("header", True).option("multiLine", True).option("enforceSchema", True)
                     .option("quote", '"').option("escape", '"').csv(files))
    if not parts:
        raise ValueError(f"no file with a header below {path}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def infer_csv(spark: SparkSession, path: str, words: list[str] | None = None) -> DataFrame:
    """CSV files with headers, their columns merged by name and cast to the types that hold all their values."""
    text = read_text_columns(spark, path)
    types = {r["column"]: r["type"] for r in found_types(text, words).collect()}       # one row per column
    return with_types(text, types, words)
