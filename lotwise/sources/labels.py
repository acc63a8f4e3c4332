"""Text-label batches: request lines out, response lines in."""

from pyspark.sql import DataFrame, SparkSession, functions as F

REQUESTS = 200_000         # lines of one file
FLAGS = ["cosmetic_damage", "functional_damage", "severe_damage"]
_RESPONSE = ("custom_id string, response struct<body: struct<choices: array<struct<message: struct<content: string>>>>>")


def request_lines(df: DataFrame, key: str, text: str, instruction: str, model: str = "gpt-4.1-nano",
                  max_tokens: int = 500) -> DataFrame:
    """One JSON request per row whose text is not blank, in the column ``value``."""
    def message(role, content):
        return F.struct(F.lit(role).alias("role"), content.alias("content"))
    body = F.struct(F.lit(model).alias("model"),
                    F.array(message("system", F.lit(instruction.strip())), message("user", F.col(text))).alias("messages"),
                    F.lit(max_tokens).alias("max_tokens"),
                    F.struct(F.lit("json_object").alias("type")).alias("response_format"))
    request = F.struct(F.concat(F.lit("request-"), F.col(key).cast("string")).alias("custom_id"),
                       F.lit("POST").alias("method"), F.lit("/v1/chat/completions").alias("url"), body.alias("body"))
    return df.where(F.col(text).rlike(r"(?U)\S")).select(F.to_json(request).alias("value"))


def write_requests(df: DataFrame, path: str, lines: int = REQUESTS, **settings) -> None:
    """Gzip files of at most ``lines`` request lines: all lines repeat the instruction, and one task reads a compressed file whole."""
    (request_lines(df, **settings).write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", lines).text(path))


def _parsed(lines: DataFrame) -> DataFrame:
    answer = F.from_json(F.col("r.response.body.choices")[0]["message"]["content"],
                         ", ".join(f"{f} int" for f in FLAGS))
    return (lines.where(F.col("value").rlike(r"(?U)\S"))
            .withColumn("r", F.from_json("value", _RESPONSE)).withColumn("a", answer)
            .withColumn("original_idx", F.regexp_extract("r.custom_id", r"^(?:request-)?(\d+)$", 1).try_cast("bigint")))


def _complete():
    good = F.col("original_idx").isNotNull()
    for flag in FLAGS:
        good = good & F.col(f"a.{flag}").isNotNull()
    return F.coalesce(good, F.lit(False))


def parse_responses(lines: DataFrame) -> DataFrame:
    """(original_idx, flags) of the lines that hold a whole answer."""
    return _parsed(lines).where(_complete()).select("original_idx", *[F.col(f"a.{f}").alias(f) for f in FLAGS])


def rejected_responses(lines: DataFrame) -> DataFrame:
    return _parsed(lines).where(~_complete()).select("value")


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return parse_responses(spark.read.text(path))
