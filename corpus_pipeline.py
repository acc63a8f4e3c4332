"""Pipeline over ``documents``: toxicity, line dedup, near duplicates, mixing, tokens.

Every stage takes (spark, docs, sf_dir), works on all rows of its predecessor,
and returns the columns of ``documents``; the last one returns token ids.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise.llm import language, lines, mixing, ngram_join, pieces, toxicity
from lotwise.llm.queries_models import tokenizer_path
from lotwise.llm.registry import table
from lotwise.session import materialize, ship_package

#: Share of its characters in lines of other sites above which a text is left to the near-duplicate stage.
SPARED = 1 / 3

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def shipped(stage: Stage) -> Stage:
    """Send the package to the Python workers before the stage runs."""
    @wraps(stage)
    def with_package(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return stage(spark, docs, sf_dir)
    return with_package


@shipped
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the chain tagger predicts as toxic go.  The fifth of the labels held out elsewhere is unused here too."""
    held_out = language.held_out("doc_id", 5, 0)
    model = toxicity.fit(docs.where(~held_out), table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score(docs, model).where("predicted = 0").select("row.*")


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sites stay in one document only; all rows stay.

    A text of which more than a third is found on other sites is a copy, not a page
    with boilerplate.  It stays whole, so that the next stage sees it as it came.
    """
    return lines.without_boilerplate(docs, spared=SPARED)


@shipped
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return ngram_join.one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them."""
    return mixing.mix(docs)


@shipped
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, packed as little-endian unsigned 32-bit integers, their number, and the text they decode to."""
    out = pieces.encode_documents(docs, tokenizer_path())
    return out.select("row.*", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode),
]

#: The tagger, the join and the tokenizer cannot be said in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
