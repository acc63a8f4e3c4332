"""Colour names: nearest base colour, greedy groups of like spellings, nearest frequent value by vector."""

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType

from lotwise import fixed_values as fx
from lotwise.functions.text import fold_letters
from lotwise.operators.relational import best_row
from lotwise.operators.similarity import norm
from lotwise.operators.stats import value_counts
from lotwise.session import join_lookup, materialize, materialize_counted


@F.pandas_udf(StringType())
def _base_colour(colours: pd.Series) -> pd.Series:
    def nearest(colour):
        found = difflib.get_close_matches(colour, fx.BASE_COLOURS, n=1, cutoff=fx.BASE_COLOUR_CUTOFF)
        return found[0] if found else fx.NO_COLOUR
    return colours.map(nearest)


def to_base_colour(df: DataFrame, column: str, out: str) -> DataFrame:
    """Nearest base colour by sequence ratio, worked out once per distinct spelling."""
    spelled = df.select(F.col(f"`{column}`")).where(F.col(f"`{column}`").isNotNull()).distinct()
    table, rows = materialize_counted(spelled.withColumn("_base", _base_colour(fold_letters(F.col(f"`{column}`")))), "colours")
    return (join_lookup(df, table, [column], rows)
            .withColumn(out, F.coalesce("_base", F.lit(fx.NO_COLOUR))).drop("_base"))


# ------------------------------------------------------------------ greedy groups
@F.pandas_udf(DoubleType())
def _ratio(leader: pd.Series, word: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, a, b).ratio() for a, b in zip(leader, word)], dtype=float)


def _leading_letters(values: DataFrame, cutoff: float) -> DataFrame:
    """(text, token): the rare letters of which a text must share one with any text of ratio >= cutoff.

    A ratio of c needs c * (la + lb) / 2 common letters, hence at least
    la * c / (2 - c) of a text's la letters; the first la - that + 1 letters
    in a fixed order cannot all be missed.  Repeated letters count singly.
    """
    letters = values.select("text", F.posexplode(F.split("text", "")).alias("p", "letter")).where("letter <> ''")
    numbered = letters.groupBy("text", "letter").agg(F.count("*").alias("times")).select(
        "text", F.explode(F.transform(F.sequence(F.lit(1), F.col("times").cast("int")),
                                      lambda i: F.concat("letter", i.cast("string")))).alias("token"))
    rarity = numbered.groupBy("token").agg(F.count("*").alias("texts"))
    packed = numbered.join(rarity, "token").groupBy("text").agg(
        F.array_sort(F.collect_list(F.struct("texts", "token"))).alias("t"))
    size = F.size("t")
    kept = size - F.ceil(size * F.lit(cutoff / (2 - cutoff)) - F.lit(1e-9)).cast("int") + 1
    return packed.select("text", F.explode(F.slice("t", F.lit(1), kept)).alias("e")).select("text", F.col("e.token").alias("token"))


def group_spellings(spellings: DataFrame, cutoff: float = fx.COLOUR_GROUP_CUTOFF) -> DataFrame:
    """(text, leader, label) for normalised texts with ``n`` rows and ``spelled`` raw spellings.

    Texts are taken by falling n, then by text.  A text joins the earlier
    leader it resembles most, else it leads.  The one-by-one pass is done in
    rounds over the pairs that reach the cutoff: a text whose earlier
    neighbours are all settled as followers leads, a text next to an earlier
    leader follows.
    """
    values = materialize(spellings, "spellings")
    tokens = materialize(_leading_letters(values, cutoff), "tokens")
    pairs = (tokens.withColumnRenamed("text", "a").join(tokens.withColumnRenamed("text", "b"), "token")
             .where("a <> b").select("a", "b").distinct())
    left = values.select(F.col("text").alias("a"), F.col("n").alias("na"))
    right = values.select(F.col("text").alias("b"), F.col("n").alias("nb"))
    earlier = (F.col("na") > F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    near = (pairs.join(left, "a").join(right, "b").where(earlier)
            .where(F.least(F.length("a"), F.length("b")) * 2 >= F.lit(cutoff - 1e-9) * (F.length("a") + F.length("b")))
            .withColumn("ratio", _ratio("a", "b")).where(F.col("ratio") >= cutoff).select("a", "b", "ratio"))
    near = materialize(near, "near")                              # a stands before b

    state = values.join(near.select(F.col("b").alias("text")).distinct(), "text", "left_anti").select("text", F.lit(True).alias("leads"))
    state = materialize(state, "state")
    total, settled = values.count(), -1
    while True:
        done = state.count()
        if done == total or done == settled:
            break
        settled = done
        open_ = near.join(state.select(F.col("text").alias("b")), "b", "left_anti")
        seen = open_.join(state.withColumnRenamed("text", "a"), "a", "left")
        verdict = seen.groupBy(F.col("b").alias("text")).agg(
            F.bool_or(F.coalesce("leads", F.lit(False))).alias("follows"),
            F.bool_and(F.coalesce(~F.col("leads"), F.lit(False))).alias("free"))
        fresh = verdict.where("follows or free").select("text", (~F.col("follows")).alias("leads"))
        state = materialize(state.unionByName(fresh), "state")
    leaders = state.where("leads").select(F.col("text").alias("a"))
    joined = best_row(near.join(leaders, "a").join(state.where("not leads").select(F.col("text").alias("b")), "b")
                      .withColumn("down", _reversed(F.col("a"))), ["b"], [-F.col("ratio"), F.col("down")], ["a"])
    groups = (joined.select(F.col("b").alias("text"), F.col("a").alias("leader"))
              .unionByName(leaders.select(F.col("a").alias("text"), F.col("a").alias("leader"))))
    groups = materialize(groups, "groups")
    labels = best_row(groups.join(values, "text"), ["leader"], [-F.col("spelled"), -F.col("n"), F.col("text")], ["text"])
    return groups.join(labels.withColumnRenamed("text", "label"), "leader").select("text", "leader", "label")


def _reversed(c: Column) -> Column:
    """Sort key under which texts come in falling order (larger code points first, longer first)."""
    return F.concat(F.transform(F.split(c, ""), lambda x: -F.ascii(x)), F.array(F.lit(1)))


def to_colour_group(df: DataFrame, column: str, out: str) -> DataFrame:
    text = fold_letters(F.col(f"`{column}`"))
    counts = value_counts(df, column).withColumn("text", text)
    values = counts.groupBy("text").agg(F.sum("n").alias("n"), F.count("*").alias("spelled"))
    groups, rows = materialize_counted(group_spellings(values).select("text", "label"), "labels")
    joined = join_lookup(df.withColumn("_text", text), groups.withColumnRenamed("text", "_text"), ["_text"], rows)
    return joined.withColumn(out, F.coalesce("label", F.lit(fx.NO_COLOUR_GROUP))).drop("_text", "label")


# ------------------------------------------------------------------ nearest frequent value
def to_frequent_value(df: DataFrame, column: str, vectors: DataFrame, out: str, top: int = fx.TOP_COLOURS) -> DataFrame:
    """Rare values become the most similar of the ``top`` values by vector cosine.

    ``vectors`` holds (value, vector).  Frequent values stay; a value without
    a vector becomes the most frequent one; equal scores go to the more
    frequent.  The frequent values are one array of fixed size next to each
    distinct rare value, so nothing is multiplied out.
    """
    counts = materialize(value_counts(df, column).withColumnRenamed(column, "value"), "counts")
    known, _ = materialize_counted(vectors.select("value", "vector", norm(F.col("vector")).alias("size")), "vectors")
    leading = counts.orderBy(F.desc("n"), "value").limit(top)
    heads = leading.join(known, "value", "left").select(
        F.struct((-F.col("n")).alias("o"), "value", "vector", "size").alias("h"))
    heads = heads.agg(F.array_sort(F.collect_list("h")).alias("h"))                    # ``top`` entries
    rows = counts.join(known, "value", "left").withColumn("h", heads.scalar())
    scored = F.transform(F.filter("h", lambda h: h["vector"].isNotNull() & (h["size"] > 0)), lambda h: F.struct(
        (-F.aggregate(F.zip_with("vector", h["vector"], lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                      lambda acc, v: acc + v) / (F.col("size") * h["size"])).alias("s"),
        h["o"].alias("o"), h["value"].alias("value")))
    first = F.col("h")[0]["value"]
    same = F.exists("h", lambda h: h["value"] == F.col("value"))
    target = (F.when(same, F.col("value")).when(F.col("vector").isNull() | (F.col("size") == 0), first)
              .otherwise(F.coalesce(F.array_min(scored)["value"], first)))
    table, n = materialize_counted(rows.select(F.col("value").alias(column), target.alias("_target")), "targets")
    order = df.columns if out in df.columns else [*df.columns, out]
    return join_lookup(df, table, [column], n).withColumn(out, F.col("_target")).select(*[F.col(f"`{c}`") for c in order])
