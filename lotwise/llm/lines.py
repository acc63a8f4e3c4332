"""Line dedup by the number of distinct sites a line is found on.

A HyperLogLog sketch of the sites is kept per line hash and merged by
aggregation.  Where the estimate lies near the limit the distinct sites are
counted exactly.  A line on ``min_sites`` sites or more is boilerplate: it goes
from every document but its holder, the document with the least id, so no
passage is lost altogether.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.llm.groups import join_split
from lotwise.session import join_lookup, materialize

MIN_SITES = 8
LOG_K = 12
#: Four standard errors of a sketch with 2 ** LOG_K registers.
BAND = 4 * 1.04 / 2 ** (LOG_K / 2)


def line_key(line: Column) -> Column:
    """128 bits of a line without blanks at its ends; a blank line has no key."""
    bare = F.btrim(line, F.lit(" \t\r"))
    return F.when(bare != "", F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit(7), bare).alias("b")))


def boilerplate(keys: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(a, b, holder) of the lines on ``min_sites`` sites or more.

    ``keys`` has one row per document and line: (id, site, a, b).  The sketch
    is taken of the distinct sites of a task first and merged by key, so a line
    that is everywhere costs one row per task.
    """
    sketches = keys.groupBy("a", "b").agg(F.hll_sketch_agg("site", F.lit(LOG_K)).alias("sketch"),
                                          F.min("id").alias("holder"))
    spread = materialize(sketches.select("a", "b", "holder", F.hll_sketch_estimate("sketch").alias("sites"))
                         .where(F.col("sites") >= F.lit(min_sites - max(1.0, BAND * min_sites))), "lines-spread")
    margin = max(1.0, BAND * min_sites)
    sure = spread.where(F.col("sites") > min_sites + margin)
    near = spread.where(F.col("sites") <= min_sites + margin)
    exact = (keys.join(near.select("a", "b"), ["a", "b"], "left_semi")
             .groupBy("a", "b", "site").agg(F.lit(1).alias("one"))
             .groupBy("a", "b").agg(F.count("site").alias("exact")))
    counted = near.join(exact, ["a", "b"]).where(F.col("exact") >= min_sites)
    return materialize(sure.select("a", "b", "holder").unionByName(counted.select("a", "b", "holder")), "lines-gone")


def copied(keys: DataFrame) -> DataFrame:
    """(rk, copied): the characters of each text in lines that stand on two sites or more, by ``keys`` (rk, site, place, n, a, b)."""
    shared = keys.groupBy("a", "b").agg(F.min("site").alias("one"), F.max("site").alias("other"), F.count("*").alias("rows")).where("one <> other")
    found = join_split(keys.select("rk", "place", "n", "a", "b"), shared.select("a", "b", "rows"), ["a", "b"], "rk")
    # Rows alike in id and text have one key.
    return found.groupBy("rk", "place").agg(F.first("n").alias("n")).groupBy("rk").agg(F.sum("n").alias("copied"))


def drop_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, id_column: str = "doc_id",
                     site_column: str = "source", text_column: str = "text", spared: float | None = None) -> DataFrame:
    """(row struct, lines, kept lines) of every row of ``docs``; ``row`` is the row as it came.

    With ``spared`` a text of which more than this share of the characters is in
    lines of two sites or more is a copy of other texts rather than a page with
    boilerplate, and keeps all lines.

    * Null text stays null (no lines); empty text has one blank line.  Blank
      lines are never counted and never removed.
    * A null site counts for no site.  Null ids hold a line only if all its ids
      are null; then the line stays everywhere.
    * Rows alike in id and text are treated alike; all rows stay, even if no
      line is left to them.
    * A very long text, or one of very many lines, takes time in proportion.
    * An empty table gives an empty one; other columns travel in the struct.
    """
    # The struct alone carries the text through the join below.
    rows = docs.select(F.struct("*").alias("row"), F.col(id_column).alias("id"), F.col(site_column).alias("site"),
                       F.xxhash64(F.col(id_column), F.col(text_column)).alias("rk"))
    lines = F.split(F.col(f"row.`{text_column}`"), "\n", -1)
    marked = F.transform(lines, lambda x: F.struct(line_key(x).alias("k"), F.length(x).alias("n")))
    keys = materialize(rows.select("rk", "id", "site", F.posexplode(marked).alias("place", "line"))
                       .where("line.k is not null").select("rk", "id", "site", "place", "line.n", "line.k.a", "line.k.b"), "lines-keys")
    gone = boilerplate(keys, min_sites)
    # A line on every page is one key: the lines that go are a small table, or salted.
    hit = (join_lookup(keys, gone, ["a", "b"], how="inner").where(~F.col("id").eqNullSafe(F.col("holder")))
           .groupBy("rk").agg(F.sort_array(F.collect_set("place")).alias("gone")))
    if spared is not None:
        hit = hit.join(copied(keys), "rk")
        gone = F.when(F.col("copied") <= spared * F.length(F.col(f"row.`{text_column}`")), F.col("gone"))
    else:
        gone = F.col("gone")
    joined = rows.select("row", "rk").join(hit, "rk", "left").select("row", lines.alias("lines"), gone.alias("gone"))
    # What lies between the places that go, in one pass over the lines.
    starts = F.concat(F.array(F.lit(0)), F.transform("gone", lambda p: p + 1))
    between = F.zip_with(starts, F.concat("gone", F.array(F.size("lines"))), lambda a, b: F.slice("lines", a + 1, b - a))
    return joined.select("row", "lines", F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.flatten(between)).alias("kept"))


def without_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, spared: float | None = None) -> DataFrame:
    """``docs`` with the kept lines as text and, where there is one, their length as n_chars.

    Null texts stay null; empty and very long texts are as in ``drop_boilerplate``.
    """
    out = drop_boilerplate(docs, min_sites, spared=spared).withColumn("now", F.array_join("kept", "\n"))
    fresh = {"text": F.col("now"), "n_chars": F.length("now").cast("bigint")}
    return out.select(*[fresh[c].alias(c) if c in fresh else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
