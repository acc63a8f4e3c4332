"""Secret scans with an incremental ledger of blobs.

Every version of a text is addressed by its content.  The ledger remembers
which blob was scanned with which version of which rule.  A scan takes the
distinct blobs, leaves out the pairs of blob and rule version that the ledger
has, scans the rest, and appends what it found, so a text that comes back under
another path, or a second scan with one changed rule, costs next to nothing.
Findings reach all paths by a join on the blob.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lotwise.llm.folds import SPANS, spans


@dataclass(frozen=True)
class Rule:
    """One kind of secret.  A match counts if its ``group`` has ``least`` characters or more."""
    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# Letters in either case are spelled out, since engines differ in what folds to them.
_WORDS = ("[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
          "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]")
ASSIGN = rf"""({_WORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (
    Rule("assign", ASSIGN, group=2, least=6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),        # a run of fewer characters has no longer match inside
    Rule("hex", "[0-9a-f]{24,}"),
)
RULES = BASE + (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", "[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("url", r"[a-z][a-z0-9+.-]{1,20}://[^\x00-\x20/:@]{1,100}:[^\x00-\x20/:@]{3,100}@"),
)


def spans_of(text: Column, rule: Rule) -> Column:
    """Spans of the rule's matches in code points, leftmost first, end exclusive.

    The text between the matches and the matches themselves take turns, so the
    running sum of their lengths gives the places.
    """
    pattern = F.lit(rule.pattern)
    gaps = F.split(text, rule.pattern, -1)
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    valued = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else hits
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), F.arrays_zip(hits.alias("hit"), valued.alias("value")),
                       lambda gap, h: F.struct(F.length(gap).cast("bigint").alias("gap"), F.length(h["hit"]).cast("bigint").alias("hit"),
                                               (F.length(h["value"]) >= rule.least).alias("good")))
    found = spans(steps)
    return F.when(text.rlike(rule.pattern), found).otherwise(F.array().cast(SPANS))


def seen(ledger: DataFrame) -> DataFrame:
    """(blob, rules): the rule versions each blob was scanned with."""
    return ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("rules"))


def scan(versions: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...] = RULES,
         text_column: str = "text") -> DataFrame:
    """New ledger rows (blob, rules, findings) for the pairs that ``ledger`` lacks.

    ``rules`` names the rule versions scanned now, ``findings`` has their spans,
    in the order of ``rules``.  A blob without findings has a row as well: it is
    known to be clean.  Null text is the empty blob.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    blobs = versions.select(F.sha2(text, 256).alias("blob"), text.alias("text")).groupBy("blob").agg(
        F.first("text").alias("text"))
    names = F.array(*[F.lit(r.name) for r in rules])
    if ledger is None:
        todo = blobs.withColumn("todo", names)
    else:
        todo = (blobs.join(seen(ledger), "blob", "left")
                .withColumn("todo", F.array_except(names, F.coalesce("rules", F.array().cast("array<string>")))).drop("rules")
                .where(F.size("todo") > 0))
    findings = F.array(*[
        F.when(F.array_contains("todo", F.lit(r.name)),
               F.struct(F.lit(r.name).alias("rule"), spans_of(F.col("text"), r).alias("spans"))) for r in rules])
    return todo.select("blob", F.col("todo").alias("rules"),
                       F.filter(findings, lambda x: x.isNotNull() & (F.size(x["spans"]) > 0)).alias("findings"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger below ``path``, or None before the first scan."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
    return spark.read.parquet(path) if there else None


def update_ledger(versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, text_column: str = "text") -> DataFrame:
    """Scan what the ledger below ``path`` lacks, append it, and return the whole ledger."""
    spark = versions.sparkSession
    scan(versions, read_ledger(spark, path), rules, text_column).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def findings(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES,
             text_column: str = "text") -> DataFrame:
    """(row struct, found) of every version; ``found`` has (start, rule number, kind, stop), in order.

    Only the given rule versions count, whatever else the ledger knows.  The
    join is on the blob; a blob with very many paths is a skewed key of the
    large side, which adaptive execution splits.

    Null and empty texts have no findings, equal texts have equal findings; an
    empty table gives an empty one; other columns travel in the struct, also
    those with a dot in their name.  Time grows with the length of a text and
    with its matches, however many there are.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    number = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))])
    kind = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.lit(r.kind))])
    wanted = F.array(*[F.lit(r.name) for r in rules])
    hit = (ledger.select("blob", F.explode("findings").alias("f")).where(F.array_contains(wanted, F.col("f.rule")))
           .select("blob", "f.rule", F.explode("f.spans").alias("s"))
           .groupBy("blob").agg(F.sort_array(F.collect_set(F.struct(
               F.col("s.start").alias("start"), number[F.col("rule")].alias("number"), kind[F.col("rule")].alias("kind"),
               F.col("s.stop").alias("stop")))).alias("found")))
    rows = versions.select(F.struct(*[F.col(f"`{c}`") for c in versions.columns if c != text_column]).alias("row"),
                           F.sha2(text, 256).alias("blob"))
    empty = F.array().cast("array<struct<start:bigint,number:int,kind:string,stop:bigint>>")
    return rows.join(hit, "blob", "left").select("row", "blob", F.coalesce("found", empty).alias("found"))


def spans_text(found: Column) -> Column:
    """kind:start:stop of every finding, joined by commas."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")
