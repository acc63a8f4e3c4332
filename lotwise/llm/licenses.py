"""License scans: ordered signature rules with a keyword prefilter.

A text becomes its words, each between blanks of its own, so that a signature
is a regex over whole words and two matches never share a blank.  Only texts
that hold a keyword are looked at, and only with the signatures of the keywords
they hold.  Of overlapping detections those go that lie inside one of a surer
or equal priority.  All of it happens within the row: nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.llm.folds import before_each, bound, in_chunks, spans
from lotwise.llm.license_rules import BASE, WEIGHTS, Signature, compiled, signatures

#: Words are runs of these once A-Z is lowered, so letters of either case; the others stand between words.
INSIDE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
OTHERS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_count(text: Column) -> Column:
    """Number of words: of each word its first character stays, and nothing else."""
    return F.length(F.regexp_replace(text, f"{OTHERS}*+({INSIDE}){INSIDE}*+|{OTHERS}++", "$1")).cast("bigint")


def padded(text: Column) -> Column:
    """The words of a text with A-Z lowered, each between blanks of its own (a text with words)."""
    bare = F.btrim(F.regexp_replace(text, f"{OTHERS}+", "  "), F.lit(" "))
    return F.translate(F.concat(F.lit(" "), bare, F.lit(" ")), UPPER, LOWER)


def padded_count(line: Column) -> Column:
    """Number of words in a part of a padded text."""
    return F.floor((F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))) / 2).cast("bigint")


def _branches(words: list[str]) -> str:
    """Regex for one of the words that reads every shared beginning once."""
    if words == [""]:
        return ""
    by_letter: dict[str, list[str]] = {}
    for w in words:
        by_letter.setdefault(w[:1], []).append(w[1:])
    parts = [k + _branches(v) if k else "" for k, v in by_letter.items()]
    return f"(?:{'|'.join(parts)})" if len(parts) > 1 else parts[0]


def has_keyword(text: Column, words: set[str]) -> Column:
    """Whether the text may hold one of the words, in any case."""
    around = F.concat(F.lit(" "), F.lower(text), F.lit(" "))
    return around.rlike(OTHERS + _branches(sorted(words)) + OTHERS)


def places(line: Column, pattern: Column) -> Column:
    """Spans, in words, of the pattern's matches in a padded text, leftmost first."""
    gaps, hits = F.split(line, pattern, -1), F.regexp_extract_all(line, pattern, F.lit(0))
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits,
                       lambda gap, hit: F.struct(padded_count(gap).alias("gap"), padded_count(hit).alias("hit"), F.lit(True).alias("good")))
    return spans(steps)


def _table(rules: tuple[Signature, ...]) -> Column:
    """The signatures as one constant array (fixed size: they are part of the program)."""
    return F.array(*[F.struct(
        F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"), F.lit(i).alias("number"),
        F.lit(f" {r.keyword} ").alias("keyword"), F.lit(r.literal).alias("literal"), F.lit(r.pattern).alias("pattern")) for i, r in enumerate(rules)])


def detections(line: Column, rules: tuple[Signature, ...]) -> Column:
    """Array of (start, order, priority, number, stop, label) before suppression, in the order of the sweep."""
    chosen = F.filter(_table(rules), lambda r: F.contains(line, r["keyword"]) & F.contains(line, r["literal"]))
    found = F.transform(chosen, lambda r: F.transform(places(line, r["pattern"]), lambda s: F.struct(
        s["start"].alias("start"), (-s["stop"]).alias("order"), r["priority"].alias("priority"),
        r["number"].alias("number"), s["stop"].alias("stop"), r["label"].alias("label"))))
    return F.sort_array(F.flatten(found))


def suppressed(found: Column, priorities: tuple[int, ...]) -> Column:
    """Detections that no other one of a surer or equal priority contains.

    In order of start, longest first, whatever contains a detection comes before
    it, so the furthest stop per priority so far decides.
    """
    out = "array<struct<start:bigint,order:bigint,priority:int,number:int,stop:bigint,label:string>>"
    fars = [f"far{p}" for p in priorities]
    kind = f"struct<{','.join(f'{x}:bigint' for x in fars)}>"
    nowhere = F.struct(*[F.lit(-1).cast("bigint").alias(x) for x in fars])

    def further(far, d):
        return F.struct(*[F.when(d["priority"] == p, F.greatest(far[x], d["stop"])).otherwise(far[x]).alias(x)
                          for p, x in zip(priorities, fars, strict=True)])

    def furthest(one, other):
        return F.struct(*[F.greatest(one[x], other[x]).alias(x) for x in fars])

    def add(acc, d):
        inside = F.lit(False)
        for p, x in zip(priorities, fars, strict=True):
            inside = inside | ((d["priority"] >= p) & (acc["far"][x] >= d["stop"]))
        return F.struct(further(acc["far"], d).alias("far"),
                        F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], F.array(d))).cast(out).alias("out"))

    def of_chunk(chunk, far):
        return F.aggregate(chunk, F.struct(far.alias("far"), F.array().cast(out).alias("out")), add, lambda acc: acc["out"])

    def all_chunks(chunks):
        reached = F.transform(chunks, lambda c: F.aggregate(c, nowhere, further))
        return F.flatten(F.zip_with(chunks, before_each(reached, nowhere, kind, furthest), of_chunk))

    return bound(in_chunks(found), lambda chunks: F.when(F.size(chunks) == 1, of_chunk(F.element_at(chunks, 1), nowhere)).otherwise(all_chunks(chunks)))


def scan_licenses(docs: DataFrame, rules: tuple[Signature, ...] | None = None, text_column: str = "text",
                  keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (all but the text if None), with n_words, base, kept and score.

    * ``base``: (phrase label, start) of the base phrases, by label and place.
    * ``kept``: detections left by suppression.  ``score``: the weight of the surest, 0 without any.

    Null and empty texts have no words and no detections; equal rows have equal
    results; an empty table gives an empty one.  Other columns pass unchanged
    inside the struct ``row``, also those with a dot in their name.  Time grows
    with the length of a text and with its detections, however many there are.
    """
    rules = signatures() if rules is None else rules
    priorities = tuple(sorted({r.priority for r in rules}))
    keep = [c for c in docs.columns if c != text_column] if keep is None else keep
    text = F.coalesce(F.col(text_column), F.lit(""))
    gate = has_keyword(text, {r.keyword for r in rules} | {max(p.split(), key=len) for p in BASE})
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), word_count(text).alias("n_words"),
                       F.when(gate, padded(text)).alias("line"))
    line = F.col("line")
    none_base = F.array().cast("array<struct<label:string,start:bigint>>")
    none = F.array().cast("array<struct<start:bigint,order:bigint,priority:int,number:int,stop:bigint,label:string>>")

    def labelled(phrase, label):
        pattern = compiled(phrase)
        found = F.transform(places(line, F.lit(pattern)), lambda s: F.struct(F.lit(label).alias("label"), s["start"].alias("start")))
        return F.when(F.contains(line, F.lit(pattern)), found).otherwise(none_base)

    base = F.flatten(F.array(*[labelled(phrase, label) for phrase, label in BASE.items()]))
    weight = F.create_map(*[x for p in priorities for x in (F.lit(p), F.lit(WEIGHTS[p]))])
    out = rows.select("row", "n_words", F.when(line.isNotNull(), F.struct(
        base.alias("base"), suppressed(detections(line, rules), priorities).alias("kept"))).alias("found"))
    out = out.select("row", "n_words", F.coalesce("found.base", none_base).alias("base"), F.coalesce("found.kept", none).alias("kept"))
    best = F.array_min(F.transform("kept", lambda d: d["priority"]))
    return out.withColumn("score", F.coalesce(weight[best], F.lit(0.0)))
