"""Description scores: TF-IDF of word 2-3-grams, standardised, projected on principal components."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from lotwise import fixed_values as fx
from lotwise.functions.text import fold_letters
from lotwise.operators.fitted import FitStep, FittedModel
from lotwise.session import materialize, materialize_counted

FIRST_WORDS = 8192        # words whose 2-grams are counted first
MOST_HEADS = 200_000      # words, or 2-grams, that tasks are told to count


def text_words(text: Column) -> Column:
    """Words of two letters or more, lower case, accents removed."""
    return F.regexp_extract_all(fold_letters(F.coalesce(text, F.lit(""))), F.lit(r"(?U)\b(\w\w+)\b"), F.lit(1))


def joined_grams(words: Column) -> Column:
    """2- and 3-grams of an array of words, joined by one space."""
    def joined(w, n):
        starts = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - (n - 1)))
        return F.transform(F.coalesce(starts, F.array().cast("array<int>")),
                           lambda i: F.array_join(F.slice(w, i, F.lit(n)), " "))
    # the outer lambda binds the words: they are found once, not once per gram
    return F.transform(F.array(words), lambda w: F.concat(joined(w, 2), joined(w, 3)))[0]


def _known_grams(words: pa.ListArray, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(document, term place) of every 2- and 3-gram that is a known term."""
    flat = words.flatten()
    doc = np.repeat(np.arange(len(words), dtype=np.int64), np.diff(words.offsets.to_numpy()))
    docs, terms = [], []
    for n in (2, 3):
        if len(flat) < n:
            continue
        shifted = [flat.slice(i, len(flat) - n + 1) for i in range(n)]
        places = pc.index_in(pc.binary_join_element_wise(*shifted, " "), value_set=names)
        whole = (doc[:len(doc) - n + 1] == doc[n - 1:]) & places.is_valid().to_numpy(zero_copy_only=False)
        docs.append(doc[:len(doc) - n + 1][whole])
        terms.append(places.fill_null(0).to_numpy().astype(np.int64)[whole])
    empty = np.array([], dtype=np.int64)
    return np.concatenate(docs or [empty]), np.concatenate(terms or [empty])


def word_counts(words: DataFrame) -> DataFrame:
    """Word counts: (word, uses)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = pc.value_counts(batch.column("words").flatten())
            yield pa.RecordBatch.from_arrays([seen.field("values"), seen.field("counts")], names=["word", "uses"])

    return words.mapInArrow(run, "word string, uses bigint").groupBy("word").agg(F.sum("uses").alias("uses"))


def _gram_codes(words: pa.ListArray, names: pa.Array, n: int, heads: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(document, code) of every n-gram of the words ``names``; a 3-gram counts if both its 2-grams are in ``heads``.

    The code of a 2-gram is made of its words' places, that of a 3-gram of the place of its first 2-gram and its last word.
    """
    flat, many = words.flatten(), len(names)
    doc = np.repeat(np.arange(len(words), dtype=np.int64), np.diff(words.offsets.to_numpy()))
    place = pc.index_in(flat, value_set=names).fill_null(-1).to_numpy().astype(np.int64)
    good = (place[:-1] >= 0) & (place[1:] >= 0) & (doc[:-1] == doc[1:])
    pair = place[:-1] * many + place[1:]
    if n == 2:
        return doc[:-1][good], pair[good]
    at = np.searchsorted(heads, pair)
    good &= heads[np.minimum(at, len(heads) - 1)] == pair if len(heads) else False
    whole = good[:-1] & good[1:]
    return doc[:-2][whole], (at[:-1] * many + place[2:])[whole]


def gram_counts(words: DataFrame, names: list[str], n: int, heads: np.ndarray | None = None) -> DataFrame:
    """(code, uses, docs) of the n-grams of the words ``names``; see ``_gram_codes``."""
    known = pa.array(names, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, code = _gram_codes(batch.column("words"), known, n, heads)
            code, at, uses = np.unique(code, return_inverse=True, return_counts=True)
            once = np.unique(doc * max(len(code), 1) + at)
            docs = np.bincount(once % max(len(code), 1), minlength=len(code))
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(uses.astype(np.int64)), pa.array(docs.astype(np.int64))], names=["code", "uses", "docs"])

    return (words.mapInArrow(run, "code bigint, uses bigint, docs bigint")
            .groupBy("code").agg(F.sum("uses").alias("uses"), F.sum("docs").alias("docs")))


def frequent_terms(words: DataFrame, rows: int, limit: int, min_df: int, max_df: float,
                   first: int = FIRST_WORDS, most: int = MOST_HEADS) -> list[tuple[str, int]]:
    """(term, df) of the most used 2- and 3-grams within the document-frequency limits; ``limit`` bounds the list.

    A gram is never used more often than a word or a 2-gram in it.  The 2-grams
    of the most used words give a number of uses that the last term of the list
    reaches at least, so only 2-grams of words and 3-grams of 2-grams that reach
    it are counted.  Where that leaves more than ``most`` of them, all grams are
    counted as texts.
    """
    def kept(counts):
        return counts.where((F.col("docs") >= min_df) & (F.col("docs") <= max_df * rows))

    counted = materialize(word_counts(words), "words")
    ranked = counted.orderBy(F.desc("uses"), "word").limit(first + 1).collect()
    names, rest = [r["word"] for r in ranked[:first]], ranked[first]["uses"] if len(ranked) > first else 0
    pairs = materialize(gram_counts(words, names, 2), "pairs")
    last = kept(pairs).orderBy(F.desc("uses")).limit(limit).select("uses").collect()
    least = last[-1]["uses"] if len(last) == limit else 1
    if rest >= least:
        if counted.where(F.col("uses") >= least).limit(most + 1).count() > most:
            return _frequent_texts(words, kept, limit)
        names = [r["word"] for r in counted.where(F.col("uses") >= least).orderBy("word").collect()]
        pairs = materialize(gram_counts(words, names, 2), "pairs")
    often = pairs.where(F.col("uses") >= least)
    if often.limit(most + 1).count() > most:
        return _frequent_texts(words, kept, limit)
    heads = np.sort(np.array([r["code"] for r in often.select("code").collect()], dtype=np.int64))
    many = max(len(names), 1)

    def listed(counts):
        return kept(counts.where(F.col("uses") >= least))

    def text(head, *more):
        return " ".join([names[head // many], names[head % many], *more])

    # grams that tie with the last one are all looked at, as their texts decide
    two, three = (_top(listed(x), limit, most) for x in (pairs, gram_counts(words, names, 3, heads)))
    if len(two) > most or len(three) > most:
        return _frequent_texts(words, kept, limit)
    found = [(text(r["code"]), r["uses"], r["docs"]) for r in two]
    found += [(text(int(heads[r["code"] // many]), names[r["code"] % many]), r["uses"], r["docs"]) for r in three]
    return [(term, docs) for term, _, docs in sorted(found, key=lambda x: (-x[1], x[0].encode()))[:limit]]


def _top(counts: DataFrame, limit: int, most: int) -> list:
    """The rows that no ``limit`` others surpass in uses, or more than ``most`` of them."""
    counts = materialize(counts, "counts")
    last = counts.orderBy(F.desc("uses")).limit(limit).agg(F.min("uses")).first()[0]
    return counts.where(F.col("uses") >= (last or 0)).limit(most + 1).collect()


def _frequent_texts(words: DataFrame, kept, limit: int) -> list[tuple[str, int]]:
    """The same list from counts of every gram."""
    terms = words.select(joined_grams(F.col("words")).alias("terms"))
    uses = terms.select(F.explode("terms").alias("term"), F.lit(1).alias("uses"), F.lit(0).alias("docs"))
    docs = terms.select(F.explode(F.array_distinct("terms")).alias("term"), F.lit(0).alias("uses"), F.lit(1).alias("docs"))
    counts = uses.unionByName(docs).groupBy("term").agg(F.sum("uses").alias("uses"), F.sum("docs").alias("docs"))
    return [(r["term"], r["docs"]) for r in kept(counts).orderBy(F.desc("uses"), "term").limit(limit).collect()]


def _terms_of(names: list[str]):
    """Words -> the 2- and 3-grams among them that are in ``names``."""
    known = pa.array(names, pa.string())

    @F.arrow_udf(ArrayType(StringType()))
    def terms(words: pa.Array) -> pa.Array:
        doc, term = _known_grams(words, known)
        order = np.argsort(doc, kind="stable")
        ends = np.append(0, np.cumsum(np.bincount(doc, minlength=len(words)))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), known.take(pa.array(term[order])))
    return terms


class DescriptionScores(FitStep):
    """Adds embed_1 .. embed_k.

    The rows stay sparse: scaling and centring are folded into the projection.
    Components come from the correlation matrix of at most ``terms`` columns,
    summed up by the executors.  A component's sign makes its largest loading
    positive.
    """

    def __init__(self, k: int = fx.EMBED_COMPONENTS, text: str = fx.TEXT, terms: int = fx.EMBED_TERMS,
                 min_df: int = fx.EMBED_MIN_DF, max_df: float = fx.EMBED_MAX_DF):
        super().__init__(k=k, text=text, terms=terms, min_df=min_df, max_df=max_df)

    def _fit(self, df):
        s = self.settings
        if s["text"] not in df.columns:
            raise ValueError(f"missing column {s['text']!r}")
        words, n = materialize_counted(df.select(text_words(F.col(f"`{s['text']}`")).alias("words")), "words")
        found = frequent_terms(words, n, s["terms"], s["min_df"], s["max_df"])
        if not found:
            raise ValueError("no term lies within the document-frequency limits")
        names = [term for term, _ in found]
        idf = [math.log((1 + n) / (1 + docs)) + 1 for _, docs in found]
        docs = words.select(_terms_of(names)("words").alias("terms"))
        counted = CountVectorizerModel.from_vocabulary(names, inputCol="terms", outputCol="tf").transform(docs)
        weighted = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="tf", outputCol="w").transform(counted)
        # written once: the moments and the correlation read the vectors several times
        unit = materialize(Normalizer(p=2.0, inputCol="w", outputCol="v").transform(weighted).select("v"), "vectors")
        moments = unit.select(Summarizer.metrics("mean", "variance").summary(F.col("v")).alias("m")).first()["m"]
        mean = moments["mean"].toArray()
        deviation = np.sqrt(moments["variance"].toArray() * (n - 1) / n)
        deviation[deviation == 0] = 1.0
        if len(names) > 1:
            matrix = np.nan_to_num(Correlation.corr(unit, "v").first()[0].toArray())
        else:
            matrix = np.ones((1, 1))
        values, axes = np.linalg.eigh(matrix)
        order = np.argsort(-values, kind="stable")[:s["k"]]
        axes = axes[:, order]
        axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
        axes = np.pad(axes, ((0, 0), (0, s["k"] - axes.shape[1])))
        rows = [(i, name, float(idf[i]), float(mean[i]), float(deviation[i]), axes[i].tolist())
                for i, name in enumerate(names)]
        table = df.sparkSession.createDataFrame(
            rows, "place int, term string, idf double, mean double, deviation double, loadings array<double>")
        share = [float(v) for v in np.maximum(values[order], 0) / max(values.sum(), 1e-300)]
        return DescriptionScoresModel(s | {"variance_share": share}, {"terms": table})


class DescriptionScoresModel(FittedModel):
    def projection(self):
        rows = sorted(self.tables["terms"].collect(), key=lambda r: r["place"])      # at most ``terms`` rows
        names = pa.array([r["term"] for r in rows])
        idf = np.array([r["idf"] for r in rows])
        axes = np.array([r["loadings"] for r in rows]) / np.array([r["deviation"] for r in rows])[:, None]
        offset = np.array([r["mean"] for r in rows]) @ axes

        @F.arrow_udf(ArrayType(DoubleType()))
        def project(words: pa.Array) -> pa.Array:
            doc, term = _known_grams(words, names)
            cell, tf = np.unique(doc * len(idf) + term, return_counts=True)
            doc, term = cell // len(idf), cell % len(idf)
            weight = tf * idf[term]
            length = np.sqrt(np.bincount(doc, weights=weight ** 2, minlength=len(words)))
            length[length == 0] = 1.0
            scores = np.stack([np.bincount(doc, weights=weight * axes[term, j], minlength=len(words)) / length - offset[j]
                               for j in range(axes.shape[1])], axis=1)
            ends = np.arange(len(words) + 1, dtype=np.int32) * axes.shape[1]
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(scores.reshape(-1)))
        return project

    def apply(self, df):
        s = self.settings
        if s["k"] == 0:
            return df
        scored = df.withColumn("_e", self.projection()(text_words(F.col(f"`{s['text']}`"))))
        return scored.withColumns({f"embed_{j + 1}": F.col("_e")[j] for j in range(s["k"])}).drop("_e")

    def first(self, k: int) -> "DescriptionScoresModel":
        """The same fit with its first k components only."""
        terms = self.tables["terms"].withColumn("loadings", F.slice("loadings", 1, k))
        return DescriptionScoresModel(self.settings | {"k": k}, {"terms": terms})
