"""Language identification by error-correcting output codes.

Every language has a codeword.  One binary classifier per bit, linear in hashed
character n-grams, tells the languages with that bit set from the others.  The
bits' margins are decoded to the codeword of least weighted loss; a bit that
was often wrong in training weighs less, and a small lead marks the document as
ambiguous.

The classifiers come from n-gram counts per language, which are sums over all
training documents; a second pass over them measures every bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

BUCKETS = 8192
ORDERS = (1, 2, 3)
SLICE_CHARS = 1_000_000
SLICE_TEXTS = 128
#: A lead in probability below this marks a document as ambiguous.
AMBIGUOUS = 0.2
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(counts per text and bucket, letters per text).  Runs of other characters count as one blank."""
    letters = _letters()
    parts, letter_counts = [], np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint32)
        is_letter = letters[codes]
        letter_counts[i] = is_letter.sum()
        codes = np.where(is_letter, codes, np.uint32(32))
        if len(codes):
            codes = codes[np.concatenate([[True], is_letter[1:] | is_letter[:-1]])]
        parts.append(codes)
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    flat = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int64) * BUCKETS, sizes)
    counts = np.zeros(len(texts) * BUCKETS, dtype=np.int64)
    hashed = np.zeros(len(flat), dtype=np.uint32)
    for order in range(1, max(ORDERS) + 1):
        hashed = hashed[:len(flat) - order + 1] * np.uint32(0x9E3779B1) + flat[order - 1:]
        if order in ORDERS and len(hashed):
            mixed = hashed ^ (hashed >> np.uint32(15))
            bucket = (mixed * np.uint32(0x85EBCA6B) + np.uint32(order)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
            same = owner[:len(hashed)] == owner[order - 1:]
            counts += np.bincount(owner[:len(hashed)][same] + bucket[same], minlength=len(counts))
    return counts.reshape(len(texts), BUCKETS), letter_counts


def slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLICE_CHARS or i + 1 - start >= SLICE_TEXTS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def codewords(languages: int) -> np.ndarray:
    """Rows of +1 and -1: every division in two up to six languages, else the best of many random codes."""
    if languages <= 6:
        splits = range(1, 2 ** max(languages - 1, 1))
        return np.array([[1 if i == 0 or not (s >> (i - 1)) & 1 else -1 for s in splits] for i in range(languages)])
    draw = np.random.default_rng(5)
    bits = int(np.ceil(15 * np.log2(languages)))
    best, most = None, -1
    for _ in range(200):
        code = draw.choice([-1, 1], (languages, bits))
        apart = (bits - code @ code.T) // 2
        least = (apart + np.eye(languages, dtype=np.int64) * bits).min()
        if least > most and (np.abs(code.sum(0)) < languages).all():
            best, most = code, least
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray            # languages x bits
    weights: np.ndarray         # buckets x bits
    scale: np.ndarray           # typical size of a bit's margin
    trust: np.ndarray           # weight of a bit's loss, 1 on average

    def margins(self, counts: np.ndarray) -> np.ndarray:
        total = np.maximum(counts.sum(1, keepdims=True), 1)
        return (counts.astype(np.float32) @ self.weights) / total

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number, score, ambiguous) of every row of margins."""
        signed = margins[:, None, :] * self.code[None, :, :] / self.scale
        loss = (np.logaddexp(0, -4 * signed) * self.trust).mean(2)
        odds = np.exp(-2 * (loss - loss.min(1, keepdims=True)))
        share = odds / odds.sum(1, keepdims=True)
        ordered = np.sort(share, axis=1)
        lead = ordered[:, -1] - (ordered[:, -2] if share.shape[1] > 1 else 0)
        return share.argmax(1), ordered[:, -1], lead < AMBIGUOUS


def fit(train: DataFrame, text_column: str = "text", lang_column: str = "lang") -> LanguageModel:
    """Learn from all rows with a language and a text.

    What reaches the driver is one number per language and bucket, whatever the
    number of rows.
    """
    rows = train.where(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(text_column).alias("text"), F.col(lang_column).alias("lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), np.array(batch.column("lang").to_pylist(), dtype=object)
            for a, b in slices(texts):
                counts, _ = gram_counts(texts[a:b])
                for lang in set(langs[a:b]):
                    sums[lang] = sums.get(lang, 0) + counts[langs[a:b] == lang].sum(0)
        for lang, total in sums.items():
            there = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(there), pa.string()), pa.array(there, pa.int32()), pa.array(total[there], pa.int64())],
                names=["lang", "bucket", "n"])

    summed = rows.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = summed.toPandas()
    languages = sorted(table["lang"].unique())
    counts = np.zeros((len(languages), BUCKETS))
    place = {x: i for i, x in enumerate(languages)}
    counts[table["lang"].map(place).to_numpy(dtype=int), table["bucket"].to_numpy()] = table["n"].to_numpy()
    code = codewords(len(languages)) if languages else np.zeros((0, 1), dtype=int)
    shares = (counts + 0.1) / (counts + 0.1).sum(1, keepdims=True)
    weights = np.zeros((BUCKETS, code.shape[1]), dtype=np.float32)
    for bit in range(code.shape[1]):
        yes, no = shares[code[:, bit] > 0], shares[code[:, bit] < 0]
        if len(yes) and len(no):
            weights[:, bit] = np.log(yes.mean(0)) - np.log(no.mean(0))
        elif len(yes):
            weights[:, bit] = 1
    model = LanguageModel(languages, code, weights, np.ones(code.shape[1]), np.ones(code.shape[1]))
    if not languages:
        return model

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, size, n = np.zeros(code.shape[1]), np.zeros(code.shape[1]), 0
        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for a, b in slices(texts):
                margins = model.margins(gram_counts(texts[a:b])[0])
                signed = margins * code[[place[x] for x in langs[a:b]]]
                right, size, n = right + (signed > 0).sum(0), size + np.abs(margins).sum(0), n + len(margins)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(right)), pa.int32()), pa.array(right), pa.array(size), pa.array([n] * len(right), pa.int64())],
            names=["bit", "correct", "size", "n"])

    bits = (rows.mapInArrow(measure, "bit int, correct double, size double, n bigint").groupBy("bit")
            .agg(F.sum("correct").alias("correct"), F.sum("size").alias("size"), F.sum("n").alias("n")).toPandas().sort_values("bit"))
    n = np.maximum(bits["n"].to_numpy(dtype=float), 1)
    wrong = (n - bits["correct"].to_numpy() + 1) / (n + 2)
    trust = np.maximum(np.log((1 - wrong) / wrong), 0.05)
    model.trust = trust / trust.mean()
    model.scale = np.maximum(bits["size"].to_numpy() / n, 1e-9)
    return model


def predict(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """(row struct, lang_pred, score, ambiguous) of every row; ``row`` has all columns but the text.

    Null texts and texts without a letter are ``und`` with score 0, as is every
    text when nothing was learnt.  Rows with the same text have the same
    result, ties go to the first language by name, an empty table gives an
    empty one.
    """
    rest = [c for c in docs.columns if c != text_column]
    row = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(row.alias("row"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    schema = StructType([rows.schema["row"], StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                         StructField("ambiguous", BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts):
                counts, letters = gram_counts(texts[a:b])
                known = (letters > 0) & bool(model.languages)
                names, scores = np.full(b - a, UNKNOWN, dtype=object), np.zeros(b - a)
                unsure = np.ones(b - a, dtype=bool)
                if known.any():
                    best, share, close = model.decode(model.margins(counts[known]))
                    names[known] = np.array(model.languages, dtype=object)[best]
                    scores[known], unsure[known] = share, close
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(a, b - a), pa.array(names, pa.string()), pa.array(scores), pa.array(unsure)],
                    names=["row", "lang_pred", "score", "ambiguous"])

    return rows.mapInArrow(run, schema)


def held_out(id_column: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % parts == part
