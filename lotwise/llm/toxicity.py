"""Toxic spans by a linear-chain conditional random field.

The chain has two states, clean and toxic.  Its weights are for a token, its
neighbours and the change of state; they are fitted to labelled tokens.  The
tokens' labels come from the labels of documents: in a toxic document those
words are toxic that toxic documents hold far more often than others.

Forward-backward marginals of a text give its offending spans, and their
greatest value and sum give its score by a logistic fit to document labels.

Two-state messages are products of 2 x 2 matrices, so a batch of texts is cut
into chunks of equal length: products of all chunks, then the messages at their
ends, then all messages inside.  This is exact; nothing is cut off.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, StructField, StructType)

#: The fit reads so many labelled documents at most, those of least id hash, none longer than SAMPLE_CHARS.
SAMPLE_ROWS = 6000
SAMPLE_CHARS = 100_000
STEPS = 30
CHUNK = 64
BLOCK_TOKENS = 250_000
SLICE_CHARS = 2_000_000
TOKEN = re.compile(r"\w+")


def _matrices(unary: np.ndarray, first: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """(2, 2, n): step matrices; at the first token of a text both rows start afresh."""
    odds = np.exp(np.clip(unary, -30, 30))
    steps = np.empty((2, 2, len(unary)))
    for i in (0, 1):
        steps[i, 0] = np.where(first, 1.0, np.exp(moves[i, 0]))
        steps[i, 1] = np.where(first, np.exp(moves[2, 1]), np.exp(moves[i, 1])) * odds
    return steps


def messages(unary: np.ndarray, first: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(forward, backward, steps): normalised messages (2, n) of all texts laid end to end.

    ``unary`` is the log odds of the toxic state at each token, ``first`` marks
    the first token of a text, ``moves`` has the log weights of the changes of
    state in rows 0 and 1 and of the start in row 2.
    """
    n = len(unary)
    chunks = max(-(-n // CHUNK), 1)
    steps = np.zeros((2, 2, chunks * CHUNK))
    steps[0, 0, n:] = steps[1, 1, n:] = 1.0
    steps[:, :, :n] = _matrices(unary, first, moves)
    grid = np.ascontiguousarray(steps.reshape(2, 2, chunks, CHUNK).transpose(3, 0, 1, 2))

    whole = grid[0].copy()
    for t in range(1, CHUNK):
        m = grid[t]
        whole = np.stack([np.stack([whole[i, 0] * m[0, j] + whole[i, 1] * m[1, j] for j in (0, 1)]) for i in (0, 1)])
        whole /= whole.max(axis=(0, 1))
    ahead, behind = np.empty((2, chunks)), np.empty((2, chunks))
    a0, a1 = 0.5, 0.5
    rows = whole.transpose(2, 0, 1).reshape(chunks, 4).tolist()
    for c, (p, q, r, s) in enumerate(rows):
        ahead[0, c], ahead[1, c] = a0, a1
        a0, a1 = a0 * p + a1 * r, a0 * q + a1 * s
        total = a0 + a1
        a0, a1 = a0 / total, a1 / total
    b0, b1 = 0.5, 0.5
    for c in range(chunks - 1, -1, -1):
        behind[0, c], behind[1, c] = b0, b1
        p, q, r, s = rows[c]
        b0, b1 = p * b0 + q * b1, r * b0 + s * b1
        total = b0 + b1
        b0, b1 = b0 / total, b1 / total

    forward, backward = np.empty((CHUNK, 2, chunks)), np.empty((CHUNK, 2, chunks))
    now = ahead
    for t in range(CHUNK):
        m = grid[t]
        now = np.stack([now[0] * m[0, 0] + now[1] * m[1, 0], now[0] * m[0, 1] + now[1] * m[1, 1]])
        now = now / now.sum(0)
        forward[t] = now
    now = behind
    for t in range(CHUNK - 1, -1, -1):
        backward[t] = now
        m = grid[t]
        now = np.stack([m[0, 0] * now[0] + m[0, 1] * now[1], m[1, 0] * now[0] + m[1, 1] * now[1]])
        now = now / now.sum(0)

    def flat(x):
        return x.transpose(1, 2, 0).reshape(2, -1)[:, :n]

    return flat(forward), flat(backward), steps[:, :, :n]


def toxic_marginals(unary: np.ndarray, first: np.ndarray, moves: np.ndarray) -> np.ndarray:
    if not len(unary):
        return np.zeros(0)
    forward, backward, _ = messages(unary, first, moves)
    both = forward * backward
    return both[1] / both.sum(0)


@dataclass
class ToxicModel:
    words: dict[str, int]           # known words; 0 stands for all others
    weights: np.ndarray             # (3, words): token before, token, token after
    moves: np.ndarray               # (3, 2): changes of state and the start
    document: np.ndarray            # logistic weights: constant, greatest marginal, log of their sum, log of their share

    def unary(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        before, after = _neighbours(ids, first)
        return self.weights[0, before] + self.weights[1, ids] + self.weights[2, after]

    def ids(self, tokens: list[str]) -> list[int]:
        get = self.words.get
        return [get(t, 0) for t in tokens]


def _neighbours(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    before, after = np.zeros_like(ids), np.zeros_like(ids)
    before[1:] = np.where(first[1:], 0, ids[:-1])
    after[:-1] = np.where(first[1:], 0, ids[1:])
    return before, after


def document_features(marginals: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(texts, 4) of the marginals of texts laid end to end; a text without tokens has zeros."""
    out = np.zeros((len(sizes), 4))
    out[:, 0] = 1
    full = np.flatnonzero(sizes)
    if len(full):
        starts = (np.cumsum(sizes) - sizes)[full]
        total = np.add.reduceat(marginals, starts)
        out[full, 1] = np.maximum.reduceat(marginals, starts)
        out[full, 2] = np.log1p(total)
        out[full, 3] = np.log1p(100 * total / sizes[full])
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], 0.1)
    for _ in range(30):
        p = _sigmoid(x @ w)
        w -= np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(keep), x.T @ (p - y) + keep * w)
    return w


def fit_tokens(texts: Iterable[str], toxic: np.ndarray, steps: int = STEPS) -> ToxicModel:
    """Fit the chain and the document score to texts and their labels."""
    codes: dict[str, int] = {}
    docs = [np.array([codes.setdefault(t, len(codes)) for t in TOKEN.findall(text.lower())], dtype=np.int32)
            for text in texts]
    counts = np.zeros((2, len(codes)))
    for tokens, label in zip(docs, toxic.tolist(), strict=True):
        counts[label, np.unique(tokens)] += 1
    clean, bad = counts
    n1, n0 = max(int(toxic.sum()), 1), max(int((1 - toxic).sum()), 1)
    # Far more frequent in toxic documents, by more than four standard deviations of the count.
    expected = (clean + bad) * n1 / (n0 + n1)
    marked = (bad >= 3) & (bad / n1 > 4 * (clean + 1) / (n0 + 1)) & (bad - expected > 4 * np.sqrt(expected))
    known = marked | (clean + bad >= 5)
    place = np.where(known, np.cumsum(known), 0)
    words = {t: int(place[i]) for t, i in codes.items() if known[i]}
    model = ToxicModel(words, np.zeros((3, len(words) + 1)), np.zeros((3, 2)), np.zeros(4))
    model.weights[1] = -4.0                     # where the fit starts and what the ridge draws to
    model.weights[1, place[marked]] = 2.0
    blocks, start, size = [], 0, 0
    for k, tokens in enumerate(docs):
        size += len(tokens)
        if size >= BLOCK_TOKENS or k + 1 == len(docs):
            part = docs[start:k + 1]
            sizes = np.array([len(t) for t in part], dtype=np.int64)
            flat = np.concatenate(part)
            first = np.zeros(len(flat), dtype=bool)
            first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
            label = np.repeat(toxic[start:k + 1], sizes) * marked[flat]
            blocks.append((place[flat], first, label, sizes))
            start, size = k + 1, 0
    _fit_chain(model, [b for b in blocks if len(b[0])], steps)
    if docs:
        features = np.concatenate([document_features(toxic_marginals(model.unary(i, f), f, model.moves), sizes)
                                   for i, f, _, sizes in blocks])
        model.document = _logistic(features, toxic.astype(float))
    return model


def _fit_chain(model: ToxicModel, blocks: list[tuple], steps: int) -> None:
    """Maximum likelihood with a ridge, by Adam on all tokens; the gradient is summed over blocks of texts."""
    size, n = model.weights.shape[1], max(sum(len(b[0]) for b in blocks), 1)
    means = [np.zeros_like(model.weights), np.zeros_like(model.moves)]
    squares = [np.zeros_like(model.weights), np.zeros_like(model.moves)]
    prior = model.weights.copy()
    for step in range(1, steps + 1):
        grads, moves = 0.05 * (prior - model.weights), -0.05 * model.moves
        for ids, first, labels, _ in blocks:
            before, after = _neighbours(ids, first)
            forward, backward, matrices = messages(model.unary(ids, first), first, model.moves)
            both = forward * backward
            gamma = both[1] / both.sum(0)
            miss = labels - gamma
            grads += np.stack([np.bincount(x, miss, size) for x in (before, ids, after)])
            later = np.flatnonzero(~first)
            pair = forward[:, None, later - 1] * matrices[:, :, later] * backward[None, :, later]
            pair /= pair.sum((0, 1))
            moves[:2] -= pair.sum(2)
            moves[2] -= [(1 - gamma)[first].sum(), gamma[first].sum()]
            state = labels.astype(int)
            np.add.at(moves, (np.where(first, 2, np.roll(state, 1)), state), 1)
        for k, (value, grad) in enumerate(((model.weights, grads), (model.moves, moves))):
            means[k] = 0.9 * means[k] + 0.1 * grad
            squares[k] = 0.99 * squares[k] + 0.01 * grad ** 2
            value += 0.25 * (means[k] / (1 - 0.9 ** step)) / (np.sqrt(squares[k] / (1 - 0.99 ** step)) + 1e-6 * n)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_column: str = "doc_id",
        text_column: str = "text", label_column: str = "toxic") -> ToxicModel:
    """Learn from at most ``sample_rows`` labelled documents.

    A document with several labels counts as toxic if one of them says so; null
    labels and ids are left out.  Without any labelled text the score of every
    document is 0.5.
    """
    chosen = (labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
              .groupBy(F.col(id_column).alias("id")).agg(F.max(label_column).alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(sample_rows))
    # At most sample_rows pairs of numbers, hence the broadcast.
    sample = (docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
              .where(F.col("text").isNotNull() & (F.length("text") <= SAMPLE_CHARS))
              .join(F.broadcast(chosen), "id").orderBy(F.xxhash64("id"), "id").limit(sample_rows).toPandas())
    return fit_tokens(sample["text"], sample["label"].to_numpy(dtype=int).clip(0, 1))


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLICE_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def score_texts(model: ToxicModel, texts: list[str]) -> tuple[np.ndarray, list[list[dict]]]:
    """Score and toxic spans (start, stop, p; code points) of every text."""
    tokens = [TOKEN.findall(t.lower()) for t in texts]
    sizes = np.array([len(t) for t in tokens], dtype=np.int64)
    ids = np.array([i for t in tokens for i in model.ids(t)], dtype=np.int64)
    first = np.zeros(len(ids), dtype=bool)
    begins = np.cumsum(sizes) - sizes
    first[begins[sizes > 0]] = True
    marginals = toxic_marginals(model.unary(ids, first), first, model.moves)
    scores = _sigmoid(document_features(marginals, sizes) @ model.document)
    spans: list[list[dict]] = [[] for _ in texts]
    flagged = np.flatnonzero(marginals >= 0.5)
    for i in np.unique(np.searchsorted(begins, flagged, "right") - 1).tolist() if len(flagged) else []:
        inside = marginals[begins[i]:begins[i] + sizes[i]]
        places = [m.span() for m in TOKEN.finditer(texts[i])]
        if len(places) != sizes[i]:             # lowering changed a word's characters: places in the lowered text
            places = [m.span() for m in TOKEN.finditer(texts[i].lower())]
        last = -2
        for k in np.flatnonzero(inside >= 0.5).tolist():
            p = float(inside[k])
            if k == last + 1:
                spans[i][-1]["stop"] = places[k][1]
                spans[i][-1]["p"] = max(spans[i][-1]["p"], p)
            else:
                spans[i].append({"start": places[k][0], "stop": places[k][1], "p": p})
            last = k
    return scores, spans


def score(docs: DataFrame, model: ToxicModel, text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row struct, score, predicted, spans) of every row of ``docs``; ``row`` has the ``keep`` columns, or all.

    Null counts as empty; a text without tokens has the score of no marginals
    at all.  Equal texts have equal scores, an empty table gives an empty one,
    and columns of any name travel in the struct.
    """
    keep = docs.columns if keep is None else keep
    row = F.struct(*[F.col(f"`{c}`") for c in keep])
    rows = docs.select(row.alias("row"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    span = StructType([StructField("start", IntegerType()), StructField("stop", IntegerType()), StructField("p", DoubleType())])
    schema = StructType([rows.schema["row"], StructField("score", DoubleType()), StructField("predicted", IntegerType()),
                         StructField("spans", ArrayType(span))])
    sent = docs.sparkSession.sparkContext.broadcast(model)      # at most the words of the sample
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in _slices(texts):
                scores, spans = score_texts(sent.value, texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(a, b - a), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)),
                     pa.array(spans, kind)], names=["row", "score", "predicted", "spans"])

    return rows.mapInArrow(run, schema)
