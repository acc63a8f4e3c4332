"""Packing of token streams into windows by order-preserving dynamic programming.

The documents of a partition are one stream, in their order.  Windows are cut
from it at the ends of documents or sentences.  The cost of a window is its
padding, a penalty for a cut that parts a document, and a little for the window
itself.  With positions ``P`` and least costs ``f``

    f[j] = penalty[j] + min over i of f[i] + padding(P[j] - P[i]),

padding is ``size - (P[j] - P[i])``, so the best ``i`` in reach is the front of a
monotone queue of ``f[i] + P[i]``; windows of a power of two need no padding and
are tried one by one.  No row is shuffled: a window lies in one partition.
"""

from __future__ import annotations

import os
import re
from array import array
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

SIZE = 2048
END_ID = 1
REACH = 1 << 20         # tokens in one run of the dynamic programme; it ends with a document
LONG = 128              # a stretch of more tokens without an end of a sentence may be cut inside
STEP = 16               # at every so many tokens
CACHED_WORDS = 400_000
ENDS = re.compile("[.!?…。！？][\"'”’»)\\]]*$")


@dataclass(frozen=True)
class Costs:
    """In tokens of padding: a cut after a sentence, one inside a sentence, and a window."""
    sentence: float = 8.0
    inside: float = 64.0
    window: float = 4.0


#: Words of these characters alone are lowered and parted here as the tokenizer's own normal form does it.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]*")
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def byte_letters() -> dict[int, str]:
    """Letters beyond ASCII as the characters that stand for their UTF-8 bytes: printable ones for themselves, others from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in printable)}
    return {c: "".join(others.get(b, chr(b)) for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class PartIds(dict):
    """Token ids of parts as bytes, merged when they are first asked for."""

    def __init__(self, model):
        super().__init__()
        self.model, self.letters = model, byte_letters()

    def __missing__(self, part: str) -> bytes:
        spelled = part if part.isascii() else part.translate(self.letters)
        found = self[part] = array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
        return found


class WordIds:
    """Token ids of words, by the tokenizer's merges.

    The tokenizer treats what stands between ASCII white space by itself, and
    inside it letters, digits and other signs; so the ids of a text are those of
    its parts in turn, and each part goes through the merges once.  Words of
    other scripts, and special tokens, go through the whole tokenizer.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark has a task per core already
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(definition)
        self.parts = PartIds(self.tokenizer.model)
        self.known: dict[str, bytes] = {}

    def learn(self, words: list[str]) -> None:
        """Ids of words not seen before."""
        parts, find, others = self.parts, PARTS.findall, []
        for w in words:
            if PLAIN.fullmatch(w) and "<|" not in w:
                self.known[w] = b"".join([parts[x] for x in find(w.lower())])
            else:
                others.append(w)
        for start in range(0, len(others), 4096):
            some = others[start:start + 4096]
            for w, found in zip(some, self.tokenizer.encode_batch(some, add_special_tokens=False), strict=True):
                self.known[w] = array("I", found.ids).tobytes()

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, number of ids of each word)."""
        for cache in (self.parts, self.known):
            if len(cache) > CACHED_WORDS:
                cache.clear()
        self.learn([w for w in words if w not in self.known])
        ids = [self.known[w] for w in words]
        return np.frombuffer(b"".join(ids), "<u4"), np.array([len(x) // 4 for x in ids], dtype=np.int64)


def ramp(counts: np.ndarray) -> np.ndarray:
    """0 .. n - 1 for every n of ``counts``, one after the other."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


@dataclass
class Stream:
    """Token ids of documents in turn, the ends of the documents, and the ends of sentences inside them."""
    ids: np.ndarray
    ends: np.ndarray
    sentences: np.ndarray


def read_stream(texts: pa.Array, words_of: WordIds, end_id: int) -> Stream:
    """Every text's ids with ``end_id`` after them."""
    split = pc.ascii_split_whitespace(texts)
    words, owner = split.flatten(), pc.list_parent_indices(split).to_numpy()
    filled = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    coded, owner = words.filter(pa.array(filled)).dictionary_encode(), owner[filled]
    distinct = coded.dictionary.to_pylist()
    flat, counts = words_of(distinct)
    flat, counts = np.append(flat, np.uint32(end_id)), np.append(counts, 1)
    stops = np.array([bool(ENDS.search(w)) for w in distinct] + [False])
    per_text = np.bincount(owner, minlength=len(texts))
    place = np.insert(coded.indices.to_numpy().astype(np.int64), np.cumsum(per_text), len(distinct))
    length = counts[place]
    until = np.cumsum(length)
    last = place == len(distinct)
    # The id after a document's last word belongs to its last sentence.
    sentence = stops[place] & ~np.append(last[1:], True)
    ids = flat[np.repeat((np.cumsum(counts) - counts)[place], length) + ramp(length)]
    return Stream(ids, until[last], until[sentence])


def candidates(stream: Stream, size: int, costs: Costs) -> tuple[np.ndarray, np.ndarray]:
    """Places where a cut may be, from 0 to the end, and what each one costs."""
    total = int(stream.ends[-1])
    known = np.unique(np.concatenate([[0], stream.ends, stream.sentences]))
    gaps = np.diff(known)
    long = gaps > LONG
    more = (gaps[long] - 1) // STEP
    inside = np.repeat(known[:-1][long], more) + (ramp(more) + 1) * STEP
    tail = np.arange(max(total - size, 0) + 1, total)       # the last window may end in powers of two
    places = np.unique(np.concatenate([known, inside, tail]))
    penalty = np.full(len(places), costs.inside)
    penalty[np.searchsorted(places, stream.sentences)] = costs.sentence
    penalty[np.searchsorted(places, stream.ends)] = 0.0
    return places, penalty


def best_cuts(places: np.ndarray, penalty: np.ndarray, size: int, costs: Costs) -> np.ndarray:
    """The cuts of least cost, the first and the last place included.  Of equal costs the longest window wins."""
    exact_j, exact_i = [], []
    power = 1
    while power < size:
        at = np.searchsorted(places, places - power)
        hit = places[at] == places - power
        exact_j.append(np.flatnonzero(hit))
        exact_i.append(at[hit])
        power *= 2
    j, i = np.concatenate(exact_j), np.concatenate(exact_i)
    order = np.lexsort((i, j))
    source = i[order].tolist()
    first = np.searchsorted(j[order], np.arange(len(places) + 1)).tolist()
    spot, fee = places.tolist(), (penalty + costs.window).tolist()
    cost, back = [0.0] * len(spot), [0] * len(spot)
    queue: deque[int] = deque([0])
    value = [0.0] * len(spot)           # cost + place, what the queue is ordered by
    for j in range(1, len(spot)):
        here = spot[j]
        while spot[queue[0]] < here - size:
            queue.popleft()
        best, came = value[queue[0]] + size - here, queue[0]
        for t in range(first[j], first[j + 1]):
            if cost[source[t]] < best:
                best, came = cost[source[t]], source[t]
        cost[j], back[j] = best + fee[j], came
        value[j] = cost[j] + here
        while queue and value[queue[-1]] > value[j]:
            queue.pop()
        queue.append(j)
    cuts, j = [len(spot) - 1], len(spot) - 1
    while j:
        j = back[j]
        cuts.append(j)
    return places[np.array(cuts[::-1])]


def padding(length: int, size: int = SIZE) -> int:
    """What a sequence of ``length`` tokens is filled up with: nothing at a power of two."""
    return 0 if length & (length - 1) == 0 else size - length


def pack(docs: DataFrame, definition: str, size: int = SIZE, end_id: int = END_ID, costs: Costs = Costs(),
         text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, start, length, ids, doc_tokens, sequence_id, offset), one row per piece of a document.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit integers,
    ``start`` the ids of its document before it, ``doc_tokens`` all ids of the
    document, the one at its end included.  A sequence is the pieces of one
    ``sequence_id`` in order of ``offset``, without gaps.

    * A null or empty text, or one of white space, is one piece of one id.
    * A text longer than a window is cut at ends of sentences, and inside a
      stretch of more than ``LONG`` tokens without one.  Work and memory grow in
      proportion to the text.
    * Repeated rows are packed each by itself; ties are resolved by order.  An
      empty table gives an empty one.
    * ``keep`` columns (by default all but the text) travel in ``row``.
    """
    keep = [c for c in docs.columns if c != text_column] if keep is None else keep
    row = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(row.alias("row"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    schema = (f"row {rows.schema['row'].dataType.simpleString()}, start bigint, length bigint, ids binary, "
              "doc_tokens bigint, sequence_id bigint, offset bigint")

    def pieces(kept: pa.Array, stream: Stream, number: int) -> tuple[pa.RecordBatch, int]:
        cuts = best_cuts(*candidates(stream, size, costs), size, costs)
        begins = np.concatenate([[0], stream.ends[:-1]])
        edges = np.unique(np.concatenate([cuts, stream.ends]))
        start, stop = edges[:-1], edges[1:]
        of = np.searchsorted(stream.ends, start, side="right")
        window = np.searchsorted(cuts, start, side="right") - 1
        raw = stream.ids.astype("<u4").tobytes()
        made = pa.RecordBatch.from_arrays(
            [kept.take(pa.array(of)), pa.array(start - begins[of]), pa.array(stop - start),
             pa.array([raw[4 * a:4 * b] for a, b in zip(start.tolist(), stop.tolist(), strict=True)], pa.binary()),
             pa.array((stream.ends - begins)[of]), pa.array(number + window), pa.array(start - cuts[window])],
            names=["row", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
        return made, number + len(cuts) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = WordIds(definition)
        number = TaskContext.get().partitionId() << 33
        held: list[tuple[pa.Array, Stream]] = []

        def flush():
            nonlocal number
            shift = np.cumsum([0] + [len(s.ids) for _, s in held])[:-1]
            whole = Stream(np.concatenate([s.ids for _, s in held]),
                           np.concatenate([s.ends + x for (_, s), x in zip(held, shift, strict=True)]),
                           np.concatenate([s.sentences + x for (_, s), x in zip(held, shift, strict=True)]))
            made, number = pieces(pa.concat_arrays([k for k, _ in held]), whole, number)
            held.clear()
            return made

        waiting = 0
        for batch in batches:
            at, texts = 0, batch.column("text")
            size_of = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            while at < batch.num_rows:
                # Some 8 MB of text at a time, one document at least.
                until = at + max(1, int(np.searchsorted(np.cumsum(size_of[at:]), 8 << 20)))
                stream = read_stream(texts.slice(at, until - at), words_of, end_id)
                held.append((batch.column("row").slice(at, until - at), stream))
                waiting, at = waiting + len(stream.ids), until
                if waiting >= REACH:
                    yield flush()
                    waiting = 0
        if held:
            yield flush()

    return rows.mapInArrow(run, schema)
