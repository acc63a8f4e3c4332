"""Periodic runs of words by recompression.

The words of many documents, parted by separators that occur once, are rewritten
in rounds until little is left: runs of one symbol become a block, then pairs of
a left and a right symbol become one.  Equal stretches are rewritten alike but
at their ends, so two places are compared by climbing to large equal symbols and
descending where they differ: the longest common extension takes as many steps
as there are rounds, not words.

A run of period ``q`` and four periods or more holds a multiple of ``3 q``
together with the place ``q`` further on.  These grid points, about
``n / 3 * log(n)`` for ``n`` words, are the candidates; those whose words agree are
extended exactly to both sides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

LEAST_LENGTH = 6
LEAST_PERIODS = 4       # the grid of three periods needs four or more
BATCH_WORDS = 200_000   # words in one grammar, or one document
CANDIDATES = 500_000    # grid points looked at together
_ODD = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Grammar:
    """All levels one after the other; entries are borders, of which level ``k`` has symbols + 1 from ``base[k]``.

    ``symbol[b]`` stands after border ``b``; ``ahead`` and ``behind`` count the equal
    symbols from there on and up to there.  ``up`` and ``down`` are the borders in
    the next and the former level, ``edge`` tells whether the next level has it.
    """
    base: np.ndarray
    symbol: np.ndarray
    ahead: np.ndarray
    behind: np.ndarray
    up: np.ndarray
    down: np.ndarray
    edge: np.ndarray


def _renamed(left: np.ndarray, right: np.ndarray, width: int, names: int) -> tuple[np.ndarray, int]:
    """Names from ``names`` on, equal for equal (left, right)."""
    found, number = np.unique(left * width + right, return_inverse=True)
    return names + number, names + len(found)


def recompress(words: np.ndarray, least: int) -> Grammar:
    """Grammar of ``words`` (numbers from 0), rewritten until at most ``least`` symbols are left."""
    symbols, names, level = words.astype(np.int64), int(words.max()) + 1, 0
    down = np.arange(len(symbols) + 1)
    out: dict[str, list] = {k: [] for k in ("symbol", "ahead", "behind", "up", "down", "edge")}
    sizes = []
    while True:
        n = len(symbols)
        first = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
        count = np.diff(np.append(first, n))
        inside = np.arange(n) - np.repeat(first, count)
        sizes.append(n + 1)
        out["symbol"].append(np.append(symbols, -1))
        out["ahead"].append(np.append(np.repeat(count, count) - inside, 0))
        out["behind"].append(np.append(inside + 1, 0))
        out["down"].append(down)
        if n <= max(least, 1):
            out["up"].append(np.zeros(n + 1, dtype=np.int64))
            out["edge"].append(np.zeros(n + 1, dtype=bool))
            break
        # Blocks: a symbol and how often it stands in a row.
        blocks = symbols[first]
        many = count > 1
        if many.any():
            blocks[many], names = _renamed(blocks[many], count[many], n + 1, names)
        # Pairs: the symbols fall into left and right ones by a hash, in the order that gives more pairs.
        mixed = (blocks.astype(np.uint64) + np.uint64((level + 1) * _ODD % 2**64)) * _MIX
        side = ((mixed ^ (mixed >> np.uint64(32))) * _MIX) >> np.uint64(63) == 1
        rising, falling = ~side[:-1] & side[1:], side[:-1] & ~side[1:]
        pairs = np.flatnonzero(rising if rising.sum() >= falling.sum() else falling)
        stays = np.ones(len(blocks), dtype=bool)
        stays[pairs + 1] = False
        if len(pairs):
            blocks[pairs], names = _renamed(blocks[pairs], blocks[pairs + 1], names, names)
        parent = np.cumsum(stays) - 1
        down = np.append(first[stays], n)
        edge = np.zeros(n + 1, dtype=bool)
        edge[down] = True
        out["up"].append(np.append(np.repeat(parent, count), int(stays.sum())))
        out["edge"].append(edge)
        symbols, level = blocks[stays], level + 1
    joined = {k: np.concatenate(v) for k, v in out.items()}
    small = {k: v if k in ("edge", "symbol") else v.astype(np.int32) for k, v in joined.items()}
    return Grammar(np.cumsum([0] + sizes)[:-1], **small)


def extend(g: Grammar, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
    """How many words agree after (or before) the borders ``a`` and ``b`` of the lowest level."""
    x, y = a.astype(np.int64), b.astype(np.int64)
    level = np.zeros(len(x), dtype=np.int64)
    back = 0 if forward else 1
    reach = g.ahead if forward else g.behind
    active, top = np.arange(len(x)), len(g.base) - 1
    while len(active):
        at = level[active]
        i, j = x[active] + g.base[at], y[active] + g.base[at]
        climbs = g.edge[i] & g.edge[j]
        above = g.base[np.minimum(at + 1, top)]
        climbs &= g.symbol[np.where(climbs, above + g.up[i] - back, 0)] == g.symbol[np.where(climbs, above + g.up[j] - back, 0)]
        same = ~climbs & (g.symbol[i - back] == g.symbol[j - back])
        falls = ~climbs & ~same & (at > 0)
        step = np.where(same, np.minimum(reach[i - back], reach[j - back]), 0) * (1 - 2 * back)
        x[active] = np.where(climbs, g.up[i], np.where(falls, g.down[i], x[active] + step))
        y[active] = np.where(climbs, g.up[j], np.where(falls, g.down[j], y[active] + step))
        level[active] = at + climbs - falls
        active = active[climbs | same | falls]
    return np.abs(x - a)


def find_runs(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of all runs, in this order.

    ``words`` holds the documents' words with a separator of its own before and
    after each, ``starts`` and ``lengths`` say where a document's words lie.
    """
    whole = recompress(words, len(starts))
    periods = np.where(lengths >= LEAST_LENGTH, lengths // LEAST_PERIODS, 0)
    owner = np.repeat(np.arange(len(starts)), periods)
    period = np.arange(len(owner)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    points = (lengths[owner] - period - 1) // (3 * period) + 1
    found = []
    until = np.cumsum(points)
    at = 0
    while at < len(owner):
        stop = max(at + 1, int(np.searchsorted(until, (until[at - 1] if at else 0) + CANDIDATES, side="right")))
        doc, q, k = owner[at:stop], period[at:stop], points[at:stop]
        place = (np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)) * 3 * np.repeat(q, k)
        doc, q = np.repeat(doc, k), np.repeat(q, k)
        i = starts[doc] + place
        hit = words[i] == words[i + q]
        doc, q, i, place = doc[hit], q[hit], i[hit], place[hit]
        # A run of four periods around the point agrees one period further on, or one before.
        after = words[i + q] == words[np.minimum(i + 2 * q, starts[doc] + lengths[doc])]
        before = (place >= q) & (words[np.maximum(i - q, 0)] == words[i])
        doc, q, i = (v[after | before] for v in (doc, q, i))
        first = i - extend(whole, i, i + q, False)
        last = i + q + extend(whole, i, i + q, True)
        good = last - first >= np.maximum(LEAST_LENGTH, LEAST_PERIODS * q)
        found.append(np.stack([doc[good], (first - starts[doc])[good], (last - first)[good], q[good]]))
        at = stop
    if not found:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    every = np.concatenate(found, axis=1)
    # Multiples of a period find the same stretch: the least period stays.
    every = every[:, np.lexsort((every[3], every[2], every[1], every[0]))]
    fresh = np.ones(every.shape[1], dtype=bool)
    fresh[1:] = (every[:3, 1:] != every[:3, :-1]).any(0)
    every = every[:, fresh]
    return tuple(every[:, np.lexsort((every[3], every[1], every[0]))])


def _with_separators(codes: np.ndarray, lengths: np.ndarray, names: int) -> tuple[np.ndarray, np.ndarray]:
    """Words with a separator before each document and after the last one, and the documents' starts."""
    ends = np.cumsum(lengths)
    words = np.insert(codes, np.concatenate([[0], ends]), names + np.arange(len(lengths) + 1))
    return words, ends - lengths + np.arange(len(lengths)) + 1


def periodic_runs(docs: DataFrame, text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, n_words, runs, collapsed) of every row.

    Words are what ASCII white space parts.  A run is a stretch of words of
    smallest period ``q``, as long as it can be, of ``LEAST_LENGTH`` words and
    ``LEAST_PERIODS`` periods or more; ``runs`` holds (start, length, period) by start,
    then period.  ``collapsed`` is the text without the words that some run holds
    after its first period, joined by one space.

    * Null and empty texts, and those of white space, have no words and no runs.
    * A very long text is one grammar by itself; time grows with
      ``n * log(n)``, also where one word fills it.
    * Repeated rows have results each; an empty table gives an empty one.
    * ``keep`` columns (by default all) travel in ``row``.
    """
    keep = docs.columns if keep is None else keep
    row = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(row.alias("row"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    schema = (f"row {rows.schema['row'].dataType.simpleString()}, n_words bigint, "
              "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")

    def some(kept: pa.Array, words: pa.Array, lengths: np.ndarray) -> pa.RecordBatch:
        coded = words.dictionary_encode()
        flat, starts = _with_separators(coded.indices.to_numpy().astype(np.int64), lengths, len(coded.dictionary))
        doc, start, length, period = find_runs(flat, starts, lengths)
        begins = np.concatenate([[0], np.cumsum(lengths)])
        change = np.zeros(int(begins[-1]) + 1, dtype=np.int64)
        np.add.at(change, begins[doc] + start + period, 1)
        np.add.at(change, begins[doc] + start + length, -1)
        stays = np.cumsum(change)[:-1] == 0
        left = np.concatenate([[0], np.cumsum(stays)])[begins]
        lists = pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), words.filter(pa.array(stays)))
        spans = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], names=["start", "length", "period"])
        of = np.searchsorted(doc, np.arange(len(lengths) + 1)).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [kept, pa.array(lengths), pa.ListArray.from_arrays(pa.array(of), spans), pc.binary_join(lists, " ")],
            names=["row", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = pc.ascii_split_whitespace(batch.column("text"))
            words, owner = split.flatten(), pc.list_parent_indices(split).to_numpy()
            filled = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
            words = words.filter(pa.array(filled))
            lengths = np.bincount(owner[filled], minlength=batch.num_rows).astype(np.int64)
            until = np.cumsum(lengths)
            at = 0
            while at < batch.num_rows:
                before = int(until[at - 1]) if at else 0
                stop = max(at + 1, int(np.searchsorted(until, before + BATCH_WORDS, side="right")))
                yield some(batch.column("row").slice(at, stop - at), words.slice(before, int(until[stop - 1]) - before), lengths[at:stop])
                at = stop

    return rows.mapInArrow(run, schema)
