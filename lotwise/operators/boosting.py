"""Gradient boosting on histograms, with leaf penalties and a learned side for missing values.

Every feature becomes a bin number of one byte; 255 stands for missing.  Features of
few bins share a byte, whose sums give those of each of them.  Rows lie in written
blocks of some ten thousand, byte by byte, with their target, their fold and one margin
per fit.  A level of a tree is one job: tasks sum gradients and row counts
per (fit, node, byte, value), the sums meet by key, and what reaches the driver
is the best split of every (fit, node).  The driver keeps the trees only.

Several fits, such as the folds and parameter sets of a search, grow in the same
jobs, ``FITS`` of them at a time, so that neither the margins of a row nor the sums of a
task grow with the length of a search.  Levels are many and each is small, so they run
as keyed reductions on the blocks; planning a query per level would cost more than the
level itself.  A tree is walked once to move the margins, which are held with the blocks
until the next one, and written after every ``KEEP`` trees, so a lost executor costs the
trees since then.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise.operators.relational import stable_hash
from lotwise.session import delete_path, materialize, materialize_counted, scratch_path

MISSING = 255
BYTE = 256
BLOCK = 1 << 15
TASK_BLOCKS = 2         # blocks to a task at least
FITS = 8                # fits that grow together
KEEP = 20
NO_FOLD = -1
GATHERED = 64 << 20      # bytes of a level's sums, by all tasks, up to which the driver adds them
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Boosting:
    """Parameters of one fit; the row and column shares are drawn per tree."""
    trees: int = 100
    depth: int = 6
    rate: float = 0.3
    row_share: float = 1.0
    column_share: float = 1.0
    gamma: float = 0.0          # least gain of a split
    alpha: float = 0.0          # penalty on the size of a leaf's value
    lam: float = 1.0            # penalty on its square
    least_weight: float = 1.0   # least rows of a leaf
    seed: int = 42


@dataclass
class Tree:
    """Nodes in arrays, the root first; a leaf has feature -1.  Rows up to bin ``cut`` go left."""
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [True])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    rows: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, missing_left: bool, gain: float) -> tuple[int, int]:
        at = len(self.feature)
        for name, first in (("feature", -1), ("cut", 0), ("missing_left", True), ("left", 0), ("right", 0), ("value", 0.0), ("gain", 0.0), ("rows", 0.0)):
            getattr(self, name).extend([first, first])
        self.feature[node], self.cut[node], self.missing_left[node] = feature, cut, missing_left
        self.left[node], self.right[node], self.gain[node] = at, at + 1, gain
        return at, at + 1

    def prune(self, gamma: float) -> None:
        """Splits above leaves go, from below, if they gain less than ``gamma``."""
        for node in range(len(self.feature) - 1, -1, -1):
            if self.feature[node] >= 0 and self.gain[node] < gamma and self.feature[self.left[node]] < 0 and self.feature[self.right[node]] < 0:
                self.feature[node], self.gain[node] = -1, 0.0


# ------------------------------------------------------------------ splits
def shrunk(g, alpha: float):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def score(g, n, p: Boosting):
    return shrunk(g, p.alpha) ** 2 / (n + p.lam)


def best_splits(hist: np.ndarray, p: Boosting) -> list[tuple[float, int, bool, float, float]]:
    """(gain, cut, missing left, gradients left, rows left) for each of the sums ``hist``.

    ``hist`` is keys x 2 x bins: gradients and rows by bin, the missing ones last.
    Without a split that gains anything the gain is 0.  Of equal gains the
    least bin wins, the missing rows on the left; gains count to ten digits.
    """
    g, n = (np.cumsum(hist[:, k, :-1], axis=1) for k in (0, 1))
    lost_g, lost_n = hist[:, 0, -1:], hist[:, 1, -1:]
    all_g, all_n = g[:, -1:] + lost_g, n[:, -1:] + lost_n
    # Missing rows on the left, then on the right.
    left_g, left_n = np.concatenate([g + lost_g, g], axis=1), np.concatenate([n + lost_n, n], axis=1)
    right_g, right_n = all_g - left_g, all_n - left_n
    # A cut behind an empty bin parts the rows as the one before does.
    filled = np.tile(hist[:, 1, :-1] > 0, 2)
    good = filled & (left_n >= max(p.least_weight, 1)) & (right_n >= max(p.least_weight, 1))
    gain = np.where(good, score(left_g, left_n, p) + score(right_g, right_n, p) - score(all_g, all_n, p), 0.0)
    gain[gain <= 1e-6] = 0.0
    unit = 10.0 ** (9 - np.floor(np.log10(np.where(gain > 0, gain, 1.0))))
    gain = np.round(gain * unit) / unit
    at, keys = np.argmax(gain, axis=1), np.arange(len(gain))
    bins = n.shape[1]
    return [(float(x), int(k % bins), bool(k < bins), float(a), float(b)) for x, k, a, b in zip(
        gain[keys, at], at, left_g[keys, at], left_n[keys, at], strict=True)]


def drawn_columns(p: Boosting, tree: int, features: int) -> np.ndarray:
    if p.column_share >= 1:
        return np.arange(features)
    many = max(1, int(p.column_share * features))
    return np.sort(np.random.default_rng([p.seed, tree]).choice(features, many, replace=False))


def drawn_rows(p: Boosting, tree: int, keys: np.ndarray) -> np.ndarray:
    if p.row_share >= 1:
        return np.ones(len(keys), dtype=bool)
    x = (keys.astype(np.uint64) ^ np.uint64((p.seed * 1_000_003 + tree + 1) * int(_MIX) % 2**64)) * _MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(11)).astype(np.float64) / 2**53 < p.row_share


# ------------------------------------------------------------------ blocks
def edges_of(df: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Upper ends of each feature's bins: its values if they are few, else values at even ranks."""
    shares = [(k + 1) / bins for k in range(bins - 1)]
    wide = df.select(*[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(features)])
    found = wide.agg(*[F.percentile_approx(f"f{i}", shares, 10_000).alias(f"f{i}") for i in range(len(features))]).first()
    out = []
    for i in range(len(features)):
        out.append(sorted({float(x) for x in found[i] or [] if not math.isnan(x)}))
    return out


def binned(values: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """Bin numbers of features x rows; null and not-a-number are missing."""
    out = np.empty(values.shape, dtype=np.uint8)
    for i, e in enumerate(edges):
        out[i] = np.searchsorted(np.array(e), values[i], side="left")
        out[i, np.isnan(values[i])] = MISSING
    return out


def _values(batch: pa.RecordBatch, features: int) -> np.ndarray:
    return np.stack([batch.column(f"f{i}").to_numpy(zero_copy_only=False).astype(np.float64) for i in range(features)]) \
        if features else np.zeros((0, batch.num_rows))


@dataclass
class Packs:
    """How features share bytes: the byte ``of`` a feature, and its bin (or ``MISSING``) by the value of that byte."""
    of: np.ndarray
    codes: np.ndarray                                       # features x values of a byte
    stride: list[int] = field(default_factory=list)
    states: list[int] = field(default_factory=list)
    plain: list[int] = field(default_factory=list)          # states without the missing one
    sizes: list[int] = field(default_factory=list)          # values in use, by byte

    @classmethod
    def single(cls, features: int) -> "Packs":
        """A byte for every feature, with its bin as it is."""
        return cls(np.arange(features), np.tile(np.arange(BYTE), (features, 1)))

    @classmethod
    def shared(cls, plain: list[int], missing: list[bool]) -> "Packs":
        states, of, stride, sizes = [p + m for p, m in zip(plain, missing, strict=True)], [0] * len(plain), [1] * len(plain), []
        for f in sorted(range(len(plain)), key=lambda f: (-states[f], f)):
            at = next((k for k, size in enumerate(sizes) if size * states[f] <= BYTE), len(sizes))
            if at == len(sizes):
                sizes.append(1)
            of[f], stride[f] = at, sizes[at]
            sizes[at] *= states[f]
        sizes = sizes or [1]
        codes = np.array([np.arange(BYTE) // stride[f] % states[f] for f in range(len(plain))]).reshape(-1, BYTE)
        for f, p in enumerate(plain):
            codes[f, codes[f] == p] = MISSING
        return cls(np.array(of, dtype=np.int64), codes, stride, states, plain, sizes)

    def pack(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.sizes), bins.shape[1]), dtype=np.uint8)
        for f, p in enumerate(self.plain):
            code = np.where(bins[f] == MISSING, p, bins[f]).astype(np.uint8) if self.states[f] > p else bins[f]
            out[self.of[f]] += code * np.uint8(self.stride[f])
        return out

    def sums_of(self, feature: int, sums: np.ndarray) -> np.ndarray:
        """Sums by bin of a feature, the missing ones last, from the sums by value of its byte (the last axis)."""
        states, plain, stride, size = (x[feature] for x in (self.states, self.plain, self.stride, [self.sizes[k] for k in self.of]))
        by_state = sums[..., :size].reshape(*sums.shape[:-1], size // (states * stride), states, stride).sum(axis=(-3, -1))
        out = np.zeros((*sums.shape[:-1], plain + 1))
        out[..., :states if states > plain else -1] = by_state
        return out


class Walk:
    """A tree as tables: the byte that a node looks at, and the next node by its value."""

    def __init__(self, tree: Tree, packs: Packs):
        feature = np.array(tree.feature)
        inner, many = np.flatnonzero(feature >= 0), len(feature)
        self.byte, self.value = np.zeros(many, dtype=np.int64), np.array(tree.value)
        following = np.repeat(np.arange(many)[:, None], BYTE, axis=1)
        if len(inner):
            cut, side, left, right = (np.array(x)[inner][:, None] for x in (tree.cut, tree.missing_left, tree.left, tree.right))
            code = packs.codes[feature[inner]]
            following[inner] = np.where(np.where(code == MISSING, side, code <= cut), left, right)
            self.byte[inner] = packs.of[feature[inner]]
        self.following = following.ravel()
        self.steps, level = 0, [0]
        while level := [k for n in level if tree.feature[n] >= 0 for k in (tree.left[n], tree.right[n])]:
            self.steps += 1

    def node_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf that each row of ``bins`` (bytes x rows) falls into."""
        many = bins.shape[1]
        if not self.steps:
            return np.zeros(many, dtype=np.int64)
        at = self.following[:BYTE].take(bins[self.byte[0]])
        flat, rows, first = bins.ravel(), np.arange(many), self.byte * many
        for _ in range(self.steps - 1):
            at = self.following.take(at * BYTE + flat.take(first.take(at) + rows))
        return at

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.value.take(self.node_of(bins))


@dataclass
class Block:
    """Some ten thousand rows: bytes x rows, target, and margins by fit; row keys and folds if fits ask for them.

    While trees grow, margins are held less the target, and the target is not held.
    """
    bins: np.ndarray
    y: np.ndarray
    key: np.ndarray
    fold: np.ndarray
    margins: np.ndarray

    @classmethod
    def read(cls, row, width: int) -> "Block":
        bins = np.frombuffer(row[0], np.uint8).reshape(width, -1)
        return cls(bins, np.frombuffer(row[1]), np.frombuffer(row[2], np.int64),
                   np.frombuffer(row[3], np.int32), np.frombuffer(row[4]).reshape(-1, bins.shape[1]))


BLOCK_SCHEMA = "bins binary, y binary, key binary, fold binary"


@dataclass
class Ready:
    """Rows in written blocks, for any number of fits; ``means`` has the mean target without each fold asked for."""
    features: list[str]
    target: str
    edges: list[list[float]]
    packs: Packs
    blocks: RDD
    means: dict[int, float]

    def started(self, bases: list[float]) -> RDD:
        """The blocks with a margin for every base, less the target."""
        def run(rows) -> Iterator[tuple]:
            for bins, y, key, fold in rows:
                yield bins, b"", key, fold, (np.array(bases)[:, None] - np.frombuffer(y)).tobytes()
        return self.blocks.mapPartitions(run)


def ready_rows(df: DataFrame, target: str, features: list[str], sets: list[Boosting], folds: list[int], fold: str | None,
               key: str | None, bins: int = MISSING) -> Ready:
    """Blocks of the rows that have a target; keys and folds are kept if ``sets`` draw rows or ``folds`` leave some out."""
    edges, wanted = edges_of(df, features, min(bins, MISSING)), sorted({*folds})
    numbers = [F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(features)]
    ident = F.xxhash64(*([F.col(f"`{key}`")] if key else [F.col(f"`{c}`") for c in (*features, target)]))
    rows = df.select(*numbers, F.col(f"`{target}`").cast("double").alias("y"), ident.alias("key"),
                     (F.col(f"`{fold}`") if fold else F.lit(NO_FOLD)).cast("int").alias("fold")).where("y is not null")
    of_folds = [F.avg(F.when(F.col("fold") != w, F.col("y")) if w != NO_FOLD else "y").alias(f"m{k}") for k, w in enumerate(wanted)]
    lost = [F.col(f"f{i}").isNull() | F.isnan(f"f{i}") for i in range(len(features))]
    found = rows.agg(F.count("*").alias("rows"), *of_folds, *[F.max(F.when(~x, F.col(f"f{i}"))).alias(f"top{i}") for i, x in enumerate(lost)],
                     *[F.count_if(x).alias(f"lost{i}") for i, x in enumerate(lost)]).first()
    # bins that no row is in take no place
    packs = Packs.shared([max(1, len(e) + (bool(e) and found[f"top{i}"] is not None and found[f"top{i}"] > e[-1])) for i, e in enumerate(edges)],
                         [found[f"lost{i}"] > 0 for i in range(len(features))])
    width, drawn, parted = len(features), any(p.row_share < 1 for p in sets), wanted != [NO_FOLD]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(parts):
            packed, y, k, f = (np.concatenate(x, axis=-1) for x in zip(*parts, strict=True))
            made = (packed, y, k if drawn else k[:0], f if parted else f[:0])
            return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in made], names=["bins", "y", "key", "fold"])

        waiting, many = [], 0
        for batch in batches:
            packed = packs.pack(binned(_values(batch, width), edges))
            y, k, f = (batch.column(c).to_numpy() for c in ("y", "key", "fold"))
            start = 0
            while start < len(y):
                s = slice(start, start + BLOCK - many)
                waiting.append((packed[:, s], y[s], k[s], f[s]))
                start, many = s.stop, many + len(y[s])
                if many == BLOCK:
                    yield block(waiting)
                    waiting, many = [], 0
        if waiting:
            yield block(waiting)

    written, many = materialize_counted(rows.mapInArrow(run, BLOCK_SCHEMA), "boost-blocks")
    # levels are many, so small tasks would cost more than the work, and uneven ones would be waited for
    tasks = max(1, min(df.sparkSession.sparkContext.defaultParallelism, many // TASK_BLOCKS))
    return Ready(features, target, edges, packs, written.repartition(tasks).rdd.map(tuple),
                 {w: float(found[f"m{k}"] or 0.0) for k, w in enumerate(wanted)})


def _moved(width: int, grown: list[Tree | None], packs: Packs | None = None) -> Callable:
    """Task work after a tree: the blocks with the margins moved by each fit's last tree; fits that are not listed are done."""
    def run(rows) -> Iterator[tuple]:
        walks = [t and Walk(t, packs or Packs.single(width)) for t in grown]
        for row in rows:
            b = Block.read(row, width)
            margins = b.margins[:len(walks)].copy()
            for i, w in enumerate(walks):
                if w is not None:
                    margins[i] += w.predict(b.bins)
            yield *row[:4], margins.tobytes()
    return run


def _held(rows: RDD) -> RDD:
    return rows.persist(StorageLevel.MEMORY_AND_DISK)


# ------------------------------------------------------------------ fits
@dataclass
class _Fit:
    """One fit in progress; rows of ``without`` take no part."""
    params: Boosting
    without: int
    base: float
    trees: list[Tree] = field(default_factory=list)
    tree: Tree = field(default_factory=Tree)
    open: list[int] = field(default_factory=list)
    columns: np.ndarray = field(default_factory=lambda: np.arange(0))

    def bytes(self, packs: Packs) -> list[int]:
        """The bytes that hold the drawn columns."""
        return np.unique(packs.of[self.columns]).tolist()

    def settle(self, node: int, g: float, n: float) -> None:
        """The value of a node with the given sums, as long as it is a leaf."""
        self.tree.value[node] = float(-shrunk(g, self.params.alpha) / (n + self.params.lam) * self.params.rate)
        self.tree.rows[node] = float(n)


def _level_sums(fits: list[tuple[int, "_Fit"]], packs: Packs, by_node: bool) -> Callable:
    """Task work of a level: (fit, sums) of the open nodes, or ((fit, place of the node), sums).

    Sums are gradients and rows, by node, byte with a drawn column, and value.
    """
    slim = [(i, replace(f, trees=[]), len(f.trees)) for i, f in fits]       # grown trees stay in the driver
    width, cells = len(packs.sizes), max(packs.sizes, default=0)

    def run(rows) -> Iterator[tuple]:
        sums: dict[int, np.ndarray] = {}
        walks = {i: Walk(f.tree, packs) for i, f, _ in slim}
        for row in rows:
            b = Block.read(row, width)
            for i, f, number in slim:
                used = drawn_rows(f.params, number, b.key) if f.params.row_share < 1 else None
                if f.without != NO_FOLD:
                    used = b.fold != f.without if used is None else used & (b.fold != f.without)
                place = np.full(len(f.tree.feature), -1)
                place[f.open] = np.arange(len(f.open))
                node = place.take(walks[i].node_of(b.bins))
                inside = node >= 0 if used is None else used & (node >= 0)
                gradient, bins = b.margins[i], b.bins
                if not inside.all():
                    at = np.flatnonzero(inside)
                    node, gradient, bins = node.take(at), gradient.take(at), bins.take(at, axis=1)
                node *= cells
                held, many = f.bytes(packs), len(f.open) * cells
                if i not in sums:
                    sums[i] = np.zeros((2, len(f.open), len(held), cells))
                for k, byte in enumerate(held):
                    at = node + bins[byte]
                    sums[i][0, :, k] += np.bincount(at, gradient, many).reshape(-1, cells)
                    sums[i][1, :, k] += np.bincount(at, minlength=many).reshape(-1, cells)
        for i, total in sums.items():
            if by_node:
                yield from (((i, k), total[:, k:k + 1]) for k in range(total.shape[1]))
            else:
                yield i, total
    return run


def _best(fit: _Fit, packs: Packs, sums: np.ndarray) -> list[tuple]:
    """(split, column, sums of all bins) for every node of ``sums``; of equal gains the least column wins."""
    best: list = [None] * sums.shape[1]
    held = fit.bytes(packs)
    for column in fit.columns.tolist():
        hist = packs.sums_of(column, sums[:, :, held.index(packs.of[column])]).swapaxes(0, 1)
        for k, split in enumerate(best_splits(hist, fit.params)):
            if best[k] is None or split[0] > best[k][0][0]:
                best[k] = (split, column, tuple(hist[k].sum(axis=1).tolist()))
    return best


def fit_boosted(df: DataFrame, target: str, features: list[str], sets: list[Boosting], folds: list[int] | None = None,
                fold: str | None = None, key: str | None = None, bins: int = MISSING) -> list["BoostedModel"]:
    """One model per parameter set, grown together.

    With ``folds`` (one per set) the rows of that fold, told by the ``fold`` column,
    are left out of the fit.  ``key`` names the column that row draws depend on; by
    default it is the whole row.  Rows without a target take no part; without any
    row the model is 0 everywhere.
    """
    folds = [NO_FOLD] * len(sets) if folds is None else folds
    return grown_on(ready_rows(df, target, features, sets, folds, fold, key, bins), sets, folds)


def grown_on(ready: Ready, sets: list[Boosting], folds: list[int]) -> list["BoostedModel"]:
    """One model per parameter set; those of like size grow together."""
    fits = [_Fit(p, w, ready.means[w]) for p, w in zip(sets, folds, strict=True)]
    alike = sorted(fits, key=lambda x: (-x.params.trees, -x.params.depth))
    for start in range(0, len(alike), FITS):
        _grow(ready, alike[start:start + FITS])
    return [BoostedModel(ready.features, ready.target, ready.edges, x.base, x.trees, x.params) for x in fits]


def _grow(ready: Ready, fits: list[_Fit]) -> None:
    """Grow the trees of ``fits``, which are in order of their numbers of trees, most first."""
    packs, context = ready.packs, ready.blocks.context
    spark = SparkSession(context)
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(scratch_path(spark, "boost-kept"))
    width, cells, tasks = len(packs.sizes), max(packs.sizes, default=0), ready.blocks.getNumPartitions()
    rows, spent, kept = _held(ready.started([x.base for x in fits])), [], []
    for number in range(max((x.params.trees for x in fits), default=0)):
        growing = [(i, x) for i, x in enumerate(fits) if number < x.params.trees]
        for _, x in growing:
            x.tree, x.open, x.columns = Tree(), [0], drawn_columns(x.params, number, len(ready.features))
        level = 0
        while active := [(i, x) for i, x in growing if x.open and level < x.params.depth]:
            nodes, of_fit = sum(len(x.open) * len(x.bytes(packs)) for _, x in active), dict(active)
            found: dict[tuple[int, int], tuple] = {}
            if tasks * nodes * cells * 16 > GATHERED:
                sums = rows.mapPartitions(_level_sums(active, packs, True)).reduceByKey(lambda a, b: a + b, _reducers(context, nodes))
                slim = {i: replace(x, trees=[]) for i, x in active}
                found.update(sums.map(lambda r: (r[0], _best(slim[r[0][0]], packs, r[1])[0])).collect())
            else:                               # the tasks' sums are few and small: no shuffle
                total: dict[int, np.ndarray] = {}
                for i, part in rows.mapPartitions(_level_sums(active, packs, False)).collect():
                    total[i] = total[i] + part if i in total else part
                for i, part in total.items():
                    found.update({(i, k): best for k, best in enumerate(_best(of_fit[i], packs, part))})
            while spent:                        # what the rows came from
                spent.pop().unpersist()
            if rows.isCheckpointed():
                kept = _forgotten(spark, kept, rows)
            for i, x in active:
                opened = []
                for k, node in enumerate(x.open):
                    (gain, cut, side, left_g, left_n), column, (g, n) = found.get((i, k)) or ((0.0, 0, True, 0.0, 0.0), 0, (0.0, 0.0))
                    if node == 0:
                        x.settle(node, g, n)
                    if gain > 0:
                        left, right = x.tree.split(node, column, cut, side, gain)
                        x.settle(left, left_g, left_n)
                        x.settle(right, g - left_g, n - left_n)
                        opened += [k for k, rows_ in ((left, left_n), (right, n - left_n)) if rows_ >= 2 * max(x.params.least_weight, 1)]
                x.open = opened
            level += 1
        for _, x in growing:
            x.tree.prune(x.params.gamma)
            x.trees.append(x.tree)
        spent.append(rows)
        rows = _held(rows.mapPartitions(_moved(width, [x.tree for _, x in growing if number + 1 < x.params.trees], packs)))
        if (number + 1) % KEEP == 0:
            rows.checkpoint()                   # written by the next job
    for held in [*spent, rows]:
        held.unpersist()
    _forgotten(spark, kept, None)


def _forgotten(spark: SparkSession, kept: list[str], rows: RDD | None) -> list[str]:
    """The files of ``rows`` are kept, those of earlier ones go."""
    path = rows and rows.getCheckpointFile()
    for old in kept:
        if old != path:
            delete_path(spark, old)
    return [path] if path else []


def _reducers(context, nodes: int) -> int:
    """Tasks that sum the nodes of a level: one per hundred nodes and bytes."""
    return max(1, min(context.defaultParallelism, nodes // 100))


class BoostedModel:
    """Trees over bins, with what turns features into bins."""

    def __init__(self, features, target, edges, base, trees, params):
        self.features, self.target, self.edges, self.base, self.trees, self.params = features, target, edges, base, trees, params

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``."""
        edges, base, trees, width = self.edges, self.base, self.trees, len(self.features)

        @F.pandas_udf("double")
        def predicted(parts: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            walks = [Walk(t, Packs.single(width)) for t in trees]
            for values in parts:
                bins = binned(values.to_numpy(dtype=np.float64).reshape(len(values), width).T, edges)
                yield pd.Series(base + sum((w.predict(bins) for w in walks), np.zeros(len(values))))

        return df.withColumn("prediction", predicted(F.struct(*[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(self.features)])))

    def staged_errors(self, df: DataFrame, by: str | None = None) -> DataFrame:
        """(by, trees, rmse, rows): the error after every number of trees, in one pass over the rows."""
        return staged_errors([self], df, by).drop("model")

    def importance(self, top: int | None = None) -> list[tuple[str, float]]:
        """Features by their mean gain per split, as shares of all."""
        gains: dict[str, list[float]] = {}
        for t in self.trees:
            for f, g in zip(t.feature, t.gain, strict=True):
                if f >= 0:
                    gains.setdefault(self.features[f], []).append(g)
        mean = {f: sum(g) / len(g) for f, g in gains.items()}
        total = sum(mean.values()) or 1.0
        listed = sorted(((f, mean.get(f, 0.0) / total) for f in self.features), key=lambda x: (-x[1], x[0]))
        return listed[:top]

    def as_table(self, spark: SparkSession) -> DataFrame:
        """(tree, node, feature, threshold, missing_left, left, right, value, gain, rows): values up to the threshold go left."""
        rows = []
        for number, t in enumerate(self.trees):
            for node in range(len(t.feature)):
                f = t.feature[node]
                inner = f >= 0
                cut = t.cut[node]
                limit = (self.edges[f][cut] if cut < len(self.edges[f]) else math.inf) if inner else None
                rows.append((number, node, self.features[f] if inner else None, limit, t.missing_left[node] if inner else None,
                             t.left[node] if inner else None, t.right[node] if inner else None, t.value[node], t.gain[node], t.rows[node]))
        return spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, missing_left boolean, "
                                           "left int, right int, value double, gain double, rows double")


def staged_errors(models: list[BoostedModel], df: DataFrame, by: str | None = None, part_of: list | None = None) -> DataFrame:
    """(model, by, trees, rmse, rows) after every tree of every model; rows without a target are left out.

    With ``part_of`` a model is measured on the rows whose ``by`` equals its entry.
    Every task sums squared errors per model, part and number of trees, so what
    is shuffled does not grow with the rows.
    """
    features, target = models[0].features, models[0].target
    width = len(features)
    label = F.col(f"`{by}`").cast("string") if by else F.lit("all")
    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(features)],
                     F.col(f"`{target}`").cast("double").alias("y"), F.coalesce(label, F.lit("")).alias("part")).where("y is not null")
    packed = [(m.edges, m.base, m.trees) for m in models]
    wanted = None if part_of is None else [str(p) for p in part_of]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, str], np.ndarray] = {}
        counts: dict[tuple[int, str], int] = {}
        walks = [(edges, base, [Walk(t, Packs.single(width)) for t in trees]) for edges, base, trees in packed]
        for batch in batches:
            values, y, part = _values(batch, width), batch.column("y").to_numpy(), np.array(batch.column("part").to_pylist(), dtype=object)
            for name in set(part.tolist()):
                here = part == name
                bins = None
                for i, (edges, base, trees) in enumerate(walks):
                    if wanted is not None and wanted[i] != name:
                        continue
                    bins = binned(values[:, here], edges) if bins is None or edges is not walks[i - 1][0] else bins
                    error = base - y[here]
                    found = [float(error @ error)]
                    for t in trees:
                        error = error + t.predict(bins)
                        found.append(float(error @ error))
                    sums[i, name] = sums.get((i, name), 0) + np.array(found)
                    counts[i, name] = counts.get((i, name), 0) + int(here.sum())
        for (i, name), total in sums.items():
            n = len(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * n, pa.int32()), pa.array([name] * n), pa.array(range(n), pa.int32()), pa.array(total), pa.array([counts[i, name]] * n, pa.int64())],
                names=["model", "part", "trees", "squares", "rows"])

    summed = rows.mapInArrow(run, "model int, part string, trees int, squares double, rows bigint").groupBy("model", "part", "trees").agg(
        F.sum("squares").alias("squares"), F.sum("rows").alias("rows"))
    return summed.select("model", F.col("part").alias(by or "part"), "trees", F.sqrt(F.col("squares") / F.col("rows")).alias("rmse"), "rows")


# ------------------------------------------------------------------ search
def fold_of(key: str, folds: int):
    return (F.floor(stable_hash(F.col(f"`{key}`").cast("string"), seed="fold") / 97) % folds).cast("int")


def search_staged(df: DataFrame, target: str, features: list[str], sets: list[Boosting], key: str, folds: int = 3,
                  tried: list[int] | None = None) -> list[tuple[Boosting, float]]:
    """(set, mean error over the folds), best first.

    Sets that differ in the number of trees alone are one fit per fold: the
    longest one, whose error after every tree is known.  All fits grow together.
    ``tried`` lists further numbers of trees to score every set at.
    """
    longest: dict[Boosting, int] = {}
    for p in sets:
        bare = replace(p, trees=0)
        longest[bare] = max(longest.get(bare, 0), p.trees, *(tried or [0]))
    asked = [replace(p, trees=n) for p, n in longest.items()]
    errors = fold_errors(*folded(df, target, features, asked, key, folds), asked, folds)
    scored = [(replace(p, trees=n), errors[replace(p, trees=0), n]) for p in sets for n in dict.fromkeys([p.trees, *(tried or [])])]
    return sorted(dict(scored).items(), key=lambda x: (x[1], repr(x[0])))


def folded(df: DataFrame, target: str, features: list[str], sets: list[Boosting], key: str, folds: int) -> tuple[DataFrame, Ready]:
    """The rows with their fold, written once, and their blocks for fits of ``sets`` without a fold."""
    rows = materialize(df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*features, target, key])]).withColumn("fold_", fold_of(key, folds)), "boost-rows")
    return rows, ready_rows(rows, target, features, sets, list(range(folds)), "fold_", key)


def fold_errors(rows: DataFrame, ready: Ready, sets: list[Boosting], folds: int) -> dict[tuple[Boosting, int], float]:
    """Mean error over the folds of every set (with trees=0 as its name) after every number of trees."""
    every = [(p, k) for p in sets for k in range(folds)]
    models = grown_on(ready, [p for p, _ in every], [k for _, k in every])
    found: dict[tuple[Boosting, int], list[float]] = {}
    for r in staged_errors(models, rows, "fold_", [k for _, k in every]).collect():
        found.setdefault((replace(every[r["model"]][0], trees=0), r["trees"]), []).append(r["rmse"])
    return {k: sum(v) / len(v) for k, v in found.items()}


def halving_staged(df: DataFrame, target: str, features: list[str], sets: list[Boosting], key: str, folds: int = 3,
                   factor: int = 3, most: int = 400) -> list[dict]:
    """Rounds of growing numbers of trees; the best third of the sets goes on to the next round, up to ``most`` trees."""
    steps = max(0, math.ceil(math.log(max(len(sets), 1), factor) - 1e-9))
    left, rounds = list(dict.fromkeys(replace(p, trees=0) for p in sets)), []
    rows, ready = folded(df, target, features, left, key, folds)
    for step in range(steps + 1):
        trees = max(1, most // factor ** (steps - step))
        errors = fold_errors(rows, ready, [replace(p, trees=trees) for p in left], folds)
        ranked = sorted(left, key=lambda p: (errors[p, trees], repr(p)))
        rounds.append({"trees": trees, "sets": len(left), "best": replace(ranked[0], trees=trees), "rmse": errors[ranked[0], trees]})
        left = ranked[:max(1, len(ranked) // factor)]
    return rounds
