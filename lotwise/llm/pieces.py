"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

The symbols of many words lie in one flat array.  Each round finds the least
pair rank of every word by a segmented minimum, merges in all words at once,
closes the gaps, and lets finished words go, until no pair remains.

The library takes the best pair first and the leftmost among equals, one merge
at a time.  A round merges all leftmost occurrences of a word's best pair when
no piece that has the merged one at its start or end ranks as well or better:
then nothing that the merge makes can come before the other occurrences.
Otherwise it merges the leftmost one alone.  Both give the library's result.

No piece has a blank after another character, so a text falls apart before each
run of blanks, and equal words are encoded once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

BLANK = "▁"
NO_PAIR = np.int32(2**31 - 1)
CACHED_WORDS = 400_000
SLICE_CHARS = 4_000_000


class PieceModel:
    """Pieces, merge table and word cache of one model file, given as bytes."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor
        sp = SentencePieceProcessor(model_proto=model)
        self.size, self.bos, self.eos = sp.get_piece_size(), sp.bos_id(), sp.eos_id()
        pieces = [sp.id_to_piece(i) for i in range(self.size)]
        special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) for i in range(self.size)]
        ids = {p: i for i, p in enumerate(pieces) if not special[i]}
        byte_ids = {int(p[1:-1], 16): i for i, p in enumerate(pieces) if sp.is_byte(i)}
        if len(byte_ids) != 256 or any(sp.is_unused(i) for i in range(self.size)):
            raise ValueError("a BPE model with byte fallback and without unused pieces is needed")
        if any(BLANK in p.lstrip(BLANK) for p in ids):
            raise ValueError("a piece has a blank after another character: texts cannot be cut at blanks")
        self.byte_ids = np.array([byte_ids[b] for b in range(256)], dtype=np.int64)
        # Characters that only longer pieces have get symbols of their own behind the pieces.
        self.symbols = dict(ids)
        for p in ids:
            for c in p:
                self.symbols.setdefault(c, self.size + len(self.symbols) - len(ids))
        self.first_unknown = self.size + len(self.symbols) - len(ids)
        self.span = self.first_unknown + 0x110000
        scores = sorted({sp.get_score(i) for i in ids.values()}, reverse=True)
        places = {s: k for k, s in enumerate(scores)}
        rank = {p: places[sp.get_score(i)] for p, i in ids.items()}
        self.of_char = np.arange(0x110000, dtype=np.int64) + self.first_unknown
        for p, i in self.symbols.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        self._merge_table(ids, rank)
        self._decode_table(pieces, special, byte_ids)
        self.extra = {v: k for k, v in self.symbols.items() if v >= self.size}
        self.segments = re.compile(self._run_cut(ids, rank, len(scores) - 1) + f"{BLANK}+[^{BLANK}]*")
        self.words: dict[str, bytes] = {}

    def _run_cut(self, ids: dict[str, int], rank: dict[str, int], last: int) -> str:
        """Pattern that cuts long runs of blanks from the left, or nothing.

        It holds where pieces of blanks alone share the last rank with nothing
        else, so that they merge last and from the left, and where the run's
        first blanks are seen to become one piece of the greatest length.
        """
        blanks = [p for p in ids if set(p) == {BLANK}]
        most = max(map(len, blanks), default=0)
        tied = {p for p in ids if rank[p] == last} | {BLANK} == set(blanks) | {BLANK}
        mixed = any(p.startswith(BLANK * 2) and set(p) != {BLANK} for p in ids)
        if most < 2 or not tied or mixed:
            return ""
        runs = [[BLANK * n, BLANK * (n - most)] for n in range(most + 1, 4 * most)]
        long, short = (self.merge_rounds([r[i] for r in runs]) for i in (0, 1))
        whole = np.array([ids[BLANK * most]], dtype="<u4").tobytes()
        if any(a != whole + b for a, b in zip(long, short, strict=True)):
            return ""
        return f"{BLANK}{{{most}}}(?={BLANK})|"

    def _merge_table(self, ids: dict[str, int], rank: dict[str, int]) -> None:
        best_around: dict[str, int] = {}
        keys, ranks, results = [], [], []
        for p, i in ids.items():
            for cut in range(1, len(p)):
                left, right = p[:cut], p[cut:]
                for part in (left, right):
                    if part in ids:
                        best_around[part] = min(best_around.get(part, len(rank)), rank[p])
                if left in self.symbols and right in self.symbols:
                    keys.append(self.symbols[left] * self.span + self.symbols[right])
                    ranks.append(rank[p])
                    results.append(i)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.ranks = np.array(ranks, dtype=np.int32)[order]
        self.results = np.array(results, dtype=np.int64)[order]
        self.safe = np.zeros(self.size, dtype=bool)
        for p, i in ids.items():
            self.safe[i] = best_around.get(p, len(rank) + 1) > rank[p]

    def _decode_table(self, pieces: list[str], special: list[bool], byte_ids: dict[int, int]) -> None:
        texts = [b"" if special[i] else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        for b, i in byte_ids.items():
            texts[i] = bytes([b])
        self.sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.buffer = np.frombuffer(b"".join(texts), dtype=np.uint8)

    # -------------------------------------------------------------- encoding
    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left * self.span + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        there = self.keys[at] == key
        return np.where(there, self.ranks[at], NO_PAIR), np.where(there, self.results[at], 0)

    def merge_rounds(self, words: list[str]) -> list[bytes]:
        """Packed ids of every word after all merges (``words`` are not empty)."""
        lengths = np.array([len(w) for w in words])
        sym = self.of_char[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")]
        word = np.repeat(np.arange(len(words)), lengths)
        done = [b""] * len(words)

        def ranked(sym, word):
            ranks, made = np.full(len(sym), NO_PAIR, dtype=np.int32), np.zeros(len(sym), dtype=np.int64)
            inside = np.flatnonzero(word[:-1] == word[1:])
            ranks[inside], made[inside] = self._pairs(sym[inside], sym[inside + 1])
            return ranks, made

        ranks, made = ranked(sym, word)
        while len(sym):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(ranks, starts)
            over = best == NO_PAIR
            sizes = np.diff(np.append(starts, len(sym)))
            if over.any():
                stay = np.repeat(~over, sizes)
                self._finish(done, sym[~stay], word[starts[over]], sizes[over])
                sym, word, ranks, made = sym[stay], word[stay], ranks[stay], made[stay]
                if not len(sym):
                    break
                best, sizes = best[~over], sizes[~over]
            at = np.flatnonzero(ranks == np.repeat(best, sizes))
            # In a run of pairs that share symbols every second one is merged.
            fresh = np.concatenate([[True], at[1:] != at[:-1] + 1])
            offset = np.arange(len(at)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            first = np.concatenate([[True], word[at[1:]] != word[at[:-1]]])
            # One piece that is not safe lets the whole word take its leftmost merge alone.
            group = np.cumsum(first) - 1
            all_safe = np.logical_and.reduceat(self.safe[made[at]], np.flatnonzero(first))
            at = at[np.where(all_safe[group], offset % 2 == 0, first)]
            sym[at] = made[at]
            stay = np.ones(len(sym), dtype=bool)
            stay[at + 1] = False
            at = at - np.arange(len(at))
            sym, word, ranks, made = sym[stay], word[stay], ranks[stay], made[stay]
            near = np.concatenate([at, at[at > 0] - 1])
            ranks[near], made[near] = NO_PAIR, 0
            near = near[near + 1 < len(sym)]
            near = near[word[near] == word[near + 1]]
            ranks[near], made[near] = self._pairs(sym[near], sym[near + 1])
        return done

    def _finish(self, done: list[bytes], symbols: np.ndarray, words: np.ndarray, sizes: np.ndarray) -> None:
        """Put the ids of finished words in place; characters without a piece become their bytes' pieces."""
        odd = symbols >= self.size
        if odd.any():
            ends = np.cumsum(sizes)
            spelled = [self._bytes_of(s) if s >= self.size else (s,) for s in symbols.tolist()]
            grown = np.add.reduceat(np.array([len(x) for x in spelled]), ends - sizes)
            symbols, sizes = np.array([i for x in spelled for i in x]), grown
        packed = symbols.astype("<u4").tobytes()
        ends = 4 * np.cumsum(sizes)
        for w, a, b in zip(words.tolist(), (ends - 4 * sizes).tolist(), ends.tolist(), strict=True):
            done[w] = packed[a:b]

    def _bytes_of(self, symbol: int) -> list[int]:
        char = self.extra.get(symbol) or chr(symbol - self.first_unknown)
        return self.byte_ids[list(char.encode("utf-8", "surrogatepass"))].tolist()

    def _keys_of(self, text: str) -> list[str]:
        """The text's words without their first blank."""
        if not text:
            return []
        parts = text.replace(BLANK, " ").split(" ")
        if "" not in parts:
            return parts
        return [s[1:] for s in self.segments.findall(BLANK + text.replace(" ", BLANK))]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text with begin and end ids, packed as little-endian unsigned 32-bit integers."""
        keys = [self._keys_of(t) for t in texts]
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        known = self.words
        new = list({k for ks in keys for k in ks if k not in known})
        for i in range(0, len(new), 50_000):
            part = new[i:i + 50_000]
            known.update(zip(part, self.merge_rounds([BLANK + k for k in part]), strict=True))
        begin, end = np.array([self.bos], "<u4").tobytes(), np.array([self.eos], "<u4").tobytes()
        return [b"".join([begin, *map(known.__getitem__, ks), end]) for ks in keys]

    # -------------------------------------------------------------- decoding
    def decode(self, packed: list[bytes]) -> list[str]:
        """Texts of packed ids; the blank that encoding puts first is taken off again."""
        counts = np.array([len(p) // 4 for p in packed])
        ids = np.frombuffer(b"".join(packed), "<u4").astype(np.int64)
        sizes = self.sizes[ids]
        before = np.cumsum(sizes) - sizes
        flat = self.buffer[np.repeat(self.starts[ids] - before, sizes) + np.arange(sizes.sum())].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts)]
        begins = np.concatenate([[0], ends[:-1]])
        out = []
        for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
            text = flat[a:b].decode("utf-8", "replace")
            out.append(text[1:] if text.startswith(" ") else text)
        return out


@lru_cache(maxsize=2)
def load_model(model: bytes) -> PieceModel:
    return PieceModel(model)


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLICE_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_documents(docs: DataFrame, model_path: str, text_column: str = "text", round_trip: bool = True) -> DataFrame:
    """(row struct, ids, decoded) of every row of ``docs``.

    ``ids`` are packed little-endian unsigned 32-bit integers, begin and end ids
    included; ``decoded`` is the text that they decode to (null unless
    ``round_trip``).  ``row`` has all columns but the text.

    Null counts as empty, and empty texts have the begin and end ids alone.
    Rows that are alike have the same result, an empty table gives an empty
    one, and columns of any name travel in the struct.  The model file, of
    fixed size, is sent to the executors, which need no copy of it.
    """
    with open(model_path, "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())
    rest = [c for c in docs.columns if c != text_column]
    row = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(row.alias("row"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    schema = StructType([rows.schema["row"], StructField("ids", BinaryType()), StructField("decoded", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(sent.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in _slices(texts):
                ids = model.encode(texts[a:b])
                decoded = model.decode(ids) if round_trip else [None] * len(ids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(a, b - a), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                    names=["row", "ids", "decoded"])

    return rows.mapInArrow(run, schema)
