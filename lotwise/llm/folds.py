"""Running values over the array of one row, in time that grows with its length.

A fold that appends to an array copies it at every step.  So an array is folded
in chunks of some hundred entries, each with what it starts from, and the
chunks' answers are joined at the end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

CHUNK = 256
SPANS = "array<struct<start:bigint,stop:bigint>>"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def in_chunks(values: Column, size: int = CHUNK) -> Column:
    """Array of arrays of at most ``size`` entries; of an empty array, an empty one."""
    return bound(values, lambda v: F.when(F.size(v) <= size, F.filter(F.array(v), lambda x: F.size(x) > 0)).otherwise(F.transform(
        F.sequence(F.lit(0), F.floor((F.size(v) - 1) / size).cast("int")), lambda c: F.slice(v, c * size + 1, F.lit(size)))))


def before_each(values: Column, start: Column, kind: str, merge: Callable[[Column, Column], Column]) -> Column:
    """What ``merge`` makes of ``start`` and all entries before, for every entry (of few)."""
    first = F.struct(start.alias("now"), F.array().cast(f"array<{kind}>").alias("out"))
    return F.aggregate(values, first, lambda acc, x: F.struct(
        merge(acc["now"], x).alias("now"), F.concat(acc["out"], F.array(acc["now"])).alias("out")), lambda acc: acc["out"])


def spans(steps: Column) -> Column:
    """Spans of the hits among ``steps`` (gap, hit, good: array of structs): lengths before and of each, and whether it counts."""
    zero = F.lit(0).cast("bigint")

    def add(acc, x):
        begin = acc["at"] + x["gap"]
        stop = begin + x["hit"]
        span = F.array(F.struct(begin.alias("start"), stop.alias("stop")))
        return F.struct(stop.alias("at"), F.when(x["good"], F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    def of_chunk(chunk, at):
        return F.aggregate(chunk, F.struct(at.alias("at"), F.array().cast(SPANS).alias("out")), add, lambda acc: acc["out"])

    def all_chunks(chunks):
        lengths = F.transform(chunks, lambda c: F.aggregate(c, zero, lambda acc, x: acc + x["gap"] + x["hit"]))
        return F.flatten(F.zip_with(chunks, before_each(lengths, zero, "bigint", lambda a, b: a + b), of_chunk))

    return bound(in_chunks(steps), lambda chunks: F.when(F.size(chunks) == 1, of_chunk(F.element_at(chunks, 1), zero)).otherwise(all_chunks(chunks)))
