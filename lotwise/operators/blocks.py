"""Work on many bounded groups at a time, inside one Arrow pass over sorted partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def group_starts(table: pa.Table, by: list[str]) -> np.ndarray:
    """First row of every run of equal values in the ``by`` columns (which hold no nulls)."""
    fresh = np.zeros(table.num_rows, dtype=bool)
    fresh[0] = True
    for name in by:
        column = table.column(name)
        differs = pc.not_equal(column.slice(1), column.slice(0, table.num_rows - 1))
        fresh[1:] |= np.asarray(differs.combine_chunks().to_numpy(zero_copy_only=False), dtype=bool)
    return np.flatnonzero(fresh)


def map_groups(df: DataFrame, by: list[str], work: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]],
               schema: str, within: list[str] | None = None) -> DataFrame:
    """``work(table, starts)`` over whole groups, many of them at a time, rows in order of ``within``.

    The groups must be bounded: a task holds one Arrow batch and the group that
    reaches into the next one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
            starts = group_starts(table, by)
            if len(starts) > 1:
                yield from work(table.slice(0, int(starts[-1])).combine_chunks(), starts[:-1])
                table = table.slice(int(starts[-1]))
            rest = table
        if rest is not None:
            rest = rest.combine_chunks()
            yield from work(rest, group_starts(rest, by))

    return df.repartition(*by).sortWithinPartitions(*by, *(within or [])).mapInArrow(run, schema)
