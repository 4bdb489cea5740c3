"""All comparisons within a group, in blocks that many tasks share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chunk(name: str, key: str, chunks: Column) -> Column:
    """The part of its group, from 0 to ``chunks`` - 1, that a row belongs to."""
    return F.pmod(F.xxhash64(F.lit(name), key), chunks).cast("int")


def every(chunks: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), chunks - 1))


def dealt(rows: DataFrame, group: str, parts: int) -> DataFrame:
    """Rows of one block (``group``, ``i``, ``j``) next to each other, whole in one task."""
    return rows.repartition(parts, group, "i", "j").sortWithinPartitions(group, "i", "j")


def whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Blocks of two rows or more out of rows sorted by their first three columns."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]).combine_chunks() if rest else table
        key = np.stack([table.column(c).to_numpy().astype(np.int64) for c in range(3)], axis=1)
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts[:-1]], cuts):
            if b - a > 1:
                yield table.slice(a, b - a)
        rest = table.slice(cuts[-1] if len(cuts) else 0)
    if rest and rest.num_rows > 1:
        yield rest


def lowest_reached(ids: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Per row the lowest identifier that the links of the square matrix ``near`` lead to."""
    low, most = ids.copy(), np.iinfo(np.int64).max
    while True:
        moved = np.minimum(low, np.where(near, low, most).min(axis=1))
        if (moved == low).all():
            return low
        low = moved
