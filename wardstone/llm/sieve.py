"""A filter of bounded size that finds the few rows of a wide table whose id is in a long list, without moving the rest.

The ids set two bits each in a bitmap of at most `MOST_BITS` bits, which every task gets. Rows whose bits are not set are
surely not on the list; the others are few and are joined with it. A full bitmap lets more rows through to the join, which
takes longer but changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 28
BITS_EACH = 16
SEEDS = (11, 12)


def _bit(column: str, seed: int, bits: int):
    return F.xxhash64(column, F.lit(seed)).bitwiseAND(F.lit(bits - 1))


def bitmap(ids: DataFrame) -> np.ndarray:
    """The bitmap of a column of ids, `id`."""
    bits = 1 << min(MOST_BITS.bit_length() - 1, max(10, (BITS_EACH * ids.count()).bit_length()))
    marks = ids.select(F.explode(F.array(*(_bit("id", seed, bits) for seed in SEEDS))).alias("at"))
    words = marks.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("bits"))
    found = words.toArrow()  # at most MOST_BITS / 64 rows
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def split(table: DataFrame, column: str, marks: np.ndarray, listed: bool) -> DataFrame:
    """The rows of table that may be on the list, or those that surely are not. Null ids are not."""
    bits, names = 64 * len(marks), table.columns

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = np.ones(batch.num_rows, dtype=bool)
            for k in range(len(SEEDS)):
                at = batch.column(batch.num_columns - len(SEEDS) + k).to_numpy()
                hit &= ((marks[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
            hit &= batch.column(column).is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(hit == listed)).select(names)

    return table.select("*", *(_bit(column, seed, bits).alias(f"__bit_{seed}") for seed in SEEDS)).mapInArrow(of, table.schema)


def listed(table: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows of table whose id is in ids(id)."""
    return split(table, column, bitmap(ids), True).join(ids.withColumnRenamed("id", column), column, "left_semi").select(table.columns)


def unlisted(table: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows of table whose id is not in ids(id), or null."""
    marks = bitmap(ids)
    maybe = split(table, column, marks, True).join(ids.withColumnRenamed("id", column), column, "left_anti").select(table.columns)
    return split(table, column, marks, False).unionAll(maybe)
