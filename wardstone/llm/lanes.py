"""Two tables of packed rows that meet in lanes: a task holds the one's rows of a lane, which are bounded, and the other's
rows stream past them.

Both come by one shuffle and are told apart by their order. Nothing is joined, so Spark neither pairs rows before they are
read nor takes a table of few but large rows for one that it can broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def met(held: DataFrame, asked: DataFrame, lanes: int, order: str, start: Callable, kinds: str) -> DataFrame:
    """start(rows held in a lane, a record batch each) gives a function that turns one asked row into record batches.

    Both tables have a column `lane` of 0 to lanes - 1; asked rows come by `order`. A lane without held rows gives nothing.
    """
    columns = {**dict(held.dtypes), **dict(asked.dtypes)}

    def side(df: DataFrame, number: int) -> DataFrame:
        own = ((F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in columns.items() if c != "lane")
        return df.select(F.col("lane").cast("int").alias("lane"), F.lit(number).alias("side"), *own)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane, own, visit = None, [], None
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                if (here := row.column("lane")[0].as_py()) != lane:
                    lane, own, visit = here, [], None
                if row.column("side")[0].as_py() == 0:
                    own.append(row.take(pa.array([0])))  # a copy, so that the batch can go
                    continue
                if visit is None and own:
                    visit, own = start(own), []
                if visit is not None:
                    yield from visit(row)

    both = side(held, 0).unionAll(side(asked, 1)).repartitionById(lanes, "lane")
    return both.sortWithinPartitions("lane", "side", order).mapInArrow(of, kinds)
