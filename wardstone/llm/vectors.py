"""Vectors of integers: which rows take part, their shape, and the matrices that tasks compute with.

Integer products of such vectors are exact in doubles as long as no sum reaches 2 to the 53; `shape` refuses tables
where one could.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != math.inf))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def scaled(vector: Column, by: int) -> Column:
    """floor(by * x) of each component, reckoned in doubles."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(by)) * x.cast("double")))


@dataclass(frozen=True)
class Shape:
    rows: int
    width: int
    #: The largest component, as an absolute value.
    most: float

    def kind(self) -> str:
        """The smallest integers that hold all components."""
        return next((kind for kind in ("<i2", "<i4") if self.most <= np.iinfo(kind).max), "<i8")


def shape(rows: DataFrame) -> Shape:
    """Rows and components of a column `v`. Shorter vectors count as filled up with zeros."""
    largest = F.aggregate("v", F.lit(0.0), lambda most, x: F.greatest(most, F.abs(x.cast("double"))))
    found = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.max(largest).alias("most")).first()
    width = max(1, found["width"] or 0)
    if (found["most"] or 0.0) ** 2 * width * 4 >= 2.0**53:
        raise ValueError("vectors are too long for exact inner products in 53 bits")
    return Shape(found["n"], width, found["most"] or 0.0)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as doubles, a row each."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def lists(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as a list column of longs."""
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int64).ravel()))


def pivots(rows: DataFrame, most: int, width: int) -> np.ndarray:
    """Up to so many vectors, those with the smallest hash of vec_id: a bounded sample that any run draws again."""
    taken = rows.select("v", "vec_id").orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(most).select("v").toArrow()
    found = [matrix(chunk, width) for chunk in taken.column("v").chunks]
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, width))


def single(most: float) -> type:
    """The kind of numbers in which products of up to so much are exact: no sum of components passes the product of the
    lengths of two vectors."""
    return np.float32 if most < 2.0**24 else np.float64


def squares(values: np.ndarray) -> np.ndarray:
    """The squared norm of each row."""
    return np.einsum("ij,ij->i", values, values)


def nearest(values: np.ndarray, among: np.ndarray, block: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """For each row the first of the nearest rows of `among`, and the distance to it."""
    at, far = np.zeros(len(values), dtype=np.int64), np.zeros(len(values))
    step, own = max(1, block // max(1, len(among))), squares(among)
    for i in range(0, len(values), step):
        part = values[i : i + step]
        apart = squares(part)[:, None] + own - 2.0 * (part @ among.T)
        at[i : i + step] = apart.argmin(1)
        far[i : i + step] = apart.min(1)
    return at, np.sqrt(far)


def assigned(rows: DataFrame, among: np.ndarray, width: int) -> DataFrame:
    """Rows with the `cell` of the pivot nearest to their vector `v` and the `far` distance to it.

    Repeats of a row within a record batch are given once.
    """
    names = [c for c in rows.columns if c not in ("cell", "far")]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = matrix(batch.column("v"), width)
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            if len(np.unique(ids)) < len(ids):
                others = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in names if c not in ("v", "vec_id")]
                first = np.sort(np.unique(np.column_stack([ids.astype(np.int64).view(np.float64), values, *others]).view(np.int64), axis=0, return_index=True)[1])
                batch, values = batch.take(pa.array(first)), values[first]
            cell, far = nearest(values, among)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(cell), pa.array(far)], [*names, "cell", "far"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)
    return rows.select(names).mapInArrow(of, f"{kinds}, cell long, far double")
