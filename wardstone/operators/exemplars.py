"""The known-bad vector nearest to each vector, for a bank of any size.

The bank is an inverted file, built and used within the plan: exemplars are put in cells by the signs of fixed random
directions, and each cell is cut into blocks, which keep their centroid and the widest angle to it. Blocks are packed, some
thousand exemplars in a row, and so are vectors, where they lie; both stay the bytes they came as until a task reads them.
Every pack of the bank meets every pack of vectors in a cross join: what Spark knows to be small is broadcast, and otherwise
the partitions of both are paired as they lie, so the bank is shuffled once and never copied. What is moved for a pair of
packs grows with their sum, what is computed with their product. For unit vectors v, a centroid at the angle a, and members
within the angle r, no member's cosine is above cos(a - r); a block is opened for those vectors alone whose threshold, or
best so far, that bound reaches. What is opened is compared in single precision, with a bounded error, and what may be a
best then exactly, so nothing is lost; nothing reaches the driver, and no job runs while the plan is built.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Directions whose signs name a cell, exemplars of a block, rows of a pack, and digits of a similarity.
DIRECTIONS, BLOCK, PACK, DIGITS = 8, 1024, 4096, 6
#: Rows that are compared together, and candidates of each on average from which all are compared exactly.
ROWS, MANY = 1024, 16
#: Parts of the packs; each reads the whole bank once.
PARTS = 8


def _raw(column: pa.Array) -> np.ndarray:
    """Vectors of one length as they came, in single precision where that is their own; missing components are NaN."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes != sizes[0]).any():
        raise ValueError("vectors differ in length")
    return values.astype(np.float32 if values.dtype == np.float32 else np.float64).reshape(len(sizes), -1)


def _units(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; missing components and vectors of length 0 count as 0."""
    rows = np.nan_to_num(rows.astype(np.float64))
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)


def _kind(df: DataFrame, vector: str) -> str:
    return "<f4" if dict(df.dtypes)[vector] == "array<float>" else "<f8"


def _bytes(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] * rows.itemsize if len(rows) else 0)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))])


def _read(batch: pa.RecordBatch, at: int, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(batch.column(name)[at].as_buffer(), dtype=kind)


def _celled(kind: str):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = _raw(batch.column("vector")).astype(kind)
                units = _units(rows)
                signs = units @ np.random.default_rng(20_240_229).standard_normal((DIRECTIONS, units.shape[1])).T > 0
                cell = (signs << np.arange(DIRECTIONS)).sum(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("exemplar"), _bytes(rows), pa.array(cell.astype(np.int32))], ["exemplar", "vector", "cell"])

    return of


_BANK = "ids binary, vectors binary, centres binary, widest binary, ends binary"


def _blocked(kind: str):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Neighbouring rows as one row, PACK of them at most, in blocks of one cell."""
        for batch in batches:
            parts = max(1, -(-batch.num_rows // PACK))
            for part in np.array_split(np.arange(batch.num_rows), parts):
                if not len(part):
                    continue
                own = batch.slice(part[0], len(part))
                cell = own.column("cell").to_numpy()
                begins = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(part)]
                cuts = [at for begin, end in zip(begins, begins[1:]) for at in range(begin, end, BLOCK)]
                rows = np.frombuffer(b"".join(own.column("vector").to_pylist()), dtype=kind).reshape(len(part), -1)
                units, ends = _units(rows), np.array([*cuts[1:], len(part)], dtype=np.int64)
                centres = np.add.reduceat(units, cuts, axis=0)
                centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-300)
                at_centre = np.einsum("ij,ij->i", units, np.repeat(centres, np.diff(np.append(0, ends)), axis=0))
                widest = np.clip(np.minimum.reduceat(at_centre, cuts), -1.0, 1.0)
                one = [own.column("exemplar").to_numpy(), rows, centres, widest, ends]
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in one], [c.split()[0] for c in _BANK.split(", ")])

    return of


def _packed_bank(exemplars: DataFrame, vector: str) -> DataFrame:
    tasks = int(exemplars.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = exemplars.where(F.col(vector).isNotNull() & F.col("exemplar").isNotNull()).select(F.col("exemplar").cast("long").alias("exemplar"), F.col(vector).alias("vector"))
    kind = _kind(rows, "vector")
    celled = rows.mapInArrow(_celled(kind), "exemplar long, vector binary, cell int")
    lain = celled.repartitionByRange(tasks, "cell", "exemplar").sortWithinPartitions("cell", "exemplar")
    return lain.select("exemplar", "vector", "cell").mapInArrow(_blocked(kind), _BANK)


def bank(exemplars: DataFrame, vector: str) -> DataFrame:
    """The blocks of a bank (exemplar, vector): ids, units, centre, widest."""
    kind = _kind(exemplars, vector)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, widest, ends = _read(batch, i, "ids", "<i8"), _read(batch, i, "widest", "<f8"), _read(batch, i, "ends", "<i8")
                units = _units(_read(batch, i, "vectors", kind).reshape(len(ids), -1))
                centres = _read(batch, i, "centres", "<f8").reshape(len(ends), -1)
                for j, (begin, end) in enumerate(zip([0, *ends.tolist()], ends.tolist())):
                    one = [ids[begin:end], units[begin:end].ravel(), centres[j]]
                    yield pa.RecordBatch.from_arrays([*(pa.array([x]) for x in one), pa.array([widest[j]])], ["ids", "units", "centre", "widest"])

    return _packed_bank(exemplars, vector).mapInArrow(of, "ids array<long>, units array<double>, centre array<double>, widest double")


def _packed(key: str, kind: str):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in np.array_split(np.arange(batch.num_rows), max(1, -(-batch.num_rows // PACK))):
                if len(part):
                    own = batch.slice(part[0], len(part))
                    keys = pa.ListArray.from_arrays(pa.array([0, own.num_rows], pa.int32()), own.column("key"))
                    yield pa.RecordBatch.from_arrays([keys, pa.array([_raw(own.column("vector")).astype(kind).tobytes()], pa.binary())], ["keys", "values"])

    return of, f"keys array<{key}>, values binary"


class _Pack:
    """A pack of vectors and the best exemplar of each so far."""

    def __init__(self, keys: pa.Array, rows: np.ndarray, threshold: float):
        self.keys, self.rows, self.short, self.least = keys, _units(rows), _units(rows).astype(np.float32), threshold - 10.0**-DIGITS
        self.best, self.who = np.full(len(keys), -2.0), np.full(len(keys), -1, dtype=np.int64)

    def asked(self) -> np.ndarray:
        return np.maximum(self.least, self.best - 10.0**-DIGITS)

    def take(self, at: np.ndarray, cosine: np.ndarray, ids: np.ndarray) -> None:
        """Better exemplars of the vectors `at`, of which there may be several for one; of equal ones the smaller."""
        cosine = np.round(cosine, DIGITS)
        order = np.lexsort((ids, -cosine, at))
        at, cosine, ids = at[order], cosine[order], ids[order]
        first = np.append(True, np.diff(at) != 0)
        at, cosine, ids = at[first], cosine[first], ids[first]
        better = (cosine > self.best[at]) | ((cosine == self.best[at]) & (ids < self.who[at]))
        self.best[at[better]], self.who[at[better]] = cosine[better], ids[better]

    def meet(self, ids: np.ndarray, rows: np.ndarray, centres: np.ndarray, widest: np.ndarray, ends: np.ndarray) -> None:
        units = _units(rows)
        short = units.astype(np.float32)
        error = (units.shape[1] + 8) * 2.0**-23  # of a product of two rows of length 1 in single precision
        middle = np.clip(self.rows @ centres.T, -1, 1)
        bound = np.where(middle >= widest, 1.0, middle * widest + np.sqrt((1 - middle**2) * (1 - widest**2))) + 1e-9  # cos(a - r)
        slabs, begin = [], 0  # of neighbouring blocks
        for j, end in enumerate(ends.tolist()):
            if slabs and end - slabs[-1][0] <= BLOCK:
                slabs[-1][1:] = [end, j + 1]
            else:
                slabs.append([begin, end, j + 1])
            begin = end
        last = 0
        for begin, end, j in slabs:
            near = np.flatnonzero(bound[:, last:j].max(axis=1) >= self.asked())
            last = j
            for i in range(0, len(near), ROWS):
                own = near[i : i + ROWS]
                scores = self.short[own] @ short[begin:end].T
                hit = np.flatnonzero(scores >= (self.asked()[own] - error).astype(np.float32)[:, None])
                if len(hit) > MANY * len(own):  # where most are alike
                    cosine = np.round(self.rows[own] @ units[begin:end].T, DIGITS)
                    top = cosine.max(axis=1)
                    self.take(own, top, np.where(cosine == top[:, None], ids[begin:end], np.iinfo(np.int64).max).min(axis=1))
                elif len(hit):
                    at, of = own[hit // (end - begin)], begin + hit % (end - begin)
                    self.take(at, np.einsum("ij,ij->i", self.rows[at], units[of]), ids[of])

    def given(self, threshold: float) -> pa.RecordBatch:
        hit = np.flatnonzero(self.who >= 0)
        hit = hit[self.best[hit] >= threshold]
        return pa.RecordBatch.from_arrays([self.keys.take(pa.array(hit)), pa.array(self.who[hit]), pa.array(self.best[hit])], ["key", "exemplar", "similarity"])


def _nearest(threshold: float, kind: str, bank_kind: str):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, pack = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                if pack is None or batch.column("pack")[i].as_py() != name:
                    if pack is not None:
                        yield pack.given(threshold)
                    name, keys = batch.column("pack")[i].as_py(), batch.column("keys")[i].values
                    keys = keys.take(pa.array(np.arange(len(keys))))  # a copy, so that the batch can go
                    pack = _Pack(keys, _read(batch, i, "values", kind).reshape(len(keys), -1), threshold)
                ids, ends = _read(batch, i, "ids", "<i8"), _read(batch, i, "ends", "<i8")
                pack.meet(ids, _read(batch, i, "vectors", bank_kind).reshape(len(ids), -1), _read(batch, i, "centres", "<f8").reshape(len(ends), -1), _read(batch, i, "widest", "<f8"), ends)
        if pack is not None:
            yield pack.given(threshold)

    return of


def nearest_exemplars(vectors: DataFrame, exemplars: DataFrame, key: str, vector: str, threshold: float) -> DataFrame:
    """Best exemplar of each vector with a cosine, rounded, at or above the threshold: key, exemplar, similarity.

    Of equal ones the smaller exemplar. Null vectors have none; rows that share a key have the best of theirs. Exemplars
    are (exemplar, vector) of any number; none give no rows. Vectors of different lengths are refused.
    """
    kind = dict(vectors.dtypes)[key]
    rows = vectors.where(F.col(vector).isNotNull()).select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    own = _kind(rows, "vector")
    packs = rows.mapInArrow(*_packed(kind, own)).withColumn("pack", F.xxhash64("keys", "values")).repartition(PARTS)
    met = packs.crossJoin(_packed_bank(exemplars, vector))
    found = met.mapInArrow(_nearest(threshold, own, _kind(exemplars, vector)), f"key {kind}, exemplar long, similarity double")
    one = F.max(F.struct("similarity", (-F.col("exemplar")).alias("less"))).alias("best")
    return found.groupBy("key").agg(one).select(F.col("key").alias(key), (-F.col("best.less")).alias("exemplar"), "best.similarity")
