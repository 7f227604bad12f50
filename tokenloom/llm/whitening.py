"""Embedding whitening: exact integer covariance by bit-sliced scatter, eigenvectors, projected rows.

An entry c becomes the integer x = floor(64 c) + 1,000,000. Of every batch of rows each dimension is
shifted by its least value and cut into bit planes, one bit per row packed into words. The popcount
of the AND of two planes counts the rows that hold both bits, so popcounts weighted by powers of two
add up to the cross-products of the shifted integers, and the shifts are added back. All of it is
exact; a task returns one sum per pair of dimensions, in limbs of 32 bits. The driver holds those sums
only (at most `MOST_DIMENSIONS` dimensions), centres them as integers, n times the cross-product less
the product of the sums, and rounds once, by dividing by n squared, before the eigenvectors are taken.

* A vector that is null, or holds a null, NaN or infinite entry, or one beyond 2^62 / 64, is dropped.
* Vectors of several lengths cannot share a covariance: those of the most frequent length (of the
  longer one in a tie) are taken, the others are dropped. Empty vectors have no components.
* Repeated rows and repeated or null ids are rows of their own; an id plays no part.
* A component without variance, as of one row or of equal rows, is returned with a null `whitened`; its
  `explained` is 0, or null if nothing varies at all. `identity_error` is over the other components.
* A `deviation` beyond 64 bits is null. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Entries become floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64.0, 1_000_000
COMPONENTS = 32
MOST_DIMENSIONS = 4096
# Entries whose scaled value reaches it have no 64-bit integer.
MOST_SCALED = 2.0**62
# Rows whose bit planes are packed at a time, and rows that are unfolded into components at a time.
PACKED_ROWS = 16_384
UNFOLDED_ROWS = 2_048
LIMB_BITS = 32

SUMS_TYPE = "i int, j int, limb int, value long"
# Second index of a dimension's own sum, and both indices of the number of rows.
OWN_SUM = -1
ROWS = -2
OUT_TYPE = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def usable_vectors(vectors: DataFrame, embedding: str = "embedding", vec_id: str = "vec_id") -> tuple[DataFrame, int]:
    """`vec_id` and `v` of the vectors that take part, and their length."""
    entries = vectors[embedding].cast("array<double>")
    slim = vectors.select(vectors[vec_id].cast("long").alias("vec_id"), entries.alias("v"))
    # A comparison with NaN as the largest number is false for it, and for null.
    fine = F.forall("v", lambda c: F.coalesce(F.abs(c) < MOST_SCALED / SCALE, F.lit(False)))
    slim = slim.where(F.col("v").isNotNull() & fine)
    sizes = slim.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    size = first["size"] if first else 0
    if size > MOST_DIMENSIONS:
        raise ValueError(f"{size} dimensions: at most {MOST_DIMENSIONS} have their cross-products on the driver")
    return slim.where(F.size("v") == size), size


def integers(column: pa.Array, size: int) -> np.ndarray:
    """Rows of x."""
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    return np.floor(SCALE * values).astype(np.int64) + OFFSET


def bit_planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed planes of a rows x dimensions array of unsigned integers; the dimension and the bit of each plane."""
    planes, dimensions, bits = [], [], []
    padding = -len(shifted) % 64
    for d in range(shifted.shape[1]):
        column = shifted[:, d]
        for bit in range(int(column.max()).bit_length()):
            on = (column >> np.uint64(bit)).astype(np.uint8) & 1
            planes.append(np.packbits(np.pad(on, (0, padding))).view(np.uint64))
            dimensions.append(d)
            bits.append(bit)
    words = (len(shifted) + padding) // 64
    stacked = np.stack(planes) if planes else np.zeros((0, words), np.uint64)
    return stacked, np.array(dimensions, np.int64), np.array(bits, np.int64)


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and cross-products (upper triangle) of the columns of `x`, exact: int64 where that holds them, else Python integers."""
    rows, size = x.shape
    least = x.min(axis=0)
    # The difference of two int64 always fits uint64.
    planes, dimension, bit = bit_planes(x.view(np.uint64) - least.view(np.uint64))
    widest = int(bit.max(initial=-1)) + 1
    most = max(abs(int(x.min())), abs(int(x.max())), 1)
    fits = 2 * max(widest, most.bit_length()) + rows.bit_length() + 2 <= 62
    kind = np.int64 if fits else object
    weight = np.array([1 << int(b) for b in bit], kind)
    sums = np.zeros(size, kind)
    cross = np.zeros((size, size), kind)
    own = np.bitwise_count(planes).sum(axis=1, dtype=np.int64).astype(kind)
    np.add.at(sums, dimension, weight * own)
    for p in range(len(planes)):
        both = np.bitwise_count(planes[p:] & planes[p]).sum(axis=1, dtype=np.int64).astype(kind)
        both = both * weight[p:] * weight[p]
        d = dimension[p]
        # Two planes of one dimension stand for both of their orders.
        same = np.searchsorted(dimension[p:], d, "right")
        cross[d, d] += both[0] + 2 * both[1:same].sum()
        np.add.at(cross[d], dimension[p + same :], both[same:])
    least = least.astype(kind)
    crossed = cross + np.outer(least, sums) + np.outer(sums, least) + rows * np.outer(least, least)
    return sums + rows * least, np.triu(crossed)


def limbs(values: np.ndarray) -> list[np.ndarray]:
    """int64 limbs of exact integers; all but the last are non-negative and below 2^32."""
    out = []
    while values.dtype == object and any(not -(1 << 62) < v < (1 << 62) for v in values):
        out.append((values & ((1 << LIMB_BITS) - 1)).astype(np.int64))
        values = values >> LIMB_BITS
    values = values.astype(np.int64)
    return [*out, values & ((1 << LIMB_BITS) - 1), values >> LIMB_BITS]


def scatter_sums(usable: DataFrame, size: int) -> DataFrame:
    """Limbs of all sums and cross-products, and the number of rows; one row each whatever the number of vectors."""
    upper = np.triu_indices(size)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows = 0
        for batch in batches:
            x = integers(batch.column(0), size)
            rows += len(x)
            for at in range(0, len(x), PACKED_ROWS):
                sums, cross = scatter(x[at : at + PACKED_ROWS])
                parts = limbs(np.concatenate([sums, cross[upper]]))
                held += [np.zeros(len(parts[0]), np.int64) for _ in range(len(parts) - len(held))]
                for total, part in zip(held, parts):
                    total += part
        i = np.concatenate([np.arange(size), upper[0]])
        j = np.concatenate([np.full(size, OWN_SUM), upper[1]])
        for limb, values in enumerate(held):
            columns = [i.astype(np.int32), j.astype(np.int32), np.full(len(i), limb, np.int32), values]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["i", "j", "limb", "value"])
        if rows:
            columns = [pa.array([v], t) for v, t in ((ROWS, pa.int32()), (ROWS, pa.int32()), (0, pa.int32()), (rows, pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["i", "j", "limb", "value"])

    return usable.select("v").mapInArrow(add, SUMS_TYPE).groupBy("i", "j", "limb").agg(F.sum("value").alias("value"))


@dataclass(frozen=True)
class Whitening:
    """The fitted transform: sums of x over `n` rows, unit eigenvectors by falling eigenvalue, and the covariance's trace."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def size(self) -> int:
        return len(self.sums)

    def varying(self) -> np.ndarray:
        """Components whose eigenvalue is more than the rounding of the largest one."""
        return self.values > 4 * np.finfo(float).eps * max(self.size, 1) * max(self.trace, 0.0)

    def scaled(self) -> np.ndarray:
        """Columns that project a centred row onto whitened components; NaN where nothing varies."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.varying(), self.vectors / np.sqrt(self.values), np.nan)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        most = max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))
        if self.n * most + max(map(abs, self.sums), default=0) < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)


def covariance(cross: dict[tuple[int, int], int], sums: list[int], n: int) -> np.ndarray:
    """Covariance with divisor n: integers until one correctly rounded division."""
    size = len(sums)
    out = np.zeros((size, size))
    for (i, j), value in cross.items():
        out[i, j] = out[j, i] = (n * value - sums[i] * sums[j]) / (n * n)
    return out


def fit(usable: DataFrame, size: int, components: int = COMPONENTS) -> Whitening | None:
    """The transform of all rows of `usable`; None without rows."""
    exact: dict[tuple[int, int], int] = {}
    # At most two or three limbs per pair of dimensions.
    for i, j, limb, value in scatter_sums(usable, size).collect():
        exact[i, j] = exact.get((i, j), 0) + (value << (LIMB_BITS * limb))
    n = exact.pop((ROWS, ROWS), 0)
    if not n:
        return None
    sums = [exact.pop((i, OWN_SUM)) for i in range(size)]
    v = covariance(exact, sums, n)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    # Of the two directions, the one whose largest entry is positive.
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]) if size else np.ones(0)
    return Whitening(n, sums, vectors * signs, values, float(np.trace(v)))


def identity_error(usable: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened rows' covariance less the identity, measured on the rows."""
    used = np.flatnonzero(model.varying())
    if not len(used):
        return None
    project, size = model.scaled()[:, used], model.size

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(used) + 1, len(used)))
        for batch in batches:
            w = (model.centred(integers(batch.column(0), size)) / model.n).astype(float) @ project
            total[1:] += w.T @ w
            total[0] += w.sum(axis=0)
        i, j = np.indices(total.shape)
        columns = [i.ravel().astype(np.int32), j.ravel().astype(np.int32), total.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["i", "j", "value"])

    sums = usable.select("v").mapInArrow(add, "i int, j int, value double")
    total = np.zeros((len(used) + 1, len(used)))
    for i, j, value in sums.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        total[i, j] = value
    mean = total[0] / model.n
    measured = total[1:] / model.n - np.outer(mean, mean)
    return float(np.abs(measured - np.eye(len(used))).max())


def deviations(centred: np.ndarray) -> pa.Array:
    """Sum of squares of every row; null beyond 64 bits."""
    most = max(abs(int(centred.min(initial=0))), abs(int(centred.max(initial=0))))
    if most * most * max(centred.shape[1], 1) < 1 << 63:
        return pa.array((centred * centred).sum(axis=1, dtype=np.int64))
    exact = [sum(int(c) ** 2 for c in row) for row in centred]
    return pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())


def whitened_rows(usable: DataFrame, model: Whitening, error: float | None) -> DataFrame:
    """One row per vector and component."""
    project, size, count = model.scaled(), model.size, len(model.values)
    with np.errstate(invalid="ignore"):
        explained = np.maximum(model.values, 0) / model.trace if model.trace > 0 else np.full(count, np.nan)
    empty = np.isnan(project[0]) if size else np.zeros(0, bool)

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows if count else 0, UNFOLDED_ROWS):
                part = batch.slice(at, UNFOLDED_ROWS)
                centred = model.centred(integers(part.column(1), size))
                w = (centred / model.n).astype(float) @ np.where(empty, 0.0, project)
                rows, each = part.num_rows, np.repeat(np.arange(part.num_rows), count)
                total = rows * count
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                        pa.array(np.full(total, model.n, np.int64)),
                        deviations(centred).take(pa.array(each)),
                        pa.array(w.ravel(), mask=np.tile(empty, rows)),
                        pa.array(np.tile(explained, rows), mask=np.tile(np.isnan(explained), rows)),
                        pa.array([error] * total, pa.float64()),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return usable.select("vec_id", "v").mapInArrow(unfold, OUT_TYPE)


def whiten(vectors: DataFrame, embedding: str = "embedding", vec_id: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """Whitened components of every usable vector, with its exact deviation and the quality of the transform.

    The table is read three times: for the covariance, to measure the result, and to return it.
    """
    usable, size = usable_vectors(vectors, embedding, vec_id)
    model = fit(usable, size, components) if size else None
    if model is None:
        return vectors.sparkSession.createDataFrame([], OUT_TYPE)
    return whitened_rows(usable, model, identity_error(usable, model))
