"""Embedding whitening from a weighted covariance over different vectors.

Components become integers, floor(scale * c). Equal integer vectors are one vector with a multiplicity; the fit gives each
weight one, or its multiplicity. Sums over vectors are taken in tasks, one row for each dimension, or pair of dimensions,
and added up by Spark. The covariance is a matrix product of vectors centred by their exact sums, weighted; its
eigenvectors are found on the driver (dimensions squared numbers, whatever the number of rows). Each different vector is
whitened once and joined back to its rows by its value. Vectors that many rows share, at most ``1 / HOT_SHARE`` of them,
are joined by a broadcast, so no task gets all rows of a vector.

Defined results: rows whose vector is null, or holds null or non-finite entries, are dropped; all others stay, rows without
an id and repeated ones included. Shorter vectors count as filled with zeros. Components whose eigenvalue is not above the
rounding error of the largest have no whitened value and are left out, so equal vectors only give no rows, as an empty
table does. ``deviation`` is null where it does not fit in a long. Entries beyond a long become the nearest long. Only the
named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.session import stage as written

#: A vector with more than this share of all rows is joined by a broadcast; vectors turned into one matrix at a time.
HOT_SHARE, ROWS = 1 / 500, 4096

_LARGEST = (1 << 63) - 1
_PIECES = "array<struct<component: int, whitened: double, explained: double>>"


@dataclass(frozen=True)
class Whitener:
    """A fit: weight, exact sums, unit eigenvectors as columns, their eigenvalues, and the trace of the covariance."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def explained(self) -> np.ndarray:
        """Share of the trace of each component."""
        return self.values / self.trace if self.trace > 0 else self.values

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Squared distance from the mean, times n squared, of each row; None beyond a long."""
        most = max((int(np.abs(x).max()) if x.size else 0) * self.n, max(map(abs, self.sums), default=0))
        if 4 * most * most * max(x.shape[1], 1) < _LARGEST:
            gaps = self.n * x - np.array(self.sums, dtype=np.int64)
            return (gaps * gaps).sum(axis=1).tolist()
        exact = (sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist())
        return [d if d <= _LARGEST else None for d in exact]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Rows projected on the components, each scaled to unit variance."""
        return centred(x, self.n, self.sums) @ self.axes / np.sqrt(self.values)


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """Rows less the mean, which is the whole part and the rest of sums / n."""
    whole = [s // n for s in sums]
    rest = [(s - w * n) / n for s, w in zip(sums, whole, strict=True)]
    return (x - np.array(whole, dtype=np.int64)).astype(float) - np.array(rest)


def integer_rows(rows: DataFrame, id_column: str, vector: str, scale: int) -> DataFrame:
    """``row_id`` and ``x``, the integer vector without zeros at its end, of the rows that have a valid vector."""
    value = F.col(f"`{vector}`")
    bad = F.exists(value, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    x = F.transform(value, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    valid = rows.filter(value.isNotNull() & ~bad)
    return valid.select(F.col(f"`{id_column}`").alias("row_id"), x.alias("x")).withColumn("x", F.slice("x", F.lit(1), full_size(F.col("x"))))


def full_size(x: Column) -> Column:
    """Number of entries up to the last that is not zero."""
    return F.coalesce(F.array_max(F.transform(x, lambda c, i: F.when(c != 0, i + 1).otherwise(0))), F.lit(0))


def matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of the batches, and their column ``x`` as a matrix."""
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            part = batch.slice(at, ROWS)
            lists = part.column("x")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            out = np.zeros((len(part), width), dtype=np.int64)
            row = np.repeat(np.arange(len(part)), sizes)
            out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy(zero_copy_only=False)
            yield part, out


def fit(groups: DataFrame, components: int) -> Whitener | None:
    """Fit from the different vectors ``x`` with their ``weight``; None if there are none."""
    width = groups.agg(F.max(F.size("x"))).first()[0]
    if width is None:
        return None

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = np.zeros(width, np.int64), np.zeros(width, np.int64), 0
        for part, x in matrices(batches, width):
            weight = part.column("weight").to_numpy()
            for w in np.unique(weight):  # halves of 32 bits, so that sums of many rows fit
                same = x[weight == w]
                high, low, n = high + int(w) * (same >> 32).sum(axis=0), low + int(w) * (same & 0xFFFFFFFF).sum(axis=0), n + int(w) * len(same)
        columns = [np.arange(width + 1, dtype=np.int32), np.r_[high, 0], np.r_[low, n]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["i", "high", "low"])

    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    sums = {r["i"]: (int(r["high"]) << 32) + int(r["low"]) for r in groups.mapInArrow(add, "i int, high long, low long").groupBy("i").agg(*exact).collect()}
    n, total = sums[width], tuple(sums[i] for i in range(width))
    upper = np.triu_indices(width)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        product = np.zeros((width, width))
        for part, x in matrices(batches, width):
            c = centred(x, n, total)
            product += (c * part.column("weight").to_numpy().astype(float)[:, None]).T @ c
        columns = [upper[0].astype(np.int32), upper[1].astype(np.int32), product[upper]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["i", "j", "v"])

    covariance = np.zeros((width, width))
    for r in groups.mapInArrow(multiply, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        covariance[r["i"], r["j"]] = covariance[r["j"], r["i"]] = r["v"] / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    sound = values > width * np.finfo(float).eps * values.max(initial=0.0)
    return Whitener(n, total, axes[:, sound], values[sound], float(np.trace(covariance)))


def whiten(
    rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = 4, scale: int = 256,
    by_multiplicity: bool = False, hot_share: float = HOT_SHARE,
) -> DataFrame:
    """``id_column, n, deviation, identity_error, whitened`` of each row with a valid vector; ``whitened`` is a list of structs
    of ``component, whitened, explained``.

    The fit weighs every different vector one, or by its multiplicity.
    """
    spark = rows.sparkSession
    valid = integer_rows(rows, id_column, vector, scale)
    groups = written(valid.groupBy("x").agg(F.count("*").alias("copies")), "whiten-vectors")
    weighed = groups.withColumn("weight", F.col("copies") if by_multiplicity else F.lit(1).cast("long"))
    model = fit(weighed, components)
    if model is None or not len(model.values):
        kind = rows.schema[id_column].dataType.simpleString()
        return spark.createDataFrame([], f"`{id_column}` {kind}, n long, deviation long, identity_error double, whitened {_PIECES}")
    k, width = len(model.values), len(model.sums)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in matrices(batches, width):
            lists = pa.ListArray.from_arrays(np.arange(0, len(part) * k + 1, k, dtype=np.int32), model.whiten(x).ravel())
            columns = [part.column("x"), part.column("copies"), part.column("weight"), pa.array(model.deviations(x), pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, ["vector", "copies", "weight", "deviation", "w"])

    once = written(weighed.mapInArrow(apply, "vector array<long>, copies long, weight long, deviation long, w array<double>"), "whitened")
    hot = F.col("copies") > hot_share * groups.agg(F.sum("copies")).first()[0]
    # the hot vectors are less than 1 / hot_share rows
    joined = valid.join(F.broadcast(once.filter(hot)), F.col("x") == F.col("vector"), "left")
    found = joined.filter(F.col("vector").isNotNull())
    rest = joined.filter(F.col("vector").isNull()).select("row_id", "x").join(once.filter(~hot), F.col("x") == F.col("vector"))
    share = [float(s) for s in model.explained]
    pieces = F.array(*[F.struct(F.lit(i + 1).alias("component"), F.get("w", F.lit(i)).alias("whitened"), F.lit(share[i]).alias("explained")) for i in range(k)])
    return found.unionByName(rest).select(
        F.col("row_id").alias(id_column), F.lit(model.n).cast("long").alias("n"), "deviation", F.lit(identity_error(once, k)).alias("identity_error"),
        pieces.cast(_PIECES).alias("whitened"),
    )


def identity_error(once: DataFrame, k: int) -> float:
    """Largest absolute entry of the weighted covariance of the whitened vectors less the identity."""
    w = [F.get("w", F.lit(i)) for i in range(k)]
    weight = F.col("weight").cast("double")
    means = once.agg(F.sum(weight).alias("n"), *[F.sum(weight * w[i]).alias(f"m{i}") for i in range(k)]).first()
    mean = [means[f"m{i}"] / means["n"] for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = once.agg(*[F.sum(weight * (w[i] - F.lit(mean[i])) * (w[j] - F.lit(mean[j]))).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(sums[f"c{i}_{j}"] / means["n"] - (i == j)) for i, j in pairs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four components of every embedding, fitted on each different vector once."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return whiten(vectors).select("vec_id", "n", "deviation", "identity_error", F.inline("whitened"))
