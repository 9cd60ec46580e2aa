"""Whitening of embeddings by a covariance over distinct vectors.

Rows are grouped by their quantised vector ``x``.  Each distinct vector counts once, or as often as it
stands, in the mean and in the covariance; a task centres its vectors and multiplies them as one matrix, and the
products are added up entry by entry.  Distinct vectors are whitened once and joined back to the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .vectors import SCALE, matrix, pieces, quantised

COMPONENTS = 4
HOT_SHARE = 1000  # a vector of more than a thousandth of the rows is hot; there are fewer than a thousand such vectors


@dataclass
class Model:
    """What the fit list says: its weight, sums, the eigenvectors (rows) by falling eigenvalue, the eigenvalues and the trace."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Centred rows on each component over the root of its eigenvalue; NaN where the eigenvalue is zero."""
        scale = np.where(self.values > 0, np.sqrt(np.maximum(self.values, 0)), np.nan)
        return (x - self.sums / self.n) @ self.vectors.T / scale

    def deviation(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sum over dimensions of (n * x - sums) ** 2, exact, and whether it fits in 64 bits.  Products wrap around, so a sum that fits is right."""
        near = self.n * x.astype(np.float64) - self.sums
        with np.errstate(over="ignore"):
            gap = np.int64(self.n) * x - self.sums
            return (gap * gap).sum(axis=1), (near * near).sum(axis=1) < 2.0 ** 63 * (1 - 1e-9)


def sums(df: DataFrame, column: str, dims: int) -> np.ndarray:
    """Weighted sum of each dimension of ``column``, then the sum of the weights; ``df`` also has ``weight``.  Whole numbers add up exactly."""
    kind = df.schema[column].dataType.elementType.simpleString()

    def run(batches):
        total = np.zeros(dims + 1, np.int64 if kind == "bigint" else np.float64)
        for batch in batches:
            for piece in pieces(batch, dims):
                w = piece.column("weight").to_numpy()
                total[:dims] += (matrix(piece.column(column)) * w[:, None]).sum(axis=0)
                total[dims] += w.sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims + 1)), pa.array(total)], ["i", "v"])

    rows = df.select(column, "weight").mapInArrow(run, f"i long, v {kind}").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(dims + 1, np.int64 if kind == "bigint" else np.float64)
    for i, v in rows:
        out[i] = v
    return out


def covariance(df: DataFrame, column: str, mean: np.ndarray, n: float) -> np.ndarray:
    """Weighted covariance of ``column`` with divisor ``n``, centred before it is multiplied; the driver gets one number per pair of dimensions."""
    dims = len(mean)

    def run(batches):
        total = np.zeros((dims, dims))
        for batch in batches:
            for piece in pieces(batch, dims):
                y = matrix(piece.column(column)) - mean
                total += (y * piece.column("weight").to_numpy()[:, None]).T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims)), pa.array(total.ravel())], ["i", "v"])

    table = df.select(column, "weight").mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(dims * dims)
    out[table["i"].to_numpy()] = table["v"].to_numpy()
    out = out.reshape(dims, dims) / n
    return (out + out.T) / 2


def fit(distinct: DataFrame, dims: int, components: int = COMPONENTS) -> Model:
    """The model over the fit list (x, weight) of vectors with ``dims`` entries."""
    total = sums(distinct, "x", dims)
    n = int(total[dims])
    v = covariance(distinct, "x", total[:dims] / n, n)
    values, vectors = np.linalg.eigh(v)
    first = np.argsort(-values, kind="stable")[:components]
    trace = float(np.trace(v))
    # what rounding leaves of a zero is no variance
    values = np.where(values[first] > 1e-12 * max(trace, 0) / dims, values[first], 0.0)
    return Model(n, total[:dims], vectors[:, first].T.copy(), values, trace)


def distinct_vectors(rows: DataFrame, weights: str = "one") -> DataFrame:
    """x, times, weight of each distinct ``x``: the fit list, with weight one or the number of its rows."""
    if weights not in ("one", "count"):
        raise ValueError("weights are 'one' or 'count'")
    return rows.groupBy("x").agg(F.count(F.lit(1)).alias("times")).withColumn("weight", F.lit(1).cast("long") if weights == "one" else F.col("times"))


def whitened(embeddings: DataFrame, weights: str = "one", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of each row of ``embeddings`` (vec_id, embedding) and component.

    Rows take part if their vector is neither null nor empty, all its entries are finite and it is as long as the longest;
    all other columns are left out.  ``x`` is floor(scale * entry), which is taken to lie within 2 ** 31.  Null and repeated
    ids stay as they are, and a row that stands twice is returned twice.  Components are unit eigenvectors by falling eigenvalue, of
    either sign, the same for all rows; a vector of fewer dimensions has fewer.  ``whitened`` is null for a component without
    variance, ``explained`` null where there is none at all, ``deviation`` null beyond 64 bits.  ``identity_error``
    covers the components with variance.  An empty table gives an empty table.
    """
    rows = quantised(embeddings.select("vec_id", "embedding"), "embedding", scale)
    distinct = written(distinct_vectors(rows, weights))
    head = distinct.agg(F.max(F.size("x")).alias("dims"), F.sum("times").alias("rows")).first()
    if not head["rows"]:
        return embeddings.select("vec_id").filter("false").selectExpr(
            "vec_id", "0 AS component", "0L AS n", "0L AS deviation", "0D AS whitened", "0D AS explained", "0D AS identity_error")
    dims = head["dims"]
    model = fit(distinct, dims, components)

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, dims):
                x = matrix(piece.column("x"))
                w, (gap, fits) = model.whitened(x), model.deviation(x)
                flat = pa.array(w.ravel(), mask=np.isnan(w).ravel())
                offsets = pa.array(np.arange(0, w.size + 1, w.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays([piece.column("x"), piece.column("times"), piece.column("weight"), pa.ListArray.from_arrays(offsets, flat),
                                                  pa.array(gap, mask=~fits)], ["x", "times", "weight", "w", "deviation"])

    done = written(distinct.mapInArrow(run, "x array<long>, times long, weight long, w array<double>, deviation long"))
    with_variance = np.flatnonzero(model.values > 0)
    error = 0.0
    if len(with_variance):
        kept = done.select(F.array(*[F.get("w", int(i)) for i in with_variance]).alias("w"), "weight")
        mean = sums(kept, "w", len(with_variance))[:-1] / model.n
        error = float(np.abs(covariance(kept, "w", mean, model.n) - np.eye(len(with_variance))).max())

    # hot vectors, fewer than a thousand, meet their rows without a shuffle
    hot = done.filter(F.col("times") * HOT_SHARE > head["rows"]).select("x", "w", "deviation")
    rest = done.filter(F.col("times") * HOT_SHARE <= head["rows"]).select("x", "w", "deviation")
    joined = rows.join(F.broadcast(hot), "x").unionByName(rows.join(F.broadcast(hot.select("x")), "x", "left_anti").join(rest, "x"))
    explained = F.array(*[F.lit(float(v / model.trace) if model.trace > 0 else None).cast("double") for v in model.values])
    return joined.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
