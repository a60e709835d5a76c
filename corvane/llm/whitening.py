"""Embeddings whitened by the eigenvectors of their covariance, refined from single precision."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from corvane.llm.common import parts, written

SCALE, SHIFT = 1024, 100_000
EDGE = 2.0 ** 62
COMPONENTS = 8
FAN_IN = 64
SWEEPS = 12
CLOSE = 1e-5  # of the matrix's norm: what single-precision vectors tell apart for certain
DEPTH = 8
HIGH = np.longdouble
MOST = (1 << 63) - 1


@dataclass
class Whitening:
    """Count, sums per dimension, unit eigenvectors as columns, their eigenvalues, and the trace."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float


def usable(df: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector is a non-empty list of finite numbers, as ``_vector``."""
    finite = F.forall(vector_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return df.filter(finite & (F.size(vector_col) > 0)).withColumn("_vector", F.col(vector_col).cast("array<double>"))


def _matrix(batch: pa.RecordBatch, column: str, length: int) -> np.ndarray:
    """Long x of the batch's vectors, one row each; values beyond 2^62 stop there."""
    entries = batch[column].flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
    return np.clip(np.floor(entries * SCALE), -EDGE, EDGE).astype(np.int64) + SHIFT


def totals(rows: DataFrame) -> tuple[int, list[int]]:
    """Count and exact sums of x over the vectors of the most frequent length (of equals the longest)."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in parts(batches):
            sizes = np.array(batch["_vector"].value_lengths())
            for size in np.unique(sizes).tolist():
                x = _matrix(batch.filter(pa.array(sizes == size)), "_vector", size)
                n, high, low = held.get(size, (0, 0, 0))
                held[size] = (n + len(x), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0))
        for size, (n, high, low) in held.items():
            yield pa.RecordBatch.from_pydict({
                "size": np.full(size, size), "dim": np.arange(size), "n": np.full(size, n), "high": high, "low": low})

    exact = "decimal(38,0)"
    sums = rows.select("_vector").mapInArrow(add, "size bigint, dim bigint, n bigint, high bigint, low bigint").groupBy(
        "size", "dim").agg(F.sum("n").alias("n"), *[F.sum(F.col(c).cast(exact)).alias(c) for c in ("high", "low")])
    sums = written(sums, "sums")
    best = sums.filter("dim = 0").orderBy(F.desc("n"), F.desc("size")).first()
    if best is None:
        return 0, []
    found = sums.filter(F.col("size") == best["size"]).orderBy("dim").collect()
    return best["n"], [(int(r["high"]) << 32) + int(r["low"]) for r in found]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n: the whole part of the mean goes in integers, the rest in double precision."""
    whole, rest = zip(*(divmod(s, n) for s in sums))
    return (x - np.array(whole)).astype(np.float64) - np.array(rest, np.float64) / n


def covariance(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """V of the centred vectors, divisor n.

    Every task multiplies its centred rows into one matrix; these are added row by row in a tree
    of 64 at a time, always in the order of the tasks. The driver gets the finished matrix alone.
    """
    d = len(sums)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((d, d))
        for batch in parts(batches):
            y = _centred(_matrix(batch, "_vector", d), n, sums)
            held += y.T @ y
        if held.any():
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(d, part)), pa.array(np.arange(d)), pa.array(list(held))], ["part", "dim", "row"])

    schema = "part bigint, dim bigint, row array<double>"
    level = written(rows.select("_vector").mapInArrow(multiply, schema), "products")

    def add(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values("part")
        total = np.sum(np.stack(ordered["row"].to_numpy()), axis=0)
        return pd.DataFrame({"part": [int(ordered["part"].iloc[0]) // FAN_IN], "dim": [ordered["dim"].iloc[0]], "row": [total]})

    most = level.agg(F.max("part")).first()[0]
    if most is None:
        return np.zeros((d, d))
    while True:
        level = level.groupBy("dim", F.floor(F.col("part") / FAN_IN)).applyInPandas(add, schema)
        most //= FAN_IN
        if not most:
            break
    found = {r["dim"]: r["row"] for r in level.collect()}
    v = np.array([found[i] for i in range(d)]) / n
    return (v + v.T) / 2


def start(a: np.ndarray) -> np.ndarray:
    """Eigenvectors in single precision, as columns by rising eigenvalue."""
    scale = float(np.abs(a).max()) or 1.0
    return np.linalg.eigh((a / scale).astype(np.float32))[1].astype(a.dtype)


def refined(a: np.ndarray, x: np.ndarray, least_gap: float) -> tuple[np.ndarray, np.ndarray, float]:
    """One correction of eigenvectors ``x`` by matrix products: vectors, eigenvalues, largest change.

    With R = I - X'X and S = X'AX the correction of a pair is (s + l_j r) / (l_j - l_i); where two
    eigenvalues are closer than ``least_gap`` or than S and R can tell, only orthogonality is restored.
    """
    r = np.eye(x.shape[1], dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    gap = values[None, :] - values[:, None]
    off = np.where(np.abs(gap) > least_gap, s, 0) + np.diag(np.diag(s) - values)
    apart = np.abs(gap) > max(least_gap, 2 * (_norm(off) + _norm(a) * _norm(r)))
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return x + x @ e, values, float(np.abs(e).max())


def swept(a: np.ndarray, x: np.ndarray, least_gap: float) -> tuple[np.ndarray, np.ndarray]:
    """Corrections until they no longer shrink."""
    before = np.inf
    for _ in range(SWEEPS):
        x, values, change = refined(a, x, least_gap)
        if change >= before / 2:
            break
        before = change
    return x, values


def _norm(m: np.ndarray):
    return np.sqrt((m * m).sum())


def eigenvectors(a: np.ndarray, depth: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of a symmetric matrix, to the precision of its type.

    Single-precision vectors are corrected until nothing changes. Vectors of close eigenvalues span
    the right space by then, but are mixed within it: there the matrix is projected on that space, less the
    mean eigenvalue, and the small problem is solved in the same way, at its own scale. The last
    sweeps go over all vectors.
    """
    if len(a) == 1:
        return np.diag(a).copy(), np.ones((1, 1), a.dtype)
    tiny, norm = float(np.finfo(a.dtype).eps), float(_norm(a))
    x, values = swept(a, start(a), CLOSE * norm)
    for some in close(values, 2 * CLOSE * norm):
        part = x[:, some]
        small = part.T @ (a @ part)
        small = (small + small.T) / 2 - np.diag(np.full(len(some), values[some].mean()))
        if depth < DEPTH and float(_norm(small)) > 64 * len(a) * tiny * norm:
            x[:, some] = part @ eigenvectors(small, depth + 1)[1]
    x, _ = swept(a, x, 1e4 * tiny * norm)
    x, values, _ = refined(a, x, np.inf)
    x = x / np.sqrt((x * x).sum(0))
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def close(values: np.ndarray, limit: float) -> list[np.ndarray]:
    """Index groups of at least two eigenvalues whose neighbours are closer than ``limit``."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > limit) + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def fit_whitening(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all usable vectors; None if there are none.

    Sums are exact integers; the covariance comes from a second pass over the centred vectors; its
    eigenvectors start in single precision and are corrected in extended precision. What reaches
    the driver is the sums and the matrix, whose size is that of the vectors, not of the table.
    Components without variance (1e-13 of the trace or less) are left out.
    """
    rows = usable(df, vector_col)
    n, sums = totals(rows)
    if not n:
        return None
    v = covariance(rows.filter(F.size("_vector") == len(sums)), n, sums)
    values, vectors = eigenvectors(v.astype(HIGH))
    trace = float(np.trace(v))
    kept = [i for i in range(min(components, len(values))) if values[i] > 1e-13 * trace]
    vectors = vectors[:, kept].astype(np.float64)
    signs = np.sign(vectors[np.abs(vectors).argmax(0), range(len(kept))]) if kept else np.ones(0)
    return Whitening(n, sums, vectors * signs, values[kept].astype(np.float64), trace)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums of (n*x - S)^2 in whole numbers; None beyond a long."""
    whole, rest = (np.array(v) for v in zip(*(divmod(s, n) for s in sums)))
    y = x - whole
    bound = n * (max(abs(int(y.min())), abs(int(y.max()))) + 1) if y.size else 0
    if bound * bound * len(sums) <= MOST:
        t = n * y - rest
        return (t * t).sum(1).tolist()
    exact = [sum((n * int(v) - int(r)) ** 2 for v, r in zip(row, rest)) for row in y]
    return [e if e <= MOST else None for e in exact]


def whiten(df: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, deviation, whitened) of the usable vectors that have the model's length."""
    n, sums = model.n, model.sums
    scaled = model.vectors / np.sqrt(model.values)
    schema = T.StructType([
        T.StructField("vec_id", df.schema[id_col].dataType), T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            x = _matrix(batch, "_vector", len(sums))
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], pa.array(_deviations(x, n, sums), pa.int64()),
                 pa.array(list(_centred(x, n, sums) @ scaled), pa.list_(pa.float64()))], schema.names)

    rows = usable(df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector")), "vector")
    return rows.filter(F.size("_vector") == len(sums)).select("vec_id", "_vector").mapInArrow(project, schema)


def identity_error(whitened: DataFrame, k: int) -> float:
    """Largest absolute entry of the whitened vectors' covariance (centred, divisor n) minus the identity."""
    w = [F.col("whitened")[i] for i in range(k)]
    means = whitened.agg(*[F.avg(c) for c in w]).first()
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    found = whitened.agg(*[F.avg((w[i] - F.lit(means[i])) * (w[j] - F.lit(means[j]))) for i, j in pairs]).first()
    return max(abs(found[p] - (i == j)) for p, (i, j) in enumerate(pairs))


SCHEMA = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whitened_rows(spark: SparkSession, df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector and component up to 8, by falling eigenvalue.

    Vectors that are null, empty, or hold null or non-finite entries have no rows, nor have vectors of
    another length than most. Repeated rows and null ids count and are returned each. Entries beyond
    2^62 / 1024 stop there, and a deviation beyond a long is null. Fewer than 8 components remain
    where fewer have any variance; a table without variance, or an empty one, gives no rows.
    Other columns are ignored. The largest entry of each eigenvector is positive.
    """
    model = fit_whitening(df, vector_col)
    schema = T.StructType([
        T.StructField("vec_id", df.schema[id_col].dataType), *T.StructType.fromDDL(SCHEMA).fields])
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema)
    rows = written(whiten(df, model, id_col, vector_col), "whitened")
    error = identity_error(rows, len(model.values))
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "w")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation",
        F.col("w").alias("whitened"), explained[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"))
