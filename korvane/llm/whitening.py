"""Embedding whitening: the leading eigenvectors of the covariance by block Lanczos, without ever forming it."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import finite_vector, stage

#: Entries stay below this in size, so that differences of two fit a long.
MOST = 1 << 60
#: A pair is found once its residual is below TOLERANCE times the largest eigenvalue; a direction shorter than BREAKDOWN times it is none.
TOLERANCE, BREAKDOWN = 1e-14, 1e-12
#: Restarts with no better residuals after which what is found is as good as double precision gives.
PATIENCE = 3
#: Residuals above this times the largest eigenvalue are an error.
WORST = 1e-9


def integers(vectors: DataFrame, scale: int, shift: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, x): finite vectors of the commonest length (the greatest of several) as floor(scale * entry) + shift."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(finite_vector(F.col("v")) & F.forall("v", lambda c: F.abs(c * scale) < MOST))
    sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    dim = sizes[0]["dim"] if sizes else 0
    return rows.where(F.size("v") == dim).select("id", F.transform("v", lambda c: F.floor(c * scale) + F.lit(shift)).alias("x"))


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64)


def sums(rows: DataFrame, dim: int) -> list[int]:
    """The exact sum of each dimension."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = [0] * dim
        for pdf in batches:
            if len(pdf):
                x = matrix(pdf["x"])
                fits = float(np.abs(x).max()) * len(x) < 2**62
                total = [a + int(b) for a, b in zip(total, x.sum(0) if fits else x.astype(object).sum(0), strict=True)]
        yield pd.DataFrame({"dim": range(dim), "s": [Decimal(v) for v in total]})

    found = rows.select("x").mapInPandas(run, "dim int, s decimal(38,0)").groupBy("dim").agg(F.sum("s").alias("s")).collect()
    out = [0] * dim
    for r in found:
        out[r["dim"]] = int(r["s"])
    return out


def centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """x less the mean in double precision. The mean's whole part goes as an integer, so that a large shift costs no digits."""
    whole = np.array([s // n for s in total], dtype=np.int64)
    rest = np.array([(s % n) / n for s in total])
    return (x - whole).astype(np.float64) - rest


def deviations(x: np.ndarray, n: int, total: list[int]) -> list[int]:
    """For each row the exact sum of (n x - total)^2."""
    far = max((float(np.abs(x).max()) * n, *(abs(float(s)) for s in total)))
    if far < 2**61:
        y = x * n - np.array(total, dtype=np.int64)
        if float(np.abs(y).max()) ** 2 * y.shape[1] < 2**62:
            return (y * y).sum(1).tolist()
        y = y.astype(object)
    else:
        y = x.astype(object) * n - np.array(total, dtype=object)
    return (y * y).sum(1).tolist()


def summed(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], height: int, width: int) -> np.ndarray:
    """The sum of part(x), a matrix of height x width, over all batches of vectors: one matrix a task, added up by a grouping; height rows reach the driver."""
    names = [f"w{j}" for j in range(width)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((height, width))
        for pdf in batches:
            if len(pdf):
                total += part(matrix(pdf["x"]))
        out = pd.DataFrame(total, columns=names)
        out.insert(0, "row", np.arange(height))
        yield out

    parts = rows.select("x").mapInPandas(run, "row int, " + ", ".join(f"{c} double" for c in names))
    found = parts.groupBy("row").agg(*[F.sum(c).alias(c) for c in names]).collect()
    out = np.zeros((height, width))
    for r in found:
        out[r["row"]] = r[1:]
    return out


def orthonormal(block: np.ndarray, basis: np.ndarray, least: float) -> np.ndarray:
    """The directions of block outside basis, orthonormal; those shorter than least are left out. Every column is cleaned of all before it, three times over."""
    out = []
    for v in block.T:
        full = np.column_stack([basis, *out]) if out else basis
        start = v
        for _ in range(3):
            v = v - full @ (full.T @ v)
        size = np.linalg.norm(v)
        if size > max(least, 1e-10 * np.linalg.norm(start)):
            v = v / size
            v = v - full @ (full.T @ v)
            out.append(v / np.linalg.norm(v))
    return np.column_stack(out) if out else np.zeros((len(block), 0))


def eigenpairs(apply: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, block: int = 16, most: int | None = None, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, vectors as columns, residuals) of the wanted largest eigenvalues of the symmetric operator apply, by block Lanczos.

    A step applies the operator to a block of at most `block` directions and orthogonalises the result against the whole
    basis. Where directions are lost (breakdown), random ones take their place. The basis holds at most `most` directions
    (by default twice what is wanted and two blocks); then it restarts from the best Ritz vectors, whose images are known.
    It ends when all wanted residuals are at the level of double precision, or no more directions are left. Basis and
    images are two matrices of dim x most on the driver, however many rows lie behind the operator.
    """
    wanted = min(wanted, dim)
    most = min(dim, most or max(2 * wanted, wanted + block) + 2 * block)
    keep = min(wanted + block // 2, most - 1) if most < dim else most
    random = np.random.default_rng(seed)
    basis, images = np.zeros((dim, 0)), np.zeros((dim, 0))
    new = random.standard_normal((dim, min(block, dim)))
    best, idle, top = np.inf, 0, 0.0
    while True:
        fresh = orthonormal(new, basis, BREAKDOWN * top)
        room = min(block, most - basis.shape[1])
        while fresh.shape[1] < min(room, 1):  # breakdown: the basis is closed under the operator
            fresh = orthonormal(random.standard_normal((dim, room)), basis, 0.0)
        fresh = fresh[:, :room]
        basis, images = np.hstack([basis, fresh]), np.hstack([images, apply(fresh)])
        small = basis.T @ images
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        top = max(abs(values[0]), abs(values[-1]))
        head = turn[:, :wanted]
        residuals = images @ head - basis @ head * values[:wanted]
        sizes = np.linalg.norm(residuals, axis=0)
        full = basis.shape[1] == dim
        if full or (basis.shape[1] >= wanted and (sizes <= TOLERANCE * top).all()):
            break
        new = images[:, -fresh.shape[1] :]
        if basis.shape[1] >= most:
            worst = sizes.max()
            best, idle = (worst, 0) if worst < 0.5 * best else (best, idle + 1)
            if idle >= PATIENCE:
                break
            ritz = turn[:, :keep]
            open_ = np.argsort(-sizes, kind="stable")[:block]
            new = residuals[:, open_]
            basis, images = basis @ ritz, images @ ritz
    vectors = basis @ turn[:, :wanted]
    return values[:wanted], vectors / np.linalg.norm(vectors, axis=0), sizes


def whiten(vectors: DataFrame, components: int = 32, scale: int = 64, shift: int = 1_000_000, block: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, n, deviation, whitened, explained, identity_error) for each vector that takes part.

    An entry c becomes the integer x = floor(scale * c) + shift. Of the n integer vectors with sums S, V is the covariance
    (divisor n). whitened and explained are arrays over the leading eigenvectors of V, at most `components`, by falling
    eigenvalue e: (x - S/n) on the eigenvector over sqrt(e), and e over the trace of V, which is the sum of all deviations
    over n^3. deviation, a decimal, is the exact sum over the dimensions of (n x - S)^2. identity_error is the largest absolute
    entry of the covariance of all `whitened` less the identity.

    V is never formed: block Lanczos asks for V Q for blocks Q, and each such pass over the staged vectors adds up
    Y^T (Y Q) of the centred vectors Y by task. It raises an error if residuals stay above 1e-9 of the largest eigenvalue.

    Eigenvalues that rounding can't tell from zero have no component, so a table of few or equal vectors has fewer, or
    none (empty arrays, identity_error 0). Left out are vectors that are null, hold null or non-finite entries, or entries
    of 2^60 / scale and more in size, and those not of the commonest length (the greatest of several). Repeated rows count
    and come back as often as they are there, with their null or repeated ids. An empty table gives an empty result.
    Other columns are not read.
    """
    schema = "id {}, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    rows = stage(integers(vectors, scale, shift, id_col, vector_col), "whiten-vectors")
    schema = schema.format(rows.schema["id"].dataType.simpleString())
    shape = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("dim")).first()
    n, dim = shape["n"], shape["dim"] or 0
    if not n or not dim:
        return rows.sparkSession.createDataFrame([], schema)
    total = sums(rows, dim)
    values, axes, residuals = eigenpairs(lambda q: summed(rows, lambda x: _product(centred(x, n, total), q), dim, q.shape[1]) / n, dim, components, block)
    if residuals.size and residuals.max() > WORST * max(values[0], 0):
        raise ArithmeticError(f"block Lanczos stopped at a residual of {residuals.max()} for a largest eigenvalue of {values[0]}")
    real = values > max(values[0], 0) * dim * 1e-13
    values, axes = values[real], axes[:, real]
    k = len(values)
    turn = axes / np.sqrt(values)

    def moments(x: np.ndarray) -> np.ndarray:
        z = centred(x, n, total) @ turn
        return np.vstack([z.T @ z, z.sum(0)])

    seen = summed(rows, moments, k + 1, k) / n if k else np.zeros((1, 0))
    error = float(np.abs(seen[:k] - np.outer(seen[k], seen[k]) - np.eye(k)).max()) if k else 0.0
    spread = sum_of_deviations(rows, n, total)
    explained = [float(v) / (spread / n**3) for v in values]

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = matrix(pdf["x"])
                z = centred(x, n, total) @ turn
                yield pd.DataFrame({"id": pdf["id"], "n": n, "deviation": [Decimal(v) for v in deviations(x, n, total)], "whitened": list(z), "explained": [explained] * len(x), "identity_error": error})

    return rows.mapInPandas(project, schema)


def _product(y: np.ndarray, q: np.ndarray) -> np.ndarray:
    return y.T @ (y @ q)


def sum_of_deviations(rows: DataFrame, n: int, total: list[int]) -> int:
    """The exact sum of deviations() over all rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = sum(sum(deviations(matrix(pdf["x"]), n, total)) for pdf in batches if len(pdf))
        yield pd.DataFrame({"high": [Decimal(s >> 64)], "low": [Decimal(s & (2**64 - 1))]})

    found = rows.select("x").mapInPandas(run, "high decimal(38,0), low decimal(38,0)").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).first()
    return (int(found["high"]) << 64) + int(found["low"])


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """whiten over all embeddings, a row for each vector and component; a deviation that no long holds is null."""
    out = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    rows = out.select("id", "n", F.col("deviation").try_cast("long").alias("deviation"), "explained", "identity_error", F.posexplode("whitened").alias("place", "whitened"))
    return rows.select(F.col("id").alias("vec_id"), (F.col("place") + 1).alias("component"), "n", "deviation", "whitened", F.get("explained", F.col("place")).alias("explained"), "identity_error")
