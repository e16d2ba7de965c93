"""Whitening of embeddings by spectral divide-and-conquer on their covariance (QDWH).

1. Each entry becomes an integer, floor(64 c) + 1000000; a row is packed into few bytes.
   The distinct packed rows are the fit list: Spark joins equal rows in
   each task before it shuffles them, so a vector that fills a third of the table is one row.
2. Sums are exact integers. The covariance is summed from centred rows: each task gives one
   small matrix, and Spark adds them up. Only matrices of the dimension's size reach the driver.
3. The covariance's eigenvectors come from polar decompositions of the shifted matrix (dynamically
   weighted Halley iterations by QR): with the polar factor U, (U + I) / 2 projects on
   the eigenvectors above the shift. Bases of both invariant subspaces split the matrix in two
   smaller ones, down to single components.
4. Mean and components (a matrix of the dimension's size) go to all tasks, which whiten every row.

Defined results: rows whose vector is null, empty, or holds a null, a non-finite entry or one whose integer
is beyond 62 bits are left out; so are rows whose length isn't the commonest one (of ties the largest), since they
belong to another space. A null vec_id keeps its row; repeated rows each get theirs. Components whose eigenvalue is not above
RANK_EPS of the largest have no whitened values and are left out, so one distinct row gives no
rows, as does an empty table. ``deviation`` is null where it doesn't fit a long. Equal eigenvalues: any
orthonormal basis of their space. Columns other than vec_id and embedding are ignored. Vectors of any length are taken
whole; the driver holds a few matrices of length squared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tripmart.llm.common import stored

GRID, ORIGIN = 64, 1_000_000
COMPONENTS = 16
#: Eigenvalues below this part of the largest are noise of rounding.
RANK_EPS = 1e-13
LIMIT = 2**62
WIDTHS = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.int64}


# -- packed integer rows ----------------------------------------------------------------


def grid(vectors: pa.Array) -> list[bytes | None]:
    """Packed integers of each vector: the width in bytes, then the entries less ORIGIN; None if left out."""
    col = vectors.cast(pa.list_(pa.float64()))
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    values = col.flatten()
    bad = values.is_null().to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(values.fill_null(0.0).to_numpy(zero_copy_only=False) * GRID)
        bad = bad | ~(np.abs(x) < LIMIT)
    lengths = np.array(col.value_lengths().fill_null(0), np.int64)
    ends = np.cumsum(lengths)
    wrong = np.concatenate([[0], np.cumsum(bad)])
    ok = (lengths > 0) & (wrong[ends] == wrong[ends - lengths])
    x = np.where(bad, 0, x).astype(np.int64)
    out: list[bytes | None] = []
    for good, a, b in zip(ok.tolist(), (ends - lengths).tolist(), ends.tolist()):
        if not good:
            out.append(None)
            continue
        row = x[a:b]
        low, high = int(row.min()), int(row.max())
        width = next(w for w in WIDTHS if -(1 << (8 * w - 1)) <= low and high < 1 << (8 * w - 1))
        out.append(bytes([width]) + row.astype(f"<i{width}").tobytes())
    return out


def unpack(rows: list[bytes]) -> np.ndarray:
    """(rows, dimension) integers less ORIGIN of packed rows of one dimension."""
    out = np.empty((len(rows), (len(rows[0]) - 1) // rows[0][0]), np.int64)
    widths = np.array([r[0] for r in rows])
    for w in np.unique(widths):
        at = np.flatnonzero(widths == w)
        out[at] = np.frombuffer(b"".join(rows[i][1:] for i in at), f"<i{w}").reshape(len(at), -1)
    return out


def _grid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = grid(batch.column("embedding"))
        dim = [None if p is None else (len(p) - 1) // p[0] for p in packed]
        out = pa.record_batch([batch.column("vec_id"), pa.array(packed, pa.binary()), pa.array(dim, pa.int32())], names=["vec_id", "x", "dim"])
        yield out.filter(out.column("dim").is_valid())


# -- sums over the fit list --------------------------------------------------------------


def _offsets(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly: int64 where it fits, else Python integers."""
    if int(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0) < LIMIT:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n, rounded once."""
    return (_offsets(x, n, sums) / n).astype(np.float64)


def _column_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x = unpack(batch.column("x").to_pylist())
            # halves: their sums stay far below 64 bits, and Spark adds up the parts as decimals
            yield pa.record_batch([pa.array(np.arange(x.shape[1])), pa.array((x >> 32).sum(axis=0)), pa.array((x & 0xFFFFFFFF).sum(axis=0)),
                                   pa.array(np.full(x.shape[1], len(x)))], names=["j", "high", "low", "n"])


def _products(n: int, sums: list[int], onto: np.ndarray | None):
    """Per task, the sum of outer products of centred rows (or of what they are on ``onto``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                z = centred(unpack(batch.column("x").to_pylist()), n, sums)
                z = z if onto is None else z @ onto
                total = z.T @ z if total is None else total + z.T @ z
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.record_batch([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "v"])

    return run


def covariance(fit: DataFrame, n: int, sums: list[int], onto: np.ndarray | None = None) -> np.ndarray:
    parts = fit.mapInArrow(_products(n, sums, onto), "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    size = len(sums) if onto is None else onto.shape[1]
    out = np.zeros((size, size))
    for i, j, v in parts.collect():  # size squared rows at most
        out[i, j] = out[j, i] = v / n
    return out


# -- spectral divide-and-conquer ------------------------------------------------------------


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The symmetric orthogonal factor of a symmetric matrix: its matrix sign, by QDWH iterations."""
    m = len(a)
    eye = np.eye(m)
    x = a / np.linalg.norm(a)
    # lower bound of the smallest singular value; for a singular matrix the least that arithmetic tells apart
    try:
        low = 1 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        low = 0.0
    low = min(max(low, 1e-17), 1.0)
    for _ in range(40):
        d = (4 * (1 - low**2) / low**4) ** (1 / 3)
        r = np.sqrt(1 + d)
        s = r + np.sqrt(max(8 - 4 * d + 8 * (2 - low**2) / (low**2 * r), 0.0)) / 2
        b = (s - 1) ** 2 / 4
        c = s + b - 1
        q = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))[0]
        new = b / c * x + (s - b / c) / np.sqrt(c) * q[:m] @ q[m:].T
        new = (new + new.T) / 2
        moved, x = np.linalg.norm(new - x), new
        low = min(low * (s + b * low**2) / (1 + c * low**2), 1.0)
        if moved < 1e-10 and 1 - low < 1e-10:
            break
    return x


def _split(a: np.ndarray, shift: float, rng: np.random.Generator) -> tuple[np.ndarray, int, float]:
    """An orthogonal basis whose first k columns span the eigenvectors above ``shift``; what is left between both parts."""
    m = len(a)
    projector = (polar_factor(a - shift * np.eye(m)) + np.eye(m)) / 2
    k = int(round(np.trace(projector)))
    if not 0 < k < m:
        return np.eye(m), k, np.inf
    basis = np.linalg.qr(projector @ rng.standard_normal((m, k)))[0]
    basis = np.linalg.qr(projector @ basis, mode="complete")[0]
    rest = basis[:, k:] - projector @ basis[:, k:]
    basis[:, k:] = np.linalg.qr(rest - basis[:, :k] @ (basis[:, :k].T @ rest))[0]
    return basis, k, float(np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k]))


def components(a: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    Splits each block at a shift between its eigenvalues, until a block is a number
    times the unit matrix up to rounding. A shift that leaves all on one side bounds the search; one too near an eigenvalue is moved.
    """
    a = np.asarray(a, np.float64)
    scale, rng = np.linalg.norm(a), np.random.default_rng(seed)
    values, vectors = np.zeros(len(a)), np.eye(len(a))
    noise = 4e-16 * scale
    todo = [(0, np.eye(len(a)))]
    while todo:
        at, span = todo.pop()
        m = span.shape[1]
        block = span.T @ a @ span
        block = (block + block.T) / 2
        mean = np.trace(block) / m
        off = block - mean * np.eye(m)
        if m == 1 or np.linalg.norm(off) <= noise * np.sqrt(m):
            values[at:at + m], vectors[:, at:at + m] = np.diag(block), span
            continue
        radius = np.linalg.norm(off)
        low, high, best = mean - radius, mean + radius, None
        shift = float(np.median(np.diag(block)))
        for _ in range(60):
            basis, k, left = _split(block, shift, rng)
            if 0 < k < m:
                if best is None or left < best[2]:
                    best = (basis, k, left)
                if left <= 4 * noise * np.sqrt(m):
                    break
                shift += (rng.random() - 0.5) * 0.1 * radius / m  # too near an eigenvalue
            else:
                low, high = (shift, high) if k == m else (low, shift)
                shift = (low + high) / 2
        if best is None:  # eigenvalues that no shift tells apart
            values[at:at + m], vectors[:, at:at + m] = np.diag(block), span
            continue
        basis, k, _ = best
        todo += [(at, span @ basis[:, :k]), (at + k, span @ basis[:, k:])]
    vectors = np.linalg.qr(vectors)[0]
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# -- whitening ------------------------------------------------------------------------------


def _whiten(n: int, sums: list[int], onto: np.ndarray, explained: np.ndarray, error: float, schema: pa.Schema):
    k = onto.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            offsets = _offsets(unpack(batch.column("x").to_pylist()), n, sums)
            z = (offsets / n).astype(np.float64) @ onto
            if offsets.dtype != object and offsets.shape[1] * int(np.abs(offsets).max()) ** 2 < 2**63:
                deviation = pa.array((offsets * offsets).sum(axis=1))
            else:
                wide = (offsets.astype(object) ** 2).sum(axis=1)
                deviation = pa.array([v if v < 2**63 else None for v in wide], pa.int64())
            rows = pa.array(np.repeat(np.arange(m), k))
            yield pa.record_batch([
                batch.column("vec_id").take(rows), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                deviation.take(rows), pa.array(z.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))], schema=schema)

    return run


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: up to ``most`` rows a vector."""
    spark = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType
    name = kind.simpleString()
    out = f"vec_id {name}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    packed = stored(vectors.select("vec_id", "embedding").mapInArrow(_grid, f"vec_id {name}, x binary, dim int"), "whitening_grid")
    dim = packed.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if dim is None:
        return spark.createDataFrame([], out)
    packed = packed.where(F.col("dim") == dim["dim"]).select("vec_id", "x")
    fit = stored(packed.select("x").distinct(), "whitening_fit")
    parts = fit.mapInArrow(_column_sums, "j long, high long, low long, n long").groupBy("j").agg(
        *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")], F.sum("n").alias("n"))
    cells = sorted(parts.collect())  # a row a dimension
    n, sums = int(cells[0]["n"]), [(int(c["high"]) << 32) + int(c["low"]) for c in cells]
    cov = covariance(fit, n, sums)
    values, basis = components(cov)
    k = int((values[:most] > RANK_EPS * max(values[0], 0)).sum()) if values[0] > 0 else 0
    if not k:
        return spark.createDataFrame([], out)
    onto = basis[:, :k] / np.sqrt(values[:k])
    error = float(np.abs(covariance(fit, n, sums, onto) - np.eye(k)).max())
    fields = [pa.field("vec_id", to_arrow_type(kind)), pa.field("component", pa.int32()), pa.field("n", pa.int64()), pa.field("deviation", pa.int64()),
              pa.field("whitened", pa.float64()), pa.field("explained", pa.float64()), pa.field("identity_error", pa.float64())]
    return packed.mapInArrow(_whiten(n, sums, onto, values[:k] / np.trace(cov), error, pa.schema(fields)), out)

