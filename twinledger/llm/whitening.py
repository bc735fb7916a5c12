"""Whitening of embeddings on their leading principal components.

Each partition keeps the spectrum of the rows it has seen and takes in one row at a time as a centred rank-one change
(``spectra``).  The spectra of partitions are combined, some at a time, by the same changes.  As such a chain
gathers rounding errors, one more pass projects all rows on the vectors found and solves the small
problem that is left (Rayleigh-Ritz); a last pass measures how far the whitened rows are from unit covariance.

Rows are whole numbers, ``floor(scale * entry)``, so counts and sums are exact, and rows are centred as ``(n * x - S) / n``.
A constant that is added to all entries changes neither that nor anything else here.
What is kept and sent is a few matrices of the vectors' width, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from .common import limit_batches, stored
from .spectra import EPS, Spectrum
from .vectors import matrix, vector_rows

# States that one task combines.
FAN = 8
# Entries beyond are taken for this: whole numbers up to here are exact.
LARGEST = float(1 << 52)
LONG = (1 << 63) - 1


def _whole(column: pa.Array, scale: int, width: int = 0) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * matrix(column, width)), -LARGEST, LARGEST)


def _gathered(rows: DataFrame, state: Callable[[Iterator[pa.RecordBatch]], bytes | None], merge: Callable[[bytes, bytes], bytes]) -> bytes | None:
    """One state of all rows: a state per partition, then ``FAN`` of them at a time."""
    def scan(batches):
        made = state(batches)
        if made is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([made], pa.binary())], names=["part", "state"])

    def some(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")  # the order of sums must not hang on the shuffle
        out = pdf["state"].iloc[0]
        for more in pdf["state"].iloc[1:]:
            out = merge(out, more)
        return pd.DataFrame({"part": [pdf["part"].iloc[0] // FAN], "state": [out]})

    schema = "part long, state binary"
    states = stored(rows.mapInArrow(scan, schema), "states")
    last = states.agg(F.max("part")).first()[0]
    if last is None:
        return None
    while last > 0:
        last //= FAN
        states = states.groupBy(F.floor(F.col("part") / FAN)).applyInPandas(some, schema)
    return bytes(states.first()["state"])


def _spectrum_of(scale: int):
    def state(batches):
        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _whole(batch.column(0), scale)
            now = Spectrum.empty(rows.shape[1]) if now is None else now.widened(rows.shape[1])
            if rows.shape[1] < len(now.mean):
                rows = np.pad(rows, ((0, 0), (0, len(now.mean) - rows.shape[1])))
            # Rows that are equal are one change of more weight.
            kinds, times = np.unique(rows, axis=0, return_counts=True) if rows.shape[1] else (rows[:1], np.array([len(rows)]))
            for row, exact, n in zip(kinds, kinds.astype(np.int64).tolist(), times.tolist()):
                now.add(row, n, exact)
        return None if now is None else now.packed()
    return state


def _centred(rows: np.ndarray, n: int, sums: np.ndarray, largest: int) -> np.ndarray:
    """``n * x - S``, exact: as 64-bit numbers where those hold it, else as Python's."""
    whole = rows.astype(np.int64)
    if n * (int(np.abs(rows).max(initial=0)) + 1) + largest < 1 << 62:
        return whole * n - sums.astype(np.int64)
    return whole.astype(object) * n - sums


@dataclass(frozen=True)
class Whitening:
    """``n`` rows, their exact sums, eigenvectors (columns) and eigenvalues of their covariance by
    falling value, and the trace of the covariance."""
    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    scale: int

    def positive(self, components: int) -> np.ndarray:
        """Which of the first components have a value that is not zero to double precision."""
        return self.values[:components] > 8 * EPS * len(self.values) * self.values[:1]


def _project(fit: Whitening, vectors: np.ndarray) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """From a column of vectors to ``n * x - S`` and the projection of ``x - S / n``."""
    sums = np.array(fit.sums, dtype=object)
    largest = max((abs(s) for s in fit.sums), default=0)

    def project(column):
        off = _centred(_whole(column, fit.scale, len(sums)), fit.n, sums, largest)
        return off, (off / fit.n).astype(float) @ vectors
    return project


def _square_sum(project):
    def state(batches):
        out = None
        for batch in batches:
            if batch.num_rows:
                made = project(batch.column(0))[1]
                out = made.T @ made if out is None else out + made.T @ made
        return None if out is None else out.tobytes()
    return state


def _add(a: bytes, b: bytes) -> bytes:
    return (np.frombuffer(a) + np.frombuffer(b)).tobytes()


def fit_whitening(embeddings: DataFrame, vector: str = "embedding", scale: int = 64) -> Whitening | None:
    """Means and principal components of all vectors that count (not null, finite entries only); None if there are none."""
    limit_batches(embeddings.sparkSession)
    rows = vector_rows(embeddings, vector)
    made = _gathered(rows, _spectrum_of(scale), lambda a, b: Spectrum.unpacked(a).merge(Spectrum.unpacked(b)).packed())
    if made is None:
        return None
    rough = Spectrum.unpacked(made)
    width = len(rough.mean)
    basis = np.linalg.qr(rough.vectors[:, ::-1])[0] if width else rough.vectors
    fit = Whitening(rough.n, tuple(rough.sums), basis, rough.values[::-1], 0.0, scale)
    within = np.frombuffer(_gathered(rows, _square_sum(_project(fit, basis)), _add)).reshape(width, width) / rough.n
    values, turn = np.linalg.eigh(within)
    vectors = basis @ turn[:, ::-1]
    if width:  # the sign that makes the largest entry positive
        vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(width)] < 0, -1.0, 1.0)
    return Whitening(rough.n, tuple(rough.sums), vectors, np.maximum(values[::-1], 0), float(np.trace(within)), scale)


def identity_error(embeddings: DataFrame, fit: Whitening, components: int = 32, vector: str = "embedding") -> float | None:
    """The largest entry, in absolute value, of the whitened rows' covariance less the identity, over all rows;
    None if no component has a value to divide by."""
    use = np.flatnonzero(fit.positive(components))
    if not len(use):
        return None
    root = fit.vectors[:, use] / np.sqrt(fit.values[use])
    made = _gathered(vector_rows(embeddings, vector), _square_sum(_project(fit, root)), _add)
    return float(np.abs(np.frombuffer(made).reshape(len(use), len(use)) / fit.n - np.eye(len(use))).max())


def whiten(embeddings: DataFrame, components: int = 32, vector: str = "embedding", key: str = "vec_id", scale: int = 64) -> DataFrame:
    """Whitened entries of all vectors, on up to ``components`` principal components of ``floor(scale * entry)``.

    Returns, for each vector that counts and each component (from 1, by falling eigenvalue), ``key, component, n, deviation,
    whitened, explained, identity_error``.  Vectors that are null or hold a null, NaN or infinity are left out
    and counted nowhere.  Shorter vectors are filled up with zeros.  Rows that repeat, those of one id included, and rows without an
    id all count.  ``deviation`` is null where it does not fit a long.  A component without variance
    has null in ``whitened``; if none has any, ``explained`` and ``identity_error`` are null too.  Entries beyond
    2 ** 52 after scaling count as that.  No vectors give no rows.  Other columns are ignored.
    """
    schema = T.StructType([T.StructField("_key", embeddings.schema[key].dataType), T.StructField("component", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
                           T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    fit = fit_whitening(embeddings, vector, scale)
    if fit is None or not fit.sums:
        return embeddings.sparkSession.createDataFrame([], schema).withColumnRenamed("_key", key)
    error = identity_error(embeddings, fit, components, vector)
    used = min(components, len(fit.values))
    there = fit.positive(components)
    project = _project(fit, fit.vectors[:, :used] / np.sqrt(np.where(there, fit.values[:used], 1)))
    shares = fit.values[:used] / fit.trace if fit.trace > 0 else np.full(used, np.nan)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, made = project(batch.column(1))
            large = off.dtype == object or int(np.abs(off).max(initial=0)) ** 2 * off.shape[1] > LONG
            far = ((off.astype(object) if large else off) ** 2).sum(axis=1).tolist()
            each = np.repeat(np.arange(len(off)), used)
            spread = lambda x: pa.array(np.tile(x, len(off)), mask=np.tile(np.isnan(x), len(off)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, used + 1, dtype=np.int32), len(off))),
                 pa.array(np.full(len(each), fit.n)), pa.array([f if f <= LONG else None for f in far], pa.int64()).take(pa.array(each)),
                 pa.array(made.ravel(), mask=~np.tile(there, len(off))), spread(shares),
                 pa.array(np.full(len(each), np.nan if error is None else error), mask=np.full(len(each), error is None))],
                names=schema.names)
    return vector_rows(embeddings, vector, F.col(key).alias("_key")).mapInArrow(scan, schema).withColumnRenamed("_key", key)
