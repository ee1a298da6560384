"""Embedding whitening by an incremental eigendecomposition.

Entries c become whole numbers x = floor(64 c) + 1000000. The fit list holds each distinct
x vector once. Each partition of it applies one centred rank-one update per vector
(``spectrum``: secular equation with deflation). The partitions' spectra meet in a tree, a few
at a time, each merge being rank-one updates by the other spectrum's pairs and by the way
between the means. The basis so found holds all dimensions; a last pass over the fit list
sums the centred covariance in that basis, and its eigenvectors (Rayleigh-Ritz) are the
components: their precision hangs on that pass alone, not on the order of the updates. A second
pass of the same kind measures the covariance of the whitened fit list.

Counts, sums and deviations are whole numbers and exact; a deviation beyond the range of long
is NULL. A task holds one spectrum (dimensions squared), a merge ``ARITY`` of them, the
driver one. Every stage between two passes is a written table. An update costs about the
cube of the dimensions in flops, some 0.8 ms for 64.

Results for odd input: a NULL vector, or one with a NULL, non-finite or huge entry (2^46 or
more), is dropped; so is a vector of another length than the most frequent one (ties: the
shortest), and an empty one. Repeated rows are fitted once and returned each. NULL and repeated
keys are returned as they are. A component with eigenvalue 0 (fewer distinct vectors than
components) has NULL in ``whitened`` and doesn't count in ``identity_error``; a single distinct
vector has NULL in ``explained`` and ``identity_error`` as well. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.llm.spectrum import EPS, Spectrum
from tabml.session import staged

SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 46)
ARITY = 8
PART_ROWS = 4_000
_LONG = (1 << 63) - 1


@dataclass
class Whitening:
    """``components`` columns are unit eigenvectors by falling eigenvalue; mean is sums / n."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float | None

    @property
    def solid(self) -> np.ndarray:
        """Components whose eigenvalue is more than rounding."""
        return self.eigenvalues > len(self.sums) * EPS * max(float(self.eigenvalues[0]), 0.0)

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as whole numbers and a fraction below one."""
        whole = [s // self.n for s in self.sums]
        return np.array(whole, np.int64), np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole)])


def lattice(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)


def usable(rows: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """Rows with a whole, finite vector of the most frequent length, and that length (0: no rows)."""
    entries = F.col(vector)

    def fits(c: Column) -> Column:
        c = c.cast("double")
        return F.coalesce(~F.isnan(c) & (F.abs(c) < LARGEST), F.lit(False))

    good = rows.filter(entries.isNotNull() & (F.size(entries) > 0) & F.forall(entries, fits))
    sizes = good.groupBy(F.size(entries).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), "size").first()
    if most is None:
        return good, 0
    return good.filter(F.size(entries) == most["size"]), most["size"]


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, size)


def _exact_sums(rows: np.ndarray) -> list[int]:
    if len(rows) and int(np.abs(rows).max()) * len(rows) >= _LONG:
        return [int(s) for s in rows.astype(object).sum(0)]
    return [int(s) for s in rows.sum(0)]


# One state per task: spectra and moments travel as bytes, sums as decimal text.
_STATE = "part long, n long, sums array<string>, base binary, offset binary, first binary, second binary"


def _packed(part: int, n: int, sums: list[int], *parts: np.ndarray) -> pd.DataFrame:
    row = [part, n, [str(s) for s in sums], *[np.ascontiguousarray(p).tobytes() for p in parts]]
    return pd.DataFrame([row], columns=["part", "n", "sums", "base", "offset", "first", "second"])


def _floats(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.float64)


def _spectrum_of(row) -> Spectrum:
    size = len(row.sums)
    vectors = _floats(row.second).reshape(size, size)
    return Spectrum(row.n, np.frombuffer(row.base, np.int64), _floats(row.offset), _floats(row.first), vectors)


def _merged_spectra(group: pd.DataFrame) -> pd.DataFrame:
    rows = list(group.sort_values("part").itertuples())
    whole, sums = _spectrum_of(rows[0]), [int(s) for s in rows[0].sums]
    for row in rows[1:]:
        whole.merge(_spectrum_of(row))
        sums = [a + int(b) for a, b in zip(sums, row.sums)]
    return _packed(rows[0].part // ARITY, whole.n, sums, whole.base, whole.offset, whole.values, whole.vectors)


def _merged_moments(group: pd.DataFrame) -> pd.DataFrame:
    rows = list(group.sort_values("part").itertuples())
    first, second = sum(_floats(r.first) for r in rows), sum(_floats(r.second) for r in rows)
    none = np.empty(0)
    return _packed(rows[0].part // ARITY, sum(r.n for r in rows), [], none, none, first, second)


def _reduced(states: DataFrame, merge: Callable) -> Row:
    """All states in one: groups of ``ARITY`` neighbours, round after round; each round is written."""
    states = staged(states, "spectra")
    left = states.agg((F.max("part") + 1).alias("n")).first()["n"]
    while left > 1:
        near = F.floor(F.col("part") / ARITY)
        states = staged(states.groupBy(near.alias("_near")).applyInPandas(merge, _STATE), "spectra")
        left = -(-left // ARITY)
    return states.first()


def _states(fit: DataFrame, parts: int, work: Callable[[Iterator[np.ndarray]], pd.DataFrame | None], size: int) -> DataFrame:
    """``work`` on the vectors of each of ``parts`` even parts of the fit list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = work(_matrix(b.column("x"), size) for b in batches if b.num_rows)
        if state is not None:
            state["part"] = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pandas(state, preserve_index=False)

    return fit.repartition(parts, F.xxhash64("x")).mapInArrow(run, _STATE)


def spectra(fit: DataFrame, parts: int, size: int) -> DataFrame:
    """One spectrum per part of the fit list, by a rank-one update per vector."""

    def work(blocks: Iterator[np.ndarray]) -> pd.DataFrame | None:
        whole, sums = None, [0] * size
        for rows in blocks:
            sums = [a + b for a, b in zip(sums, _exact_sums(rows))]
            whole = whole or Spectrum.empty(rows[0])
            for row in rows:
                whole.add(row)
        if whole is None:
            return None
        return _packed(0, whole.n, sums, whole.base, whole.offset, whole.values, whole.vectors)

    return _states(fit, parts, work, size)


def _moments(fit: DataFrame, parts: int, size: int, model: Whitening, onto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and mean square product of the centred vectors projected on the columns of ``onto``."""
    whole, fraction = model.centre()
    width = onto.shape[1]

    def work(blocks: Iterator[np.ndarray]) -> pd.DataFrame | None:
        n, first, second = 0, np.zeros(width), np.zeros((width, width))
        for rows in blocks:
            seen = ((rows - whole).astype(np.float64) - fraction) @ onto
            n, first, second = n + len(rows), first + seen.sum(0), second + seen.T @ seen
        none = np.empty(0)
        return _packed(0, n, [], none, none, first, second) if n else None

    row = _reduced(_states(fit, parts, work, size), _merged_moments)
    return _floats(row["first"]) / row["n"], _floats(row["second"]).reshape(width, width) / row["n"]


def fit_list(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Each distinct x vector once."""
    return rows.select(lattice(F.col(vector)).alias("x")).distinct()


def fit(rows: DataFrame, size: int, vector: str = "embedding", components: int = 16) -> Whitening | None:
    """The whitening of ``rows``, all of them usable and of ``size`` entries; None without rows."""
    if not size:
        return None
    points = staged(fit_list(rows, vector), "fit-list")
    parts = max(points.sparkSession.sparkContext.defaultParallelism, -(-points.count() // PART_ROWS))
    rough = _reduced(spectra(points, parts, size), _merged_spectra)
    basis = _spectrum_of(rough).vectors
    model = Whitening(rough["n"], [int(s) for s in rough["sums"]], basis, np.zeros(size), 0.0, None)
    _, inner = _moments(points, parts, size, model, basis)
    values, turned = np.linalg.eigh((inner + inner.T) / 2)
    found = (basis @ turned)[:, ::-1][:, :components]
    # Either sign is right: the largest entry of each component is positive.
    found = found * np.sign(found[np.abs(found).argmax(0), np.arange(found.shape[1])])
    model.components, model.eigenvalues, model.trace = found, values[::-1][:components], float(np.trace(inner))
    solid = model.solid
    if solid.any():
        onto = found[:, solid] / np.sqrt(model.eigenvalues[solid])
        mean, square = _moments(points, parts, size, model, onto)
        model.identity_error = float(np.abs(square - np.outer(mean, mean) - np.eye(onto.shape[1])).max())
    return model


def _deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Sum over the dimensions of (n x - S)^2, exactly."""
    whole, _ = model.centre()
    rest = np.array([s - int(w) * model.n for s, w in zip(model.sums, whole)], np.int64)
    away = x - whole
    reach = (int(np.abs(away).max(initial=0)) + 1) * model.n
    if reach * reach * len(whole) < _LONG:
        apart = model.n * away - rest
        return (apart * apart).sum(1).tolist()
    sums = (((model.n * away.astype(object)) - rest.astype(object)) ** 2).sum(1)
    return [int(s) if s <= _LONG else None for s in sums]


def whitened(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 16) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) per usable row and component."""
    good, size = usable(rows, vector)
    model = fit(good, size, vector, components)
    schema = T.StructType(
        [T.StructField(key, rows.schema[key].dataType), T.StructField("component", T.IntegerType())]
        + [T.StructField(c, T.LongType()) for c in ("n", "deviation")]
        + [T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")]
    )
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    points = good.select(F.col(key).alias(key), lattice(F.col(vector)).alias("_x"))
    width, solid = len(model.eigenvalues), model.solid
    onto = model.components / np.sqrt(np.where(solid, model.eigenvalues, 1.0))
    explained = model.eigenvalues / model.trace if model.trace > 0 else np.full(width, np.nan)
    whole, fraction = model.centre()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _matrix(batch.column("_x"), size)
            seen = ((x - whole).astype(np.float64) - fraction) @ onto
            each = pa.array(np.repeat(np.arange(n), width))
            deviation = pa.array(_deviations(x, model), pa.int64())
            columns = [
                batch.column(key).take(each),
                pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), n)),
                pa.array(np.full(n * width, model.n, np.int64)),
                deviation.take(each),
                pa.array(seen.ravel(), mask=~np.tile(solid, n)),
                pa.array(np.tile(explained, n), mask=np.tile(np.isnan(explained), n)),
                pa.array([model.identity_error] * (n * width), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return points.mapInArrow(score, schema)
