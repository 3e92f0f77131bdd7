"""Whitened embeddings from an incremental eigendecomposition.

Vectors become whole numbers first (``floor(scale * c) + shift``), so counts, sums and deviations are exact.

1. Each partition starts with no spread at all and takes its vectors one by one: the scatter matrix of the
   rows so far is kept as eigenvalues and eigenvectors, and a row adds one centred rank-one term. The new
   eigenvalues are the roots of the secular equation, found for all intervals at once by rational
   interpolation inside brackets; entries of the update that are next to nothing, and equal eigenvalues, are deflated
   first. New eigenvectors come from the Löwner form of the update, so they stay orthogonal.
2. Spectra of partitions are combined in groups of ``FAN_IN``, group by group until one is left: every eigenpair
   of the other is a rank-one update, and one more joins the two means.
3. The basis found is refined by Rayleigh-Ritz: all rows are projected on it, their exactly centred products are
   summed over the partitions, and the small projected matrix gives the final pairs.

No step holds more than one batch and a few ``width x width`` matrices; matrices of partitions are stored, so a
lost executor costs its own partitions. The number of rows on the driver is the number of widths, times
``width`` squared numbers.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries, or entries beyond ``2^40``
after scaling, are dropped. Vectors of each width are a fit of their own. Repeated rows and ids stay and count. Components
whose variance is not above ``1e-12`` of the largest are left out (one row, equal rows: no components at
all). Components of equal variance are any orthogonal pair. An empty table gives no rows. Columns other than the two are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rankloom.llm.tables import bounded_batches, stored

SCALE, SHIFT = 1024, 100_000
FAN_IN = 16
_LARGEST = float(1 << 40)
_NEGLIGIBLE = 1e-12
_EPS = float(np.finfo(np.float64).eps)


# --- the update -----------------------------------------------------------------------------------


def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum(z2 / (d - x)) = 0`` for ascending, distinct ``d`` and positive ``z2``.

    Returns the index of the pole each root is measured from (the nearer one) and the distance from it. Root
    ``j`` lies between ``d[j]`` and ``d[j + 1]``, the last below ``d[-1] + sum(z2)``.
    """
    k = len(d)
    at = np.arange(k)
    right = np.append(d[1:], d[-1] + z2.sum())
    gap = right - d
    # which half of its interval a root lies in decides the pole it is measured from
    middle = gap / 2
    f = 1 + (z2 / ((d[None, :] - d[:, None]) - middle[:, None])).sum(axis=1)
    from_right = (f < 0) & (at < k - 1)
    origin = at + from_right
    delta = d[None, :] - d[origin][:, None]
    lo, hi = np.where(f < 0, middle, 0.0), np.where(f < 0, gap, middle)
    lo, hi = np.where(from_right, lo - gap, lo), np.where(from_right, hi - gap, hi)
    x = (lo + hi) / 2
    ends = delta[at, np.minimum(at + 1, k - 1)].copy()
    ends[-1] = gap[-1]
    lower = np.tri(k, dtype=bool)  # poles at or left of the root's interval
    for _ in range(80):
        step = delta - x[:, None]
        terms = z2 / step
        f = 1 + terms.sum(axis=1)
        done = np.abs(f) <= 4 * _EPS * k * (1 + np.abs(terms).sum(axis=1))
        lo, hi = np.where(f <= 0, x, lo), np.where(f >= 0, x, hi)
        done |= hi - lo <= 2 * _EPS * np.maximum(np.abs(lo), np.abs(hi))
        if done.all():
            break
        slopes = terms / step
        psi = np.where(lower, slopes, 0.0).sum(axis=1)
        phi = slopes.sum(axis=1) - psi
        near, far = delta[at, at] - x, ends - x
        a = (near + far) * f - near * far * (psi + phi)
        b = near * far * f
        c = f - near * psi - far * phi
        with np.errstate(divide="ignore", invalid="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            eta = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        moved = x + eta
        inside = np.isfinite(moved) & (moved > lo) & (moved < hi)
        x = np.where(done, x, np.where(inside, moved, (lo + hi) / 2))
    return origin, x


class Spectrum:
    """Scatter matrix of rows about their mean as ``basis @ diag(values) @ basis.T``, values ascending."""

    def __init__(self, width: int):
        self.n, self.mean = 0, np.zeros(width)
        self.values, self.basis = np.zeros(width), np.eye(width)

    def add(self, row: np.ndarray) -> None:
        """One more row: the mean moves, the scatter takes one centred rank-one term."""
        away = row - self.mean
        self.update(away, self.n / (self.n + 1))
        self.n += 1
        self.mean += away / self.n

    def merge(self, other: "Spectrum") -> None:
        """The rows of another spectrum, by its eigenpairs and one term for the two means."""
        if not other.n:
            return
        for value, vector in zip(other.values, other.basis.T):
            self.update(vector, float(value))
        away, n = other.mean - self.mean, self.n + other.n
        self.update(away, self.n * other.n / n)
        self.mean += away * (other.n / n)
        self.n = n

    def update(self, v: np.ndarray, rho: float) -> None:
        """Add ``rho`` times the outer product of ``v``."""
        z = self.basis.T @ v
        size = rho * float(z @ z)
        if not size > 0:
            return
        scale = max(float(self.values[-1]), size)
        z *= np.sqrt(rho)
        z[np.abs(z) <= 8 * _EPS * np.sqrt(scale)] = 0.0
        active = np.flatnonzero(z)
        # equal eigenvalues: turn their vectors so that only the last of them meets the update
        for i, j in zip(active[:-1], active[1:]):
            if self.values[j] - self.values[i] <= 8 * _EPS * scale:
                r = np.hypot(z[i], z[j])
                c, s = z[j] / r, z[i] / r
                left, right = self.basis[:, i].copy(), self.basis[:, j].copy()
                self.basis[:, i], self.basis[:, j] = c * left - s * right, s * left + c * right
                z[i], z[j] = 0.0, r
        active = np.flatnonzero(z)
        if not len(active):
            return
        d, z2 = self.values[active], z[active] ** 2
        origin, x = secular_roots(d, z2)
        apart = (d[None, :] - d[origin][:, None]) - x[:, None]  # [root, pole] = pole - root
        apart = np.where(apart == 0, np.finfo(np.float64).tiny, apart)
        # the update whose exact eigenvalues these are
        between = d[None, :] - d[:, None]
        np.fill_diagonal(between, 1.0)
        with np.errstate(divide="ignore"):
            exact = np.exp(0.5 * (np.log(np.abs(apart)).sum(axis=0) - np.log(np.abs(between)).sum(axis=0)))
        vectors = (np.copysign(exact, z[active]) / apart).T
        vectors /= np.linalg.norm(vectors, axis=0)
        self.basis[:, active] = self.basis[:, active] @ vectors
        self.values[active] = d[origin] + x
        order = np.argsort(self.values, kind="stable")
        self.values, self.basis = self.values[order], self.basis[:, order]

    def packed(self) -> bytes:
        return np.concatenate([[float(self.n)], self.mean, self.values, self.basis.ravel()]).tobytes()

    @staticmethod
    def unpacked(raw: bytes, width: int) -> "Spectrum":
        numbers = np.frombuffer(raw)
        out = Spectrum(width)
        out.n, out.mean = int(numbers[0]), numbers[1 : 1 + width].copy()
        out.values, out.basis = numbers[1 + width : 1 + 2 * width].copy(), numbers[1 + 2 * width :].reshape(width, width).copy()
        return out


# --- rows -----------------------------------------------------------------------------------------


def whole_rows(vectors: DataFrame, id_col: str, vector_col: str, scale: int, shift: int) -> DataFrame:
    """``vec_id, width, x`` of the rows that are kept: vectors as whole numbers."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = bounded_batches(vectors).select(F.col(f"`{id_col}`").alias("vec_id"), v.alias("_v"))
    fits = lambda c: F.abs(c) <= _LARGEST / scale  # NaN is greater than any number
    usable = F.forall("_v", lambda c: F.coalesce(fits(c), F.lit(False)))
    # the condition again, as Spark may move the filter behind this
    whole = F.transform("_v", lambda c: F.when(fits(c), F.floor(c * scale).cast("long") + F.lit(shift).cast("long")))
    return rows.where(F.col("_v").isNotNull() & (F.size("_v") > 0) & usable).select("vec_id", F.size("_v").alias("width"), whole.alias("x"))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``width, places in the batch, rows`` for each width in each batch."""
    for batch in batches:
        widths = batch.column("width").to_numpy(zero_copy_only=False)
        column = batch.column("x")
        flat, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
        for width in np.unique(widths):
            places = np.flatnonzero(widths == width)
            yield int(width), places, flat[offsets[places][:, None] + np.arange(width)[None, :]]


_STATES = "width int, part long, state binary"


def _folded(start: Callable, take: Callable, pack: Callable):
    """One packed state per width and partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[int, object] = {}
        for width, _, rows in _matrices(batches):
            if width not in states:
                states[width] = start(width)
            take(states[width], width, rows)
        part = TaskContext.get().partitionId()
        for width, state in states.items():
            yield pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), pa.array([part], pa.int64()), pa.array([pack(state)], pa.binary())], ["width", "part", "state"])

    return run


def _combined(states: DataFrame, merge: Callable[[int, list[bytes]], bytes], name: str) -> DataFrame:
    """One state per width: groups of ``FAN_IN`` become one, level by level, each level stored."""

    def group(table: pa.Table) -> pa.Table:
        width, part = table.column("width")[0].as_py(), table.column("part")[0].as_py()
        order = np.argsort(table.column("part").to_numpy(), kind="stable")
        raws = [table.column("state")[int(i)].as_py() for i in order]
        return pa.table({"width": pa.array([width], pa.int32()), "part": pa.array([part // FAN_IN], pa.int64()), "state": pa.array([merge(width, raws)], pa.binary())})

    states = stored(states, name)
    while (states.agg(F.max("part").alias("m")).first()["m"] or 0) > 0:
        grouped = states.withColumn("_g", F.floor(F.col("part") / FAN_IN)).groupBy("width", "_g")
        states = stored(grouped.applyInArrow(lambda table: group(table.select(["width", "part", "state"])), _STATES), name)
    return states


def _merged_spectra(width: int, raws: list[bytes]) -> bytes:
    out = Spectrum.unpacked(raws[0], width)
    for raw in raws[1:]:
        out.merge(Spectrum.unpacked(raw, width))
    return out.packed()


def _summed(width: int, raws: list[bytes]) -> bytes:
    return np.sum([np.frombuffer(r) for r in raws], axis=0).tobytes()


class Whitening:
    """Means, components and variances of each width, fitted on all rows."""

    def __init__(self, fits: dict[int, dict]):
        self.fits = fits

    def matrix(self, width: int, components: int) -> np.ndarray:
        """``width x components``: what a centred row is multiplied with."""
        fit = self.fits[width]
        kept = fit["kept"][:components]
        return fit["basis"][:, kept] / np.sqrt(fit["values"][kept])


def _centred(rows: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``(n * x - S)``, exact: in 64-bit numbers where these suffice."""
    most = n * int(np.abs(rows).max(initial=0)) + max(map(abs, map(int, sums)), default=0)
    if most < 1 << 62:
        return rows * n - sums.astype(np.int64)
    return rows.astype(object) * n - sums


def _floats(centred: np.ndarray, n: int) -> np.ndarray:
    return centred.astype(np.float64) / n


def _deviations(centred: np.ndarray) -> list[int]:
    most = int(np.abs(centred).max(initial=0))
    if most * most * centred.shape[1] < 1 << 63:
        return (centred * centred).sum(axis=1).tolist()
    wide = centred.astype(object)
    return (wide * wide).sum(axis=1).tolist()


def fit(rows: DataFrame) -> Whitening:
    """Fit on all ``rows`` (``width, x`` of ``whole_rows``)."""
    # partitions: spectra by rank-one updates
    def take(state: Spectrum, width: int, found: np.ndarray) -> None:
        for row in found.astype(np.float64):
            state.add(row)

    spectra = _combined(rows.select("width", "x").mapInArrow(_folded(Spectrum, take, Spectrum.packed), _STATES), _merged_spectra, "spectra")
    sums = (
        rows.select("width", F.posexplode("x").alias("d", "v"))
        .groupBy("width", "d")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
        .groupBy("width")
        .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("d", "s"))).alias("s"))
    )
    fits = {r["width"]: {"n": r["n"], "sums": np.array([int(e["s"]) for e in r["s"]], dtype=object)} for r in sums.collect()}
    for r in spectra.collect():
        # an orthogonal basis again, whatever the many updates left
        fits[r["width"]]["start"] = np.linalg.qr(Spectrum.unpacked(r["state"], r["width"]).basis)[0]
    shared = rows.sparkSession.sparkContext.broadcast({w: (f["n"], f["sums"], f["start"]) for w, f in fits.items()})

    def project(state: np.ndarray, width: int, found: np.ndarray) -> None:
        n, s, start = shared.value[width]
        seen = _floats(_centred(found, n, s), n) @ start
        state += seen.T @ seen

    products = _combined(rows.select("width", "x").mapInArrow(_folded(lambda w: np.zeros((w, w)), project, lambda m: m.tobytes()), _STATES), _summed, "projected")
    for r in products.collect():
        f, width = fits[r["width"]], r["width"]
        small = np.frombuffer(r["state"]).reshape(width, width) / f["n"]
        values, turn = np.linalg.eigh((small + small.T) / 2)
        f["values"], basis = np.maximum(values[::-1], 0.0), (f["start"] @ turn)[:, ::-1]
        strongest = basis[np.abs(basis).argmax(axis=0), np.arange(width)]
        f["basis"] = basis * np.where(strongest < 0, -1.0, 1.0)
        f["trace"] = float(np.trace(small))
        f["kept"] = np.flatnonzero(f["values"] > _NEGLIGIBLE * max(float(f["values"][0]), np.finfo(np.float64).tiny))
    return Whitening(fits)


def identity_errors(rows: DataFrame, model: Whitening, components: int) -> dict[int, float]:
    """Per width the largest absolute entry of the whitened rows' covariance less the identity, over all rows."""
    shared = rows.sparkSession.sparkContext.broadcast({w: (f["n"], f["sums"], model.matrix(w, components)) for w, f in model.fits.items()})

    def take(state: np.ndarray, width: int, found: np.ndarray) -> None:
        n, s, matrix = shared.value[width]
        white = _floats(_centred(found, n, s), n) @ matrix
        k = matrix.shape[1]
        state[:k] += white.sum(axis=0)
        state[k:] += (white.T @ white).ravel()

    def start(width: int) -> np.ndarray:
        k = shared.value[width][2].shape[1]
        return np.zeros(k + k * k)

    totals = _combined(rows.select("width", "x").mapInArrow(_folded(start, take, lambda m: m.tobytes()), _STATES), _summed, "whitened")
    out = {}
    for r in totals.collect():
        n, _, matrix = shared.value[r["width"]]
        k, numbers = matrix.shape[1], np.frombuffer(r["state"])
        mean = numbers[:k] / n
        covariance = numbers[k:].reshape(k, k) / n - np.outer(mean, mean)
        out[r["width"]] = float(np.abs(covariance - np.eye(k)).max(initial=0.0))
    return out


_WHITE = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: up to ``components`` rows for each vector."""
    rows = whole_rows(vectors, id_col, vector_col, scale, shift)
    model = fit(rows)
    errors = identity_errors(rows, model, components)
    shared = rows.sparkSession.sparkContext.broadcast(
        {w: (f["n"], f["sums"], model.matrix(w, components), (f["values"] / f["trace"])[f["kept"][:components]] if f["trace"] else np.zeros(0), errors[w]) for w, f in model.fits.items()}
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, places, found in _matrices([batch]):
                n, s, matrix, share, error = shared.value[width]
                k = matrix.shape[1]
                if not k:
                    continue
                centred = _centred(found, n, s)
                white = _floats(centred, n) @ matrix
                ids = batch.column("vec_id").take(pa.array(np.repeat(places, k)))
                deviations = pa.array([Decimal(v) for v in _deviations(centred)], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(places))),
                        pa.array(np.full(len(places) * k, n, np.int64)),
                        deviations.take(pa.array(np.repeat(np.arange(len(places)), k))),
                        pa.array(white.ravel()),
                        pa.array(np.tile(share, len(places))),
                        pa.array(np.full(len(places) * k, error)),
                    ],
                    ["vec_id", *[c.split()[0] for c in _WHITE.split(", ")]],
                )

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, {_WHITE}")
