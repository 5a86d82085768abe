"""Per-series arithmetic that runs inside tasks, one model row at a time.

Pickled by value, so executors need numpy and pandas but not this package.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _square(triangle: np.ndarray, size: int) -> np.ndarray:
    full = np.zeros((size, size))
    full[np.triu_indices(size)] = triangle
    return full + np.triu(full, 1).T


def _regress(gram: np.ndarray, chosen: Sequence[int]) -> tuple[np.ndarray, float]:
    """Least squares of column 0 on the chosen columns: coefficients and error sum."""
    x = gram[np.ix_(chosen, chosen)]
    ridge = 1e-10 * np.trace(x) / len(chosen)
    beta = np.linalg.solve(x + ridge * np.eye(len(chosen)), gram[chosen, 0])
    return beta, float(gram[0, 0] - 2 * beta @ gram[chosen, 0] + beta @ x @ beta)


def _inside(coefficients: Sequence[float]) -> bool:
    """Whether the recursion with these coefficients dies out."""
    if not len(coefficients):
        return True
    return bool(np.abs(np.roots(np.r_[1.0, -np.asarray(coefficients)])).max() < 0.999)


def solve_long(order: int):
    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for row in batch.itertuples():
                # target and constant come before the lags
                gram = _square(np.asarray(row.gram), order + 2)
                if row.n <= order + 2 or gram[0, 0] <= 0:
                    continue
                try:
                    beta, _ = _regress(gram, range(1, order + 2))
                except np.linalg.LinAlgError:
                    continue
                found.append((row.series_id, float(beta[0]), beta[1:].tolist()))
            yield pd.DataFrame(found, columns=["series_id", "long_intercept", "long_ar"])

    return solve


def choose_order(order: int, fixed: tuple[int, int] | None):
    orders = [fixed] if fixed else [
        (p, q) for p in range(order + 1) for q in range(order + 1 - p)
    ]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["series_id", "n", "p", "q", "intercept", "ar", "ma", "sigma", "aic"]
        for batch in batches:
            found = []
            for row in batch.itertuples():
                gram = _square(np.asarray(row.gram), 2 * order + 2)
                best = None
                for p, q in orders:
                    chosen = [1, *range(2, 2 + p), *range(2 + order, 2 + order + q)]
                    if row.n <= len(chosen):
                        continue
                    try:
                        beta, error = _regress(gram, chosen)
                    except np.linalg.LinAlgError:
                        continue
                    ar, ma = beta[1 : 1 + p], beta[1 + p :]
                    if error <= 1e-9 * gram[0, 0] or not _inside(ar) or not _inside(-ma):
                        continue
                    aic = row.n * np.log(error / row.n) + 2 * len(chosen)
                    if best is None or aic < best[-1]:
                        sigma = float(np.sqrt(error / row.n))
                        best = (p, q, float(beta[0]), ar.tolist(), ma.tolist(), sigma, aic)
                if best:
                    found.append((row.series_id, row.n, *best))
            yield pd.DataFrame(found, columns=columns)

    return solve


def _path(model, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forecasts of the season-free series and their standard errors at the ``wanted`` steps.

    The recursion runs until what it starts from has died out. From there on forecasts are
    constant, or linear where the series was differenced, and so is the variance, so a step
    far ahead costs no more than a near one.
    """
    ar, ma = np.asarray(model.ar, dtype=float), np.asarray(model.ma, dtype=float)
    z = list(np.asarray(model.last_z, dtype=float)[: len(ar)])
    e = list(np.nan_to_num(np.asarray(model.last_e, dtype=float)[: len(ma)]))
    last = int(wanted.max())
    means, psis, recent_psi = [], [], [1.0]
    for h in range(last):
        mean = model.intercept + np.dot(ar, z) + np.dot(ma, e)
        means.append(mean)
        if len(ar):
            z = [mean, *z[:-1]]
        if len(ma):
            e = [0.0, *e[:-1]]
        psis.append(recent_psi[0])
        weights = recent_psi[: len(ar)]
        following = np.dot(ar[: len(weights)], weights) + (ma[h] if h < len(ma) else 0.0)
        recent_psi = [following, *recent_psi[: max(len(ar) - 1, 0)]]
        small = 1e-13 * (1 + abs(mean))
        if h > len(ma) and np.abs(recent_psi).max() < 1e-13 and all(abs(x - mean) < small for x in z):
            break
    mean, psi = np.array(means), np.array(psis)
    if model.d == 1:
        mean, psi = model.last_y + np.cumsum(mean), np.cumsum(psi)
    variance = np.cumsum(psi**2)
    at = np.minimum(wanted, len(mean)) - 1
    beyond = wanted - 1 - at
    growth = means[-1] if model.d == 1 else 0.0
    spread = psi[-1] ** 2 if model.d == 1 else 0.0
    return mean[at] + beyond * growth, model.sigma * np.sqrt(variance[at] + beyond * spread)


def forecast_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for model in batch.itertuples():
            wanted = np.asarray(model.wanted, dtype=np.int64)
            if not len(wanted):
                continue
            mean, error = _path(model, wanted)
            yield pd.DataFrame({"series_id": model.series_id, "step": wanted, "mean": mean, "se": error})
