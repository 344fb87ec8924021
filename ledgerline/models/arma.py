"""Numbers of one series: residuals, fit and recursion of a multiplicative seasonal model of differenced values.

The model of the differenced series w is ``phi(B) Phi(B^s) w = theta(B) Theta(B^s) e``, so products of ordinary and seasonal
lags take part. ``orders`` is ``(p, q, P, Q)``; ``b`` holds phi, theta, Phi and Theta in that order. Values before the
first one count as zero, so that all orders are compared over the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

SEASON = 12
_STABLE, _STEP = 0.99, 1e-5


def difference(y: np.ndarray) -> np.ndarray:
    """One ordinary and one seasonal difference; ``SEASON + 1`` values shorter."""
    return np.diff(y[SEASON:] - y[:-SEASON]) if len(y) > SEASON + 1 else np.zeros(0)


def _parts(orders: Sequence[int], b: np.ndarray) -> list[np.ndarray]:
    return np.split(np.asarray(b, float), np.cumsum(orders)[:-1])


def lag_weights(orders: Sequence[int], b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of w and e one, two, ... rows back, with the products of ordinary and seasonal ones."""
    phi, theta, seasonal_phi, seasonal_theta = _parts(orders, b)

    def spread(c: np.ndarray) -> np.ndarray:
        out = np.zeros(SEASON * len(c))
        out[SEASON - 1 :: SEASON] = c
        return np.concatenate(([1.0], out))

    ar = np.convolve(np.concatenate(([1.0], -phi)), spread(-seasonal_phi))
    ma = np.convolve(np.concatenate(([1.0], theta)), spread(seasonal_theta))
    return -ar[1:], ma[1:]


def stable(orders: Sequence[int], b: np.ndarray) -> bool:
    """True if own lags and shocks both die out, in the ordinary and in the seasonal part."""
    for c, sign in zip(_parts(orders, b), (1, -1, 1, -1)):
        if len(c):
            companion = np.vstack([sign * c, np.eye(len(c) - 1, len(c))])
            if not np.isfinite(c).all() or np.abs(np.linalg.eigvals(companion)).max() >= _STABLE:
                return False
    return True


def residuals(w: np.ndarray, orders: Sequence[int], points: Sequence[np.ndarray]) -> np.ndarray:
    """One column of residuals per point, all points in one pass over the rows."""
    weights = [lag_weights(orders, b) for b in points]
    made = np.stack([np.convolve(w, np.concatenate(([1.0], -ar)))[: len(w)] for ar, _ in weights], axis=1)
    back = len(weights[0][1])
    if back:
        shocks = np.stack([ma[::-1] for _, ma in weights], axis=1)
        out = np.zeros((len(w) + back, len(points)))
        for t in range(len(w)):
            out[t + back] = made[t] - (shocks * out[t : t + back]).sum(axis=0)
        made = out[back:]
    return made


def fit(w: np.ndarray, orders: Sequence[int], steps: int = 25) -> tuple[np.ndarray, float]:
    """Least conditional sum of squares by damped Gauss-Newton steps; only the moments of residuals and slopes enter a
    step. Returns coefficients and the sum of squares."""
    b = np.repeat([0.1, -0.3, 0.1, -0.3], orders)
    best = float((residuals(w, orders, [b])[:, 0] ** 2).sum())
    damping = 1e-2
    for _ in range(steps if len(b) else 0):
        found = residuals(w, orders, [b, *(b + _STEP * np.eye(len(b)))])
        slopes = (found[:, 1:] - found[:, :1]) / _STEP
        square, side = slopes.T @ slopes, slopes.T @ found[:, 0]
        before = best
        for _ in range(8):
            trial = b - np.linalg.solve(square + np.diag(damping * np.diag(square) + 1e-9), side)
            total = float((residuals(w, orders, [trial])[:, 0] ** 2).sum()) if stable(orders, trial) else np.inf
            if total < best:
                b, best, damping = trial, total, damping / 10
                break
            damping *= 10
        if before - best <= 1e-9 * before:
            break
    return b, best


def criterion(total: float, n: int, k: int) -> float:
    """Corrected information criterion of ``k`` coefficients and a variance."""
    return n * np.log(max(total / n, 1e-12)) + 2 * (k + 1) + 2 * (k + 1) * (k + 2) / (n - k - 2)


def tails(y: np.ndarray, orders: Sequence[int], b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a forecast needs of a series: its last values, differences and shocks."""
    w = difference(y)
    e = residuals(w, orders, [np.asarray(b, float)])[:, 0]
    ar, ma = lag_weights(orders, b)
    return y[-SEASON - 1 :], w[len(w) - min(len(w), len(ar)) :], e[len(e) - min(len(e), len(ma)) :]


def advance(
    state: tuple[np.ndarray, np.ndarray, np.ndarray],
    orders: Sequence[int],
    b: np.ndarray,
    values: Sequence[float | None],
) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """Go on by one row per value: a number is an observation, ``None`` a row to be forecast. Returns the new state and
    what was expected of each row."""
    y, w, e = (list(map(float, part)) for part in state)
    ar, ma = lag_weights(orders, b)
    expected = []
    for value in values:
        drift = y[-1] + y[-SEASON] - y[-SEASON - 1]
        ahead = sum(c * w[-k] for k, c in enumerate(ar, 1) if k <= len(w))
        ahead += sum(c * e[-k] for k, c in enumerate(ma, 1) if k <= len(e))
        expected.append(drift + ahead)
        y.append(expected[-1] if value is None else float(value))
        w.append(y[-1] - drift)
        e.append(w[-1] - ahead)
    kept = (y[-SEASON - 1 :], w[len(w) - min(len(w), len(ar)) :], e[len(e) - min(len(e), len(ma)) :])
    return tuple(map(np.array, kept)), np.array(expected)
