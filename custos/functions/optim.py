"""Newton minimiser over batches of points.

The objective scores a *batch* of parameter vectors at once, so that a
distributed objective (one pass with a sum per point) costs about one job an
iteration: the step lengths, together with the central differences around the
points of the longest ones; only where a shorter one is taken, a second job
scores the differences around its point.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import combinations

import numpy as np


def newton_minimize(objective: Callable[[np.ndarray], np.ndarray], x0: Sequence[float], tol: float = 1e-9,
                    width: float = 1e-3, max_iter: int = 200):
    """Minimise ``objective`` (batch -> values) from ``x0``; (best point, value, iterations).

    Ends when no step length improves the value by more than ``tol`` of it;
    raises when ``max_iter`` iterations do not get there.
    """
    x = np.asarray(x0, dtype="float64")
    k = len(x)
    unit = np.eye(k) * width
    pairs = list(combinations(range(k), 2))
    lengths = 2.0 ** np.arange(2, -14, -1)
    around = np.array([np.zeros(k), *unit, *-unit, *(unit[i] + unit[j] for i, j in pairs), *(-unit[i] - unit[j] for i, j in pairs)])
    ahead = int((lengths >= 1.0).sum())
    v = np.asarray(objective(x + around), dtype="float64")
    for iteration in range(max_iter):
        at, up, down = v[0], v[1:k + 1], v[k + 1:2 * k + 1]
        gradient = (up - down) / (2 * width)
        hessian = np.diag((up + down - 2 * at) / width ** 2)
        for n, (i, j) in enumerate(pairs):
            both = v[2 * k + 1 + n] + v[2 * k + 1 + len(pairs) + n]
            hessian[i, j] = hessian[j, i] = (both - up[i] - up[j] - down[i] - down[j] + 2 * at) / (2 * width ** 2)
        curve, axes = np.linalg.eigh(hessian)
        step = -axes @ (axes.T @ gradient / np.maximum(np.abs(curve), 1e-6))
        step *= min(1.0, 1.0 / max(float(np.linalg.norm(step)), 1e-300))
        trial = x + lengths[:, None] * step
        scored = np.asarray(objective(np.concatenate([trial, *(t + around for t in trial[:ahead])])), dtype="float64")
        values, near = scored[:len(lengths)], scored[len(lengths):].reshape(ahead, -1)
        values = np.where(np.isfinite(values), values, np.inf)
        best = int(np.argmin(values))
        if not values[best] < at - tol * max(1.0, abs(at)):
            return x, float(at), iteration
        x = trial[best]
        v = near[best] if best < ahead else np.asarray(objective(x + around), dtype="float64")
    raise ArithmeticError(f"no minimum after {max_iter} iterations")
