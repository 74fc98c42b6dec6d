"""Constant-velocity Kalman forecast as fixed weights.

With fixed noise the gains do not depend on the positions, so the forecast is a
weighted sum of the observed ones. The few weights are worked out once per setting and
become literals of a column expression.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(maxsize=None)
def kalman_weights(obs_len: int, horizon: int, process: float = 1e-5, measure: float = 0.05 ** 2) -> tuple[float, ...]:
    """Weights of the observed positions in the position ``horizon`` steps ahead."""
    move = np.array([[1.0, 1.0], [0.0, 1.0]])
    see = np.array([[1.0, 0.0]])
    # Each column of the state follows one unit impulse in the observations.
    seen = np.eye(obs_len)
    state = np.stack([seen[0], seen[1] - seen[0]])
    spread = np.eye(2)
    for step in range(obs_len):
        if step:
            state = move @ state
            spread = move @ spread @ move.T + process * np.eye(2)
        gain = spread @ see.T / (see @ spread @ see.T + measure)
        state = state + gain @ (seen[step][None, :] - see @ state)
        spread = (np.eye(2) - gain @ see) @ spread
    ahead = np.linalg.matrix_power(move, horizon) @ state
    return tuple(float(w) for w in ahead[0])


def forecast(points: Column, axis: str, obs_len: int, horizon: int) -> Column:
    """Forecast of one coordinate from the first ``obs_len`` entries of an array of points.

    A fold over the weights: written out term by term, the generated code grows beyond
    what the JVM compiles.
    """
    weights = F.array(*[F.lit(w) for w in kalman_weights(obs_len, horizon)])
    terms = F.zip_with(F.slice(points, 1, obs_len), weights, lambda p, w: w * p[axis])
    return F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)
