"""Rotations that need linear algebra: Arrow kernels over arrays of matrices."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType

VECTOR = ArrayType(DoubleType())
MATRIX = ArrayType(VECTOR)

TO_RIGHT_FORWARD_UP = np.array([[0.0, -1.0, 0.0], [1.0, 0.0, 0.0], [0.0, 0.0, 1.0]])


def proper(basis: np.ndarray) -> np.ndarray:
    """Nearest rotation: a mirrored basis has its first column turned round; one that isn't finite is the identity."""
    if not np.isfinite(basis).all():
        return np.eye(3)
    sign = np.ones(3)
    sign[0] = -1.0 if np.linalg.det(basis) < 0 else 1.0
    u, _, v = np.linalg.svd(basis * sign)
    turn = np.diag([1.0, 1.0, np.sign(np.linalg.det(u @ v)) or 1.0])
    return u @ turn @ v


def quaternion(r: np.ndarray) -> np.ndarray:
    """(w, x, y, z) with the largest of the four squared parts as divisor, so none is near zero.

    A positive trace takes w; otherwise the largest diagonal element's axis leads.
    """
    part = np.array([np.trace(r), *np.diag(r)])
    lead = 0 if part[0] > 0 else 1 + int(np.argmax(part[1:]))
    skew = np.array([r[2, 1] - r[1, 2], r[0, 2] - r[2, 0], r[1, 0] - r[0, 1]])
    if lead == 0:
        w = np.sqrt(1 + part[0]) / 2
        return np.array([w, *(skew / (4 * w))])
    i = lead - 1
    main = np.sqrt(max(1 + 2 * r[i, i] - part[0], 0)) / 2
    out = np.array([skew[i], *(r[i] + r[:, i])]) / (4 * main)
    out[lead] = main
    return out


def proper_batch(bases: np.ndarray) -> np.ndarray:
    """``proper`` of many matrices at once."""
    fine = np.isfinite(bases).all((1, 2))
    m = np.where(fine[:, None, None], bases, np.eye(3))
    m[:, :, 0] *= np.where(np.linalg.det(m) < 0, -1.0, 1.0)[:, None]
    u, _, v = np.linalg.svd(m)
    u[:, :, 2] *= np.where(np.linalg.det(u @ v) < 0, -1.0, 1.0)[:, None]
    return np.where(fine[:, None, None], u @ v, np.eye(3))


@pandas_udf(MATRIX)
def proper_rotation(basis: pd.Series) -> pd.Series:
    return pd.Series(proper_batch(np.array([[list(r) for r in b] for b in basis], float).reshape(-1, 3, 3)).tolist())


@pandas_udf(MATRIX)
def rounded(matrix: pd.Series, digits: pd.Series) -> pd.Series:
    """Matrix rounded as exact binary values are, which decimal rounding of doubles is not."""
    return pd.Series([[[round(float(x), int(n)) for x in row] for row in m] for m, n in zip(matrix, digits, strict=True)])
