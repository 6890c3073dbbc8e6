"""Singular values and right singular vectors of a small matrix by a bidiagonal qd solver.

Householder reflections make the matrix upper bidiagonal, dqds finds its singular values
without a subtraction that could lose digits, and a twisted factorisation of the shifted
tridiagonal square gives each vector. Values that lie too close for that are made
orthogonal to each other afterwards.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
NEGLIGIBLE = (10 * EPS) ** 2  # of a squared off-diagonal entry beside the squares it couples
CLOSE = 1e-3  # of the largest value: such neighbours' vectors are made orthogonal
MAX_SWEEPS = 200  # for each value; some ten are common


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """v, beta and the new first entry: x - beta * v * (v @ x) has nothing below its first entry."""
    scale = np.abs(x).max()
    if scale == 0 or not np.any(x[1:]):
        return np.zeros_like(x), 0.0, float(x[0])
    v = x / scale
    norm = np.sqrt(v @ v)
    first = -np.copysign(norm, v[0])
    v[0] -= first
    return v, 2 / (v @ v), float(first * scale)


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and V of U' matrix V, for a square matrix."""
    a = np.array(matrix, float)
    n = len(a)
    right = np.eye(n)
    for k in range(n):
        v, beta, first = _reflector(a[k:, k].copy())
        if beta:
            a[k:, k:] -= np.outer(beta * v, v @ a[k:, k:])
        a[k, k], a[k + 1 :, k] = first, 0
        if k < n - 1:
            v, beta, first = _reflector(a[k, k + 1 :].copy())
            if beta:
                a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ v, beta * v)
                right[:, k + 1 :] -= np.outer(right[:, k + 1 :] @ v, beta * v)
            a[k, k + 1], a[k, k + 2 :] = first, 0
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, float] | None:
    """One dqds step: new q and e, the smallest d and the sum of 1 / d; None if the shift is too large."""
    new_q, new_e = [], []
    d = q[0] - shift
    if d < 0:
        return None
    least, inverse = d, 1 / d if d else np.inf
    for i in range(len(e)):
        total = d + e[i]
        ratio = q[i + 1] / total if total else 1.0
        new_q.append(total)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
        if not d >= 0:
            return None
        least = min(least, d)
        inverse += 1 / d if d else np.inf
    new_q.append(d)
    return new_q, new_e, least, inverse


def _block_values(q: list[float], e: list[float]) -> list[float]:
    """Squared singular values of a bidiagonal block from its squared entries."""
    found: list[float] = []
    todo = [(list(q), list(e), 0.0)]
    left = MAX_SWEEPS * (len(q) + 1)
    while todo:
        q, e, base = todo.pop()
        while len(q) > 1:
            if e[-1] <= NEGLIGIBLE * (base + q[-1]):
                found.append(base + q.pop())
                e.pop()
                continue
            cut = next((i for i in range(len(e)) if e[i] <= NEGLIGIBLE * (base + min(q[i], q[i + 1]))), None)
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], base))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:  # grade downwards
                q, e = q[::-1], e[::-1]
            left -= 1
            if left < 0:
                raise ArithmeticError("dqds does not converge")
            # Unshifted, the smallest value lies between 1 / sum(1 / d) and the smallest d.
            plain = _sweep(q, e, 0.0)
            low, high = (1 - 8 * EPS * len(q)) / plain[3], plain[2]
            stepped = None
            for part in () if low >= 0.9 * high else (0.75, 0.25, 0.05):
                shift = low + part * (high - low)
                stepped = _sweep(q, e, shift)
                if stepped:
                    break
                high = shift
            if not stepped:
                shift = low
                stepped = _sweep(q, e, shift)
            if not stepped:
                shift, stepped = 0.0, plain
            q, e, base = stepped[0], stepped[1], base + shift
        found += [base + x for x in q]
    return found


def _twisted(diag: np.ndarray, upper: np.ndarray, value: float) -> np.ndarray:
    """Eigenvector of B'B for an eigenvalue, from the twisted factorisation with the smallest twist."""
    n = len(diag)
    square = diag * diag
    lower = upper / diag[:-1]
    tiny = EPS * EPS * max(value, float(square.max()))
    down, up = np.zeros(n), np.zeros(n)
    to_next, to_last = np.zeros(n), np.zeros(n)
    down[0] = -value
    for i in range(n - 1):
        pivot = down[i] + square[i]
        pivot = pivot if abs(pivot) > tiny else tiny
        to_next[i] = square[i] * lower[i] / pivot
        down[i + 1] = to_next[i] * lower[i] * down[i] - value
    up[-1] = square[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = square[i] * lower[i] * lower[i] + up[i + 1]
        pivot = pivot if abs(pivot) > tiny else tiny
        ratio = square[i] / pivot
        to_last[i] = lower[i] * ratio
        up[i] = up[i + 1] * ratio - value
    twist = int(np.argmin(np.abs(down + up + value)))
    z = np.zeros(n)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -to_next[i] * z[i + 1]
    for i in range(twist, n - 1):
        z[i + 1] = -to_last[i] * z[i]
    return z / np.sqrt(z @ z)


def _separate(tridiagonal: np.ndarray, values: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Orthogonal columns for neighbouring values; what has become dependent is found by inverse iteration."""
    draw = np.random.Generator(np.random.PCG64(11))
    first = 0
    for j in range(1, z.shape[1] + 1):
        if j < z.shape[1] and values[j - 1] - values[j] <= CLOSE * values[0]:
            continue
        for i in range(first + 1, j):
            known = z[:, first:i]
            x = z[:, i]
            for attempt in range(8):
                before = np.sqrt(x @ x)
                x = x - known @ (known.T @ x)
                x = x - known @ (known.T @ x)
                after = np.sqrt(x @ x)
                if after > 0.1 * before:
                    break
                x = draw.standard_normal(len(x))
                shift = values[i] + values[0] * EPS * (4 + attempt)
                for _ in range(3):
                    x = x - known @ (known.T @ x)
                    x = np.linalg.solve(tridiagonal - shift * np.eye(len(x)), x)
                    x /= np.sqrt(x @ x)
            z[:, i] = x / np.sqrt(x @ x)
        first = j
    return z


def right_singular(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of a square matrix, falling, and the right singular vectors as columns."""
    n = len(matrix)
    scale = float(np.abs(matrix).max()) if n else 0.0
    if not scale:
        return np.zeros(n), np.eye(n)
    diag, upper, right = bidiagonalise(matrix / scale)
    size = np.abs(diag).max() if np.abs(diag).max() > 0 else 1.0
    floor = EPS * EPS * max(size, np.abs(upper).max() if n > 1 else 0.0)
    diag = np.where(np.abs(diag) < floor, floor, diag)  # singular to rounding; keeps quotients finite
    coupled = np.abs(upper) > EPS * np.sqrt(np.abs(diag[:-1] * diag[1:])) * 0.5
    bounds = [0, *(np.flatnonzero(~coupled) + 1).tolist(), n]
    values, z = np.zeros(n), np.zeros((n, n))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        d, u = diag[a:b], upper[a : b - 1]
        found = np.sort(_block_values((d * d).tolist(), (u * u).tolist()))[::-1]
        values[a:b] = found
        block = np.column_stack([_twisted(d, u, float(x)) if b - a > 1 else np.ones(1) for x in found])
        tridiagonal = np.diag(d * d + np.concatenate([[0.0], u * u])) + np.diag(d[:-1] * u, 1) + np.diag(d[:-1] * u, -1)
        z[a:b, a:b] = _separate(tridiagonal, found, block)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale * scale, (right @ z)[:, order]
