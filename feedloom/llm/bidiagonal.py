"""Singular values and right singular vectors of a small matrix through its bidiagonal form."""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(np.float64).eps)
#: Squared off-diagonal entries this small against their neighbours change no digit.
NEGLIGIBLE = (EPS / 4) ** 2
#: Sweeps per singular value before the iteration is taken to have failed.
SWEEPS = 100
#: Values of a block this close to each other, relatively, have their vectors made orthogonal.
CLOSE = 1e-3
#: So are those of values this small against the greatest, whose differences are rounding.
LOST = 1e-9


def _reflector(column: np.ndarray) -> tuple[np.ndarray, float]:
    """Householder vector and factor that turn a column into a multiple of its first unit vector."""
    scale = np.abs(column).max(initial=0.0)
    if scale == 0.0 or not column[1:].any():
        return column, 0.0
    vector = column / scale
    vector[0] += np.copysign(np.linalg.norm(vector), vector[0])
    return vector, 2.0 / (vector @ vector)


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, upper diagonal and right transformation: ``matrix = U B right.T``."""
    work, size = matrix.astype(np.float64), len(matrix)
    right = np.eye(size)
    for k in range(size):
        vector, factor = _reflector(work[k:, k])
        work[k:, k:] -= factor * np.outer(vector, vector @ work[k:, k:])
        if k < size - 2:
            vector, factor = _reflector(work[k, k + 1:])
            work[k:, k + 1:] -= factor * np.outer(work[k:, k + 1:] @ vector, vector)
            right[:, k + 1:] -= factor * np.outer(right[:, k + 1:] @ vector, vector)
    return np.diag(work).copy(), np.diag(work, 1).copy(), right


def _sweep(q: list[float], e: list[float], shift: float):
    """One differential quotient-difference step; the smallest and the last of its remainders."""
    rest, lowest, new_q, new_e = q[0] - shift, q[0] - shift, [], []
    for square, following in zip(e, q[1:]):
        pivot = rest + square
        new_q.append(pivot)
        if rest < 0.0:
            return None, None, rest, None
        # A pivot of zero parts the matrix here.
        ratio = following / pivot if pivot else 0.0
        new_e.append(square * ratio)
        rest = rest * ratio - shift if pivot else following - shift
        lowest = min(lowest, rest)
    new_q.append(rest)
    return new_q, new_e, lowest, rest


def _two(q0: float, e0: float, q1: float) -> tuple[float, float]:
    """Both values of a block of two, the greater one first, without cancellation."""
    half = 0.5 * ((q0 - q1) + e0)
    top = 0.5 * (q0 + q1 + e0) + float(np.hypot(half, np.sqrt(q1 * e0)))
    return top, (q1 * (q0 / top) if top else 0.0)


def squared_singular_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, descending, by shifted dqds.

    All quantities stay positive, so that small values come out with as many digits as great ones.
    A shift that makes one negative is taken back; one that fails at the last place only is
    mended by what was missing there.
    """
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(upper).max(initial=0.0))
    if scale == 0.0:
        return np.zeros(len(diagonal))
    found: list[float] = []
    waiting = [([float(a / scale) ** 2 for a in diagonal], [float(b / scale) ** 2 for b in upper],
                0.0)]
    budget = SWEEPS * len(diagonal)
    while waiting:
        q, e, passed = waiting.pop()
        while q:
            if len(q) == 1:
                found.append(passed + q.pop())
                break
            if e[-1] <= NEGLIGIBLE * max(passed + q[-1], q[-2]):
                found.append(passed + q.pop())
                e.pop()
                continue
            cut = next((i for i, square in enumerate(e)
                        if square <= NEGLIGIBLE * max(passed, q[i], q[i + 1])), None)
            if cut is not None:
                waiting.append((q[cut + 1:], e[cut + 1:], passed))
                q, e = q[:cut + 1], e[:cut]
                continue
            if len(q) == 2:
                found += [passed + value for value in _two(q[0], e[0], q[1])]
                break
            if 1.5 * q[0] < q[-1]:
                q.reverse()
                e.reverse()
            shift = _two(q[-2], e[-1], q[-1])[1]
            for _ in range(4):
                budget -= 1
                new_q, new_e, lowest, last = _sweep(q, e, shift)
                if new_q is not None and lowest >= 0.0:
                    break
                late = last is not None and lowest == last and shift + last > 0.0
                shift = (shift + last) * (1 - 4 * EPS) if late else shift / 4
            else:
                shift = 0.0
                new_q, new_e, _, _ = _sweep(q, e, shift)
            q, e, passed = new_q, new_e, passed + shift
            if budget < 0:
                raise ArithmeticError("the singular values do not converge")
    return np.sort(np.array(found))[::-1] * scale ** 2


def twisted_vector(diagonal: np.ndarray, upper: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of ``B' B`` for an eigenvalue, from its twisted factorisation.

    The stationary transform factorises from the top, the progressive one from the bottom; they
    meet where the remainder is smallest, and the vector follows from there by products only.
    """
    size = len(diagonal)
    floor = EPS * max(np.abs(diagonal).max(), np.abs(upper).max(initial=0.0)) ** 2 * EPS
    pivots = np.maximum(diagonal ** 2, floor)
    links = upper * np.sign(diagonal[:-1] + (diagonal[:-1] == 0)) / np.sqrt(pivots[:-1])
    down, from_top = np.zeros(size), np.zeros(size - 1)
    up, from_bottom = np.zeros(size), np.zeros(size - 1)
    whole = lambda x: x if abs(x) > floor else floor
    down[0] = -value
    for i in range(size - 1):
        from_top[i] = pivots[i] * links[i] / whole(down[i] + pivots[i])
        down[i + 1] = from_top[i] * links[i] * down[i] - value
    up[-1] = pivots[-1] - value
    for i in range(size - 2, -1, -1):
        ratio = pivots[i] / whole(pivots[i] * links[i] ** 2 + up[i + 1])
        from_bottom[i] = links[i] * ratio
        up[i] = up[i + 1] * ratio - value
    at = int(np.argmin(np.abs(down + up + value)))
    vector = np.zeros(size)
    vector[at] = 1.0
    for i in range(at - 1, -1, -1):
        vector[i] = -from_top[i] * vector[i + 1]
    for i in range(at, size - 1):
        vector[i + 1] = -from_bottom[i] * vector[i]
    vector /= np.abs(vector).max()
    return vector / np.linalg.norm(vector)


def _apart(vector: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for other in others:
            vector = vector - (other @ vector) * other
    return vector


def _apart_iterated(square: np.ndarray, value: float, others: list[np.ndarray], seed: int
                    ) -> np.ndarray:
    """Inverse iteration for an eigenvector that is kept orthogonal to others of its cluster."""
    size = len(square)
    moved = square - (value + 4 * EPS * np.abs(square).max()) * np.eye(size)
    vector = np.random.default_rng(seed).standard_normal(size)
    for _ in range(4):
        vector = _apart(vector / np.linalg.norm(vector), others)
        try:
            vector = np.linalg.solve(moved, vector)
        except np.linalg.LinAlgError:
            moved += 16 * EPS * max(np.abs(square).max(), EPS) * np.eye(size)
        vector = _apart(vector / np.linalg.norm(vector), others)
    return vector


def _block_vectors(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray) -> list:
    """Vectors of the greatest values of a block whose off-diagonal entries all count."""
    if len(diagonal) == 1:
        return [np.ones(1)][:len(values)]
    found: list[np.ndarray] = []
    full = np.diag(diagonal) + np.diag(upper, 1)
    square = full.T @ full
    for n, value in enumerate(values):
        near = [found[i] for i in range(n)
                if values[i] - value <= max(CLOSE * values[i], LOST * values[0])]
        vector = twisted_vector(diagonal, upper, value)
        if near:
            vector = _apart(vector, near)
            length = np.linalg.norm(vector)
            off = np.linalg.norm(square @ vector - value * vector)
            if length < 0.5 or off > 8 * EPS * len(diagonal) * values[0] * length:
                # The factorisation sees one vector of a cluster twice: iterate apart from it.
                vector = _apart_iterated(square, value, near, n)
        found.append(vector / np.linalg.norm(vector))
    return found


def leading_directions(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest squared singular values of a square matrix and their right vectors (columns)."""
    diagonal, upper, right = bidiagonalise(matrix)
    size = len(diagonal)
    great = np.maximum(np.abs(diagonal[:-1]), np.abs(diagonal[1:]))
    ends = [*(np.flatnonzero(np.abs(upper) <= EPS / 4 * great) + 1).tolist(), size]
    parts, start = [], 0
    for end in ends:
        own, links = diagonal[start:end], upper[start:end - 1]
        values = squared_singular_values(own, links)[:count]
        for value, vector in zip(values, _block_vectors(own, links, values)):
            whole = np.zeros(size)
            whole[start:end] = vector
            parts.append((value, whole))
        start = end
    parts.sort(key=lambda part: -part[0])
    values = np.array([value for value, _ in parts[:count]])
    return values, right @ np.array([vector for _, vector in parts[:count]]).T
