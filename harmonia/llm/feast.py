"""Leading eigenpairs of a symmetric matrix by contour integration (FEAST), checked by inertia counts.

The projector onto the eigenvectors of an interval is the contour integral of
``(z - A)^-1`` around it.  Gauss-Legendre quadrature turns it into a few
solves with complex shifts; applied to a random block and repeated, the block
converges to the interval's invariant subspace, from which Rayleigh-Ritz
takes the eigenpairs.  The signs in a symmetric factorisation of ``A - s``
count the eigenvalues on each side of ``s`` (Sylvester's law of inertia):
they say where to put the intervals, how large a block must be and, at the
end, that no eigenvalue was missed.  Matrices are of the vectors' dimension,
whatever the number of vectors.
"""

from __future__ import annotations

import numpy as np

NODES = 16
MAX_ROUNDS = 200
#: Eigenvalues in one interval, unless more of them cannot be told apart.
PER_INTERVAL = 8
#: Share of an interval's width that the gap at its edge should have.
WIDE = 0.05


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the eigenvalues of symmetric ``a`` (reflections)."""
    m = np.array(a, float)
    for i in range(len(m) - 2):
        x = m[i + 1:, i].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        size = x @ x
        if size == 0:
            continue
        y = m[i + 1:, i + 1:] @ x * (2 / size)
        y -= x * ((x @ y) / size)
        m[i + 1:, i + 1:] -= np.outer(x, y) + np.outer(y, x)
        m[i + 1, i] -= 2 * x[0] * (x @ m[i + 1:, i]) / size
    return np.diag(m).copy(), np.diag(m, -1).copy()


class Inertia:
    """Counts eigenvalues below a shift by the signs of the pivots of a symmetric factorisation."""

    def __init__(self, a: np.ndarray):
        diagonal, off = tridiagonal(a)
        self.rows = list(zip(diagonal.tolist(), [0.0, *(off ** 2).tolist()]))
        self.least = np.finfo(float).tiny / np.finfo(float).eps

    def below(self, shift: float) -> int:
        pivot, negative = 1.0, 0
        for d, o in self.rows:
            pivot = d - shift - o / pivot
            if abs(pivot) < self.least:
                pivot = -self.least
            negative += pivot < 0
        return negative

    def largest(self, i: int, low: float, high: float, width: float) -> float:
        """About where the ``i``-th largest eigenvalue (from 1) lies, by bisection."""
        want = len(self.rows) - i
        while high - low > width:
            mid = (low + high) / 2
            low, high = (mid, high) if self.below(mid) <= want else (low, mid)
        return (low + high) / 2


def _intervals(inertia: Inertia, k: int, scale: float) -> list[tuple[float, float, int]]:
    """Disjoint intervals ``(from, to, eigenvalues inside)`` from the top that hold the
    ``k`` largest eigenvalues.  Their edges lie in gaps that are wide beside
    them, so that quadrature tells the sides apart; eigenvalues too close to
    tell apart stay in one interval, wide gaps belong to none."""
    d, near = len(inertia.rows), 1e-10 * scale
    about: list[float] = []

    def value(i: int) -> float:
        while len(about) <= i:
            about.append(inertia.largest(len(about) + 1, -near, 2 * scale, near / 8))
        return about[i] if i >= 0 else np.inf

    out, start = [], 0
    while start < k:
        cuts, stop = [], start + 1  # gap over width of what lies above it, and where it is
        while stop < d and (stop <= start + PER_INTERVAL or not cuts):
            gap = value(stop - 1) - value(stop)
            if gap > near:
                cuts.append((gap / (value(start) - value(stop)), stop))
            stop += 1
        if stop >= d and (not cuts or d <= start + PER_INTERVAL):
            cuts.append((1.0, d))
        wide = [c for r, c in cuts if r >= WIDE]
        stop = max(wide) if wide else max(cuts)[1]
        high, low = value(start), value(stop - 1)
        room = min((value(start - 1) - high) / 2, (low - value(stop)) / 2 if stop < d else np.inf,
                   max(high - low, abs(high) / 2, near))
        out.append((low - room, high + room, inertia.below(high + room) - inertia.below(low - room)))
        start = stop
    return out


def _interval_pairs(a: np.ndarray, low: float, high: float, count: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs between ``low`` and ``high``."""
    d, scale = len(a), np.abs(a).sum(axis=1).max()
    block = rng.standard_normal((d, min(d, 2 * count + 8)))
    centre, radius = (low + high) / 2, (high - low) / 2
    x, w = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(0.5j * np.pi * (x + 1))
    shifted = [(centre + radius * t) * np.eye(d) - a for t in turns]
    best, pairs = np.inf, None
    for _ in range(MAX_ROUNDS):
        image = sum(0.5 * wi * (radius * t * np.linalg.solve(z, block)).real for wi, t, z in zip(w, turns, shifted))
        q, weight, _ = np.linalg.svd(image, full_matrices=False)
        q = q[:, weight > 1e-14 * weight[0]]  # what the filter has left of other eigenvectors is noise
        values, turn = np.linalg.eigh(q.T @ a @ q)
        block = q @ turn
        off = np.abs(a @ block - block * values).max(axis=0) / scale
        inside = np.flatnonzero((values >= low) & (values < high))
        if len(inside) < count:
            continue
        inside = np.sort(inside[off[inside].argsort()[:count]])  # others in there are no eigenvalues
        e, v, residual = values[inside], block[:, inside], off[inside].max()
        if residual < best / 2:
            best, pairs = residual, (e, v)
        elif best < 1e-11:
            break  # as exact as rounding lets it become
        if best < 1e-15:
            break
    if pairs is None or best > 1e-9:
        raise ArithmeticError(f"{count} eigenvalues between {low} and {high} were not found")
    return pairs


def leading_pairs(a: np.ndarray, k: int, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest positive eigenvalues of a positive semidefinite matrix in
    falling order (fewer if its rank is lower) with unit eigenvectors as
    columns, the largest entry of each positive."""
    a, d = np.asarray(a, float), len(a)
    trace = float(np.trace(a)) if d else 0.0
    if not trace > 0:
        return np.zeros(0), np.zeros((d, 0))
    inertia = Inertia(a)
    k = min(k, d - inertia.below(4 * d * np.finfo(float).eps * trace))
    rng = np.random.default_rng(seed)
    found = [_interval_pairs(a, *x, rng) for x in _intervals(inertia, k, trace) if x[2]]
    # one more Rayleigh-Ritz step over all intervals makes the vectors orthogonal to each other
    q, _ = np.linalg.qr(np.hstack([v for _, v in found]))
    values, turn = np.linalg.eigh(q.T @ a @ q)
    values, vectors = values[::-1][:k], (q @ turn)[:, ::-1][:, :k]
    slack = 1e-9 * values[0]
    counts = np.array([[d - inertia.below(e + s) for s in (slack, -slack)] for e in values])
    ranks = np.arange(1, k + 1)
    if (counts[:, 0] >= ranks).any() or (counts[:, 1] < ranks).any():
        raise ArithmeticError("inertia counts and eigenvalues found do not agree")
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)])
    return values, vectors * sign
