"""Leading eigenpairs of a symmetric matrix that is known by its products with blocks of vectors only."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

Product = Callable[[np.ndarray], np.ndarray]
# Residuals count as zero in double precision from this share of the largest eigenvalue on.
TOLERANCE = 2.0**-46
# Vectors that join the subspace at once, steps of the inner solver, rounds at most.
BLOCK, STEPS, ROUNDS = 16, 4, 500


def minres(product: Product, right: np.ndarray, steps: int) -> np.ndarray:
    """``steps`` steps of MINRES from zero on symmetric systems side by side, one for each column."""
    out = np.zeros_like(right)
    size = np.linalg.norm(right, axis=0)
    active = size > 0
    v = np.divide(right, size, out=np.zeros_like(right), where=active)
    v_before, w, w_before = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    beta, rest = size.copy(), size.copy()
    cos, cos_before = np.ones_like(size), np.ones_like(size)
    sin, sin_before = np.zeros_like(size), np.zeros_like(size)
    for _ in range(steps):
        step = product(v) - beta * v_before
        alpha = (v * step).sum(axis=0)
        step -= alpha * v
        beta_next = np.linalg.norm(step, axis=0)
        turned = cos * alpha - cos_before * sin * beta
        diagonal = np.hypot(turned, beta_next)
        active = active & (diagonal > 0)
        above, above_two = sin * alpha + cos_before * cos * beta, sin_before * beta
        safe = np.where(active, diagonal, 1)
        direction = (v - above_two * w_before - above * w) / safe
        w_before, w = w, direction
        cos_before, sin_before = cos, sin
        cos, sin = np.where(active, turned / safe, 1), np.where(active, beta_next / safe, 0)
        out += np.where(active, cos * rest, 0) * direction
        rest = -sin * rest
        going = active & (beta_next > np.finfo(float).eps * size)
        v_before, v = v, np.divide(step, beta_next, out=np.zeros_like(step), where=going)
        beta, active = beta_next, going
        if not active.any():
            break
    return out


def orthonormal(vectors: np.ndarray, against: list[np.ndarray]) -> np.ndarray:
    """A basis of what the vectors add to orthonormal bases; vectors that add nothing are left out."""
    basis = np.concatenate(against, axis=1)
    lengths = np.linalg.norm(vectors, axis=0)
    vectors = vectors[:, lengths > 0] / lengths[lengths > 0]
    for _ in range(3):
        vectors = vectors - basis @ (basis.T @ vectors)
        u, s, _ = np.linalg.svd(vectors, full_matrices=False)
        vectors = u[:, s > 1e-10]
    return vectors


def largest_eigenpairs(product: Product, size: int, count: int, block: int = BLOCK, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    Block Jacobi-Davidson: Rayleigh-Ritz on a subspace whose products are kept; leading Ritz pairs
    whose residual has reached double precision are locked, and the search goes on in the
    complement of what is locked. For the next ones the correction equation, projected to the
    complement of the locked and the current vectors, is solved by some steps of MINRES, all side
    by side, so that a step costs one product with a block. The subspace is cut down to the leading
    Ritz vectors when it gets too large. Products are the only use of the matrix.
    """
    count = min(count, size)
    if not count:
        return np.zeros(0), np.zeros((size, 0))
    block = min(block, size)
    largest = min(size, count + 3 * block)
    start = np.random.default_rng(7).standard_normal((size, block))
    basis = np.linalg.qr(start)[0]
    images = product(basis)
    locked, values = np.zeros((size, 0)), []
    scale = 0.0
    for _ in range(ROUNDS):
        inner = basis.T @ images
        ritz, turn = np.linalg.eigh((inner + inner.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        basis, images = basis @ turn, images @ turn
        scale = max([scale, *np.abs(ritz)])
        residuals = images - basis * ritz
        residuals -= locked @ (locked.T @ residuals)
        lengths = np.linalg.norm(residuals, axis=0)
        full = locked.shape[1] + basis.shape[1] == size
        # Where the subspace is the whole space, no correction exists and residuals are rounding.
        done = (lengths <= TOLERANCE * scale) | full
        ready = int(np.argmin(done)) if not done.all() else len(done)
        enough = len(values) + ready >= count
        if ready:
            locked = np.concatenate([locked, basis[:, :ready]], axis=1)
            values += ritz[:ready].tolist()
            basis, images, ritz, residuals = basis[:, ready:], images[:, ready:], ritz[ready:], residuals[:, ready:]
        # What is left must be below the pairs that count.
        if enough and (full or not len(ritz) or ritz[0] <= sorted(values)[-count]):
            break
        wanted = max(1, min(block, count - len(values)))
        if basis.shape[1] == 0:
            fresh = np.random.default_rng(len(values)).standard_normal((size, wanted))
        else:
            current = basis[:, :wanted]
            aside = np.concatenate([locked, current], axis=1)

            def projected(vectors: np.ndarray) -> np.ndarray:
                return vectors - aside @ (aside.T @ vectors)

            def shifted(vectors: np.ndarray) -> np.ndarray:
                inside = projected(vectors)
                return projected(product(inside) - inside * ritz[:inside.shape[1]])

            fresh = minres(shifted, -projected(residuals[:, :wanted]), steps)
        if basis.shape[1] + wanted > largest - len(values):
            keep = max(wanted, largest - len(values) - wanted)
            basis, images = basis[:, :keep], images[:, :keep]
        fresh = orthonormal(fresh, [locked, basis])
        room = size - locked.shape[1] - basis.shape[1]
        if not fresh.shape[1]:  # the corrections lie in the subspace: go on from a random direction
            fresh = orthonormal(np.random.default_rng(size).standard_normal((size, wanted)), [locked, basis])
        fresh = fresh[:, :room]
        basis, images = np.concatenate([basis, fresh], axis=1), np.concatenate([images, product(fresh)], axis=1)
    else:
        raise ArithmeticError(f"residuals above double precision after {ROUNDS} rounds")
    order = np.argsort(values)[::-1][:count]
    return np.array(values)[order], locked[:, order]
