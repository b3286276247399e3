"""Eigenvalues of large products that are sparse up to a few directions, without a matrix of all of them.

Variants that no sample carries together meet in no product, so a sparse symmetric matrix falls into blocks, one a connected
component of its pairs; only a block is held whole.  A direction that is added to or taken from the matrix then moves the
eigenvalues to the roots of a secular equation, one between each two of the former ones.  Vectors of interest are carried
along as their products with the eigenvectors, which are never held either.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np

EPS = float(np.finfo(float).eps)
#: Numbers that are held at a time besides a block.
HELD = 1 << 18
#: Width from which a block is reduced where it is, so that no matrix is held beside it.
WIDE = 1024
#: Reflections that are applied at a time, and the width up to which a tridiagonal matrix is not halved.
PANEL, NARROW = 32, 64


def components(n: int, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """The least member of each one's component, by pairs."""
    label = np.arange(n)
    while True:
        low, new = np.minimum(label[at], label[to]), label.copy()
        for ends in (at, to, label[at], label[to]):
            np.minimum.at(new, ends, low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def blocks(n: int, at: np.ndarray, to: np.ndarray, value: np.ndarray, carried: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of the symmetric matrix that has value at (at, to) and (to, at), and the carried columns by eigenvector."""
    _, member, size = np.unique(components(n, at, to), return_inverse=True, return_counts=True)
    order = np.argsort(member, kind="stable")
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    place = np.empty(n, int)
    place[order] = np.arange(n) - first[member[order]]
    values, found = np.zeros(n), np.zeros(carried.shape)
    by_size = np.argsort(size[member[at]], kind="stable")
    at, to, value = at[by_size], to[by_size], value[by_size]
    sizes = size[member[at]]
    for width in np.unique(size):
        those = np.flatnonzero(size == width)
        lo, hi = np.searchsorted(sizes, [width, width + 1])
        slot = np.full(len(size), -1)
        most = max(1, HELD // int(width) ** 2)
        for begin in range(0, len(those), most):
            some = those[begin : begin + most]
            slot[:] = -1
            slot[some] = np.arange(len(some))
            mine = lo + np.flatnonzero(slot[member[at[lo:hi]]] >= 0)
            whole = np.zeros((len(some), width, width))
            k, i, j = slot[member[at[mine]]], place[at[mine]], place[to[mine]]
            whole[k, i, j] = whole[k, j, i] = value[mine]
            rows = order[first[some][:, None] + np.arange(width)]
            if width >= WIDE:
                values[rows[0]], found[rows[0]] = _of_tridiagonal(*_tridiagonal(whole[0], carried[rows[0]]))
                continue
            lam, vectors = np.linalg.eigh(whole)
            values[rows] = lam
            found[rows] = vectors.transpose(0, 2, 1) @ carried[rows]
    return values, found


#: Width up to which a block whose pairs are many is held for its power sums, too.
HOLDABLE = 4096


def power_sums(n: int, at: np.ndarray, to: np.ndarray, value: np.ndarray, most: int) -> np.ndarray:
    """Traces of the powers 1 to most (an even number) of the symmetric matrix with value at (at, to) and (to, at).

    Narrow blocks give them by their eigenvalues.  A wide one is not held unless its pairs fill it: there a trace of an even
    power is the sum of squares of half that power, whose columns reach only as far as so many pairs lead.
    """
    _, member, size = np.unique(components(n, at, to), return_inverse=True, return_counts=True)
    pairs = np.bincount(member[at], minlength=len(size)) * 2
    walked = (size >= WIDE) & (pairs * 8 < size**2) & ((pairs * 300 < size**2) | (size > HOLDABLE))
    out = np.zeros(most)
    for k in [None, *np.flatnonzero(walked)]:
        keep = ~walked[member] if k is None else member == k
        number, mine = np.cumsum(keep) - 1, keep[at]
        i, j, v, m = number[at[mine]], number[to[mine]], value[mine], int(keep.sum())
        if k is not None:
            out += _walked(m, i, j, v, most)
        elif m:
            lam = blocks(m, i, j, v, np.empty((m, 0)))[0]
            out += (lam[:, None] ** np.arange(1, most + 1)).sum(0)
    return out


def largest(n: int, at: np.ndarray, to: np.ndarray, value: np.ndarray, steps: int = 60) -> float:
    """A number that no eigenvalue of the matrix exceeds in size: the largest growth of any positive vector by its absolute
    values, of which some steps tell a small one (Collatz and Wielandt)."""
    off, x, best = at != to, np.ones(n), np.inf
    row, col, v = np.concatenate([at, to[off]]), np.concatenate([to, at[off]]), np.abs(np.concatenate([value, value[off]]))
    for _ in range(steps):
        y = np.bincount(row, v * x[col], minlength=n)
        best = min(best, float((y / x).max()))
        x = np.maximum(y / max(float(y.max()), 1e-300), 1e-250)
    return best * (1 + 1e-9)


def leading(times: Callable[[np.ndarray], np.ndarray], n: int, steps: int = 160, near: float = 1e-8) -> tuple[np.ndarray, np.ndarray]:
    """Some of the largest eigenvalues of a symmetric matrix and the sums of their vectors, by Lanczos' steps: those that are
    found to near, as a share of the largest.  Of equal ones it has one."""
    steps = min(steps, n)
    q, diagonal, beside = np.zeros((steps, n)), np.zeros(steps), np.zeros(steps)
    x = np.random.default_rng(7).standard_normal(n)
    for j in range(steps):
        q[j] = x / math.sqrt(float(x @ x))
        x = times(q[j])
        diagonal[j] = float(q[j] @ x)
        for _ in range(2):
            x = x - q[: j + 1].T @ (q[: j + 1] @ x)
        beside[j] = math.sqrt(float(x @ x))
        if beside[j] <= near * abs(diagonal[: j + 1]).max():
            steps = j + 1
            break
    lam, vectors = np.linalg.eigh(np.diag(diagonal[:steps]) + np.diag(beside[: steps - 1], 1) + np.diag(beside[: steps - 1], -1))
    lam, vectors = lam[::-1], vectors[:, ::-1]
    found = np.abs(beside[steps - 1] * vectors[-1]) <= near * abs(lam[0])
    m = int(np.argmin(found)) if not found.all() else steps
    m = min(m, 32)
    return lam[:m], vectors[:, :m].T @ q[:steps].sum(1)


def _walked(n: int, at: np.ndarray, to: np.ndarray, value: np.ndarray, most: int) -> np.ndarray:
    """The traces by columns of the powers up to half of most, some columns at a time: as many as HELD numbers allow."""
    off = at != to
    row, col, v = np.concatenate([at, to[off]]), np.concatenate([to, at[off]]), np.concatenate([value, value[off]])
    place = np.empty(n, int)
    place[np.argsort(-np.bincount(row, minlength=n), kind="stable")] = np.arange(n)  # those with most pairs come first
    row, col = place[row], place[col]
    order = np.argsort(row, kind="stable")
    row, col, v = row[order], col[order], v[order]
    start = np.searchsorted(row, np.arange(n + 1))
    ranks = [int((np.diff(start) > d).sum()) for d in range(min(int(np.diff(start).max()), MOST_RANKS + 1))]
    scale = float(np.bincount(row, np.abs(v), minlength=n).max())
    v = v / scale
    out = np.zeros(most)
    wide = max(1, 4 * HELD // n)
    # keys are column in its turn times n, plus row; they ascend
    todo = [(1, np.arange(b, min(n, b + wide)) + n * np.arange(min(n, b + wide) - b), np.ones(min(n, b + wide) - b)) for b in range(0, n, wide)]
    while todo:
        power, key, x = todo.pop()
        columns = int(key[-1] // n - key[0] // n) + 1
        if len(key) * 4 > columns * n and len(ranks) <= MOST_RANKS:
            whole = np.zeros(columns * n)
            whole[key - key[0] // n * n] = x
            out += _filled(whole.reshape(columns, n).T, col, v, start, ranks, power, most)
            continue
        r, c = key % n, key // n
        lengths = start[r + 1] - start[r]
        made = int(lengths.sum())
        if made > 4 * HELD and c[0] != c[-1]:
            cut = int(np.searchsorted(c, (c[0] + c[-1]) // 2, side="right"))
            todo += [(power, key[:cut], x[:cut]), (power, key[cut:], x[cut:])]
            continue
        first = np.cumsum(lengths) - lengths
        place = np.repeat(start[r] - first, lengths) + np.arange(made)
        to_key = np.repeat((c - c[0]) * n, lengths) + col[place]
        moved = np.repeat(x, lengths) * v[place]
        whole = (int(c[-1]) - int(c[0]) + 1) * n
        if made * 16 > whole:
            dense = np.bincount(to_key, moved, minlength=whole)
            key2 = np.flatnonzero(dense)
            x2, before = dense[key2], dense[key - c[0] * n]
        else:
            key2, inverse = np.unique(to_key, return_inverse=True)
            x2 = np.bincount(inverse, moved)
            found = np.minimum(np.searchsorted(key2, key - c[0] * n), len(key2) - 1)
            before = np.where(key2[found] == key - c[0] * n, x2[found], 0.0)
        out[2 * power - 2] += float(x @ before)
        out[2 * power - 1] += float(x2 @ x2)
        if 2 * power < most:
            todo.append((power + 1, key2, x2))
    return out * scale ** np.arange(1, most + 1)


#: Pairs of one variant up to which columns that have filled are multiplied by all variants' first pairs, then their second ones.
MOST_RANKS = 256


def _filled(x: np.ndarray, col: np.ndarray, v: np.ndarray, start: np.ndarray, ranks: list[int], power: int, most: int) -> np.ndarray:
    """_walked from columns that are no longer sparse."""
    out, width = np.zeros(most), max(1, 4 * HELD // len(x))
    for begin in range(0, x.shape[1], width):
        now = np.ascontiguousarray(x[:, begin : begin + width])
        for k in range(power, most // 2 + 1):
            then = np.zeros_like(now)
            for d, m in enumerate(ranks):
                at = start[:m] + d
                then[:m] += v[at][:, None] * now[col[at]]
            out[2 * k - 2] += float(np.vdot(now, then))
            out[2 * k - 1] += float(np.vdot(then, then))
            now = then
    return out


def _tridiagonal(a: np.ndarray, carried: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, what is beside it and the carried columns of the symmetric matrix after reflections that leave no more of it;
    they are made in its own place."""
    n, carried = len(a), carried.copy()
    diagonal, beside = np.empty(n), np.zeros(n - 1)
    for begin in range(0, n - 2, PANEL):
        width = min(PANEL, n - 2 - begin)
        u, w = np.zeros((n - begin, width)), np.zeros((n - begin, width))
        for j in range(width):
            k, to = begin + j, j + 1
            column = a[k:, k] - u[j:, :j] @ w[j, :j] - w[j:, :j] @ u[j, :j]
            diagonal[k], beside[k] = column[0], column[1]
            if not column[2:].any():
                continue
            beside[k] = -np.copysign(float(np.sqrt(column[1:] @ column[1:])), column[1])
            v = column[1:]
            v[0] -= beside[k]
            v /= float(np.sqrt(v @ v))
            y = a[k + 1 :, k + 1 :] @ v - u[to:, :j] @ (v @ w[to:, :j]) - w[to:, :j] @ (v @ u[to:, :j])
            u[to:, j], w[to:, j] = v, 2 * (y - (v @ y) * v)
            carried[k + 1 :] -= np.outer(2 * v, v @ carried[k + 1 :])
        for lo in range(width, n - begin, max(1, HELD // n)):
            hi = min(n - begin, lo + max(1, HELD // n))
            part = a[begin + lo : begin + hi, begin + width :]
            part -= u[lo:hi] @ w[width:].T
            part -= w[lo:hi] @ u[width:].T
    last = max(0, n - 2)
    diagonal[last:], beside[last:] = np.diag(a)[last:], np.diag(a, -1)[last:]
    return diagonal, beside, carried


def _of_tridiagonal(diagonal: np.ndarray, beside: np.ndarray, carried: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and the carried columns by eigenvector: those of two halves, which one direction joins."""
    n, half = len(diagonal), len(diagonal) // 2
    if n <= NARROW:
        lam, vectors = np.linalg.eigh(np.diag(diagonal) + np.diag(beside, 1) + np.diag(beside, -1))
        return lam, vectors.T @ carried
    link, halves, joint = beside[half - 1], diagonal.copy(), np.zeros(n)
    halves[half - 1 : half + 1] -= abs(link)
    joint[half - 1], joint[half] = np.sqrt(abs(link)), np.copysign(np.sqrt(abs(link)), link)
    with_joint = np.column_stack([carried, joint])
    parts = [_of_tridiagonal(halves[:half], beside[: half - 1], with_joint[:half]), _of_tridiagonal(halves[half:], beside[half:], with_joint[half:])]
    d, found = (np.concatenate(x) for x in zip(*parts, strict=True))
    return with_direction(d, found[:, -1], found[:, :-1])


def _step(f, psi, dpsi, phi, dphi, left, right):
    """The root of two poles and a constant that have the sums' values and slopes."""
    bounded = np.isfinite(right)
    far = np.where(bounded, right, 1.0)
    q, s = dpsi * left**2, np.where(bounded, dphi * far**2, 0.0)
    c = 1 + psi - dpsi * left + np.where(bounded, phi - dphi * far, 0.0)
    b, e = c * (left + far) + q + s, left * far * f
    root = np.sqrt(np.maximum(b * b - 4 * c * e, 0.0))
    return np.where(bounded, np.where(b <= 0, (b - root) / (2 * c), 2 * e / (b + root)), left + q / c)


def _moved(d: np.ndarray, z: np.ndarray, carried: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + z z' and the carried columns; d ascends and no z is zero."""
    n, z2 = len(d), z * z
    values, found = np.empty(n), np.empty(carried.shape)
    gap = np.append(np.diff(d), z2.sum())
    nearer, beyond_it, exact = np.empty(n, int), np.empty(n), np.ones(n)
    chunks = [np.arange(begin, min(n, begin + max(1, HELD // n))) for begin in range(0, n, max(1, HELD // n))]
    for i in chunks:
        half, last = gap[i] / 2, i == n - 1
        beyond = 1 + (1 / (d[None, :] - d[i][:, None] - half[:, None])) @ z2 < 0
        # a root is told by its distance from the nearer pole
        near = np.where(beyond & ~last, i + 1, i)
        low, high = np.where(beyond, np.where(last, half, -half), 0.0), np.where(beyond, np.where(last, gap[i], 0.0), half)
        base = d[None, :] - d[near][:, None]
        left, right = d[i] - d[near], np.where(last, np.inf, d[np.minimum(i + 1, n - 1)] - d[near])
        mu, live = (low + high) / 2, np.arange(len(i))
        for _ in range(100):
            x = mu[live]
            r = 1 / (base[live] - x[:, None])
            size = np.abs(r)
            s, a, ds, da = r @ z2, size @ z2, (r * r) @ z2, (r * size) @ z2
            f = 1 + s
            low[live], high[live] = np.where(f < 0, x, low[live]), np.where(f > 0, x, high[live])
            settled = (np.abs(f) <= 16 * EPS * (1 + a)) | (high[live] - low[live] <= 2 * EPS * np.maximum(np.abs(low[live]), np.abs(high[live])))
            with np.errstate(all="ignore"):
                to = x + _step(f, (s - a) / 2, (ds - da) / 2, (s + a) / 2, (ds + da) / 2, left[live] - x, right[live] - x)
            inside = (to > low[live]) & (to < high[live])
            mu[live] = np.where(settled, x, np.where(inside, to, (low[live] + high[live]) / 2))
            live = live[~settled]
            if not len(live):
                break
        values[i], nearer[i], beyond_it[i] = d[near] + mu, near, mu
        # the direction whose roots these are exactly (Gu and Eisenstat): its vectors are at right angles however near the roots
        pole = np.where(i[:, None] < np.arange(n), i[:, None], np.minimum(i + 1, n - 1)[:, None])
        apart = d[pole] - d[None, :]
        apart[last] = 1.0
        exact *= np.prod((mu[:, None] - base) / apart, axis=0)
    z = np.copysign(np.sqrt(np.maximum(exact, 0.0)), z)
    for i in chunks:
        vectors = z / (d[None, :] - d[nearer[i]][:, None] - beyond_it[i][:, None])
        found[i] = (vectors @ carried) / np.sqrt((vectors * vectors).sum(1))[:, None]
    return values, found


def with_direction(d: np.ndarray, z: np.ndarray, carried: np.ndarray, taken: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + z z' (taken: - z z') and the carried columns by its eigenvectors.

    Of equal eigenvalues one takes the whole direction, and one that lacks the direction stays, both to rounding.
    """
    if taken:
        values, found = with_direction(-d, z, carried)
        return -values, found
    length = float(np.sqrt(z @ z))
    scale = max(float(np.abs(d).max(initial=0.0)), length**2)
    if length == 0 or scale == 0:
        return d.copy(), carried.copy()
    order = np.argsort(d, kind="stable")
    d, z, carried = d[order], z[order].copy(), carried[order].copy()
    near = 32 * EPS * scale
    starts = np.flatnonzero(np.append(True, np.diff(d) > near))
    ends = np.append(starts[1:], len(d))
    for lo, hi in zip(starts[ends - starts > 1], ends[ends - starts > 1], strict=True):
        part = z[lo:hi].copy()
        size = float(np.sqrt(part @ part))
        if size > 0:
            # a reflection that leaves the direction to the first of them
            v = part.copy()
            v[0] += np.copysign(size, v[0])
            carried[lo:hi] -= np.outer(v, (2 / (v @ v)) * (v @ carried[lo:hi]))
            z[lo:hi] = 0.0
            z[lo] = -np.copysign(size, part[0])
    moves = np.abs(z) * length > near
    if moves.any():
        values, found = _moved(d[moves], z[moves], carried[moves])
        d = d.copy()
        d[moves], carried[moves] = values, found
    return d, carried
