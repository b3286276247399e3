"""Distribution functions that NumPy lacks: normal, gamma, chi-squared, beta, t, F, noncentral chi-squared."""

from __future__ import annotations

import math

import numpy as np

TINY = 1e-300


def norm_sf(x: float) -> float:
    return 0.5 * math.erfc(x / math.sqrt(2.0))


def norm_ppf(p: float) -> float:
    """Quantile, by Newton steps on the tail."""
    if p <= 0 or p >= 1:
        return -math.inf if p <= 0 else math.inf if p >= 1 else math.nan
    if p > 0.5:
        return -norm_ppf(1 - p)
    x = -math.sqrt(max(0.0, -2 * math.log(2 * p)))
    for _ in range(60):
        f = norm_sf(-x) - p
        step = f / max(TINY, math.exp(-x * x / 2) / math.sqrt(2 * math.pi))
        step = max(-1.0, min(1.0, step / (1 + 0.5 * step * x) if abs(step * x) < 1 else step))
        x -= step
        if abs(step) < 1e-15 * (1 + abs(x)):
            break
    return x


def gamma_q(a: float, x: float) -> float:
    """Regularised upper incomplete gamma: a series for the lower part or a continued fraction for the upper."""
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        for _ in range(100_000):
            n += 1
            term *= x / n
            total += term
            if term < total * 1e-17:
                break
        return max(0.0, 1.0 - total * front)
    b = x + 1 - a
    c, d = 1 / TINY, 1 / b
    h = d
    for i in range(1, 100_000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > TINY else TINY)
        c = b + an / c
        c = c if abs(c) > TINY else TINY
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return front * h


def chi2_sf(x: float, df: float) -> float:
    return gamma_q(df / 2, x / 2)


def chi2_isf(p: float, df: float) -> float:
    """Upper quantile: Newton's steps on the log of the tail, kept inside a bracket that halves where a step would leave it."""
    if p >= 1:
        return 0.0
    if p <= 0:
        return math.inf
    if df == 1:
        z = norm_ppf(p / 2)
        return z * z
    lo, hi = 0.0, max(1.0, df)
    while chi2_sf(hi, df) > p:
        lo, hi = hi, hi * 2
    x = (lo + hi) / 2
    for _ in range(200):
        tail = chi2_sf(x, df)
        lo, hi = (x, hi) if tail > p else (lo, x)
        density = math.exp((df / 2 - 1) * math.log(x / 2) - x / 2 - math.lgamma(df / 2)) / 2
        step = x + tail * math.log(tail / p) / density if tail > 0 and density > 0 else lo
        new = step if lo < step < hi else (lo + hi) / 2
        if abs(new - x) <= 1e-14 * x or hi - lo <= 1e-14 * hi:
            return new
        x = new
    return x


def beta_i(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta, by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_i(b, a, 1 - x)
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > TINY else TINY)
    h = d
    for m in range(1, 10_000):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + num * d
            d = 1 / (d if abs(d) > TINY else TINY)
            c = 1 + num / c
            c = c if abs(c) > TINY else TINY
            h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return front * h / a


def t_two_sided(t: float, df: float) -> float:
    return beta_i(df / 2, 0.5, df / (df + t * t)) if math.isfinite(t) else 0.0


def f_sf(x: float, d1: float, d2: float) -> float:
    return beta_i(d2 / 2, d1 / 2, d2 / (d2 + d1 * x)) if x > 0 else 1.0


def ncx2_sf(x: float, df: float, nc: float) -> float:
    """Noncentral chi-squared upper tail, a Poisson mixture summed out from its mode."""
    if nc <= 0:
        return chi2_sf(x, df)
    half, mode = nc / 2, int(nc / 2)

    def weight(k: int) -> float:
        return math.exp(-half + k * math.log(half) - math.lgamma(k + 1))

    total = 0.0
    for step in (1, -1):
        k = mode if step == 1 else mode - 1
        while k >= 0:
            w = weight(k)
            total += w * chi2_sf(x, df + 2 * k)
            if w < 1e-18:
                break
            k += step
    return min(1.0, total)


def log_factorials(n: int) -> np.ndarray:
    return np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n + 1)))])


def fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    """Two-sided exact p of [[a, b], [c, d]]: tables no likelier than the one seen, ties within 1e-7."""
    n, row, col = a + b + c + d, a + b, a + c
    lo, hi = max(0, row + col - n), min(row, col)
    k = np.arange(lo, hi + 1)
    lf = log_factorials(n)
    logp = lf[row] + lf[n - row] + lf[col] + lf[n - col] - lf[n] - lf[k] - lf[row - k] - lf[col - k] - lf[n - row - col + k]
    seen = logp[a - lo]
    return float(min(1.0, np.exp(logp[logp <= seen + 1e-7]).sum()))
