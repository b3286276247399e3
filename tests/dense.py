"""Whole-matrix forms of the gene tests, against which the aggregates are held: least squares, logistic regression, its
penalised form, and scores and products of dense genotypes."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

from helicase.functions import dist, kernels

def ols(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Coefficients, their standard errors and the residual sum of squares."""
    inv = np.linalg.pinv(x.T @ x)
    beta = inv @ x.T @ y
    rss = float(((y - x @ beta) ** 2).sum())
    df = max(1, len(y) - x.shape[1])
    return beta, np.sqrt(np.maximum(np.diag(inv) * rss / df, 0)), rss


def _prob(x: np.ndarray, beta: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))


def loglik(x: np.ndarray, y: np.ndarray, beta: np.ndarray) -> float:
    p = np.clip(_prob(x, beta), 1e-15, 1 - 1e-15)
    return float((y * np.log(p) + (1 - y) * np.log(1 - p)).sum())


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[np.ndarray, np.ndarray, bool]:
    """Coefficients, standard errors and whether Newton's method converged."""
    beta = np.zeros(x.shape[1])
    done = False
    for _ in range(steps):
        p = _prob(x, beta)
        info = (x * (p * (1 - p))[:, None]).T @ x
        try:
            step = np.linalg.solve(info, x.T @ (y - p))
        except np.linalg.LinAlgError:
            break
        beta = beta + np.clip(step, -8, 8)
        if np.abs(step).max() < 1e-9:
            done = True
            break
    p = _prob(x, beta)
    cov = np.linalg.pinv((x * (p * (1 - p))[:, None]).T @ x)
    return beta, np.sqrt(np.maximum(np.diag(cov), 0)), done


def _penalised(x: np.ndarray, y: np.ndarray, beta: np.ndarray) -> float:
    p = _prob(x, beta)
    sign, logdet = np.linalg.slogdet((x * (p * (1 - p))[:, None]).T @ x)
    return loglik(x, y, beta) + 0.5 * logdet if sign > 0 else -math.inf


def firth(x: np.ndarray, y: np.ndarray, steps: int = 100, halvings: int = 10, enough: float = 1e-6) -> tuple[np.ndarray, np.ndarray, bool]:
    """Logistic regression with Jeffreys' prior: finite estimates under separation.

    Steps use the information without the prior, so they shrink by a constant factor near the end; it is reached when one
    moves no coefficient by more than enough.
    """
    beta = np.zeros(x.shape[1])
    now = _penalised(x, y, beta)
    done = False
    cov = np.eye(x.shape[1])
    for _ in range(steps):
        p = _prob(x, beta)
        w = p * (1 - p)
        cov = np.linalg.pinv((x * w[:, None]).T @ x)
        leverage = w * ((x @ cov) * x).sum(1)
        step = cov @ (x.T @ (y - p + leverage * (0.5 - p)))
        size, best = 1.0, None
        for _ in range(halvings):
            value = _penalised(x, y, beta + size * step)
            if value >= now - 1e-12:
                best = value
                break
            size /= 2
        if best is None:
            break
        beta, now = beta + size * step, best
        if np.abs(size * step).max() < enough:
            done = True
            break
    return beta, np.sqrt(np.maximum(np.diag(cov), 0)), done


def wald(beta: float, se: float) -> float:
    return 2 * dist.norm_sf(abs(beta / se)) if se > 0 else math.nan


def added_terms(base: np.ndarray, more: np.ndarray, y: np.ndarray, binary: bool) -> float:
    """p of the columns in more on top of base: a likelihood ratio or an F test."""
    more = more[:, more.std(0) > 0]
    if not more.shape[1]:
        return math.nan
    full = np.column_stack([base, more])
    k = np.linalg.matrix_rank(full) - np.linalg.matrix_rank(base)
    if k <= 0:
        return math.nan
    if binary:
        b0, _, _ = logistic(base, y)
        b1, _, _ = logistic(full, y)
        return dist.chi2_sf(max(0.0, 2 * (loglik(full, y, b1) - loglik(base, y, b0))), k)
    _, _, rss0 = ols(base, y)
    _, _, rss1 = ols(full, y)
    df = len(y) - np.linalg.matrix_rank(full)
    if df <= 0 or rss1 <= 0:
        return math.nan
    return dist.f_sf((rss0 - rss1) / k / (rss1 / df), k, df)


@dataclass
class Null:
    """The model without the gene: design, residuals, variances of the observations."""

    x: np.ndarray
    y: np.ndarray
    residual: np.ndarray
    variance: np.ndarray
    binary: bool


def fit_null(y: np.ndarray, covariates: np.ndarray | None = None, binary: bool = True) -> Null:
    x = np.ones((len(y), 1)) if covariates is None else np.column_stack([np.ones(len(y)), covariates])
    if binary:
        beta, _, _ = logistic(x, y)
        mu = 1 / (1 + np.exp(-x @ beta))
        return Null(x, y, y - mu, mu * (1 - mu), True)
    beta, _, rss = ols(x, y)
    s2 = rss / max(1, len(y) - x.shape[1])
    # residuals and variances on the scale of the variance, as the score needs them
    return Null(x, y, (y - x @ beta) / s2, np.full(len(y), 1 / s2), False)


def scored(null: Null, g: np.ndarray) -> kernels.Scored:
    """Scores and products from the projected matrix."""
    v = np.sqrt(null.variance)[:, None]
    xv, z = null.x * v, g * v
    z = (z - xv @ np.linalg.lstsq(xv, z, rcond=None)[0]) / math.sqrt(2)
    return kernels.Scored(g.T @ null.residual, z.T @ z, (g * null.variance[:, None]).T @ g)


def allelic_series(null: Null, g: np.ndarray, category: np.ndarray, by: tuple[float, ...] = (1.0, 2.0, 3.0)) -> float | None:
    """The combination of six burden tests and the mixture test."""
    keep = np.isin(category, (1, 2, 3)) & (g.sum(0) > 0)
    g, category = g[:, keep], category[keep]
    counts = np.column_stack([g @ (category == k).astype(float) for k in (1, 2, 3)])
    ps, scale = [], np.array(by)
    for n in (counts, (counts > 0).astype(float)):
        ps += [added_terms(null.x, m, null.y, null.binary) for m in (n, (n * scale).sum(1, keepdims=True), (n * scale).max(1, keepdims=True))]
    aaf = np.clip(g.sum(0) / (2 * len(g)), 1e-8, 1 - 1e-8)
    ps.append(kernels.skat_o(scored(null, g).weighted(np.sqrt(scale[category - 1] / (aaf * (1 - aaf)))))[0])
    return kernels.cauchy(ps, [1.0] * 6 + [6.0])
