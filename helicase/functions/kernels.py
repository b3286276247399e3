"""Variance-component tests of a gene from its scores and products: SKAT, its burden score, SKAT-O, per-variant combination."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np

from helicase.functions import dist, quadform, spectra

#: Grid of mixtures between the variance test (0) and the burden test (1).
RHO = (0.0, 0.01, 0.04, 0.09, 0.25, 0.5, 1.0)
RHO_MOST = 0.999
NODES = np.polynomial.legendre.leggauss(128)


def cauchy(ps: list[float | None], weights: list[float] | None = None) -> float | None:
    """The Cauchy combination; missing values and ones drop out."""
    pairs = [(p, w) for p, w in zip(ps, weights or [1.0] * len(ps), strict=True) if p is not None and not math.isnan(p) and p < 1]
    if not pairs:
        return next((p for p in ps if p is not None and not math.isnan(p)), None)
    if len(pairs) == 1:
        return pairs[0][0]
    t = sum(w * (1 / (p * math.pi) if p < 1e-15 else math.tan((0.5 - p) * math.pi)) for p, w in pairs) / sum(w for _, w in pairs)
    if not math.isfinite(t):
        return min(1.0, min(p for p, _ in pairs) * len(pairs))
    return 1 / (t * math.pi) if t > 1e15 else 0.5 - math.atan(t) / math.pi


@dataclass
class Scored:
    """Score of each variant, their covariance given the covariates (halved), and the products of their columns."""

    score: np.ndarray
    gram: np.ndarray
    cross: np.ndarray

    def weighted(self, w: np.ndarray) -> Scored:
        both = np.outer(w, w)
        return Scored(self.score * w, self.gram * both, self.cross * both)

    def single(self) -> bool:
        """Whether the columns are all multiples of one."""
        return len(self.score) < 2 or np.linalg.matrix_rank(self.cross, hermitian=True) < 2

    def only(self, keep: np.ndarray) -> Scored:
        """The same of some of the variants."""
        at = np.ix_(keep, keep)
        return Scored(self.score[keep], self.gram[at], self.cross[at])

    def weights(self) -> np.ndarray:
        """Those of the variance test's quadratic form."""
        return _lambdas(self.gram)

    def summed(self) -> tuple[float, float]:
        """The halved variance of the sum of all scores, and the size of the products that it comes from."""
        return float(self.gram.sum()), float(np.abs(self.cross).sum())

    def single_variances(self) -> tuple[np.ndarray, np.ndarray]:
        """The variance of each score, and what it was before the covariates were taken out."""
        return 2 * np.diag(self.gram), np.diag(self.cross)

    def mixed(self, rho: float) -> np.ndarray:
        """The weights of a mixture's quadratic form."""
        # the root of (1 - r) I + r J has one direction of its own
        p = len(self.score)
        one = math.sqrt(1 - rho + p * rho) - math.sqrt(1 - rho)
        root = math.sqrt(1 - rho) * np.eye(p) + one / p * np.ones((p, p))
        return _lambdas(root @ self.gram @ root)

    def shared(self) -> SharedDirection:
        return SharedDirection.of(self.gram)

    def forms(self) -> Iterator[Scored]:
        """What tells weights, mixtures and the shared direction, in turn until tails can be told from it."""
        yield self


@dataclass
class Linked:
    """The same as Scored without a matrix of all variants: products of the pairs at, to (once each, the diagonal too) and
    directions, by variant, whose products with each other are what covariates take out (spectra)."""

    score: np.ndarray
    at: np.ndarray
    to: np.ndarray
    product: np.ndarray
    directions: np.ndarray

    def covaried(self, x: np.ndarray) -> np.ndarray:
        """The halved covariance times columns of x."""
        return (self.times(x) - self.directions @ (self.directions.T @ x)) / 2

    @cached_property
    def leading(self) -> tuple[np.ndarray, np.ndarray]:
        return spectra.leading(lambda x: self.covaried(x[:, None])[:, 0], len(self.score))

    def power_sums(self, most: int) -> np.ndarray:
        """Of the halved products' eigenvalues; those of so many powers are made once."""
        made = self.__dict__.setdefault("_power_sums", {})
        if most not in made:
            made[most] = spectra.power_sums(len(self.score), self.at, self.to, self.product / 2, most)
        return made[most]

    def weighted(self, w: np.ndarray) -> Linked:
        return Linked(self.score * w, self.at, self.to, self.product * w[self.at] * w[self.to], self.directions * w[:, None])

    def only(self, keep: np.ndarray) -> Linked:
        at, to, product = pairs_of(keep, self.at, self.to, self.product)
        return Linked(self.score[keep], at, to, product, self.directions[keep])

    def dense(self) -> Scored:
        """As matrices, for tests that ask for them."""
        cross = np.zeros((len(self.score), len(self.score)))
        cross[self.at, self.to] = cross[self.to, self.at] = self.product
        return Scored(self.score, (cross - self.directions @ self.directions.T) / 2, cross)

    @property
    def gram(self) -> np.ndarray:
        return self.dense().gram

    @property
    def cross(self) -> np.ndarray:
        return self.dense().cross

    @cached_property
    def _spectra(self) -> tuple[np.ndarray, np.ndarray]:
        """Eigenvalues of the halved covariance, and the sum of all variants by its vectors."""
        k = self.directions.shape[1]
        d, carried = spectra.blocks(len(self.score), self.at, self.to, self.product, np.column_stack([self.directions, np.ones(len(self.score))]))
        for i in range(k):
            d, carried = spectra.with_direction(d, carried[:, i], carried, taken=True)
        return d / 2, carried[:, k]

    def single(self) -> bool:
        # of eigenvalues that are not negative, the square of the sum less the sum of squares is twice their products by twos
        own = float(self.product[self.at == self.to].sum())
        squares = float(np.where(self.at == self.to, 1.0, 2.0) @ self.product**2)
        return len(self.score) < 2 or not own**2 - squares > 2 * len(self.score) * spectra.EPS * own**2

    def forms(self) -> Iterator[Powered | Linked]:
        """First power sums, few and then more, which no block has to be held for; eigenvalues only where those do not do."""
        yield Powered.of(self, POWERS[0], (np.empty(0), np.empty(0)))
        for most in POWERS:
            yield Powered.of(self, most, self.leading)
        yield self

    def times(self, x: np.ndarray) -> np.ndarray:
        """The products times columns of x."""
        out = np.empty(x.shape)
        off = self.at != self.to
        for i in range(x.shape[1]):
            out[:, i] = np.bincount(self.at, self.product * x[self.to, i], minlength=len(x)) + np.bincount(self.to[off], self.product[off] * x[self.at[off], i], minlength=len(x))
        return out

    def weights(self) -> np.ndarray:
        return _used(self._spectra[0])

    def summed(self) -> tuple[float, float]:
        twice = np.where(self.at == self.to, 1.0, 2.0)
        taken = self.directions.sum(0)
        return (float(twice @ self.product) - float(taken @ taken)) / 2, float(twice @ np.abs(self.product))

    def single_variances(self) -> tuple[np.ndarray, np.ndarray]:
        own = np.zeros(len(self.score))
        same = self.at == self.to
        own[self.at[same]] = self.product[same]
        return own - (self.directions**2).sum(1), own

    def mixed(self, rho: float) -> np.ndarray:
        # a root of the covariance on both sides of (1 - r) I + r J has the same weights as a root of that on both sides of it
        lam, on = self._spectra
        return _used(spectra.with_direction((1 - rho) * lam, math.sqrt(rho) * np.sqrt(np.maximum(lam, 0.0)) * on, np.empty((len(lam), 0)))[0])

    def shared(self) -> SharedDirection:
        lam, on = self._spectra
        p, ahead = len(lam), lam * on
        length = float(ahead @ on) / p**2
        if not length > 1e-14 * float(lam.sum()):
            return SharedDirection(p, 0.0, 0.0, _used(lam), 0.0)
        mean = ahead / (p * length)
        rest, _ = spectra.with_direction(lam, math.sqrt(length) * mean, np.empty((p, 0)), taken=True)
        loading = float(mean @ mean)
        return SharedDirection(p, length, loading, _used(rest), max(0.0, 4 * length * (float(mean @ (lam * mean)) - length * loading**2)))


#: Power sums that a large gene's tails are told from, in turn.
POWERS = (8, 12, 16, 20, 24, 30)


@dataclass
class Powered:
    """The weights of a large gene's forms by their power sums (quadform.Powers): those of the halved covariance K, and ones' K^j
    ones, j from 1, both without what the largest eigenvalues and mass, the squared sums of their vectors, tell; in units of top."""

    variants: int
    sums: np.ndarray
    ones: np.ndarray
    large: np.ndarray
    mass: np.ndarray
    top: float

    @classmethod
    def of(cls, s: Linked, most: int, leading: tuple[np.ndarray, np.ndarray]) -> Powered:
        n, k = len(s.score), s.directions.shape[1]
        sums = s.power_sums(most)
        if not sums[-1] > 0:
            raise quadform.Unmet("no weight")
        top = min(float(sums[-1]) ** (1 / most), spectra.largest(n, s.at, s.to, s.product / 2))
        sums = sums / top ** np.arange(1, most + 1)
        # what covariates take out multiplies the determinant by that of 1 + s D' (1 - s G)^-1 D, whose series these are
        factor, x = [np.eye(k)], s.directions / math.sqrt(2 * top)
        v, ones = np.ones((n, 1)), [np.ones(n)]
        for j in range(most):
            factor.append(s.directions.T @ x / math.sqrt(2 * top))
            x = s.times(x) / (2 * top)
            if j <= most // 2:
                v = s.covaried(v) / top
                ones.append(v[:, 0])
        by = np.array([float(ones[j // 2] @ ones[j - j // 2]) for j in range(1, most + 3)])
        large, mass = leading[0] / top, leading[1] ** 2
        of_large = large ** np.arange(1, most + 3)[:, None]
        return cls(n, sums - _log_slope(factor) - of_large[:most].sum(1), by - of_large @ mass, large, mass, top)

    def weights(self) -> quadform.Powers:
        return quadform.Powers(self.sums, self.top, self.large)

    def mixed(self, rho: float) -> quadform.Powers:
        share = rho / (1 - rho)
        return quadform.Powers(self.sums, (1 - rho) * self.top, self.large, *((share * self.ones[:-1], share * self.mass * self.large) if rho > 0 else ()))

    def shared(self) -> SharedDirection:
        p, (a1, a2, a3) = self.variants, (float(self.ones[j] + self.mass @ self.large ** (j + 1)) for j in range(3))
        length = a1 * self.top / p**2
        if not length > 1e-14 * float(self.sums[0] + self.large.sum()) * self.top:
            return SharedDirection(p, 0.0, 0.0, self.weights(), 0.0)
        rest = quadform.Powers(self.sums, self.top, self.large, self.ones[1:] / a1, self.mass * self.large**2 / a1, -1)
        loading = a2 * self.top**2 / (p * length) ** 2
        return SharedDirection(p, length, loading, rest, max(0.0, 4 * length * (a3 * self.top**3 / (p * length) ** 2 - length * loading**2)))


def _log_slope(series: list[np.ndarray]) -> np.ndarray:
    """The numbers of the series of the slope of log det of a series of matrices that begins with 1."""
    inverse, out = [series[0]], []
    for m in range(1, len(series)):
        inverse.append(-sum(series[i] @ inverse[m - i] for i in range(1, m + 1)))
    for m in range(len(series) - 1):
        out.append(sum((i + 1) * float(np.trace(inverse[m - i] @ series[i + 1])) for i in range(m + 1)))
    return np.array(out)


def _told(s: Scored | Linked, test: Callable):
    """The test of the first of the forms that tells its tails."""
    for form in s.forms():
        try:
            return test(form)
        except quadform.Unmet:
            continue
    raise AssertionError("eigenvalues tell every tail")


def pairs_of(keep: np.ndarray, at: np.ndarray, to: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pairs whose members are both kept, under the numbers that these then have."""
    number = np.cumsum(keep) - 1
    both = keep[at] & keep[to]
    return number[at[both]], number[to[both]], *(v[both] for v in values)


def _used(lam: np.ndarray) -> np.ndarray:
    up = lam[lam >= 0]
    return lam[lam > up.mean() / 1e5] if len(up) else lam[:0]


def _lambdas(m: np.ndarray) -> np.ndarray:
    return _used(np.linalg.eigvalsh((m + m.T) / 2))


def skat(s: Scored | Linked) -> tuple[float, str]:
    return (math.nan, "rank") if s.single() else _told(s, lambda form: quadform.p_value(float((s.score**2).sum()) / 2, form.weights()))


def summed(s: Scored | Linked) -> float:
    """The score test of the sum of all variants."""
    half, size = s.summed()
    return dist.chi2_sf(float(s.score.sum()) ** 2 / (2 * half), 1) if 2 * half > 1e-12 * size else math.nan


def _moments(lam: np.ndarray | quadform.Powers) -> tuple[float, float, float]:
    """Mean, standard deviation and degrees of freedom of the matching chi-squared."""
    c1, c2, c3, c4 = (quadform.power(lam, k) for k in (1, 2, 3, 4))
    s1, s2 = c3 / c2**1.5, c4 / c2**2
    if s1 * s1 > s2:
        a = 1 / (s1 - math.sqrt(s1 * s1 - s2))
        df = a * a - 2 * (s1 * a**3 - a * a)
    else:
        df = 1 / s2
    return c1, math.sqrt(2 * c2), df


def skat_o(s: Scored | Linked) -> tuple[float, float]:
    """p of the best mixture, corrected for the search, and that mixture."""
    return (summed(s), 1.0) if s.single() else _told(s, lambda form: _best_mixture(s.score, form))


def _best_mixture(score: np.ndarray, form: Scored | Linked | Powered) -> tuple[float, float]:
    rhos = [min(r, RHO_MOST) for r in RHO]
    ps, shapes = [], []
    for r in rhos:
        q = ((1 - r) * float((score**2).sum()) + r * float(score.sum()) ** 2) / 2
        lam = form.mixed(r)
        ps.append(quadform.p_value(q, lam)[0])
        shapes.append(_moments(lam))
    least = min(ps)
    if not least > 0:
        return least, rhos[ps.index(least)]
    # the quantile of each mixture at the least p
    points = np.array([mean + sd * (dist.chi2_isf(least, df) - df) / math.sqrt(2 * df) for mean, sd, df in shapes])
    pairs = form.shared()
    shares = np.array([1 - r for r in rhos])
    along = np.array([pairs.along(r) for r in rhos])
    beyond = pairs.beyond(lambda u: np.min((points[:, None] - along[:, None] * u) / shares[:, None], axis=0))
    return min(beyond if beyond > 0 else least, least * len(rhos)), rhos[ps.index(least)]


@dataclass
class SharedDirection:
    """What all mixtures have in common: the mean direction of the roots, whose square is a chi-squared variable u, and the
    rest of each root, a quadratic form with weights lam and a further variance from what still ties it to the direction."""

    variants: int
    length: float
    loading: float
    lam: np.ndarray | quadform.Powers
    tied: float

    @classmethod
    def of(cls, gram: np.ndarray) -> SharedDirection:
        """From the roots' products."""
        p = len(gram)
        shared = gram.sum(1) / p
        length = float(shared.mean())
        if not length > 1e-14 * float(np.trace(gram)):
            return cls(p, 0.0, 0.0, _lambdas(gram), 0.0)
        on = shared / length
        rest = gram - length * np.outer(on, on)
        # on the direction and off it the roots' products add up to the variance of their mixed terms
        return cls(p, length, float(on @ on), _lambdas(rest), max(0.0, 4 * length * float(on @ rest @ on)))

    def along(self, rho: float) -> float:
        """How much of a mixture's statistic a unit of u brings."""
        return self.length * (self.variants**2 * rho + self.loading * (1 - rho))

    def beyond(self, level) -> float:
        """The chance that the rest exceeds level(u), over u; where inversion fails, by its matching chi-squared."""
        mean, pure = quadform.power(self.lam, 1), 2 * quadform.power(self.lam, 2)
        var = pure + self.tied
        nodes, weights = 20 * (NODES[0] + 1), 20 * NODES[1]
        weights = weights * np.exp(-nodes / 2) / np.sqrt(2 * math.pi * nodes)
        at = level(nodes)
        inside = (at > 0) & (at <= mean * 1e4)
        upper = np.where(at > mean * 1e4, 0.0, 1.0)
        if inside.any():
            scaled = (at[inside] - mean) * math.sqrt(pure / var) + mean if var > 0 else at[inside]
            found = np.where(scaled > 0, quadform.p_values(np.maximum(scaled, 1e-300), self.lam), 1.0)
            if not np.isfinite(found).all():
                return self.matched(level)
            upper[inside] = np.clip(found, 0, 1)
        return max(1 - float((weights * (1 - upper)).sum()), 0.0)

    def matched(self, level) -> float:
        """The same with the rest as a chi-squared variable of its mean, variance and kurtosis, on finer nodes."""
        c2, c4 = quadform.power(self.lam, 2), quadform.power(self.lam, 4)
        mean, var, df = quadform.power(self.lam, 1), 2 * c2 + self.tied, c2**2 / c4
        x, w = np.polynomial.legendre.leggauss(512)
        u = 20 * (x + 1)
        scaled = (level(u) - mean) / math.sqrt(var) * math.sqrt(2 * df) + df
        below = np.array([1 - dist.chi2_sf(max(s, 0.0), df) for s in scaled])
        return max(1 - float((20 * w * below * np.exp(-u / 2) / np.sqrt(2 * math.pi * u)).sum()), 0.0)


def per_variant(s: Scored | Linked, w: np.ndarray, maf: np.ndarray) -> float | None:
    """Score tests of single variants, combined with weights w^2 maf (1 - maf)."""
    var, own = s.single_variances()
    ps = [dist.chi2_sf(float(x) ** 2 / float(v), 1) if v > 1e-12 * c else math.nan for x, v, c in zip(s.score, var, own, strict=True)]
    return cauchy(ps, [max(float(x), 1e-12) for x in w**2 * maf * (1 - maf)])
