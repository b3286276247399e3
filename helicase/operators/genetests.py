"""Gene tests as aggregates: regressions on what carriers change, and the sums that kernel tests need.

A cohort is a table of samples: trait y and covariates x1..xk.  Samples with the same covariates are one cell.

Regression.  A gene's predictors are zero for all but its carriers, so its fit is the cohort's cells plus the gene's
changes: each carrier leaves its cell and comes back with its predictors, and each masked sample leaves.  Newton steps of
all genes and tests are one aggregate: log likelihood, score and information are sums over cells and changes, and only
these, a few numbers a gene, reach the function that solves for the step.  Penalised (Firth) steps need the sums of
third order as well, from which the leverages' part of the score follows, so that they are one aggregate too.

Kernel sums.  Scores and products of variants are sums over samples.  Carriers are dealt by (gene, sample); what a sample
carries in a gene gives its pairs of variants, summed first where they are and then by (gene, pair).  A gene with half of
all calls is spread over all tasks; only its matrix, variants squared, reaches one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations_with_replacement, permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from helicase.functions import dist, kernels
from helicase.sources.store import materialised

#: Cells that meet a gene at a time.
BLOCK = 4096
#: Rows up to which a table of genes is broadcast (a row has some hundred numbers at most).
FEW = 100_000
Z95 = 1.959963984540054

KEY = ("gene", "test")
RESULT = "gene string, test string, p_value double, effect double, se double, ci_lower double, ci_upper double, warnings string, status string"
#: A fit under way: where the sums were last taken (beta), the step that led there and its share, what they were at the
#: last place that was better than those before, and whether a standard error there is large.
STATE = (
    "gene string, test string, beta array<double>, info array<double>, ll double, tried array<double>, size double, value double, force array<double>, slope array<double>, "
    "steep boolean, steps int, done boolean"
)


@dataclass
class Cohort:
    """The samples that are tested, and what their trait is."""

    people: DataFrame
    covariates: list[str]
    binary: bool
    n: int
    n_case: int

    @classmethod
    def of(cls, who: DataFrame, tables: list[tuple[str, DataFrame]] = (), binary: bool = True) -> Cohort:
        """From who (sample_id, y) and tables of numbers by sample_id; a sample that one of them lacks raises."""
        rows, names = who.select("sample_id", F.col("y").cast("double").alias("y")), []
        for what, table in tables:
            own = [c for c in table.columns if c != "sample_id"]
            rows = rows.join(table.select("sample_id", F.lit(True).alias("_there"), *(F.col(f"`{c}`").cast("double").alias(f"x{len(names) + i + 1}") for i, c in enumerate(own))), "sample_id", "left")
            absent = [r[0] for r in rows.where("_there IS NULL").select("sample_id").limit(5).collect()]
            if absent:
                raise ValueError(f"no {what} for {', '.join(absent)}")
            rows = rows.drop("_there")
            names += [f"x{len(names) + i + 1}" for i in range(len(own))]
        rows = materialised(rows, "cohort")
        n, n_case = rows.agg(F.count("*"), F.count_if(F.col("y") == 1)).first()
        return cls(rows, names, binary, n, n_case)

    def cells(self) -> DataFrame:
        """block, n, ny, nyy by covariates."""
        cells = self.people.groupBy(*self.covariates).agg(F.count("*").cast("double").alias("n"), F.sum("y").alias("ny"), F.sum(F.col("y") * F.col("y")).alias("nyy"))
        blocks = max(1, -(-self.n // BLOCK)) if self.covariates else 1
        at = F.pmod(F.xxhash64(*self.covariates), F.lit(blocks)).cast("int") if self.covariates else F.lit(0)
        return cells.withColumn("block", at)

    def blocks(self) -> int:
        return max(1, -(-self.n // BLOCK)) if self.covariates else 1

    def of_gene(self, extra: list[str]) -> list[Column]:
        """A design's columns: one, covariates, the gene's."""
        return [F.lit(1.0), *(F.col(c) for c in self.covariates), *(F.col(c) for c in extra)]


def _small(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= FEW else df


# regressions


def carriers(calls: DataFrame) -> DataFrame:
    """gene, sample_id, masked, has (variant_id, d, weight, category of dosages above zero) of calls (gene, variant_id,
    sample_id, dosage, weight, category, masked); of repeated calls the largest dosage counts."""
    d = F.col("dosage").cast("double")
    rows = calls.repartition("gene", "sample_id")
    once = rows.groupBy("gene", "sample_id", "variant_id").agg(F.max(d).alias("d"), F.max("weight").cast("double").alias("weight"), F.max("category").cast("int").alias("category"), F.max("masked").alias("masked"))
    has = F.sort_array(F.collect_list(F.when(F.col("d") > 0, F.struct("variant_id", "d", "weight", "category"))))  # a gene's variants at most
    return once.groupBy("gene", "sample_id").agg(F.max("masked").alias("masked"), has.alias("has"))


def burden_of(c: Column) -> Column:
    """A sample's weighted sum of dosages."""
    return F.aggregate(c, F.lit(0.0), lambda t, v: t + v["d"] * v["weight"])


def count_of(c: Column, category: int) -> Column:
    """A sample's dosages of one category."""
    return F.aggregate(c, F.lit(0.0), lambda t, v: t + F.when(v["category"] == category, v["d"]).otherwise(0.0))


def changes(carried: DataFrame, cohort: Cohort, predictors: dict[str, list[Column]]) -> DataFrame:
    """n, ny, nyy by gene, test, covariates and predictors b0..: what a gene's carriers and masked samples change.

    carried: carriers().  predictors: by test Columns over has and over count1..count3, the dosages by category.  Besides,
    the test null has what masked samples change.
    """
    width = max(map(len, predictors.values()), default=0)
    extra = [f"b{i}" for i in range(width)]
    rows = carried.withColumns({f"count{c}": count_of(F.col("has"), c) for c in (1, 2, 3)}).join(_small(cohort.people, cohort.n), "sample_id")
    named = {t: [f"_{i}_{j}" for j in range(len(columns))] for i, (t, columns) in enumerate(predictors.items())}
    kept = ["gene", "masked", "y", *cohort.covariates]
    rows = rows.select(*kept, *(c.cast("double").alias(name) for t, columns in predictors.items() for name, c in zip(named[t], columns, strict=True)))
    carried_any = lambda names: reduce(lambda a, b: a | b, [F.col(b) != 0 for b in names], F.lit(False))
    every = [name for names in named.values() for name in names]
    rows = rows.where(F.col("masked") | carried_any(every))
    if len(predictors) > 1:  # a row goes to every test, so equal ones are counted first
        rows = rows.groupBy(*kept, *every).agg(F.count("*").cast("double").alias("_times"))
    else:
        rows = rows.withColumn("_times", F.lit(1.0))
    tests = [F.struct(F.lit(t).alias("test"), *((F.col(names[i]) if i < len(names) else F.lit(0.0)).alias(b) for i, b in enumerate(extra))) for t, names in {"null": [], **named}.items()]
    rows = rows.withColumn("_t", F.explode(F.array(*tests))).select(*kept, "_times", "_t.*").where(F.col("masked") | carried_any(extra))
    gone = F.struct((-F.col("_times")).alias("n"), *(F.lit(0.0).alias(b) for b in extra))
    back = F.struct(F.col("_times").alias("n"), *(F.col(b).alias(b) for b in extra))
    rows = rows.withColumn("_c", F.explode(F.when(F.col("masked"), F.array(gone)).otherwise(F.array(gone, back)))).select("gene", "test", *cohort.covariates, "y", "_c.*")
    y, n = F.col("y"), F.col("n")
    return rows.groupBy("gene", "test", *cohort.covariates, *extra).agg(F.sum(n).alias("n"), F.sum(n * y).alias("ny"), F.sum(n * y * y).alias("nyy"))


def _upper(m: int, order: int) -> list[tuple[int, ...]]:
    return list(combinations_with_replacement(range(m), order))


def _folded(values: list[float], m: int, order: int = 2) -> np.ndarray:
    """The symmetric array whose entries at ascending places are given."""
    out = np.empty((m,) * order)
    for at, v in zip(_upper(m, order), values, strict=True):
        for p in set(permutations(at)):
            out[p] = v
    return out


def _sums(live: DataFrame, changed: DataFrame, cells: DataFrame, cohort: Cohort, extra: list[str], n_live: int, third: bool = False) -> DataFrame:
    """ll, score and information of every live fit at its beta, over cells and changes; also sums of third order."""
    keys = live.select(*KEY, "beta")
    kept = [c for c in live.columns if c not in (*KEY, "info", "ll")]
    base = live.select(*KEY, "beta", F.struct(*kept).alias("_state")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(cohort.blocks() - 1))))
    base = base.join(F.broadcast(cells) if cohort.n <= FEW else cells, "block")
    columns = [*KEY, "beta", "_state", "n", "ny", *cohort.covariates, *extra]
    rows = base.withColumns({b: F.lit(0.0) for b in extra}).select(*columns)
    rows = rows.unionByName(changed.join(_small(keys, n_live), list(KEY)).withColumn("_state", F.lit(None).cast(rows.schema["_state"].dataType)).select(*columns))
    z = cohort.of_gene(extra)
    eta = reduce(lambda a, b: a + b, [c * F.get("beta", F.lit(i)) for i, c in enumerate(z)])
    rows = rows.withColumn("_p", 1.0 / (1.0 + F.exp(-F.greatest(F.lit(-35.0), F.least(F.lit(35.0), eta)))))
    p, n, ny = F.col("_p"), F.col("n"), F.col("ny")
    rows = rows.withColumns({"_r": ny - n * p, "_w": n * p * (1.0 - p), "_l": ny * F.ln(F.greatest(p, F.lit(1e-15))) + (n - ny) * F.ln(F.greatest(1.0 - p, F.lit(1e-15)))})
    w = F.col("_w")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0.0))
    product = lambda at: reduce(lambda a, b: a * b, [z[i] for i in at])
    sums = [total("_l").alias("ll"), F.array(*(total(F.col("_r") * c) for c in z)).alias("score"), F.array(*(total(w * product(at)) for at in _upper(len(z), 2))).alias("info")]
    sums.append(F.array(*(F.coalesce(F.max(F.abs(c)), F.lit(0.0)) for c in z)).alias("reach"))
    if third:
        sums.append(F.array(*(total(w * (0.5 - p) * product(at)) for at in _upper(len(z), 3))).alias("cubes"))
    return rows.groupBy(*KEY).agg(*sums, F.first("_state", ignorenulls=True).alias("_state")).select(*KEY, "_state.*", "ll", "score", "info", "reach", *(["cubes"] if third else []))


def _inverse(info: np.ndarray) -> np.ndarray:
    """The inverse, or that of what is not singular; predictors may be of very different size."""
    d = np.sqrt(np.maximum(np.diag(info), 0))
    d[d == 0] = 1.0
    return np.linalg.pinv(info / np.outer(d, d), rcond=1e-12, hermitian=True) / np.outer(d, d)


def _rank(info: np.ndarray) -> int:
    d = np.sqrt(np.maximum(np.diag(info), 0))
    d[d == 0] = 1.0
    return int(np.linalg.matrix_rank(info / np.outer(d, d), tol=1e-9, hermitian=True))


def _by_row(schema: str, fn: Callable[[dict], dict]):
    names = [c.strip().split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [fn(r) for r in batch.to_pylist()]
            if out:
                kinds = {"string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(), "int": pa.int32(), "array<double>": pa.list_(pa.float64())}
                yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in out], kinds[c.strip().split()[1]]) for n, c in zip(names, schema.split(", "), strict=True)], names=names)

    return run


#: Standard error from which a coefficient counts as not found, and evaluations after which such a fit is given up.
STEEP, ENOUGH_STEEP = 100.0, 10
#: Largest move of a sample's log odds at which a plain and a penalised fit end.
SETTLED = (1e-8, 1e-6)
HALVINGS = 10
#: Log odds that a step may move a sample.
FARTHEST = 50.0


def _advanced(row: dict) -> dict:
    """Takes or halves the step that was tried; a taken one is followed by the next, unless the fit has settled."""
    score, reach = np.array(row["score"]), np.maximum(np.array(row["reach"]), 1e-300)
    info, beta, penal = _folded(row["info"], len(score)), np.array(row["beta"]), row["cubes"] is not None
    tried, size, steps = np.array(row["tried"]), row["size"], row["steps"] + 1
    value = row["ll"]
    if penal:
        used = np.diag(info) > 0
        sign, log = np.linalg.slogdet(info[np.ix_(used, used)])
        value = value + 0.5 * log if sign > 0 else -math.inf
    if row["value"] is not None and not value >= row["value"] - 1e-12:
        if size <= 0.5**HALVINGS:
            return {**row, "beta": (beta - size * tried).tolist(), "ll": row["value"], "size": 0.0, "steps": steps, "done": True}
        return {**row, "beta": (beta - size / 2 * tried).tolist(), "ll": row["value"], "size": size / 2, "steps": steps, "done": False}
    inverse = _inverse(info)
    steep = bool(np.diag(inverse).max() > STEEP**2)
    done = row["value"] is not None and bool(np.abs(size * tried * reach).max() < SETTLED[penal])
    if row["test"].startswith("coast:"):
        done |= row["value"] is not None and value - row["value"] < 1e-7  # likelihoods settle before coefficients
    elif not penal:
        done |= steep and steps >= ENOUGH_STEEP
    force = score + np.einsum("jkl,kl->j", _folded(row["cubes"], len(score), 3), inverse) if penal else score
    slope = inverse
    if penal and row["force"] is not None:
        # the information lacks the penalty's part; what the last step did to the score tells it (Broyden)
        slope, moved, fell = np.array(row["slope"]).reshape(inverse.shape), size * tried, np.array(row["force"]) - force
        along = slope @ fell
        if abs(moved @ along) > 1e-12:
            slope = slope + np.outer(moved - along, moved @ slope) / (moved @ along)
        if not (slope @ force) @ force > 0:
            slope = inverse
    step = slope @ force
    step = step * min(1.0, FARTHEST / max(float(np.abs(step) @ reach), 1e-300))
    taken = {"beta": (beta if done else beta + step).tolist(), "ll": value, "value": value, "tried": step.tolist(), "size": 1.0}
    return {**row, **taken, "force": force.tolist(), "slope": slope.ravel().tolist(), "steep": steep, "steps": steps, "done": done}


def _iterated(state: DataFrame, advance: Callable[[DataFrame, int], DataFrame], steps: int, name: str) -> DataFrame:
    """Rows of state, each advanced until it is done, or so many times."""
    ended = []
    left = state.count()
    for _ in range(steps):
        if not left:
            break
        seen = Observation()
        now = materialised(advance(state, left).observe(seen, F.count_if(~F.col("done")).alias("left")), name)
        ended.append(now.where("done"))
        state, left = now.where("NOT done"), seen.get["left"]
    return reduce(DataFrame.unionByName, [*ended, *([state] if left or not ended else [])])


def fitted(keys: DataFrame, changed: DataFrame, cohort: Cohort, extra: list[str], penal: bool = False, steps: int = 60) -> DataFrame:
    """Logistic fits of every key (gene, test), plain or with Jeffreys' prior, as STATE: ll is what was maximised, size is
    0 where no share of a step was better."""
    m = 1 + len(cohort.covariates) + len(extra)
    odds = math.log((cohort.n_case + 0.5) / (cohort.n - cohort.n_case + 0.5))
    numbers, number = F.lit(None).cast("array<double>"), F.lit(None).cast("double")
    zeros = F.array(*[F.lit(0.0)] * m)
    begin = {"beta": F.array(F.lit(odds), *[F.lit(0.0)] * (m - 1)), "info": numbers, "ll": number, "tried": zeros, "size": F.lit(1.0), "value": number, "force": numbers, "slope": numbers, "steep": F.lit(False), "steps": F.lit(0), "done": F.lit(False)}
    cells = materialised(cohort.cells(), "cells")
    n_cells = cells.count()
    state = keys.select(*KEY, *(c.alias(k) for k, c in begin.items()))
    sizes = changed.groupBy(*KEY).agg((F.count("*") + n_cells).alias("_rows"))
    state = materialised(state.join(sizes, list(KEY), "left").withColumn("_rows", F.coalesce("_rows", F.lit(n_cells))), "state")
    small, large = state.where(F.col("_rows") <= MOST_LOCAL).drop("_rows"), state.where(F.col("_rows") > MOST_LOCAL).drop("_rows")

    def advance(live: DataFrame, n: int) -> DataFrame:
        sums = _sums(live, changed, cells, cohort, extra, n, penal)
        sums = sums if penal else sums.withColumn("cubes", numbers)
        return sums.mapInArrow(_by_row(STATE, _advanced), STATE)

    parts = [_finished(small, changed, cells, cohort, extra, penal, steps)] if n_cells <= MOST_LOCAL else []
    if not parts or not large.isEmpty():
        parts.append(_iterated(large, advance, steps, "firth" if penal else "newton"))
    return reduce(DataFrame.unionByName, parts)


#: Cells and changes of a fit up to which all its steps are taken in one task, which holds no more than these.
MOST_LOCAL = 20_000


def _finished(keys: DataFrame, changed: DataFrame, cells: DataFrame, cohort: Cohort, extra: list[str], penal: bool, steps: int) -> DataFrame:
    """The same steps for fits whose cells and changes are few: they meet once, by key."""
    columns = [*KEY, "beta", "n", "ny", *cohort.covariates, *extra]
    base = keys.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(cohort.blocks() - 1)))).join(F.broadcast(cells), "block")
    own = changed.join(keys.select(*KEY), list(KEY), "left_semi").withColumn("beta", F.lit(None).cast("array<double>"))
    rows = base.withColumns({b: F.lit(0.0) for b in extra}).select(*columns).unionByName(own.select(*columns))
    names = [*cohort.covariates, *extra]
    fields = [c.strip().split() for c in STATE.split(", ")]
    tasks = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(table: pa.Table) -> pa.Table:
        n, ny = table["n"].to_numpy(), table["ny"].to_numpy()
        z = np.column_stack([np.ones(len(n)), *(table[c].to_numpy() for c in names)])
        first = next(b for b in table["beta"].to_pylist() if b is not None)
        m = z.shape[1]
        row = {"gene": table["gene"][0].as_py(), "test": table["test"][0].as_py(), "beta": first, "tried": [0.0] * m, "size": 1.0, "value": None, "force": None, "slope": None, "steps": 0, "done": False}
        pairs, triples = (tuple(np.array(_upper(m, k)).T) for k in (2, 3))
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ np.array(row["beta"]), -35, 35)))
            w = n * p * (1 - p)
            sums = {"ll": float(ny @ np.log(np.maximum(p, 1e-15)) + (n - ny) @ np.log(np.maximum(1 - p, 1e-15))), "score": z.T @ (ny - n * p), "info": (z.T @ (z * w[:, None]))[pairs], "reach": np.abs(z).max(0)}
            sums["cubes"] = np.einsum("i,ij,ik,il->jkl", w * (0.5 - p), z, z, z, optimize=True)[triples] if penal else None
            row = _advanced({**row, **sums})
            if row["done"]:
                break
        row["info"] = [float(v) for v in row["info"]]
        kinds = {"string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(), "int": pa.int32(), "array<double>": pa.list_(pa.float64())}
        return pa.table([pa.array([row.get(name)], kinds[kind]) for name, kind in fields], names=[name for name, _ in fields])

    return rows.repartition(tasks, *KEY).groupBy(*KEY).applyInArrow(run, STATE)


def _wald(beta: float, se: float, p: float) -> dict:
    return {"p_value": p, "effect": beta, "se": se, "ci_lower": beta - Z95 * se, "ci_upper": beta + Z95 * se}


def _told_wald(row: dict, place: int) -> dict:
    """The test of the predictor at that place of a fit."""
    notes = [w for w in (row["warnings"] or "").split(";") if w]
    m = len(row["beta"])
    info = _folded(row["info"], m)
    used = [*range(place + 1)]
    info = info[np.ix_(used, used)]
    if _rank(info) < len(used):
        return {**row, "p_value": math.nan, "warnings": ";".join(notes)}
    se = math.sqrt(max(_inverse(info)[place, place], 0.0))
    beta = row["beta"][place]
    if row["penalised"]:
        notes.append("FIRTH" if row["done"] and row["size"] > 0 else "FIRTH_NOT_CONVERGED")
    return {**row, **_wald(beta, se, 2 * dist.norm_sf(abs(beta / se)) if se > 0 else math.nan), "warnings": ";".join(notes)}


def carrier_notes(changed: DataFrame, cohort: Cohort, names: list[str]) -> DataFrame:
    """gene, test, one_side (whether cases alone or controls alone carry the first predictor) and warnings."""
    on = F.sum(F.when(F.col("b0") > 0, F.col("ny")).otherwise(0.0))
    both = F.sum(F.when(F.col("b0") > 0, F.col("n")).otherwise(0.0))
    told = changed.where(F.col("test").isin(names)).groupBy(*KEY).agg(on.alias("on"), (both - on).alias("off"), F.sum("ny").alias("cases"), F.sum("n").alias("all"))
    cases, controls = F.col("cases") + cohort.n_case, F.col("all") - F.col("cases") + (cohort.n - cohort.n_case)
    perfect = ((F.col("off") == 0) & (F.col("on") == cases)) | ((F.col("on") == 0) & (F.col("off") == controls))
    one_side = (F.col("on") == 0) | (F.col("off") == 0)
    carried = F.col("on") + F.col("off") > 0
    notes = [F.when(F.col("on") + F.col("off") < 3, F.lit("LOW_CARRIER_COUNT")), F.when(one_side, F.when(carried, F.lit("ZERO_CARRIERS_ONE_GROUP")).otherwise("NO_CARRIERS"))]
    notes.append(F.when(one_side & carried, F.when(perfect, F.lit("PERFECT_SEPARATION")).otherwise("QUASI_SEPARATION")))
    return materialised(told.select(*KEY, one_side.alias("one_side"), F.array_join(F.array_compact(F.array(*notes)), ";").alias("warnings")), "notes")


def logistic_tests(told: DataFrame, changed: DataFrame, cohort: Cohort, extra: list[str], fits: DataFrame, firth_steps: int = 100) -> DataFrame:
    """RESULT of one-predictor tests (the first predictor) from carrier_notes and fits; genes that one side alone carries,
    or whose fit has not settled, are fitted anew with the penalty."""
    place = 1 + len(cohort.covariates)
    rows = told.join(fits.select(*KEY, "beta", "info", "steep", "done"), list(KEY), "left")
    rows = materialised(rows.withColumn("again", F.col("one_side") | F.col("beta").isNull() | F.col("steep") | ~F.col("done")), "fits")
    firth = fitted(rows.where("again").select(*KEY), changed, cohort, extra, True, firth_steps)
    firth = rows.select(*KEY, "warnings").join(firth.select(*KEY, "beta", "info", "done", "size"), list(KEY)).withColumn("penalised", F.lit(True))
    plain = rows.where("NOT again").select(*KEY, "warnings", "beta", "info", "done", F.lit(1.0).alias("size"), F.lit(False).alias("penalised"))
    return firth.unionByName(plain).mapInArrow(_by_row(RESULT, lambda r: _told_wald(r, place)), RESULT)


def likelihood_tests(fits: DataFrame, cohort: Cohort, changed: DataFrame) -> DataFrame:
    """gene, test, p_value of likelihood ratios against the fit without the gene (the gene's own, if samples are masked)."""
    x = 1 + len(cohort.covariates)
    null = fits.where("test = 'null'").select(F.col("gene").alias("_gene"), F.col("ll").alias("null_ll"))
    rows = fits.where("test LIKE 'coast:%'").join(null, F.col("gene") == F.col("_gene"), "left").drop("_gene")
    whole = fits.where("test = 'cohort'").select("ll").first()
    rows = rows.withColumn("null_ll", F.coalesce("null_ll", F.lit(whole.ll)))

    def told(row: dict) -> dict:
        info = _folded(row["info"], len(row["beta"]))
        used = [i for i in range(len(info)) if info[i, i] > 0]
        more = _rank(info[np.ix_(used, used)]) - _rank(info[:x, :x])
        p = dist.chi2_sf(max(0.0, 2 * (row["ll"] - row["null_ll"])), more) if more > 0 else math.nan
        return {**row, "p_value": p}

    return rows.mapInArrow(_by_row("gene string, test string, p_value double", told), "gene string, test string, p_value double")


def linear_fits(changed: DataFrame, cohort: Cohort, extra: list[str]) -> tuple[DataFrame, tuple]:
    """gene, test, n, products (of the design), with_y, yy; and the same of the cohort alone, from one aggregate each."""
    z = cohort.of_gene(extra)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0.0))
    product = lambda at: reduce(lambda a, b: a * b, [z[i] for i in at])
    sums = [total("n").alias("n"), F.array(*(total(F.col("n") * product(at)) for at in _upper(len(z), 2))).alias("products"), F.array(*(total(F.col("ny") * c) for c in z)).alias("with_y"), total("nyy").alias("yy")]
    base = cohort.cells().withColumns({b: F.lit(0.0) for b in extra}).agg(*sums).first()
    own = changed.groupBy(*KEY).agg(*sums)
    whole = base.n, list(base.products), list(base.with_y), base.yy
    added = lambda c, values: F.transform(F.arrays_zip(F.col(c).alias("a"), F.lit(values).alias("b")), lambda v: v["a"] + v["b"])
    return own.select(*KEY, (F.col("n") + whole[0]).alias("n"), added("products", whole[1]).alias("products"), added("with_y", whole[2]).alias("with_y"), (F.col("yy") + whole[3]).alias("yy")), whole


def _least_squares(products: list[float], with_y: list[float], yy: float, used: list[int]) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Coefficients, the products' inverse, the residual sum of squares and the rank over the used columns."""
    m = _folded(products, len(with_y))[np.ix_(used, used)]
    inverse, right = _inverse(m), np.array(with_y)[used]
    beta = inverse @ right
    return beta, inverse, max(0.0, yy - float(beta @ right)), _rank(m)


def linear_tests(fits: DataFrame, cohort: Cohort, names: list[str]) -> DataFrame:
    """RESULT of one-predictor tests by least squares."""
    place = 1 + len(cohort.covariates)
    used = [*range(place + 1)]

    def told(row: dict) -> dict:
        beta, inverse, rss, rank = _least_squares(row["products"], row["with_y"], row["yy"], used)
        if rank <= place:
            return {**row, "p_value": math.nan, "warnings": "NO_CARRIERS"}
        df = row["n"] - len(used)
        se = math.sqrt(max(inverse[place, place] * rss / max(1, df), 0.0))
        t = beta[place] / se if se > 0 else math.inf
        return {**row, **_wald(float(beta[place]), se, dist.t_two_sided(float(t), df)), "warnings": ""}

    return fits.where(F.col("test").isin(names)).mapInArrow(_by_row(RESULT, told), RESULT)


def f_tests(fits: DataFrame, cohort: Cohort) -> DataFrame:
    """gene, test, p_value of the predictors together on top of the covariates."""
    x = 1 + len(cohort.covariates)

    def told(row: dict) -> dict:
        m = len(row["with_y"])
        _, _, rss0, rank0 = _least_squares(row["products"], row["with_y"], row["yy"], [*range(x)])
        _, _, rss1, rank1 = _least_squares(row["products"], row["with_y"], row["yy"], [*range(m)])
        more, df = rank1 - rank0, row["n"] - rank1
        return {**row, "p_value": dist.f_sf((rss0 - rss1) / more / (rss1 / df), more, df) if more > 0 and df > 0 and rss1 > 0 else math.nan}

    return fits.where("test LIKE 'coast:%'").mapInArrow(_by_row("gene string, test string, p_value double", told), "gene string, test string, p_value double")


# kernel sums


def kernel_sums(carried: DataFrame, cohort: Cohort, nulls: DataFrame) -> DataFrame:
    """gene, a, b (variants, a first) with product (of dosages times variances), plain (of dosages) and, where a is b, score,
    alleles, with_x (dosages times variances times covariates), weight, category, and carriers (of the gene; summed over
    its rows), for unmasked carriers().

    nulls: gene (null: all others), beta and, for a quantitative trait, variance (of residuals).
    """
    whole = nulls.where("gene IS NULL").first()
    own = nulls.where("gene IS NOT NULL").select("gene", F.col("beta").alias("_beta"), F.col("variance").alias("_s2"))
    n_own = own.count()
    carried = carried.where("NOT masked AND size(has) > 0")
    people = cohort.people.select("sample_id", "y", *cohort.covariates)
    rows = carried.join(_small(people, cohort.n), "sample_id")
    x = cohort.of_gene([])
    if n_own:
        rows = rows.join(_small(own, n_own), "gene", "left")
        beta, s2 = F.coalesce("_beta", F.lit(list(whole.beta))), F.coalesce("_s2", F.lit(whole.variance))
    else:
        beta, s2 = F.lit(list(whole.beta)), F.lit(whole.variance)
    fit = reduce(lambda a, b: a + b, [c * F.get(beta, F.lit(i)) for i, c in enumerate(x)])
    if cohort.binary:
        p = 1.0 / (1.0 + F.exp(-F.greatest(F.lit(-35.0), F.least(F.lit(35.0), fit))))
        rows = rows.withColumn("_p", p).withColumns({"r": F.col("y") - F.col("_p"), "v": F.col("_p") * (1.0 - F.col("_p"))})
    else:
        rows = rows.withColumns({"r": (F.col("y") - fit) / s2, "v": 1.0 / s2})
    pairs = F.flatten(F.transform("has", lambda a, i: F.transform(F.slice("has", i + 1, F.size("has")), lambda b, j: F.struct(a.alias("a"), b.alias("b"), (j == 0).alias("same"), ((i == 0) & (j == 0)).alias("first")))))
    rows = rows.select("gene", "r", "v", *cohort.covariates, F.explode(pairs).alias("p"))
    same = lambda c: F.sum(F.when(F.col("p.same"), c))
    both = F.col("p.a.d") * F.col("p.b.d")
    return rows.groupBy("gene", F.col("p.a.variant_id").alias("a"), F.col("p.b.variant_id").alias("b")).agg(
        F.sum(both * F.col("v")).alias("product"), F.sum(both).alias("plain"), same(F.col("p.a.d") * F.col("r")).alias("score"), same(F.col("p.a.d")).alias("alleles"),
        F.array(*(same(F.col("p.a.d") * F.col("v") * c) for c in x)).alias("with_x"), F.max("p.a.weight").alias("weight"), F.max("p.a.category").alias("category"), F.count_if("p.first").alias("carriers"),
    )


#: Variants of a gene up to which its products are matrices; beyond, they stay pairs (kernels.Linked).
MOST_DENSE = 400


@dataclass
class GeneSums:
    """What a gene's kernel tests are given: sums by variant, and products of pairs of variants that a sample carries (a, b,
    each once, with the plain product of dosages), from which scored has the covariates taken out."""

    n: int
    binary: bool
    carriers: int
    alleles: np.ndarray
    a: np.ndarray
    b: np.ndarray
    products: np.ndarray
    variance: float
    scored: kernels.Scored | kernels.Linked
    weights: np.ndarray
    categories: np.ndarray

    @property
    def plain(self) -> np.ndarray:
        """The products of dosages as a matrix, variants squared."""
        out = np.zeros((len(self.alleles), len(self.alleles)))
        out[self.a, self.b] = out[self.b, self.a] = self.products
        return out

    def plain_sum(self, w: np.ndarray) -> float:
        """The product with itself of the sum of variants by the given weights."""
        return float((np.where(self.a == self.b, 1.0, 2.0) * self.products) @ (w[self.a] * w[self.b]))

    def variants(self, keep: np.ndarray) -> GeneSums:
        a, b, products = kernels.pairs_of(keep, self.a, self.b, self.products)
        return GeneSums(self.n, self.binary, self.carriers, self.alleles[keep], a, b, products, self.variance, self.scored.only(keep), self.weights[keep], self.categories[keep])


def _gene_sums(table: pa.Table, n: int, binary: bool) -> GeneSums:
    a, b = table["a"].to_numpy(), table["b"].to_numpy()
    names = np.unique(a)
    at, to = np.searchsorted(names, a), np.searchsorted(names, b)
    own = np.flatnonzero(a == b)
    own = own[np.argsort(at[own])]
    score, alleles = table["score"].to_numpy()[own], table["alleles"].to_numpy()[own]
    with_x = np.array(table["with_x"].take(own).to_pylist())
    first = table.slice(0, 1).to_pylist()[0]
    lam, vectors = np.linalg.eigh(_inverse(_folded(first["info"], with_x.shape[1])))
    s = kernels.Linked(score, at, to, table["product"].to_numpy(), with_x @ (vectors * np.sqrt(np.maximum(lam, 0.0))))
    masked = int(first["n_masked"])
    return GeneSums(n - masked, binary, int(table["carriers"].to_numpy().sum()), alleles, at, to, table["plain"].to_numpy(), first["variance"], s.dense() if len(names) <= MOST_DENSE else s, table["weight"].to_numpy()[own], table["category"].to_numpy()[own])


def kernel_results(sums: DataFrame, cohort: Cohort, nulls: DataFrame, tests: dict[str, Callable[[GeneSums], dict]]) -> DataFrame:
    """RESULT of the tests from kernel_sums; a gene's rows, the pairs of its variants that a sample carries, are one group."""
    whole = nulls.where("gene IS NULL").first()
    own = nulls.where("gene IS NOT NULL").select("gene", F.col("info").alias("_info"), F.col("variance").alias("_s2"), F.col("n_masked").alias("_m"))
    n_own = own.count()
    rows = sums
    if n_own:
        rows = rows.join(_small(own, n_own), "gene", "left")
        extra = [F.coalesce("_info", F.lit(list(whole.info))).alias("info"), F.coalesce("_s2", F.lit(whole.variance)).alias("variance"), F.coalesce("_m", F.lit(0)).alias("n_masked")]
    else:
        extra = [F.lit(list(whole.info)).alias("info"), F.lit(whole.variance).alias("variance"), F.lit(0).alias("n_masked")]
    rows = rows.select(*sums.columns, *extra)
    names = [c.split()[0] for c in RESULT.split(", ")]
    kinds = [pa.string(), pa.string(), *[pa.float64()] * 5, pa.string(), pa.string()]
    n, binary = cohort.n, cohort.binary

    def run(table: pa.Table) -> pa.Table:
        found = _gene_sums(table, n, binary)
        gene = table["gene"][0].as_py()
        out = [{"gene": gene, "test": t, **f(found)} for t, f in tests.items()]
        return pa.table([pa.array([r.get(c) for r in out], k) for c, k in zip(names, kinds, strict=True)], names=names)

    tasks = int(sums.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "gene").groupBy("gene").applyInArrow(run, RESULT)


def null_models(cohort: Cohort, changed: DataFrame, fits: DataFrame | None = None, linear: tuple[DataFrame, tuple] | None = None) -> DataFrame:
    """gene (null: the cohort), beta, info (of the covariates), variance, n_masked: from logistic fits or least squares."""
    x = 1 + len(cohort.covariates)
    masked = changed.where("test = 'null'").groupBy("gene").agg((-F.sum("n")).cast("int").alias("n_masked"))
    if fits is not None:
        width = x + len([c for c in changed.columns if c[0] == "b" and c[1:].isdigit()])
        own = [i for i, at in enumerate(_upper(width, 2)) if at[1] < x]
        rows = fits.where("test IN ('null', 'cohort')").select(F.when(F.col("test") == "null", F.col("gene")).alias("gene"), F.slice("beta", 1, x).alias("beta"), F.array(*(F.get("info", F.lit(i)) for i in own)).alias("info"), F.lit(1.0).alias("variance"))
    else:
        own_fits, whole = linear
        spark = own_fits.sparkSession
        kept = "gene string, test string, n double, products array<double>, with_y array<double>, yy double"
        every = own_fits.where("test = 'null'").unionByName(spark.createDataFrame([("", "cohort", *whole)], kept))

        def told(row: dict) -> dict:
            beta, _, rss, _ = _least_squares(row["products"], row["with_y"], row["yy"], [*range(x)])
            s2 = rss / max(1.0, row["n"] - x)
            info = _folded(row["products"], len(row["with_y"]))[:x, :x] / s2
            return {"gene": None if row["test"] == "cohort" else row["gene"], "beta": beta.tolist(), "info": [float(info[at]) for at in _upper(x, 2)], "variance": s2}

        schema = "gene string, beta array<double>, info array<double>, variance double"
        rows = every.mapInArrow(_by_row(schema, told), schema)
    return materialised(rows.join(masked, "gene", "left").withColumn("n_masked", F.coalesce("n_masked", F.lit(0))), "nulls")
