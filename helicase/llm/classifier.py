"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

A text becomes a vector of logarithms of smoothed rates: word length, symbols, capitals, digits, sentence marks, short
words, repeated words, repeated three-word runs, repeated lines, lines, and how far zstandard compresses it.  Each rate is
drawn towards a usual value by pseudo-counts, so that a short text, which shows little, lies near the middle.

Each class gets a mean and a covariance, shrunk first towards that of both classes together, then towards a multiple of
the unit matrix, in units of the whole sample's deviations.  A text's score is the logistic of the difference of the two
Mahalanobis log densities and log shares; the Cholesky factors are computed once and travel with the function.

Vectors are whole numbers of 1/SCALE, and so sums and products of them: they are added exactly, in any order, first in
tasks, then as decimals by class, so a fit is the same on every run.  Every labelled row outside the held-out fold takes
part; only sums by class reach the driver.  Texts are read once; what is joined with labels is doc_id and vector.

Defined results: a null or empty text has the vector of usual values.  Repeated rows and other columns pass unchanged,
but columns named as a result are replaced.  A doc_id with both labels counts in both classes.  With labelled rows of one
class only, or none, every score is the share of label 1 with one row of each class added.  Texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helicase.llm.common import by_text, materialised

#: Vectors are whole numbers of this part of one.
SCALE = 1024
#: Pseudo-counts: words, characters, lines, bytes.
WORDS, CHARS, LINES, BYTES = 15, 75, 3, 200
#: Shares of the pooled covariance and of the unit matrix in a class's covariance.
POOLED, ROUND = 0.1, 0.02
LEAST_SCORE = 0.3
LEVEL = 1
#: Name of the vector's column.
VECTOR = "_vector"

_SYMBOL, _CAPITAL, _DIGIT, _MARK = (re.compile(p) for p in ("[#$%&*|<>!]", "[A-ZÀ-Þ]", "[0-9]", "[.,;:]"))
STATISTICS = ("word length", "symbols", "capitals", "repeated words", "digits", "marks", "short words", "repeated lines", "repeated runs", "compression", "lines")


def _rate(found: float, of: float, usual: float, pseudo: float) -> float:
    return math.log((found + pseudo * usual) / (of + pseudo))


def statistics(text: str, by: zstandard.ZstdCompressor) -> list[float]:
    """The text's vector, in the order of STATISTICS."""
    words, lines = text.split(), text.split("\n")
    n, letters, raw = len(words), sum(map(len, words)), text.encode()
    runs = max(0, n - 2)
    again = runs - len(set(zip(words, islice(words, 1, None), islice(words, 2, None), strict=False)))
    count = lambda pattern: len(pattern.findall(text))
    return [
        _rate(letters, n, 5.5, WORDS),
        _rate(count(_SYMBOL), letters, 0.002, CHARS),
        _rate(count(_CAPITAL), letters, 0.03, CHARS),
        _rate(n - len(set(words)), n, 0.3, WORDS),
        _rate(count(_DIGIT), letters, 0.005, CHARS),
        _rate(count(_MARK), n, 0.1, WORDS),
        _rate(sum(len(w) <= 3 for w in words), n, 0.4, WORDS),
        _rate(len(lines) - len(set(lines)), len(lines), 0.02, LINES),
        _rate(again, n, 0.02, WORDS),
        _rate(len(by.compress(raw)) if raw else 0, len(raw), 0.5, BYTES),
        _rate(len(lines), n, 0.02, WORDS),
    ]


def _vectors(texts: list[str]) -> list[pa.Array]:
    by = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False)
    return [pa.array([[round(x * SCALE) for x in statistics(t, by)] for t in texts], pa.list_(pa.int32()))]


def vectors(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """keep's columns with the vector of whole numbers."""
    fields = [docs.schema[c] for c in keep] + [T.StructField(VECTOR, T.ArrayType(T.IntegerType()))]
    rows = docs.select(*keep, *([] if text in keep else [text]))
    return rows.mapInArrow(by_text(_vectors, [VECTOR], keep, text), T.StructType(fields))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATISTICS)).astype(np.int64)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, place, total) from rows (class, vector): the number of rows, sums, and sums of products (whole)."""
    d = len(STATISTICS)
    totals = np.zeros((2, 1 + d + d * d), np.int64)
    for batch in batches:
        kinds, x = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1))
        for k in (0, 1):
            own = x[kinds == k]
            totals[k] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
    places = np.arange(totals.shape[1], dtype=np.int32)
    for k in (0, 1):
        if totals[k, 0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(places), k, np.int32)), pa.array(places), pa.array(totals[k])], names=["kind", "place", "total"])


class Discriminant:
    """Means and Cholesky factors of both classes; without them only a share."""

    def __init__(self, share: float, means: np.ndarray | None = None, factors: np.ndarray | None = None, scale: np.ndarray | None = None) -> None:
        self.share, self.means, self.factors, self.scale = share, means, factors, scale

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of class 1 for rows of vectors (whole numbers)."""
        odds = np.full(len(x), math.log(self.share / (1 - self.share)))
        if self.means is not None:
            for sign, mean, factor in zip((-1.0, 1.0), self.means, self.factors, strict=True):
                away = np.linalg.solve(factor, ((x - mean) / self.scale).T)
                odds += sign * (-0.5 * (away * away).sum(0) - np.log(np.diag(factor)).sum())
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def discriminant(totals: dict[int, list[int]], pooled: float = POOLED, unit: float = ROUND) -> Discriminant:
    """From whole sums by class: the number of rows, sums, sums of products."""
    d = len(STATISTICS)
    n = np.array([float(totals.get(k, [0])[0]) for k in (0, 1)])
    share = float((n[1] + 1) / (n.sum() + 2))
    if not n.all():
        return Discriminant(share)
    means, scatter = np.empty((2, d)), np.empty((2, d, d))
    for k in (0, 1):
        own = totals[k]
        means[k] = [s / own[0] for s in own[1 : d + 1]]
        # whole numbers before the division, so nothing cancels
        scatter[k] = [[(own[0] * own[1 + d + i * d + j] - own[1 + i] * own[1 + j]) / own[0] ** 2 for j in range(d)] for i in range(d)]
    weights = n / n.sum()
    centre = weights @ means
    scale = np.sqrt(np.maximum((weights[:, None] * (np.diagonal(scatter, axis1=1, axis2=2) + (means - centre) ** 2)).sum(0), 1.0))
    scaled = scatter / np.outer(scale, scale)
    both = np.tensordot(weights, scaled, 1)
    factors = np.empty_like(scaled)
    for k in (0, 1):
        own = (1 - pooled) * scaled[k] + pooled * both
        level = max(np.trace(own) / d, 1e-3)
        factors[k] = np.linalg.cholesky((1 - unit) * own + unit * level * np.eye(d))
    return Discriminant(share, means, factors, scale)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def learned(rows: DataFrame, labels: DataFrame) -> Discriminant:
    """From rows (doc_id, vector) and labels (doc_id, quality) outside the held-out fold."""
    usable = labels.where("quality IN (0, 1)").where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").cast("int").alias("kind")).distinct()
    known = rows.select("doc_id", VECTOR).join(usable, "doc_id").select("kind", VECTOR)
    sums = known.mapInArrow(_sums, "kind int, place int, total bigint").groupBy("kind", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    totals: dict[int, list[int]] = {}
    for r in sums.orderBy("kind", "place").collect():  # two rows for each place of 1 + d + d * d
        totals.setdefault(r.kind, []).append(int(r.total))
    return discriminant(totals)


def scored(rows: DataFrame, model: Discriminant, keep: list[str], least: float = LEAST_SCORE) -> DataFrame:
    """keep's columns of rows (with their vectors), score and whether it is that or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = model.scores(_matrix(batch.column(batch.schema.get_field_index(VECTOR))).astype(float))
                kept = [batch.column(batch.schema.get_field_index(k)) for k in keep]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(scores), pa.array((scores >= least).astype(np.int32))], names=[*keep, "score", "predicted"])

    keep = [c for c in keep if c not in ("score", "predicted")]
    fields = [rows.schema[c] for c in keep] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return rows.select(*keep, VECTOR).mapInArrow(run, T.StructType(fields))


def classified(docs: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """keep's columns of docs (doc_id, text among them) with score and predicted, learned from labels (doc_id, quality)."""
    rows = materialised(vectors(docs, [*dict.fromkeys([*keep, "doc_id"])]), "vectors")
    return scored(rows, learned(rows, labels), keep)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = classified(docs.select("doc_id", "text"), labels, ["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
