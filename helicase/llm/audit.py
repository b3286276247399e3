"""Filter interaction audit: what each of five filters removes, in every order, from one histogram of failures.

Filters: A too few words, B too few different words, C too many capitals, D a symbol of code or tables, E a text that a
row of smaller doc_id holds too, anywhere in the table, removed or not.  A text's failures are a mask of five bits; a part
of the corpus is then three histograms of 32 masks: of all rows, of those labelled good, of those labelled toxic.  Stacked
as rows they are multiplied by integer matrices of 32 by 600 (120 orders of five steps), which say of a mask whether it is
kept after a step, removed there, redundant there (failing, but removed before) or fails that filter only.  So all orders
cost one pass over the texts, and what follows depends on the number of parts alone.

First rows of equal texts are found by a digest of 256 bits and joined back by digest and doc_id, so a text that a third
of all rows share is spread like any other; counts by part and mask are summed before they are shuffled.

Defined results: a null text is empty and equals other empty ones; a null lang is the empty part.  A null doc_id is smaller
than none and larger than none: such rows never fail E and never make others fail.  Rows that repeat a doc_id and text
do not fail E through each other.  A row is good or toxic if any label of its doc_id says so.  Parts that all filters
empty have their zeros.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MASKS = 1 << len(FILTERS)
# The limits of the filters.
LEAST_WORDS = 200
LEAST_DISTINCT = 50
MOST_CAPITALS = 3
WORD = "[^\\x20\\x09-\\x0D]+"
SYMBOL = "[#$%&*|]"

OUTCOMES = "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"


@lru_cache(maxsize=1)
def matrices() -> tuple[list[str], dict[str, np.ndarray], np.ndarray]:
    """The orders; by outcome the matrix of masks by order and step; and which filter stands at an order's step (600 by 5)."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    bits = np.array([[1 << FILTERS.index(f) for f in order] for order in orders])
    before = np.concatenate([np.zeros((len(orders), 1), int), np.bitwise_or.accumulate(bits, axis=1)[:, :-1]], axis=1)
    bit, before = bits.ravel()[None, :], before.ravel()[None, :]
    mask = np.arange(MASKS)[:, None]
    fails, gone = (mask & bit) > 0, (mask & before) > 0
    by_outcome = {"kept": ~fails & ~gone, "removed": fails & ~gone, "redundant": fails & gone, "unique_fails": mask == bit}
    at = bits.ravel()[:, None] == (1 << np.arange(len(FILTERS)))[None, :]
    return orders, {k: m.astype(np.int64) for k, m in by_outcome.items()}, at.astype(np.int64)


def text_mask(words: Column, text: Column) -> Column:
    """Failures of A to D as bits."""
    n = F.size(words)
    fails = (
        n < LEAST_WORDS,
        F.size(F.array_distinct(words)) * 100 < n * LEAST_DISTINCT,
        F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.char_length(text) * MOST_CAPITALS,
        text.rlike(SYMBOL),
    )
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def masked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, good, toxic of every row of docs (doc_id, text, lang)."""
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    rows = rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), text_mask(F.col("words"), F.col("text")).alias("own"))
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id IS NOT NULL").withColumn("first", F.lit(True))
    told = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(*(F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(a) for c, a in (("quality", "good"), ("toxic", "toxic"))))
    rows = rows.join(least, ["digest", "doc_id"], "left").join(told, "doc_id", "left")
    again = F.col("doc_id").isNotNull() & F.col("first").isNull()
    flags = (F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic"))
    return rows.select("part", (F.col("own") + F.when(again, 1 << FILTERS.index("E")).otherwise(0)).alias("mask"), *flags)


def _multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of OUTCOMES from rows (part, cells), cells being (mask, all, good, toxic) where there are any."""
    orders, by_outcome, at = matrices()
    steps = len(FILTERS)
    for batch in batches:
        parts, cells = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        stacked = np.zeros((len(parts), 3, MASKS), np.int64)
        for i, found in enumerate(cells):
            for c in found:
                stacked[i, :, c["mask"]] = c["n"], c["good"], c["toxic"]
        rows = stacked.reshape(-1, MASKS)
        counts = {k: (rows @ m).reshape(len(parts), 3, -1) for k, m in by_outcome.items()}
        shares = counts["removed"][:, 0] @ at
        for i, part in enumerate(parts):
            columns = [counts[k][i, 0] for k in ("kept", "removed", "redundant", "unique_fails")] + [counts["removed"][i, 1], counts["removed"][i, 2], at @ shares[i]]
            names = pa.array([part] * at.shape[0], pa.string()), pa.array(np.repeat(orders, steps).tolist(), pa.string()), pa.array(np.tile(np.arange(1, steps + 1), len(orders)), pa.int32())
            yield pa.RecordBatch.from_arrays([*names, *(pa.array(c, pa.int64()) for c in columns)], names=[c.split()[0] for c in OUTCOMES.split(", ")])


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of OUTCOMES, 600 for each part."""
    sums = (F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    cells = masked(docs, labels).groupBy("part", "mask").agg(*sums)
    return cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")).mapInArrow(_multiplied, OUTCOMES)  # 32 cells a part at most


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return audited(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic"))


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
g AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (
  SELECT w.part, coalesce(g.good, false) AS good, coalesce(g.toxic, false) AS toxic,
    (len(ws) < {LEAST_WORDS})::INT + 2 * (100 * len(list_distinct(ws)) < {LEAST_DISTINCT} * len(ws))::INT
      + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > {MOST_CAPITALS} * length(t))::INT + 8 * regexp_matches(t, '{SYMBOL}')::INT + 16 * coalesce(w.doc_id > least, false)::INT AS mask
  FROM w LEFT JOIN g ON w.doc_id = g.doc_id),
h AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS b),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND a.b | b.b | c.b | d.b | e.b = 31),
s AS (SELECT filter_order, step::INT AS step, bits[step] AS b, list_sum(list_concat([0], bits[1:step - 1]))::INT AS earlier FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (
  SELECT p.part, filter_order, step, s.b,
    coalesce(sum(n) FILTER (mask & (s.b | earlier) = 0), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (mask & s.b > 0 AND mask & earlier = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (mask & s.b > 0 AND mask & earlier > 0), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (mask = s.b), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (mask & s.b > 0 AND mask & earlier = 0), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (mask & s.b > 0 AND mask & earlier = 0), 0)::BIGINT AS toxic_lost
  FROM (SELECT DISTINCT part FROM h) p CROSS JOIN s JOIN h ON h.part = p.part GROUP BY p.part, filter_order, step, s.b)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, b))::BIGINT AS shapley FROM r
"""
