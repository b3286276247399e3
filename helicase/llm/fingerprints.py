"""Document fingerprints by improved consistent weighted sampling, in DataFrame functions only.

A text is a weighted set: its five-word shingles, each with how often the text holds it times the number of code points
of its words as weight, so long and repeated shingles weigh more.  For each of SAMPLES and each term with weight w, two
gamma(2, 1) variates r, c and a uniform b, all from hashes of term and sample, give t = floor(ln w / r + b) and
ln a = ln c - r (t - b + 1); the sample is (term, t) of the least a.  Two texts agree in a sample with the probability of
their generalised Jaccard similarity (sum of the smaller weights over sum of the larger).  Gamma variates are quantiles:
interpolated in a table, and in the tails, where the least a of long texts come from, computed.

Every term becomes one row only inside a task: terms are exploded, counted and reduced by hash aggregates on a key that
the rows are already partitioned by.  A document and its edited text share the terms of their common front, so terms
that both hold equally often are sampled once: terms are reduced by class (own only, common, edited only), classes are
combined afterwards.

The next document is found without a global sort: document numbers are cut at quantiles into buckets (a driver list
bounded by MOST_BUCKETS), a number that holds several quantiles is cut further by a hash of the text, the first rows of
each bucket stand in the bucket before as well, and one exchange by bucket serves the window, the aggregates and the
second window.

Defined results: a null text is empty.  A text of fewer than five words is one term; one without words has no term,
and two such texts are alike (1.0), with any other 0.0.  Null doc_ids sort first; rows with one doc_id go by a hash of
their text.  Repeated rows are documents like any other (they alone share a bucket however many they are).  One document
is its own next.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable
from functools import lru_cache
from itertools import accumulate, pairwise

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SAMPLES = 64
SHINGLE = 5
TABLE_BITS = 12
#: Samples that are computed in one row.
BLOCK = 16
TABLES = ("re", "rd", "ce", "cd")
#: A shingle of more code points weighs as one of these; they are the lower bits of a term, a hash its upper ones.
MOST_LENGTH = (1 << 16) - 1
#: Cells of the table at its low end in which c is computed.
LOW_CELLS = 16
MOST_BUCKETS = 65_536
#: Rows that a bucket of document numbers should hold at most.
BUCKET_ROWS = 20_000

SPACES = "[\\x20\\x09-\\x0D]+"
LEAST = -(1 << 63)


@lru_cache(maxsize=2)
def gamma2_quantiles(bits: int) -> tuple[float, ...]:
    """Quantiles of the gamma(2, 1) distribution, 1 - (1 + x) exp(-x), at i / 2**bits; the last cell ends at a large value."""
    out, x = [0.0], 0.0
    for i in range(1, 1 << bits):
        p = i / (1 << bits)
        lo, hi = x, 40.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if 1 - (1 + mid) * math.exp(-mid) < p else (lo, mid)
        x = lo
        out.append((lo + hi) / 2)
    return (*out, 2 * out[-1])


def words(text: Column) -> Column:
    """The words of a text; null for one without words."""
    bare = F.regexp_replace(text, f"^{SPACES}", "")
    return F.when(bare != "", F.split(bare, SPACES))


def listed(values: Iterable[float], kind: str) -> Column:
    """A constant array; one string crosses to the JVM, where the plan folds it, instead of a call for each value."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def tables(there: Column) -> list[Column]:
    """Columns re, rd, ce, cd: lower ends of the cells of r and ln c, and their widths.

    They ride along as columns (a reference in generated code): as literals each use would be shipped apart.
    """
    ends = gamma2_quantiles(TABLE_BITS)
    logs = [-100.0, *map(math.log, ends[1:])]
    made = {"re": ends[:-1], "rd": [b - a for a, b in pairwise(ends)], "ce": logs[:-1], "cd": [b - a for a, b in pairwise(logs)]}
    return [F.when(there, listed(v, "double")).alias(n) for n, v in made.items()]


def packed_sample(term: Column, log_weight: Column, k: Column) -> Column:
    """ln a in the upper bits (so min() takes the least), a code of (term, t) in the lower 32; needs the columns of tables().

    Of a hash's bits two TABLE_BITS choose cells, 20 are b, ten and ten the places inside the cells.  In the last cell r
    is the cell's end x, an exponential variate and, with probability 1 / (1 + x), another one, which is its law there;
    in the first LOW_CELLS ln c is ln s + s / 3 with s = sqrt(2 p), short of the quantile at p by less than 0.001.
    """
    size = (1 << TABLE_BITS) - 1
    last = gamma2_quantiles(TABLE_BITS)[-2]
    h = F.xxhash64(term, k)

    def bits(x: Column, at: int, n: int) -> Column:
        return F.shiftrightunsigned(x, at).bitwiseAND(F.lit((1 << n) - 1))

    def part(x: Column, at: int, n: int) -> Column:
        return (bits(x, at, n).cast("double") + F.lit(0.5)) * F.lit(2.0**-n)

    ri, ci = bits(h, 0, TABLE_BITS).cast("int"), bits(h, TABLE_BITS, TABLE_BITS).cast("int")
    more = F.xxhash64(term, k, F.lit(1))
    beyond = F.lit(last) - F.ln(part(more, 0, 32) * F.least(part(more, 32, 32) * F.lit(1.0 + last), F.lit(1.0)))
    r = F.when(ri == size, beyond).otherwise(F.get("re", ri) + F.get("rd", ri) * part(h, 44, 10))
    s = F.sqrt((ci.cast("double") + part(F.xxhash64(term, k, F.lit(2)), 12, 52)) * F.lit(2.0 ** (1 - TABLE_BITS)))
    log_c = F.when(ci < LOW_CELLS, F.ln(s) + s * F.lit(1.0 / 3.0)).otherwise(F.get("ce", ci) + F.get("cd", ci) * part(h, 54, 10))
    b = bits(h, 2 * TABLE_BITS, 20).cast("double") * F.lit(2.0**-20)
    t = F.floor(log_weight / r + b)
    log_a = log_c - r * (t - b + F.lit(1.0))
    # the least a of 2**40 terms of weight 2**40 is about exp(-56), and ln c - r (t - b + 1) is at most ln c
    rank = ((F.greatest(log_a, F.lit(-100.0)) + F.lit(101.0)) * F.lit(float(1 << 23))).cast("bigint")
    code = F.shiftrightunsigned(term, 16).bitwiseXOR(F.shiftleft(t, 7)).bitwiseAND(F.lit((1 << 32) - 1))
    return F.shiftleft(rank, 32).bitwiseOR(code)


def at_most(key: Column, bounds: list[int], df: DataFrame, name: str) -> DataFrame:
    """df with, in column name, how many of the ascending bounds are at most key: a binary search in steps."""
    depth = max(1, len(bounds).bit_length())
    table = listed(bounds + [(1 << 63) - 1] * ((1 << depth) - 1 - len(bounds)), "bigint")
    df = df.withColumn(name, F.lit(0))
    for step in reversed(range(depth)):
        half = 1 << step
        reached = key >= F.get(table, F.col(name) + F.lit(half - 1))
        df = df.withColumn(name, F.col(name) + F.when(reached, F.lit(half)).otherwise(F.lit(0)))
    return df


def with_next(docs: DataFrame) -> DataFrame:
    """bucket, row, ghost, doc_id, text, next_text: every document with the text of the next by doc_id.

    Rows with ghost stand for the first documents of the following bucket, under no doc_id that counts; the caller drops
    them at the end.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = docs.withColumns({"key": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LEAST)), "hash": F.shiftrightunsigned(F.xxhash64("text"), 1)})
    spark = docs.sparkSession
    n = keyed.count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = 1 << max(6, min(MOST_BUCKETS, max(8 * parts, n // BUCKET_ROWS)) - 1).bit_length()
    buckets = min(buckets, MOST_BUCKETS)
    shares = [i / buckets for i in range(1, buckets)]
    times = Counter(int(x) for x in keyed.approxQuantile("key", shares, 1 / (4 * buckets))) if n else Counter()
    bounds = sorted(times)
    # numbers at which several quantiles lie have buckets of their own, by hash, and then one for what follows them
    cuts = [0] + [times[x] if times[x] > 1 else 0 for x in bounds]
    offsets = list(accumulate((c + 1 for c in cuts), initial=0))
    keyed = at_most(F.col("key"), bounds, keyed, "place")
    cut = F.get(listed(cuts, "int"), F.col("place"))
    hot = (cut > 0) & (F.col("key") == F.get(listed([LEAST, *bounds], "bigint"), F.col("place")))
    by_hash = F.least(F.floor(F.col("hash").cast("double") * F.lit(2.0**-63) * cut), cut - 1)
    keyed = keyed.withColumn("bucket", (F.get(listed(offsets, "int"), F.col("place")) + F.when(hot, by_hash).otherwise(cut)).cast("int"))
    firsts = {r.bucket: tuple(r.f) for r in keyed.groupBy("bucket").agg(F.min(F.struct("key", "hash")).alias("f")).collect()}
    there = sorted(firsts)
    before = {b: there[i - 1] for i, b in enumerate(there)}
    nowhere = ((1 << 63) - 1, -1)
    first_key, first_hash = (listed([firsts.get(b, nowhere)[i] for b in range(offsets[-1])], "bigint") for i in (0, 1))
    target = listed([before.get(b, 0) for b in range(offsets[-1])], "int")
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("ghost"))
    again = F.struct(F.get(target, F.col("bucket")).alias("bucket"), F.lit(True).alias("ghost"))
    is_first = (F.col("key") == F.get(first_key, F.col("bucket"))) & (F.col("hash") == F.get(first_hash, F.col("bucket")))
    # only these columns are exchanged, whatever a reader of the result needs, so that all readers share one exchange
    placed = keyed.select("key", "hash", F.col("doc_id").isNotNull().alias("known"), "text", F.inline(F.when(is_first, F.array(own, again)).otherwise(F.array(own))))
    last = F.when(F.col("ghost"), F.lit((1 << 63) - 1)).otherwise(F.col("key"))
    placed = placed.select("bucket", last.alias("sort_key"), (F.col("known").cast("int") * 2 + F.col("ghost").cast("int")).alias("flag"), "hash", "text")
    # a named number of tasks, which grows with the rows: sampling costs far more than the bytes let expect
    placed = placed.repartition(max(parts, buckets // 8), "bucket")
    order = Window.partitionBy("bucket").orderBy("sort_key", "flag", "hash", "text")
    doc_id = F.when(F.col("flag") >= 2, F.col("sort_key")).cast(docs.schema["doc_id"].dataType)
    return placed.select(
        "bucket", F.row_number().over(order).alias("row"), (F.col("flag") % 2 == 1).alias("ghost"), doc_id.alias("doc_id"), "text", F.coalesce(F.lead("text").over(order), F.lit("")).alias("next_text")
    )


def fingerprints(pairs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Of rows with bucket, row (a number inside the bucket), text, edited and front (the common front, whose last word may
    go on differently): bucket, row and the signatures of text and edited as arrays a and b of codes (null: no term)."""
    whole = F.coalesce(F.size(words(F.col("front"))), F.lit(0)) - 1
    rows = pairs.select("bucket", "row", words(F.col("text")).alias("w"), words(F.col("edited")).alias("e"), whole.alias("whole"))
    # a trailing empty word comes from white space at the end
    n_w, n_e = (F.coalesce(F.size(c) - F.when(F.get(c, F.size(c) - 1) == "", 1).otherwise(0), F.lit(0)) for c in (F.col("w"), F.col("e")))
    rows = rows.withColumns({"nw": n_w, "ne": n_e, "whole": F.greatest("whole", F.lit(0))})
    last_w, last_e = F.greatest(F.col("nw") - SHINGLE, F.lit(0)), F.greatest(F.col("ne") - SHINGLE, F.lit(0))
    start_e = F.greatest(F.col("whole") - SHINGLE + 1, F.lit(0))
    none = F.array().cast("array<int>")
    starts = F.concat(
        F.when(F.col("nw") > 0, F.sequence(F.lit(0), last_w)).otherwise(none),
        F.when((F.col("ne") > 0) & (last_e >= start_e), F.sequence(-1 - last_e, -1 - start_e)).otherwise(none),
    )
    rows = rows.select("bucket", "row", "w", "e", "nw", "ne", "whole", starts.alias("starts"))
    rows = rows.select("bucket", "row", "w", "e", "nw", "ne", "whole", F.explode_outer("starts").alias("i"))

    def at(j: int) -> Column:
        in_w, in_e = F.col("i") + F.lit(j), F.lit(-1 + j) - F.col("i")
        return F.when(F.col("i") >= 0, F.when(in_w < F.col("nw"), F.get("w", in_w))).otherwise(F.when(in_e < F.col("ne"), F.get("e", in_e)))

    rows = rows.select("bucket", "row", "whole", "i", *(at(j).alias(f"t{j}") for j in range(SHINGLE)))
    parts = [F.col(f"t{j}") for j in range(SHINGLE)]
    length = sum((F.coalesce(F.length(p), F.lit(0)) for p in parts[1:]), F.length(parts[0]))
    # the rows to count are many, so they are small: a term carries its length, the two counts share a number
    term = F.xxhash64(*parts).bitwiseAND(F.lit(~MOST_LENGTH)).bitwiseOR(F.least(length, F.lit(MOST_LENGTH)).cast("bigint"))
    in_text, in_edited = F.col("i").isNull() | (F.col("i") >= 0), (F.col("i") < 0) | (F.col("i") + F.lit(SHINGLE) <= F.col("whole"))
    held = F.when(in_text, F.lit(1)).otherwise(F.lit(0)) + F.when(in_edited, F.lit(1 << 32)).otherwise(F.lit(0))
    rows = rows.select("bucket", "row", F.when(F.col("i").isNotNull(), term).alias("term"), held.alias("held"))
    rows = rows.groupBy("bucket", "row", "term").agg(F.sum("held").alias("held"))
    rows = rows.select("bucket", "row", "term", F.col("held").bitwiseAND(F.lit((1 << 32) - 1)).alias("na"), F.shiftrightunsigned("held", 32).alias("nb"))
    way = lambda kind, times: F.struct(F.lit(kind).alias("kind"), F.col(times).alias("times"))
    ways = F.when(F.col("na") == F.col("nb"), F.array(way(1, "na"))).when(F.col("nb") == 0, F.array(way(0, "na"))).when(F.col("na") == 0, F.array(way(2, "nb")))
    there = F.col("bucket").isNotNull() & (F.col("bucket") >= 0)
    rows = rows.select("bucket", "row", "term", *tables(there), ways.otherwise(F.array(way(0, "na"), way(2, "nb"))).alias("ways"))
    rows = rows.select("bucket", "row", "term", *TABLES, F.inline("ways"))
    # a term becomes a row for each block of samples, so that expressions are planned and compiled for one block only
    weight = F.ln((F.col("term").bitwiseAND(F.lit(MOST_LENGTH)) * F.col("times")).cast("double")).alias("lw")
    rows = rows.select("bucket", "row", "kind", "term", *TABLES, weight, F.explode(F.sequence(F.lit(0), F.lit(samples // BLOCK - 1))).alias("block"))
    least = [F.min(packed_sample(F.col("term"), F.col("lw"), F.col("block") * BLOCK + F.lit(j))).alias(f"m{j}") for j in range(BLOCK)]
    by_kind = rows.groupBy("bucket", "row", "kind", "block").agg(*least)
    code = F.lit((1 << 32) - 1)
    both = [F.min(F.when(of, F.col(f"m{j}"))).bitwiseAND(code).alias(f"{c}{j}") for c, of in (("a", F.col("kind") <= 1), ("b", F.col("kind") >= 1)) for j in range(BLOCK)]
    by_block = by_kind.groupBy("bucket", "row", "block").agg(*both)
    block = F.struct("block", *(F.array(*(F.col(f"{c}{j}") for j in range(BLOCK))).alias(c) for c in "ab"))
    found = by_block.groupBy("bucket", "row").agg(F.array_sort(F.collect_list(block)).alias("blocks"))
    return found.select("bucket", "row", *(F.flatten(F.col("blocks")[c]).alias(c) for c in "ab"))


def likeness(x: Column, y: Column, samples: int = SAMPLES) -> Column:
    return F.size(F.filter(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), lambda z: z)) / F.lit(float(samples))


def as_text(codes: Column) -> Column:
    return F.array_join(F.transform(codes, lambda x: F.coalesce(F.lpad(F.lower(F.hex(x)), 8, "0"), F.lit("--------"))), "")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    rows = rows.withColumn("n_chars", F.length("text").cast("bigint"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    rows = rows.withColumn("front", F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - cut))
    rows = rows.withColumn("edited", F.concat(F.col("front"), F.substring(F.col("next_text"), F.lit(1), cut)))
    found = fingerprints(rows).withColumn("next", F.lead("a").over(Window.partitionBy("bucket").orderBy("row")))
    found = found.select(
        "bucket", "row", as_text(F.col("a")).alias("fingerprint"), as_text(F.col("b")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b")).alias("near_edited"), likeness(F.col("a"), F.col("next")).alias("near_next"),
    )
    # the documents' own columns join what their terms gave: narrow rows on both sides
    own = rows.where(~F.col("ghost")).select("bucket", "row", "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    return own.hint("merge").join(found, ["bucket", "row"]).drop("bucket", "row")
