"""Writers: tables as TSV, JSON reports, pseudonym maps, archives.  Targets are paths or URIs that Spark opens."""

from __future__ import annotations

import gzip
import json
import os
import sys
import tarfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helicase.sources.store import located, put_file, put_text


def _shown(df: DataFrame, names: dict[str, str] | None) -> DataFrame:
    """df as text without internal columns (leading _), under the names' old spelling, nulls as NA."""
    back = {v: k for k, v in (names or {}).items()}
    return df.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NA")).alias(back.get(c, c)) for c in df.columns if not c.startswith("_")))


def write_tsv(df: DataFrame, path: str, names: dict[str, str] | None = None, compression: str | None = None) -> None:
    """A folder of TSV parts; internal columns (leading _) go, names get their old spelling back, nulls are NA."""
    _shown(df, names).write.mode("overwrite").csv(path, sep="\t", header=True, quote="", compression=compression or "none")


def _lines(df: DataFrame) -> Iterator[str]:
    yield "\t".join(df.columns) + "\n"
    for row in df.toLocalIterator():
        yield "\t".join(v.replace("\t", " ").replace("\n", " ") for v in row) + "\n"


def write_one_tsv(df: DataFrame, target: str, names: dict[str, str] | None = None) -> str:
    """The same as one file (gzip if its name ends so) or, for -, to the standard output; rows pass the driver one partition
    at a time, so large tables are better written as a folder."""
    shown = _shown(df, names)
    if target == "-":
        sys.stdout.writelines(_lines(shown))
        return target

    def write(local: str) -> None:
        with gzip.open(local, "wt", encoding="utf-8") if target.endswith(".gz") else open(local, "w", encoding="utf-8") as f:
            f.writelines(_lines(shown))

    return put_file(df.sparkSession, target, write)


def write_report_json(variants: DataFrame, summary: DataFrame, folder: str) -> None:
    """variants as JSON lines, the summary's one row as summary.json."""
    variants.write.mode("overwrite").json(f"{folder}/variants")
    put_text(variants.sparkSession, f"{folder}/summary.json", json.dumps(summary.first().asDict(recursive=True), indent=1, default=str))


def write_metadata(spark: SparkSession, folder: str, values: dict[str, str]) -> None:
    """metadata.tsv with Parameter and Value; white space in values is one blank."""
    clean = {str(k): " ".join(str(v).split()) for k, v in values.items()}
    put_text(spark, f"{folder}/metadata.tsv", "".join(f"{k}\t{v}\n" for k, v in [("Parameter", "Value"), *clean.items()]))


def write_archive(spark: SparkSession, folder: str, target: str) -> str:
    """A folder's files as one tar archive."""
    root, store = located(spark, folder)
    base = store.makeQualified(root).toString().rstrip("/")

    def write(local: str) -> None:
        with tarfile.open(local, "w:gz") as tar:
            files = store.listFiles(root, True)
            while files.hasNext():
                status = files.next()
                name = status.getPath().toString().removeprefix(base).lstrip("/")
                copy = f"{local}.member"
                store.copyToLocalFile(False, status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(f"file://{copy}"), True)
                tar.add(copy, arcname=f"{os.path.basename(base)}/{name}")
                os.remove(copy)

    return put_file(spark, target, write)


def write_pm5_lookup(lookup: DataFrame, path: str) -> None:
    """key, entries: one JSON object a line, gzip."""
    entry = F.struct("ref_aa", "alt_aa", "clnsig", "review")
    rows = lookup.groupBy(F.concat_ws(":", "gene", "aa_pos").alias("key")).agg(F.array_sort(F.collect_set(entry)).alias("entries"))
    rows.write.mode("overwrite").json(path, compression="gzip")


def write_pseudonyms(names: DataFrame, target: str, schema: str, pattern: str = "") -> None:
    """original_id and pseudonym as one TSV file, and beside it what made them."""
    rows = names.select(F.col("sample_id").alias("original_id"), F.col("pseudonym").alias("pseudonym_id")).orderBy("original_id")
    write_one_tsv(rows, target)
    put_text(names.sparkSession, f"{target}.meta.json", json.dumps({"schema": schema, "pattern": pattern, "total_samples": names.count()}, indent=1))
