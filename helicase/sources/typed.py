"""Records stored with typed INFO fields, so that filters reach the files' statistics.

A store is a folder of Parquet beside the header's lines.  Beside the columns of parsed records each INFO field has

* number_...  the whole value as a number (fields of Type Integer or Float; null if it is none, as a list is not),
* first_...   the first of several values as a number,
* list_...    all of them, typed (Number other than 0 and 1),
* text_...    the whole value (other types), or whether a flag stands,
* has_..., has_first_...  whether there is a value, and a first one: not null, empty, . or NA.

The map of INFO stays beside them, so values that do not fit their type are not lost; a scan that does not ask for it does
not read it.  Files are ranges of chromosome and position; inside a file, rows lie by the order of magnitude of a
frequency, so that row groups of common records are left out by a filter for rare ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helicase.functions.text import identifier
from helicase.plans.filterlang import Schema
from helicase.sources.store import exists, located, put_text

NUMBERS = {"Integer": "bigint", "Float": "double"}
#: Uncompressed bytes of a row group: small enough that a group holds one order of magnitude of a frequency.
ROW_GROUP = 16 << 20
HEADER = "_header.vcf"


def _names(header: DataFrame) -> list[tuple[str, str, str, str]]:
    """id, number, type and the ending of its columns, by the header's INFO fields; an id that differs from another only by
    signs a column cannot have gets a number."""
    out, seen = [], {}
    for r in header.where("source = 'INFO'").select("id", "number", "type").distinct().orderBy("id").collect():
        told = identifier(r.id).lower()
        seen[told] = seen.get(told, -1) + 1
        out.append((r.id, r.number, r.type, identifier(r.id) + (f"_{seen[told]}" if seen[told] else "")))
    return out


def _there(c: Column) -> Column:
    return c.isNotNull() & ~c.isin(".", "", "NA")


def typed(records: DataFrame, header: DataFrame) -> DataFrame:
    """Parsed records with the columns of their INFO fields."""
    made: dict[str, Column] = {}
    for name, number, kind, end in _names(header):
        value = F.element_at("info", F.lit(name))
        parts = F.split(value, ",")
        made[f"has_{end}"], made[f"has_first_{end}"] = _there(value), _there(F.get(parts, F.lit(0))) & value.isNotNull()
        if kind in NUMBERS:
            # comparisons are those of floating-point numbers, whatever the type; lists keep it
            made[f"number_{end}"], made[f"first_{end}"] = value.try_cast("double"), F.get(parts, F.lit(0)).try_cast("double")
            if number != "1":
                made[f"list_{end}"] = parts.try_cast(f"array<{NUMBERS[kind]}>")
        elif kind == "Flag":
            made[f"text_{end}"] = F.coalesce(F.map_contains_key("info", F.lit(name)), F.lit(False))
        else:
            made[f"text_{end}"] = value
            if number != "1":
                made[f"list_{end}"] = parts
    return records.withColumns({k: F.coalesce(c, F.lit(False)) if k.startswith("has_") else c for k, c in made.items()}) if made else records


def write_store(records: DataFrame, header: DataFrame, head: list[str], path: str, by: str | None = "AF", files: int | None = None, row_group: int = ROW_GROUP) -> str:
    """Parsed records as a store; by names the frequency that orders a file's rows (left out where the header has none)."""
    spark = records.sparkSession
    ends = {name: end for name, _, kind, end in _names(header) if kind in NUMBERS}
    rows = typed(records, header)
    rows = rows.repartitionByRange(files, "chrom", "pos") if files else rows.repartitionByRange("chrom", "pos")
    order: list[Column] = []
    if by in ends:
        first = F.col(f"first_{ends[by]}")
        # no value, zero, then one order of magnitude after another
        order.append(F.when(first > 0, F.floor(F.log10(first))).when(first.isNotNull(), F.lit(-400)).asc_nulls_first())
    out = rows.sortWithinPartitions(*order, "chrom", "pos").write.mode("overwrite").option("parquet.block.size", row_group)
    out.option("parquet.bloom.filter.enabled#id", "true").parquet(path)
    put_text(spark, f"{path.rstrip('/')}/{HEADER}", "\n".join(head) + "\n")
    return path


def is_store(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path.rstrip('/')}/{HEADER}")


def header_lines(spark: SparkSession, path: str) -> DataFrame:
    """The header's lines (column value), as lines of a VCF have them."""
    # Spark's own readers pass over names with this first letter, which keeps the header out of the table
    found, store = located(spark, f"{path.rstrip('/')}/{HEADER}")
    stream = store.open(found)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return spark.createDataFrame([(x,) for x in text.split("\n") if x], "value string")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    found, store = located(spark, path)
    return spark.read.parquet(store.makeQualified(found).toString())


def records_of(rows: DataFrame) -> DataFrame:
    """The columns of parsed records alone."""
    return rows.select("chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "format", "samples")


def stored_schema(schema: Schema, header: DataFrame) -> Schema:
    """A schema of parsed records whose comparisons with numbers, texts and nothing look at the store's columns."""
    out = Schema(schema.scalars, schema.arrays, {"POS": F.col("pos").cast("double"), "QUAL": F.col("qual")}, {}, {n: F.col(n.lower()) for n in ("CHROM", "ID", "REF", "ALT", "FILTER")})
    for name, _, kind, end in _names(header):
        for told in (name, f"INFO/{name}"):
            out.presence[told] = F.col(f"has_{end}")
            if kind in NUMBERS:
                out.numbers[told] = F.col(f"number_{end}")
            elif kind != "Flag":
                out.texts[told] = F.col(f"text_{end}")
        # one value of several; FORMAT fields and parts of annotations are asked for otherwise
        if (name, None) in out.arrays:
            out.presence[f"{name}[0]"] = F.col(f"has_first_{end}")
            if kind in NUMBERS:
                out.numbers[f"{name}[0]"] = F.col(f"first_{end}")
    return out
