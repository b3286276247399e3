"""VCF text as DataFrames: records, header fields, samples, calls; region scans and field extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helicase.functions import genotype, text
from helicase.functions.text import identifier
from helicase.operators import intervals
from helicase.plans.filterlang import Schema, compile_filter
from helicase.sources import blockvcf
from helicase.sources.store import located


#: Compressed bytes that one task of a block-gzip file reads.
SPLIT_BYTES = 64 << 20
BLOCK_MARK = b"\x1f\x8b\x08\x04"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a VCF, plain or gzip (by suffix); a path may be a folder or a pattern.

    A single gzip file whose blocks can be read apart (bgzip) is read in ranges of SPLIT_BYTES, others as a whole.
    """
    if path.endswith((".gz", ".bgz")) and not any(c in path for c in "*?[{"):
        found, store = located(spark, path)
        if store.exists(found) and store.isFile(found):
            size = store.getFileStatus(found).getLen()
            head = _head(spark, path)
            if size > SPLIT_BYTES and head[:4] == BLOCK_MARK and b"BC\x02\x00" in head:
                return block_lines(spark, store.makeQualified(found).toString(), size)
    return spark.read.text(path)


def _head(spark: SparkSession, path: str) -> bytes:
    found, store = located(spark, path)
    stream = store.open(found)
    try:
        return bytes(stream.readNBytes(18))
    finally:
        stream.close()


def block_lines(spark: SparkSession, path: str, size: int, split: int = 0) -> DataFrame:
    """Lines (column value) of a block-gzip file, ranges of its bytes in tasks of their own.

    A range has the blocks that begin in it; the line that a range's first block begins with belongs to the range before,
    which reads on to its end.
    """
    split = split or SPLIT_BYTES
    starts = spark.range(0, max(1, -(-size // split)), 1, max(1, -(-size // split))).select((F.col("id") * split).alias("start"))
    return starts.mapInArrow(_block_reader(path, size, split), "value string")


def _block_reader(path: str, size: int, split: int):
    def run(batches):
        import re
        import zlib

        import pyarrow as pa
        from pyarrow import fs

        store, name = fs.FileSystem.from_uri(re.sub("^s3a:", "s3:", path))

        def begins(stream, at: int) -> int:
            """Where the next block begins at or after at; the file's size if there is none."""
            while at < size:
                stream.seek(at)
                data = stream.read(1 << 17)
                place = data.find(BLOCK_MARK)
                while place >= 0:
                    if len(data) < place + 18 and at + len(data) < size:
                        break
                    # the extra field of a block names its size, and after it another block or the file's end follows
                    if data[place + 12 : place + 16] == b"BC\x02\x00":
                        length = int.from_bytes(data[place + 16 : place + 18], "little") + 1
                        stream.seek(at + place + length)
                        if at + place + length == size or stream.read(4) == BLOCK_MARK:
                            return at + place
                    place = data.find(BLOCK_MARK, place + 1)
                at += max(1, len(data) - 17) if place < 0 else place
            return size

        def content(stream, at: int) -> tuple[bytes, int]:
            stream.seek(at)
            head = stream.read(18)
            length = int.from_bytes(head[16:18], "little") + 1
            return zlib.decompress(head + stream.read(length - 18), 31), at + length

        for batch in batches:
            for start in batch.column(0).to_pylist():
                with store.open_input_file(name) as stream:
                    at, stop = begins(stream, start), begins(stream, min(size, start + split))
                    if at >= stop:
                        continue
                    rest, first = b"", at > 0
                    while at < stop:
                        data, at = content(stream, at)
                        whole, _, rest = (rest + data).rpartition(b"\n")
                        if not whole and not rest.count(b"\n") and b"\n" not in rest and not _:
                            continue
                        found = whole.split(b"\n")
                        if first:
                            found, first = found[1:], False
                        if found:
                            yield pa.RecordBatch.from_arrays([pa.array([x.decode() for x in found], pa.string())], names=["value"])
                    # the last line goes on in the next range's blocks, or ends the file
                    while at < size:
                        data, at = content(stream, at)
                        line, end, _ = data.partition(b"\n")
                        rest += line
                        if end:
                            break
                    if rest and not first:
                        yield pa.RecordBatch.from_arrays([pa.array([rest.decode()], pa.string())], names=["value"])

    return run


def write_sorted(records: DataFrame, path: str, files: int | None = None) -> None:
    """Records as Parquet in order of chromosome and position, so that ranges of them are found by the files' statistics."""
    rows = records.repartitionByRange(files, "chrom", "pos") if files else records.repartitionByRange("chrom", "pos")
    rows.sortWithinPartitions("chrom", "pos").write.mode("overwrite").parquet(path)


#: Regions that a scan names one by one; beyond them it names each chromosome's first and last position.
MOST_RANGES = 200
#: Reference bases that a record is taken to have at most where a scan is narrowed; longer ones are looked up apart.
LONG_REF = 1000


def scan_regions(spark: SparkSession, path: str, regions: DataFrame) -> DataFrame:
    """Records of write_sorted()'s files that touch a region: position ranges reach the files, the join is exact."""
    rows = spark.read.parquet(path)
    spans = regions.select("chrom", "start", "end").limit(MOST_RANGES + 1).collect()
    if len(spans) > MOST_RANGES:
        spans = regions.groupBy("chrom").agg(F.min("start").alias("start"), F.max("end").alias("end")).collect()
    near = F.lit(False)
    for r in spans:
        near = near | ((F.col("chrom") == r.chrom) & (F.col("pos") > r.start - LONG_REF) & (F.col("pos") <= r.end))
    return overlapping(rows.where(near | (F.length("ref") > LONG_REF)), regions)


def count_records(spark: SparkSession, path: str) -> int:
    """Records of a VCF, its header left out."""
    return lines(spark, path).where(~F.col("value").startswith("#") & (F.col("value") != "")).count()


def parsed(raw: DataFrame) -> DataFrame:
    """Records of VCF lines (column value).  INFO becomes a map (a flag maps to the empty text); . is null."""
    f = F.split("value", "\t")

    def cell(i: int) -> Column:
        return F.nullif(F.get(f, F.lit(i)), F.lit("."))

    return raw.where(~F.col("value").startswith("#") & (F.col("value") != "")).select(
        cell(0).alias("chrom"), cell(1).try_cast("bigint").alias("pos"), cell(2).alias("id"), cell(3).alias("ref"), cell(4).alias("alt"),
        cell(5).try_cast("double").alias("qual"), cell(6).alias("filter"),
        F.when(cell(7).isNotNull(), F.transform_values(F.str_to_map(cell(7), F.lit(";"), F.lit("=")), lambda _, v: F.coalesce(v, F.lit("")))).alias("info"),
        cell(8).alias("format"), F.when(F.size(f) > 9, F.slice(f, 10, F.size(f) - 9)).otherwise(F.array().cast("array<string>")).alias("samples"),
    )


def region_lines(spark: SparkSession, path: str, regions: DataFrame | None) -> DataFrame:
    """Lines (column value) among which are all records that touch a region: those alone where an index tells, else all."""
    if regions is None or not blockvcf.has_index(spark, path):
        return lines(spark, path)
    return blockvcf.records_of(spark, path, regions).select("value")


def read_vcf(spark: SparkSession, path: str, regions: DataFrame | None = None, where: str | None = None) -> DataFrame:
    """Records of a VCF, in the given regions and meeting the prefilter, in one plan.

    Where there are regions, and an index beside the file, only the blocks of the regions are opened.
    """
    records = parsed(region_lines(spark, path, regions))
    if where:
        records = records.where(compile_filter(where, vcf_schema(records)))
    return overlapping(records, regions) if regions is not None else records


def overlapping(records: DataFrame, regions: DataFrame) -> DataFrame:
    """Records whose reference bases touch a region (0-based, half-open)."""
    span = records.withColumns({"_start": F.col("pos") - 1, "_end": F.col("pos") - 1 + F.greatest(F.length("ref"), F.lit(1))})
    kept = intervals.any_overlap(span, regions, "_start", "_end")
    return kept.drop("_start", "_end")


def vcf_schema(records: DataFrame, info: tuple[str, ...] = ()) -> Schema:
    """Fields of parsed records for filter expressions; INFO fields by INFO/X and, those named, by X."""
    scalars = {n.upper(): F.col(n) for n in ("chrom", "pos", "id", "ref", "alt", "qual", "filter")}
    found = Schema(scalars, {})

    class Info(dict):
        def __missing__(self, key: str) -> Column:
            if not key.startswith("INFO/") and key not in info:
                raise KeyError(key)
            return F.element_at("info", F.lit(key.removeprefix("INFO/")))

        def __contains__(self, key: object) -> bool:
            return dict.__contains__(self, key) or str(key).startswith("INFO/") or key in info

    found.scalars = Info(scalars)
    return found


def header_fields(raw: DataFrame) -> DataFrame:
    """source (INFO or FORMAT), id, number, type, description of the header, by source and lower-case id."""
    v = F.col("value")
    pick = lambda p: F.regexp_extract(v, p, 1)
    rows = raw.where(v.rlike("^##(INFO|FORMAT)=<")).select(
        pick("^##(INFO|FORMAT)").alias("source"), pick(r"[<,]ID=([^,>]+)").alias("id"), pick(r"[<,]Number=([^,>]+)").alias("number"),
        pick(r"[<,]Type=([^,>]+)").alias("type"), pick(r'[<,]Description="([^"]*)"').alias("description"),
    )
    return rows.orderBy("source", F.lower("id"))


def matching_fields(header: DataFrame, pattern: str | None = None, source: str | None = None) -> DataFrame:
    """Header fields of INFO or FORMAT alone, or whose id or description has the pattern, whatever its case."""
    rows = header.where(F.col("source") == source) if source else header
    if pattern:
        rows = rows.where(F.lower("id").contains(pattern.lower()) | F.lower("description").contains(pattern.lower()))
    return rows


def told_fields(header: DataFrame, as_json: bool = False) -> str:
    """Header fields for reading: JSON, or a table in columns."""
    import json

    rows = [r.asDict() for r in header.collect()]
    if as_json:
        return json.dumps(rows, indent=1)
    names = ["source", "id", "number", "type", "description"]
    width = {n: max([len(n), *(len(r[n] or "") for r in rows)]) for n in names[:-1]}
    line = lambda r: "  ".join([*((r[n] or "").ljust(width[n]) for n in names[:-1]), r["description"] or ""]).rstrip()
    return "\n".join([line({n: n.upper() for n in names}), *map(line, rows)])


def regular(raw: DataFrame, names: list[str]) -> DataFrame:
    """Lines of a delimited table (column value) as exactly these columns, in text: cells beyond them become EXTRA_0 and
    so on where any row has them, cells that a row lacks are NA, empty and . ones too."""
    f = F.split("value", "\t")
    widest = raw.agg(F.max(F.size(f))).first()[0] or 0
    names = names + [f"EXTRA_{i}" for i in range(max(0, widest - len(names)))]
    cell = lambda i: F.coalesce(text.blank_as_null(F.get(f, F.lit(i))), F.lit("NA"))
    return raw.select(*(cell(i).alias(n) for i, n in enumerate(names)))


def missing_fields(header: DataFrame, requested: list[str]) -> list[str]:
    """Requested fields that neither the header nor the record itself has."""
    fixed = {"CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER"}
    spark = header.sparkSession
    asked = [(r, r.split(".")[-1] if r.startswith("GEN[") else r.split("[")[0].split(".")[0]) for r in requested if r not in fixed]
    if not asked:
        return []
    left = spark.createDataFrame(asked, "name string, id string").join(header.select("id").distinct(), "id", "left_anti")
    return sorted(r.name for r in left.collect())


def sample_names(raw: DataFrame) -> list[str]:
    head = raw.where(F.col("value").startswith("#CHROM")).first()
    return head.value.split("\t")[9:] if head else []


def chromosome_spans(records: DataFrame) -> DataFrame:
    return records.groupBy("chrom").agg(F.min("pos").alias("start"), F.max("pos").alias("end"))


def fields(records: DataFrame, requested: list[str], samples: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Requested fields as text columns: fixed ones, ANN[0].X, NMD[0].X, GEN[*].X and GEN[i].X, others from INFO; NA if missing.

    keep: columns of records that stand before them.
    """
    at = {k: F.col(k) for k in ("info", "format", "samples")}
    out: list[Column] = []
    for name in requested:
        if name in ("CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER"):
            out.append(text.or_na(F.col(name.lower()).cast("string")).alias(name))
        elif name.startswith("ANN[0]."):
            out.append(text.ann_subfield(F.element_at("info", F.lit("ANN")), name[7:]).alias(identifier(name)))
        elif name.startswith("NMD[0]."):
            out.append(text.nmd_subfield(F.element_at("info", F.lit("NMD"))).alias(identifier(name)))
        elif name.startswith("GEN["):
            index, _, part = name[4:].partition("].")
            place = F.array_position(F.split(at["format"], ":"), part) - 1
            for i in range(len(samples)) if index == "*" else [int(index)]:
                cell = F.get(F.split(F.get(at["samples"], F.lit(i)), ":"), F.when(place >= 0, place.cast("int")))
                out.append(text.or_na(text.blank_as_null(cell) if part != "GT" else cell).alias(f"GEN_{i}__{part}"))
        else:
            out.append(text.or_na(text.blank_as_null(F.element_at("info", F.lit(name)))).alias(identifier(name)))
    return records.select(*keep, *out)


def calls(records: DataFrame, samples: list[str], gene: Column | None = None, extra: list[str] | None = None) -> DataFrame:
    """The long table variant_key, gene, sample_id, gt, dosage of carriers and missing calls; hom-ref calls have no row.

    extra names further FORMAT fields, whose values stand in the array column extra, . where there is none.
    """
    place = (F.array_position(F.split("format", ":"), "GT") - 1).cast("int")
    gene = gene if gene is not None else text.ann_subfield(F.element_at("info", F.lit("ANN")), "GENE")
    key = genotype.variant_key(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt"))
    places = F.array(*((F.array_position(F.split("format", ":"), name) - 1).cast("int") for name in extra or []))
    rows = records.select(key.alias("variant_key"), gene.alias("gene"), place.alias("place"), *([places.alias("places")] if extra else []), F.posexplode("samples").alias("i", "cell"))
    parts = F.split("cell", ":")
    more = [F.transform("places", lambda p: F.coalesce(F.get(parts, F.when(p >= 0, p)), F.lit("."))).alias("extra")] if extra else []
    rows = rows.select("variant_key", "gene", F.get(F.lit(samples), F.col("i")).alias("sample_id"), F.get(parts, F.col("place")).alias("gt"), *more)
    return rows.where(~genotype.is_ref(F.col("gt"))).withColumn("dosage", genotype.association_dosage(F.col("gt")))


def one_effect_per_row(records: DataFrame, key: str = "ANN") -> DataFrame:
    """A row per annotation entry; records with one or none stay."""
    entries = F.split(F.element_at("info", F.lit(key)), ",")
    rows = records.withColumn("_entry", F.explode_outer(entries))
    kept = F.map_filter("info", lambda k, _: k != key)
    one = F.map_from_arrays(F.array(F.lit(key)), F.array(F.col("_entry")))
    return rows.withColumn("info", F.when(F.col("_entry").isNull(), F.col("info")).otherwise(F.map_concat(kept, one))).drop("_entry")


def write_vcf_lines(records: DataFrame) -> DataFrame:
    """Records as VCF lines again (column value)."""
    dot = lambda c: F.coalesce(c.cast("string"), F.lit("."))
    info = F.array_join(F.transform(F.map_entries("info"), lambda e: F.when(e["value"] == "", e["key"]).otherwise(F.concat(e["key"], F.lit("="), e["value"]))), ";")
    fixed = [dot(F.col(c)) for c in ("chrom", "pos", "id", "ref", "alt", "qual", "filter")]
    tail = F.when(F.size("samples") > 0, F.concat(F.lit("\t"), dot(F.col("format")), F.lit("\t"), F.array_join("samples", "\t"))).otherwise("")
    return records.select(F.concat(F.concat_ws("\t", *fixed, dot(F.nullif(info, F.lit("")))), tail).alias("value"))
