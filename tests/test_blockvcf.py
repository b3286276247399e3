"""Indexed block-gzip VCFs: the blocks that a scan opens, its rows against a search of all, both kinds of index."""

import gzip
import hashlib
import io
import random
import struct

import pytest
from pyspark.sql import functions as F

from helicase.sources import blockvcf, vcf
from test_analysis import HEAD, line

SIZE = 1 << 29
NOISE = lambda i: "".join(hashlib.sha512(f"{i} {k}".encode()).hexdigest() for k in range(5))


def made(n=4000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        ref = "A" * rnd.choice([1, 1, 1, 4, 40_000 if i % 500 == 0 else 2])
        rows.append((rnd.choice(["chr1", "chr2", "chrX"]), rnd.choice([rnd.randrange(1, 200_000), rnd.randrange(1, 90_000_000)]), ref, "." if i % 3 else "PASS", i % 90))
    return rows


def text_of(rows):
    return ["\t".join([c, str(p), f"v{i}", ref, "G", str(q), told, f"AF=0.1;N={NOISE(i)}", "GT", "0/1"]) for i, (c, p, ref, told, q) in enumerate(rows)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("blocks") / "cohort")
    told = blockvcf.write_indexed(spark.createDataFrame([(t,) for t in text_of(made())], "value string"), HEAD.strip().split("\n"), path, 3)
    assert told.agg(F.sum("records")).first()[0] == 4000
    return path


def touched(rows, regions):
    return sorted(f"v{i}" for i, (c, p, ref, *_) in enumerate(rows) if any(c.removeprefix("chr") == r[0].removeprefix("chr") and p - 1 < r[2] and r[1] < p - 1 + len(ref) for r in regions))


REGIONS = [
    [("1", 1000, 9000)], [("chr2", 0, 1), ("X", 150_000, 150_001)], [("1", 0, SIZE)], [("2", 16_383, 16_385), ("2", 16_384, 40_000), ("2", 30_000, 60_000)], [("7", 0, 100)],
    [("1", 80_000_000, 90_000_000), ("X", 0, 50_000)], [("1", 100_000_000, SIZE)],
]


@pytest.mark.parametrize("regions", REGIONS)
def test_scan_equals_search_of_all(spark, folder, regions):
    table = spark.createDataFrame(regions, "chrom string, start bigint, end bigint")
    found = blockvcf.records_of(spark, folder, table)
    assert sorted(r.id for r in vcf.parsed(found.select("value")).select("id").collect()) == touched(made(), regions)


def test_whole_files_are_read_without_regions(spark, folder):
    assert sorted(r.value for r in blockvcf.records_of(spark, folder).select("value").collect()) == sorted(text_of(made()))
    files = blockvcf.parts_of(folder)
    assert len(files) == 3
    # any reader of gzip can read them, header and all
    with gzip.open(files[0], "rt") as f:
        assert f.readline().startswith("##fileformat")


def test_two_regions_open_the_blocks_of_two_regions(folder):
    regions = [("1", 20_000_000, 20_200_000), ("2", 60_000_000, 60_200_000)]
    opened, every = set(), 0
    rows = 0
    reader = blockvcf.Reader(folder, regions, 1 << 20)
    for path in blockvcf.parts_of(folder):
        with open(path, "rb") as stream:
            seen = []
            list(blockvcf.lines_between(stream, 0, 1 << 62, seen))
            every += len(seen)
            for begin, end in reader.chunks(blockvcf.index_of(path)):
                seen = []
                rows += sum(1 for _ in blockvcf.lines_between(stream, begin, end, seen))
                opened |= {(path, s) for s in seen}
    assert every > 10 and 0 < len(opened) <= 4
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == len(touched(made(), regions)) <= rows < 4000


@pytest.mark.parametrize("split", [1, 5000, 1 << 30])
def test_tasks_share_no_line(folder, split):
    reader = blockvcf.Reader(folder, None, split)
    parts = reader.partitions()
    assert (len(parts) > 10) == (split <= 5000)
    found = [v for p in parts for b in reader.read(p) for v in b.column("value").to_pylist()]
    assert sorted(found) == sorted(text_of(made()))


def test_filters_reach_the_source(spark, folder):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        rows = blockvcf.records_of(spark, folder).where("chrom = 'chr1' and pos between 1000 and 90000 and filter = 'PASS' and qual >= 40")
        expected = sorted(t for t, (c, p, _, told, q) in zip(text_of(made()), made()) if c == "chr1" and 1000 <= p <= 90_000 and told == "PASS" and q >= 40)
        assert sorted(r.value for r in rows.collect()) == expected and expected
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    reader = blockvcf.FilteringReader(folder, None, 1 << 20)
    from pyspark.sql.datasource import EqualTo, GreaterThan, LessThanOrEqual

    told = [EqualTo(("chrom",), "chr1"), GreaterThan(("pos",), 999), LessThanOrEqual(("pos",), 90_000), EqualTo(("filter",), "PASS")]
    assert list(reader.pushFilters(told)) == told
    size = lambda r: sum(e - b for p in r.partitions() for b, e in p.chunks)
    assert size(reader) < size(blockvcf.Reader(folder, None, 1 << 20)) / 3


def test_both_kinds_of_index(folder):
    """The same chunks from a .csi of a deeper tree, made here from the file's lines."""
    path = blockvcf.parts_of(folder)[0]
    tbi = blockvcf.index_of(path)
    assert blockvcf.read_index(blockvcf.told_index(tbi)) == tbi
    out = [b"CSI\1", struct.pack("<3i", 14, 6, 28 + 5)]
    name = next(iter(tbi.contigs))
    names = name.encode() + b"\0"
    out += [struct.pack("<7i", 2, 1, 2, 0, 35, 0, len(names)), names, struct.pack("<i", 1)]
    first = ((1 << 18) - 1) // 7
    contig = tbi.contigs[name]
    bins = {first + (n - 4681): c for n, c in contig.bins.items() if n >= 4681}
    out.append(struct.pack("<i", len(bins)))
    for n, chunks in bins.items():
        out.append(struct.pack(f"<IQi{2 * len(chunks)}Q", n, chunks[0][0], len(chunks), *(x for c in chunks for x in c)))
    raw = b"".join(out)
    csi = blockvcf.read_index(blockvcf.block(raw[:60_000]) + blockvcf.block(raw[60_000:]) + blockvcf.LAST_BLOCK if len(raw) > 60_000 else gzip.compress(raw))
    assert csi.depth == 6 and list(csi.contigs) == [name]
    low = [c for c in csi.chunks(name, 50_000, 60_000)]
    assert low and all(any(b <= x[0] and x[1] <= e for b, e in tbi.chunks(name, 50_000, 60_000)) for x in low)


def test_faults_and_empty_files(spark, tmp_path):
    with pytest.raises(ValueError, match="neither"):
        blockvcf.read_index(gzip.compress(b"none of them"))
    (tmp_path / "a.vcf.gz").write_bytes(blockvcf.block(b"#x\n") + blockvcf.LAST_BLOCK)
    with pytest.raises(FileNotFoundError, match="no index"):
        blockvcf.index_of(str(tmp_path / "a.vcf.gz"))
    path = str(tmp_path / "empty")
    blockvcf.write_indexed(spark.createDataFrame([], "value string"), ["#CHROM"], path)
    assert blockvcf.records_of(spark, path).count() == 0
    far = spark.createDataFrame([("1\t999999999\t.\tA\tG\t.\t.\t.",)], "value string")
    with pytest.raises(Exception, match="beyond what a .tbi"):
        blockvcf.write_indexed(far, [], str(tmp_path / "far"))


def test_long_lines_and_incompressible_text():
    rnd = random.Random(5)
    lines = ["1\t" + str(i + 1) + "\t.\tA\tG\t.\t.\t" + "".join(chr(rnd.randrange(33, 0x3000)) for _ in range(rnd.choice([0, 10, 120_000]))) for i in range(12)]
    out = io.BytesIO()
    writer = blockvcf._Writer(out)
    for text in lines:
        writer.record(text)
    writer.close()
    chunks = writer.index.chunks("1", 0, SIZE)
    found = [r.decode() for b, e in chunks for _, r in blockvcf.lines_between(out, b, e)]
    assert found == lines
    cut = blockvcf.cut(chunks, writer.index.starts(), 1)
    assert [r.decode() for g in cut for b, e in g for _, r in blockvcf.lines_between(out, b, e)] == lines


def test_run_reads_through_the_index(spark, tmp_path):
    from helicase.plans import analysis

    text = HEAD + line(100, 0.001, "HIGH", "G1", "0/1", "0/0", "0/0") + line(90_000, 0.001, "HIGH", "G2", "0/1", "0/0", "0/0")
    out = io.BytesIO()
    writer = blockvcf._Writer(out)
    for row in text.strip().split("\n"):
        writer.text(row.encode() + b"\n") if row.startswith("#") else writer.record(row)
    writer.close()
    (tmp_path / "a.vcf.gz").write_bytes(out.getvalue())
    (tmp_path / "a.vcf.gz.tbi").write_bytes(blockvcf.told_index(writer.index))
    chrom = text.strip().split("\n")[-1].split("\t")[0]
    (tmp_path / "genes.bed").write_text(f"{chrom}\t50\t200\tG1\n")
    rows = vcf.region_lines(spark, str(tmp_path / "a.vcf.gz"), spark.createDataFrame([(chrom, 50, 200)], "chrom string, start bigint, end bigint"))
    assert "block_vcf" in rows._jdf.queryExecution().toString() and rows.count() == 1
    found = analysis.analyse(spark, analysis.Settings(vcf=str(tmp_path / "a.vcf.gz"), genes="G1", gene_regions=str(tmp_path / "genes.bed")))
    assert [r.gene for r in found.variants.collect()] == ["G1"]
