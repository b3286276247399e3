"""Block-gzip VCFs with an index: a data source that opens only the blocks of its regions, and a writer of such files.

A file a.vcf.gz has its index beside it, a.vcf.gz.tbi or a.vcf.gz.csi.  An index tells, by bin of a tree of intervals, the
virtual offsets between which the bin's records lie; a virtual offset is a block's place in the file times 65,536 plus a
place in the block's text.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

#: Compressed bytes that one task reads; longer chunks are cut where the index knows a record's start.
SPLIT_BYTES = 64 << 20
#: Text of one block that the writer makes; a block holds at most 65,536 bytes, compressed or not.
BLOCK_TEXT = 65_280
#: The empty block that ends a file.  Fixed value of the format.
LAST_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
#: Shape of the tree of a .tbi index: its smallest bins hold 2**14 bases, and five levels lie above them.  Fixed values.
MIN_SHIFT, DEPTH = 14, 5
SCHEMA = "chrom string, pos bigint, qual double, filter string, value string, block bigint"
ROWS = 4096


def opened(path: str):
    """The store of a path or URI, and the path within it."""
    import re

    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^s3a:", "s3:", path))


def plain(chrom: str) -> str:
    return chrom.removeprefix("chr")


# the tree of intervals


def bin_of(start: int, end: int, shift: int = MIN_SHIFT, depth: int = DEPTH) -> int:
    """The smallest bin that holds start to end (0-based, half-open)."""
    for level in range(depth, 0, -1):
        at = shift + 3 * (depth - level)
        if start >> at == (end - 1) >> at:
            return ((1 << 3 * level) - 1) // 7 + (start >> at)
    return 0


def bins_over(start: int, end: int, shift: int = MIN_SHIFT, depth: int = DEPTH) -> list[range]:
    """By level, the bins that may hold records between start and end."""
    start, end = max(0, start), min(end, 1 << (shift + 3 * depth))
    if start >= end:
        return []
    first = [((1 << 3 * level) - 1) // 7 for level in range(depth + 1)]
    return [range(t + (start >> (shift + 3 * (depth - level))), t + ((end - 1) >> (shift + 3 * (depth - level))) + 1) for level, t in enumerate(first)]


# the index


@dataclass
class Contig:
    bins: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    #: .tbi: by 16,384 bases, the offset of the first record that touches them.
    windows: list[int] = field(default_factory=list)
    #: .csi: by bin, the same.
    first: dict[int, int] = field(default_factory=dict)


@dataclass
class Index:
    contigs: dict[str, Contig]
    shift: int = MIN_SHIFT
    depth: int = DEPTH

    def chunks(self, chrom: str, start: int, end: int) -> list[tuple[int, int]]:
        """Offsets between which records of start to end may lie, in order, none overlapping."""
        found: list[tuple[int, int]] = []
        for name, contig in self.contigs.items():
            if plain(name) != plain(chrom):
                continue
            least = 0
            if contig.windows:
                least = contig.windows[min(max(0, start) >> MIN_SHIFT, len(contig.windows) - 1)]
            elif contig.first:
                at = ((1 << 3 * self.depth) - 1) // 7 + (max(0, start) >> self.shift)
                while at and at not in contig.first:
                    at = (at - 1) >> 3
                least = contig.first.get(at, 0)
            for bins in bins_over(start, end, self.shift, self.depth):
                # of a level's bins or of the contig's, whichever are fewer
                named = bins if len(bins) <= len(contig.bins) else [b for b in contig.bins if b in bins]
                found += [(max(b, least), e) for n in named for b, e in contig.bins.get(n, ()) if e > least]
        return joined(found)

    def starts(self) -> list[int]:
        """Every offset at which the index says a record starts."""
        return sorted({b for c in self.contigs.values() for n in c.bins.values() for b, _ in n} | {w for c in self.contigs.values() for w in c.windows if w})


def joined(chunks: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Chunks in order; those that touch, or meet in one block, become one."""
    out: list[tuple[int, int]] = []
    for b, e in sorted(chunks):
        if out and b >> 16 <= out[-1][1] >> 16:
            out[-1] = out[-1][0], max(out[-1][1], e)
        else:
            out.append((b, e))
    return out


def cut(chunks: list[tuple[int, int]], starts: list[int], split: int) -> list[list[tuple[int, int]]]:
    """Chunks in groups of about split compressed bytes; a longer one is cut at known starts of records."""
    import bisect

    groups: list[list[tuple[int, int]]] = []
    held = split
    for b, e in chunks:
        while b < e:
            if held >= split:
                groups.append([])
                held = 0
            stop, room = e, split - held
            if (e >> 16) - (b >> 16) > room:
                i = bisect.bisect_left(starts, ((b >> 16) + room) << 16)
                stop = min(e, starts[i]) if i < len(starts) else e
            groups[-1].append((b, stop))
            held += (stop >> 16) - (b >> 16) + 1
            b = stop
    return groups


def read_index(data: bytes) -> Index:
    """An index file's content, .tbi or .csi, compressed as block-gzip."""
    import gzip

    raw = gzip.decompress(data)
    at = 0

    def take(form: str) -> tuple:
        nonlocal at
        found = struct.unpack_from("<" + form, raw, at)
        at += struct.calcsize("<" + form)
        return found

    def names() -> list[str]:
        nonlocal at
        kind, *_, length = take("7i")
        if kind & 0xFFFF != 2:
            raise ValueError("the index is not of a VCF")
        found = raw[at : at + length].rstrip(b"\0").split(b"\0") if length else []
        at += length
        return [n.decode() for n in found]

    (magic,) = take("4s")
    shift, depth, csi = MIN_SHIFT, DEPTH, magic == b"CSI\1"
    if csi:
        shift, depth, extra = take("3i")
        stop = at + extra
        called = names()
        at = stop
        (count,) = take("i")
    elif magic == b"TBI\1":
        (count,) = take("i")
        called = names()
    else:
        raise ValueError("neither a .tbi nor a .csi index")
    contigs: dict[str, Contig] = {}
    summary = ((1 << 3 * (depth + 1)) - 1) // 7 + 1
    for n in range(count):
        contig = Contig()
        for _ in range(take("i")[0]):
            (number,) = take("I")
            if csi:
                contig.first[number] = take("Q")[0]
            pairs = take(f"{2 * take('i')[0]}Q")
            if number != summary:
                contig.bins[number] = list(zip(pairs[::2], pairs[1::2]))
            else:
                contig.first.pop(number, None)
        if not csi:
            contig.windows = list(take(f"{take('i')[0]}Q"))
        contigs[called[n]] = contig
    return Index(contigs, shift, depth)


def told_index(index: Index) -> bytes:
    """The content of a .tbi file."""
    names = b"".join(n.encode() + b"\0" for n in index.contigs)
    # columns of chromosome and position, none of an end, header lines begin with #
    out = [b"TBI\1", struct.pack("<8i", len(index.contigs), 2, 1, 2, 0, ord("#"), 0, len(names)), names]
    for contig in index.contigs.values():
        out.append(struct.pack("<i", len(contig.bins)))
        for number, chunks in sorted(contig.bins.items()):
            out.append(struct.pack(f"<Ii{2 * len(chunks)}Q", number, len(chunks), *(x for c in chunks for x in c)))
        out.append(struct.pack(f"<i{len(contig.windows)}Q", len(contig.windows), *contig.windows))
    raw = b"".join(out)
    return b"".join(block(raw[i : i + BLOCK_TEXT]) for i in range(0, len(raw), BLOCK_TEXT)) + LAST_BLOCK


# blocks


def block(data: bytes) -> bytes:
    by = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = by.compress(data) + by.flush()
    if len(body) > 65_510:
        by = zlib.compressobj(0, zlib.DEFLATED, -15)
        body = by.compress(data) + by.flush()
    head = struct.pack("<4BI2BH2B2H", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25)
    return head + body + struct.pack("<2I", zlib.crc32(data), len(data))


def block_at(stream, at: int) -> tuple[bytes, int]:
    """The text of the block at that place, and the next block's place; nothing at the file's end."""
    stream.seek(at)
    head = stream.read(12)
    if len(head) < 12:
        return b"", at
    extra = stream.read(int.from_bytes(head[10:12], "little"))
    place = 0
    while extra[place : place + 2] != b"BC":
        place += 4 + int.from_bytes(extra[place + 2 : place + 4], "little")
        if place >= len(extra):
            raise ValueError(f"no block at {at}")
    size = int.from_bytes(extra[place + 4 : place + 6], "little") + 1
    return zlib.decompress(head + extra + stream.read(size - 12 - len(extra)), 31), at + size


def lines_between(stream, begin: int, end: int, seen: list[int] | None = None) -> Iterator[tuple[int, bytes]]:
    """(block, line) of the lines that start between two virtual offsets.  seen gets the place of each block opened."""
    at, skip = begin >> 16, begin & 0xFFFF
    rest, started = b"", 0
    while True:
        data, after = block_at(stream, at)
        if after == at:
            break
        if seen is not None:
            seen.append(at)
        while skip < len(data):
            if not rest:
                started = at << 16 | skip
                if started >= end:
                    return
            stop = data.find(b"\n", skip)
            if stop < 0:
                rest, skip = rest + data[skip:], len(data)
                continue
            yield started >> 16, rest + data[skip:stop]
            rest, skip = b"", stop + 1
        at, skip = after, 0
        if not rest and at << 16 >= end:
            return
    if rest:
        yield started >> 16, rest


# the source


@dataclass
class Part(InputPartition):
    path: str
    chunks: list[tuple[int, int]]


def parts_of(path: str) -> list[str]:
    """The files of a path: itself, or those of a folder that have an index."""
    from pyarrow import fs

    store, name = opened(path)
    if store.get_file_info(name).type != fs.FileType.Directory:
        return [path]
    found = {f.base_name for f in store.get_file_info(fs.FileSelector(name))}
    return [f"{path.rstrip('/')}/{n}" for n in sorted(found) if f"{n}.tbi" in found or f"{n}.csi" in found]


def index_of(path: str) -> Index:
    from pyarrow import fs

    store, name = opened(path)
    for suffix in (".tbi", ".csi"):
        if store.get_file_info(name + suffix).type == fs.FileType.File:
            with store.open_input_file(name + suffix) as stream:
                return read_index(stream.read())
    raise FileNotFoundError(f"no index beside {path}")


class Reader(DataSourceReader):
    def __init__(self, path: str, spans: list[tuple[str, int, int]] | None, split: int) -> None:
        self.path, self.spans, self.split = path, spans, split
        self.chroms: set[str] | None = None
        self.low, self.high = 0, 1 << 62
        self.filters: set[str] | None = None
        self.quality: float | None = None

    def chunks(self, index: Index) -> list[tuple[int, int]]:
        reach = 1 << (index.shift + 3 * index.depth)
        spans = self.spans if self.spans is not None else [(c, 0, reach) for c in index.contigs]
        found: list[tuple[int, int]] = []
        for chrom, start, end in spans:
            names = [c for c in index.contigs if plain(c) == plain(chrom) and (self.chroms is None or c in self.chroms)]
            for name in names:
                # a record that reaches into a span starts before it, so only the filters on pos bound the start
                found += index.chunks(name, max(start, self.low - 1), min(end, self.high))
        return joined(found)

    def partitions(self) -> list[Part]:
        found = []
        for path in parts_of(self.path):
            index = index_of(path)
            found += [Part(path, c) for c in cut(self.chunks(index), index.starts(), self.split)]
        return found or [Part("", [])]

    def read(self, partition: Part):
        import bisect

        import pyarrow as pa

        spans: dict[str, list[tuple[int, int]]] | None = None
        if self.spans is not None:
            spans = {}
            for chrom, start, end in sorted(self.spans, key=lambda s: s[1:]):
                own = spans.setdefault(plain(chrom), [])
                if own and start <= own[-1][1]:
                    own[-1] = own[-1][0], max(own[-1][1], end)
                else:
                    own.append((start, end))
        schema = pa.schema([("chrom", pa.string()), ("pos", pa.int64()), ("qual", pa.float64()), ("filter", pa.string()), ("value", pa.string()), ("block", pa.int64())])
        if not partition.chunks:
            return
        store, name = opened(partition.path)
        rows: list[tuple] = []
        with store.open_input_file(name) as stream:
            for begin, end in partition.chunks:
                for at, raw in lines_between(stream, begin, end):
                    if not raw or raw.startswith(b"#"):
                        continue
                    line = raw.decode().rstrip("\r")
                    cells = line.split("\t", 7)
                    chrom, pos = cells[0], int(cells[1])
                    if (self.chroms is not None and chrom not in self.chroms) or not self.low <= pos <= self.high:
                        continue
                    if spans is not None:
                        own = spans.get(plain(chrom), [])
                        i = bisect.bisect_left(own, (pos - 1 + max(1, len(cells[3])),)) - 1
                        if i < 0 or own[i][1] <= pos - 1:
                            continue
                    quality = None if cells[5] == "." else float(cells[5])
                    told = None if cells[6] == "." else cells[6]
                    if (self.filters is not None and told not in self.filters) or (self.quality is not None and (quality is None or quality < self.quality)):
                        continue
                    rows.append((chrom, pos, quality, told, line, at))
                    if len(rows) >= ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                        rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)


class FilteringReader(Reader):
    """The reader where filters are pushed down; Spark takes a reader with this method only where its setting allows it."""

    def pushFilters(self, filters: list) -> Iterable:
        """Chromosomes and positions choose blocks, FILTER and QUAL leave lines out; Spark looks at all of them again."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            value = getattr(f, "value", None)
            if isinstance(f, (EqualTo, In)) and name in ("chrom", "filter"):
                told = {value} if isinstance(f, EqualTo) else set(value)
                before = self.chroms if name == "chrom" else self.filters
                setattr(self, "chroms" if name == "chrom" else "filters", told if before is None else before & told)
            elif name == "pos" and isinstance(f, EqualTo):
                self.low, self.high = max(self.low, value), min(self.high, value)
            elif name == "pos" and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.low = max(self.low, value + isinstance(f, GreaterThan))
            elif name == "pos" and isinstance(f, (LessThan, LessThanOrEqual)):
                self.high = min(self.high, value - isinstance(f, LessThan))
            elif name == "qual" and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.quality = value if self.quality is None else max(value, self.quality)
        return filters


class BlockVcf(DataSource):
    """format("block_vcf"): option path, a file or a folder of them; option regions, JSON of [chrom, start, end] (0-based,
    half-open; none: everything); option pushdown, true where spark.sql.python.filterPushdown.enabled is: filters on chrom,
    pos, filter and qual are taken."""

    @classmethod
    def name(cls) -> str:
        return "block_vcf"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        import json

        told = self.options.get("regions")
        spans = None if told is None else [(str(c), int(s), int(e)) for c, s, e in json.loads(told)]
        kind = FilteringReader if self.options.get("pushdown") == "true" else Reader
        return kind(self.options["path"], spans, int(self.options.get("split", SPLIT_BYTES)))


#: Regions that a scan names one by one; beyond them it names each chromosome's first and last position.
MOST_SPANS = 10_000


def has_index(spark: SparkSession, path: str) -> bool:
    from helicase.sources.store import exists

    return any(exists(spark, path + suffix) for suffix in (".tbi", ".csi"))


def records_of(spark: SparkSession, path: str, regions: DataFrame | None = None) -> DataFrame:
    """chrom, pos, qual, filter, value (the line), block of an indexed VCF, or a folder of them, that touch a region."""
    import json

    from pyspark.sql import functions as F

    from helicase.sources.store import located

    found, store = located(spark, path)
    spark.dataSource.register(BlockVcf)
    reader = spark.read.format("block_vcf").option("path", store.makeQualified(found).toString())
    reader = reader.option("pushdown", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"))
    if regions is not None:
        spans = regions.select("chrom", "start", "end").distinct().limit(MOST_SPANS + 1).collect()
        if len(spans) > MOST_SPANS:
            spans = regions.groupBy("chrom").agg(F.min("start").alias("start"), F.max("end").alias("end")).collect()
        reader = reader.option("regions", json.dumps([[r.chrom, r.start, r.end] for r in spans]))
    return reader.load()


# the writer


class _Writer:
    """Lines in order into blocks, and their index."""

    def __init__(self, stream) -> None:
        self.stream, self.at, self.held = stream, 0, bytearray()
        self.index, self.chrom, self.number = Index({}), None, -1

    def offset(self) -> int:
        return self.at << 16 | len(self.held)

    def text(self, data: bytes) -> None:
        self.held += data
        while len(self.held) >= BLOCK_TEXT:
            self.flush(BLOCK_TEXT)

    def flush(self, size: int) -> None:
        made = block(bytes(self.held[:size]))
        self.stream.write(made)
        self.at += len(made)
        del self.held[:size]

    def record(self, line: str) -> None:
        chrom, pos, _, ref = line.split("\t", 4)[:4]
        start = int(pos) - 1
        end = start + max(1, len(ref))
        if chrom != self.chrom:
            if chrom in self.index.contigs:
                raise ValueError(f"records of {chrom} do not lie together")
            self.chrom, self.number = chrom, -1
            self.index.contigs[chrom] = Contig()
        begin = self.offset()
        self.text(line.encode() + b"\n")
        contig, number = self.index.contigs[chrom], bin_of(start, end)
        chunks = contig.bins.setdefault(number, [])
        if number == self.number:
            chunks[-1] = chunks[-1][0], self.offset()
        else:
            chunks.append((begin, self.offset()))
        self.number = number
        for window in range(len(contig.windows), ((end - 1) >> MIN_SHIFT) + 1):
            # windows without a record of their own point where the next record starts
            contig.windows.append(begin)

    def close(self) -> None:
        while self.held:
            self.flush(min(len(self.held), BLOCK_TEXT))
        self.stream.write(LAST_BLOCK)


def write_indexed(lines: DataFrame, head: list[str], path: str, files: int | None = None) -> DataFrame:
    """Record lines (column value; others are left out) as a folder of block-gzip VCFs with an index each, in order of
    chromosome and position; returns file, records.

    Every task writes its own range under a name of the attempt and moves it to its place when it is whole, so tasks may
    be repeated.  Records beyond 2**29 bases are refused, which .tbi cannot hold.
    """
    from pyspark.sql import functions as F

    from helicase.sources.store import located

    spark = lines.sparkSession
    found, store = located(spark, path)
    store.mkdirs(found)
    target = store.makeQualified(found).toString()
    cells = F.split("value", "\t")
    rows = lines.where(~F.col("value").startswith("#") & (F.col("value") != "")).select("value", cells[0].alias("chrom"), cells[1].cast("bigint").alias("pos"))
    rows = rows.repartitionByRange(files, "chrom", "pos") if files else rows.repartitionByRange("chrom", "pos")

    def write(batches):
        import os
        import uuid

        import pyarrow as pa
        from pyspark import TaskContext

        from helicase.sources.blockvcf import _Writer, opened, told_index

        store, folder = opened(target)
        name = f"part-{TaskContext.get().partitionId():05}.vcf.gz"
        part, count = f"{folder}/.{name}.{uuid.uuid4().hex}", 0
        with store.open_output_stream(part, compression=None) as stream:
            out = _Writer(stream)
            out.text("".join(h + "\n" for h in head).encode())
            for batch in batches:
                for line, pos in zip(batch.column("value").to_pylist(), batch.column("pos").to_pylist()):
                    if pos > 1 << 29:
                        raise ValueError(f"position {pos} is beyond what a .tbi index holds")
                    out.record(line)
                    count += 1
            out.close()
        with store.open_output_stream(f"{part}.tbi", compression=None) as stream:
            stream.write(told_index(out.index))
        store.move(part, f"{folder}/{name}")
        store.move(f"{part}.tbi", f"{folder}/{name}.tbi")
        yield pa.RecordBatch.from_arrays([pa.array([os.path.basename(name)]), pa.array([count], pa.int64())], names=["file", "records"])

    told = rows.sortWithinPartitions("chrom", "pos", "value").mapInArrow(write, "file string, records bigint").collect()
    return spark.createDataFrame(told, "file string, records bigint")
