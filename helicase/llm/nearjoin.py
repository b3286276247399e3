"""N-gram Jaccard join of all texts by chosen paths.

A text's set is its five-word shingles (all words, if fewer).  Texts are linked if their sets' Jaccard similarity is
at least 0.8.  Sets are embedded as POSITIONS min-hashes; in each of several runs a set picks positions whose hash
falls under BRANCHING / POSITIONS, and sets that picked the same position and value share a bucket.  Small buckets
are compared by brute force on sketches; in large ones near copies of a leader are tied to it and leave, and the rest
is split on further picks, bucket by bucket.  What no split divides is compared in pairs of blocks.  The number of
runs follows from the target recall: a pair at the threshold shares BRANCHING * 0.8 picks a level on average, so a
run misses it with the extinction probability of that branching process at most.

Sketches only tie candidates together; every pair inside a candidate component is then compared exactly on its sets,
in blocks, and counted.  Equal texts are one node throughout, different ones never, whatever their doc_ids: a node is
the text's 64-bit hash (n texts have a collision with a chance of n * n / 2**65).  Only stars leave a bucket or block,
never all pairs.

Defined results: a null text is empty; texts without words have no links.  class_id is the least doc_id of the linked
texts' connected component, text_id that of equal texts, n_copies the rows with that text, n_links the different
texts linked to it.  Repeated rows are copies.  Null doc_ids come before all others and are null again in results;
where doc_ids repeat or are null, different classes may show one class_id.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helicase.llm.common import binary_parts, discard, materialised, shared_dir, sliced
from helicase.llm.graph import components, local_stars

SHINGLE = 5
NEAR_NUM, NEAR_DEN = 4, 5
POSITIONS = 64
BRANCHING = 2.0
TARGET_RECALL = 0.999
#: Sketch positions that must agree in a candidate pair: over four standard deviations below 0.8 * POSITIONS.
AGREE = 38
#: Sketch positions that tie a near copy to its leader: what is near the copy then still agrees with the leader.
TIED = 58
BUCKET = 2048
BLOCK = 1024
DEPTH = 3
#: Text bytes of a block where texts are compared exactly.
BLOCK_BYTES = 4 << 20
#: Text bytes handled at a time.
STEP_BYTES = 1 << 20

#: Stands for a null doc_id inside.
NO_ID = -(1 << 63)

_U = np.uint64
_P = 0x9E3779B97F4A7C15
_PINV = pow(_P, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def runs(recall: float = TARGET_RECALL) -> int:
    lost = 0.0
    for _ in range(200):
        lost = math.exp(-BRANCHING * NEAR_NUM / NEAR_DEN * (1 - lost))
    return math.ceil(math.log(1 - recall) / math.log(lost))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def seeds(n: int, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + _U(salt << 32)) * _U(_P))


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers.get(base, ())) < n:
        values = np.full(n, base, np.uint64)
        values[0] = 1
        _powers[base] = np.multiply.accumulate(values)
    return _powers[base][:n]


def tokens(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles (with repeats) and the row of each, by row; every byte of the texts counts."""
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    space = _SPACE[data]
    first, last = offsets[:-1][np.diff(offsets) > 0], offsets[1:][np.diff(offsets) > 0]
    after, before = np.append(True, space[:-1]), np.append(space[1:], True)
    after[first] = True
    before[last - 1] = True
    start, stop = np.flatnonzero(~space & after), np.flatnonzero(~space & before) + 1
    if not len(start):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * _power(_P, n), out=total[1:])
    word = mix((total[stop] - total[start]) * _power(_PINV, n)[start] + (stop - start).astype(np.uint64))
    row = np.searchsorted(offsets, start, side="right") - 1
    count = np.bincount(row, minlength=len(offsets) - 1)
    head = np.cumsum(count) - count
    scale = seeds(SHINGLE, 7) | _U(1)
    padded = np.append(word, np.zeros(SHINGLE, np.uint64))
    place = np.arange(len(word)) - head[row]
    size = np.minimum(count, SHINGLE)
    here = np.flatnonzero(place <= (count - size)[row])
    value = np.zeros(len(here), np.uint64)
    short = size[row[here]]
    for j in range(SHINGLE):
        value += np.where(j < short, padded[here + j] * scale[j], _U(0))
    return mix(value + short.astype(np.uint64)), row[here]


def sketches(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Min-hashes (rows x POSITIONS) of the rows that have a token, and those rows."""
    token, row = tokens(offsets, data)
    rows, first = np.unique(row, return_index=True)
    out = np.empty((len(rows), POSITIONS), np.uint64)
    if len(rows):
        for k, (a, b) in enumerate(zip(seeds(POSITIONS, 1) | _U(1), seeds(POSITIONS, 2), strict=True)):
            np.minimum.reduceat(token * a + b, first, out=out[:, k])
    return out, rows


def picks(values: np.ndarray, paths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that pick a position from their path (one each), and the new path of each pick."""
    here = mix((mix(values + seeds(POSITIONS, 3)) ^ paths[:, None]) * _U(_P))
    row, k = np.nonzero(here < _U(int(BRANCHING / POSITIONS * 2.0**64)))
    return row, here[row, k] ^ mix(paths[row])


def _embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    start = seeds(runs(), 4)
    for whole in batches:
        pa.default_memory_pool().release_unused()  # of the batch before
        for batch in sliced(whole, 2, STEP_BYTES):
            n = batch.num_rows
            values, rows = sketches(*binary_parts(batch.column(2)))
            owner, path = [], []
            for s in start:
                row, new = picks(values, np.full(len(rows), s))
                owner.append(rows[row])
                path.append(new)
            owner, path = np.concatenate(owner), np.concatenate(path)
            order = np.argsort(owner, kind="stable")
            lists = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int32)
            sketch = np.zeros((n, POSITIONS), np.uint16)
            sketch[rows] = (mix(values) & _U(0xFFFF)).astype(np.uint16)
            raw = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * 2 * POSITIONS).astype(np.int32)), pa.py_buffer(sketch)])
            size = np.diff(binary_parts(batch.column(2))[0]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size), pa.ListArray.from_arrays(pa.array(lists), pa.array(path[order].view(np.int64))), raw],
                names=["doc_id", "node", "size", "paths", "sketch"],
            )


def _sketch_matrix(column: pa.Array) -> np.ndarray:
    _, data = binary_parts(column)
    at, _ = binary_parts(column)
    return data[at[0] : at[-1]].view(np.uint16).reshape(len(column), POSITIONS)


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = _sketch_matrix(batch.column(2)).astype(np.uint64) * _U(_P)
        row, path = picks(values, batch.column(0).to_numpy().view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), batch.column(1).take(pa.array(row))], names=["path", "node"])


def groups_of(batches: Iterator[pa.RecordBatch], n_keys: int, least: int = 20_000) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Runs of whole groups (rows with equal leading key columns, which must come sorted), with each group's first row."""
    held: list[pa.RecordBatch] = []

    def starts(table: pa.RecordBatch) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[0] = True
        for i in range(n_keys):
            k = table.column(i).to_numpy(zero_copy_only=False)
            new[1:] |= k[1:] != k[:-1]
        return np.flatnonzero(new)

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < least:
            continue
        table = joined()
        first = starts(table)
        if first[-1]:
            yield table.slice(0, first[-1]), first[:-1]
        held = [table.slice(first[-1])]
        rows = held[0].num_rows
    if held:
        table = joined()
        yield table, starts(table)


def _tied(sketch: np.ndarray, node: np.ndarray, left: np.ndarray, right: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars of the pairs of rows, one of left and one of right (equal or disjoint), that agree in so many positions."""
    inside = len(left) == len(right) and np.array_equal(left, right)
    rows = left if inside else np.concatenate([left, right])
    near = np.zeros((len(rows), len(rows)), bool)
    columns = np.ascontiguousarray(sketch[right].T)
    at = 0 if inside else len(left)
    for block in np.array_split(np.arange(len(left)), max(1, len(left) // 256)):
        same = np.zeros((len(block), len(right)), np.uint8)
        for k in range(POSITIONS):
            same += sketch[left[block], k][:, None] == columns[k][None, :]
        near[block, at:] = same >= least
    near |= near.T
    root = _roots(near, node[rows])
    moved = node[rows] != node[rows][root]
    return node[rows][moved], node[rows][root][moved]


def _edges(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(a):
        a, b = local_stars(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars of candidate pairs inside buckets: rows (path, node, sketch) sorted by path."""
    for table, first in groups_of(batches, 1):
        node, sketch = table.column(1).to_numpy(), _sketch_matrix(table.column(2))
        size = np.diff(np.append(first, table.num_rows))
        group = np.repeat(np.arange(len(first)), size)
        small = size <= 32
        a, b = [], []
        for d in range(1, int(size[small].max(initial=1))):
            i = np.flatnonzero((group[d:] == group[:-d]) & small[group[d:]])
            i = i[(sketch[i] == sketch[i + d]).sum(1) >= AGREE]
            a.append(node[i])
            b.append(node[i + d])
        for g in np.flatnonzero(~small):
            rows = np.arange(first[g], first[g] + size[g])
            x, y = _tied(sketch, node, rows, rows, AGREE)
            a.append(x)
            b.append(y)
        if a:
            yield from _edges(np.concatenate(a), np.concatenate(b))


def _brute_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same for pairs of blocks: rows (path, lo, hi, block, node, sketch) sorted by the first three."""
    for table, first in groups_of(batches, 3, BLOCK):
        node, sketch, block = table.column(4).to_numpy(), _sketch_matrix(table.column(5)), table.column(3).to_numpy()
        lo, hi = table.column(1).to_numpy(), table.column(2).to_numpy()
        a, b = [], []
        for start, stop in zip(first, np.append(first[1:], table.num_rows), strict=True):
            rows = np.arange(start, stop)
            left = rows[block[rows] == lo[start]]
            right = rows[block[rows] != lo[start]]
            x, y = _tied(sketch, node, left, left if lo[start] == hi[start] else right, AGREE)
            a.append(x)
            b.append(y)
        yield from _edges(np.concatenate(a), np.concatenate(b))


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path, block, node, sketch): per block, leaders stay (leader null), near copies are tied to one."""
    for table, first in groups_of(batches, 2, BLOCK):
        path, node, sketch = table.column(0), table.column(2).to_numpy(), _sketch_matrix(table.column(3))
        leader = node.copy()
        for start, stop in zip(first, np.append(first[1:], table.num_rows), strict=True):
            rows = np.arange(start, stop)[np.argsort(node[start:stop], kind="stable")]
            while len(rows):
                tied = (sketch[rows[1:]] == sketch[rows[0]]).sum(1) >= TIED
                leader[rows[1:][tied]] = node[rows[0]]
                rows = rows[1:][~tied]
        yield pa.RecordBatch.from_arrays([path, pa.array(node), pa.array(leader)], names=["path", "node", "leader"])


def candidates(sets: DataFrame, sketch: DataFrame, folders: list[str] | None = None) -> DataFrame:
    """Edges (a, b) whose components hold every pair of near texts; sets: node, paths (copies have equal ones); sketch: node,
    sketch, once each.  folders: takes the paths of what is written here, which may go once the edges are read."""
    folders = [] if folders is None else folders

    def kept(df: DataFrame, name: str) -> DataFrame:
        folders.append(shared_dir(df.sparkSession, name))
        return materialised(df, name, folders[-1])

    def _counted(rows: DataFrame) -> DataFrame:
        """path, node, n: the rows of paths that have two nodes at least, with their number."""
        n = rows.groupBy("path").agg(F.count("*").alias("n")).where("n > 1")
        return kept(rows.join(n, "path"), "paths")

    rows = _counted(sets.select(F.explode("paths").alias("path"), "node").distinct())
    small, ties = [], []  # buckets to compare by brute force, all in one pass at the end, and what leaders tied

    def blocks(n: str, most: int) -> Column:
        return F.ceil(F.col(n) / most).cast("int")

    def sorted_out(rows: DataFrame) -> DataFrame:
        small.append(rows.where(F.col("n") <= BUCKET).select("path", "node"))
        return rows.where(F.col("n") > BUCKET)

    large = sorted_out(rows)
    for _ in range(DEPTH):
        for _ in range(2):
            if large.isEmpty():
                break
            block = F.pmod(F.xxhash64("node"), blocks("n", BLOCK)).cast("int")
            dealt = large.join(sketch, "node").select("path", block.alias("block"), "node", "sketch")
            done = kept(dealt.repartition("path", "block").sortWithinPartitions("path", "block").mapInArrow(_compress, "path bigint, node bigint, leader bigint"), "tied")
            ties.append(done.where("node <> leader").select("node", "leader"))
            large = sorted_out(_counted(done.where("node = leader").select("path", "node")))
        if large.isEmpty():
            break
        split = large.join(sketch, "node").select("path", "node", "sketch").mapInArrow(_split, "path bigint, node bigint")
        large = sorted_out(_counted(split.distinct()))
    with_sketch = reduce(DataFrame.union, small).join(sketch, "node").select("path", "node", "sketch")
    found = with_sketch.repartition("path").sortWithinPartitions("path").mapInArrow(_brute, "a bigint, b bigint")
    found = reduce(DataFrame.union, ties, found)
    if large.isEmpty():
        return found
    parts = blocks("n", BLOCK)
    rest = large.join(sketch, "node").select("path", "node", "sketch", F.pmod(F.xxhash64("node"), parts).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
    rest = rest.select("path", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "sketch")
    return found.union(rest.repartition("path", "lo", "hi").sortWithinPartitions("path", "lo", "hi").mapInArrow(_brute_blocks, "a bigint, b bigint"))


def _common(token: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Numbers of common tokens (n x n) of sets given as distinct (row, token) pairs."""
    _, at, times = np.unique(token, return_inverse=True, return_counts=True)
    shared = times[at] > 1
    at, row = at[shared], row[shared]
    out = np.zeros((n, n), np.int32)
    if not len(at):
        return out
    _, at, times = np.unique(at, return_inverse=True, return_counts=True)
    if float((times.astype(float) ** 2).sum()) * 10 < float(n) * n * len(times) * 0.5:
        order = np.argsort(at, kind="stable")
        row, ends = row[order], np.cumsum(times)
        for size in np.unique(times):
            heads = (ends - times)[times == size]
            members = row[heads[:, None] + np.arange(size)]
            np.add.at(out, (np.repeat(members, size, axis=1).ravel(), np.tile(members, (1, size)).ravel()), 1)
        return out
    for low in range(0, len(times), 4096):
        part = (at >= low) & (at < low + 4096)
        dense = np.zeros((n, min(4096, len(times) - low)), np.float32)
        dense[row[part], at[part] - low] = 1.0
        out += np.rint(dense @ dense.T).astype(np.int32)
    return out


def _roots(near: np.ndarray, node: np.ndarray) -> np.ndarray:
    """For each row of a symmetric relation the place of its component's least node."""
    order = np.argsort(node, kind="stable")
    rank = np.empty(len(node), np.int32)
    rank[order] = np.arange(len(node), dtype=np.int32)
    label = rank.copy()
    while True:
        new = label.copy()
        for part in np.array_split(np.arange(len(node)), max(1, len(node) // 256)):
            new[part] = np.minimum(label[part], np.where(near[part], label[None, :], np.int32(len(node))).min(1))
        new = np.minimum(new, new[order[new]])
        if np.array_equal(new, label):
            return order[label]
        label = new


def _once(batches: Iterator[pa.RecordBatch], keys: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    """The first row of each run of rows with equal numbers in these columns."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.column_stack([batch.column(k).to_numpy() for k in keys])
        new = np.append(last is None or bool((values[0] != last).any()), (values[1:] != values[:-1]).any(1))
        last = values[-1]
        yield batch if new.all() else batch.filter(pa.array(new))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (comp, lo, hi, block, node, text) sorted by the first three and node; per node its links in the pair of blocks and
    the least node that they connect it to there."""
    for table, first in groups_of(_once(batches, (0, 1, 2, 4)), 3, 256):
        lo, hi, block, node = (table.column(c).to_numpy() for c in (1, 2, 3, 4))
        offsets, data = binary_parts(table.column(5))
        nodes, links, roots = [], [], []
        for start, stop in zip(first, np.append(first[1:], table.num_rows), strict=True):
            token, row = tokens(offsets[start : stop + 1], data)
            order = np.lexsort((token, row))
            token, row = token[order], row[order]
            new = np.append(True, (token[1:] != token[:-1]) | (row[1:] != row[:-1]))[: len(token)]
            token, row = token[new], row[new]
            n = stop - start
            size = np.bincount(row, minlength=n)
            near = _common(token, row, n)
            weight = (NEAR_NUM * size).astype(np.int32)
            near = (near > 0) & ((NEAR_NUM + NEAR_DEN) * near >= weight[:, None] + weight[None, :])
            np.fill_diagonal(near, False)
            if lo[start] != hi[start]:
                near &= block[start:stop][:, None] != block[start:stop][None, :]
            times = near.sum(1)
            linked = np.flatnonzero(times)
            if len(linked):
                here = node[start:stop][linked]
                nodes.append(here)
                links.append(times[linked])
                roots.append(here[_roots(near[np.ix_(linked, linked)], here)])
        if nodes:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in (nodes, links, roots)], names=["node", "links", "root"])


def _numbered(docs: DataFrame) -> tuple[Column, Column]:
    """A row's doc_id without nulls and its text's node."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)), F.xxhash64(F.coalesce("text", F.lit("")))


def _classed(docs: DataFrame) -> DataFrame:
    """doc_id (NO_ID for null), node, root (the least node linked to it), class_id, text_id, n_copies, n_links for every row."""
    number, node = _numbered(docs)
    docs = docs.select(number.alias("doc_id"), node.alias("node"), F.coalesce("text", F.lit("")).alias("text"))
    sets = materialised(docs.mapInArrow(_embed, "doc_id bigint, node bigint, size int, paths array<bigint>, sketch binary"), "sets")
    texts = materialised(sets.groupBy("node").agg(F.min("doc_id").alias("text_id"), F.count("*").alias("n_copies"), F.max("size").alias("size"), F.first("sketch").alias("sketch")), "texts")
    folders: list[str] = []
    found = components(candidates(sets, texts.select("node", "sketch"), folders))
    for folder in folders:
        discard(docs.sparkSession, folder)
    near = found.join(texts.select("node", "text_id", "size"), "node")
    parts = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("size") / BLOCK_BYTES)).cast("int")
    near = materialised(near.join(near.groupBy("root").agg(parts.alias("parts")), "root"), "near")
    ids = materialised(near.select(F.col("text_id").alias("doc_id")).distinct(), "ids")  # narrow, so that it filters texts where they lie for longer
    rows = docs.join(ids, "doc_id", "left_semi").join(near.select("node", F.col("text_id").alias("doc_id"), "root", "parts"), ["node", "doc_id"])
    rows = rows.select("root", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"), "node", "text")
    rows = rows.select("root", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "text")
    found = rows.repartition("root", "lo", "hi").sortWithinPartitions("root", "lo", "hi", "node").mapInArrow(_verify, "node bigint, links bigint, root bigint")
    found = materialised(found, "links")
    per_node = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    wide = near.where("parts > 1").select("node")
    several = found.join(wide, "node", "left_semi")
    roots = found.join(wide, "node", "left_anti").select("node", "root")
    if not several.isEmpty():
        roots = roots.union(components(several.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    linked = materialised(per_node.join(roots, "node").join(near.select("node", "text_id"), "node"), "linked")
    least = linked.groupBy("root").agg(F.min("text_id").alias("class_id"))
    linked = linked.join(least, "root").select("node", "n_links", "root", "class_id")
    return sets.select("doc_id", "node").join(texts.select("node", "text_id", "n_copies").join(linked, "node", "left"), "node").select(
        "doc_id", "node", F.coalesce("root", "node").alias("root"), F.coalesce("class_id", "text_id").alias("class_id"), "text_id", "n_copies", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links")
    )


def joined(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, text_id, n_copies, n_links for every row of docs (doc_id, text)."""
    shown = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return _classed(docs).select(shown("doc_id"), shown("class_id"), shown("text_id"), "n_copies", "n_links")


#: The same by brute force: distinct shingles of distinct texts, a self-join on shingles, and components by recursion.
SQL = """
WITH RECURSIVE t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
u AS (SELECT text, min(doc_id) AS node, count(*)::BIGINT AS n_copies FROM t GROUP BY text),
w AS (SELECT node, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM u),
s AS (SELECT DISTINCT node, unnest(list_transform(range(1, greatest(len(ws) - 3, 2)), lambda i: list_slice(ws, i, i + 4))) AS shingle FROM w WHERE len(ws) > 0),
n AS (SELECT node, count(*) AS size FROM s GROUP BY node),
c AS (SELECT a.node AS a, b.node AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.node <> b.node GROUP BY a.node, b.node),
l AS (SELECT a, b FROM c JOIN n x ON x.node = a JOIN n y ON y.node = b WHERE 9 * common >= 4 * (x.size + y.size)),
r AS (SELECT node, node AS reached FROM u UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.reached),
k AS (SELECT node, min(reached) AS class_id FROM r GROUP BY node),
d AS (SELECT a AS node, count(*)::BIGINT AS n_links FROM l GROUP BY a)
SELECT t.doc_id, k.class_id, u.node AS text_id, u.n_copies, coalesce(d.n_links, 0)::BIGINT AS n_links
FROM t JOIN u ON u.text = t.text JOIN k ON k.node = u.node LEFT JOIN d ON d.node = u.node
"""


def representatives(docs: DataFrame) -> DataFrame:
    """Of each class of linked or equal texts one row of docs, the first by doc_id and text."""
    hits = _classed(docs).where("doc_id = class_id").groupBy(F.col("root").alias("_root"), F.col("node").alias("_kept_node"), F.col("doc_id").alias("_kept_id")).agg(F.count("*").alias("_n"))
    kept = materialised(hits.withColumn("_rows", F.sum("_n").over(Window.partitionBy("_root"))), "kept")
    docs.sparkSession._jvm.System.gc()  # what was shuffled so far goes before the texts are
    number, node = _numbered(docs)
    rows = docs.withColumns({"_kept_id": number, "_kept_node": node}).join(kept, ["_kept_node", "_kept_id"])
    once = rows.where("_rows = 1").select(*docs.columns)
    if kept.where("_rows > 1").isEmpty():
        return once
    first = Window.partitionBy("_root").orderBy("text")
    several = rows.where("_rows > 1").withColumn("_place", F.row_number().over(first)).where("_place = 1")
    return once.union(several.select(*docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(spark.read.parquet(f"{sf_dir}/documents.parquet"))
