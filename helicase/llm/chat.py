"""Chat formatting by columnar byte assembly.

Rows of conversations become formatted text: per turn a header, the escaped text and an end mark.  A batch is
laid out in numpy: the lengths of all segments, their cumulative offsets, then the indices that scatter constants,
roles and texts into one preallocated Arrow buffer, which becomes the output column without a copy.

Rows are dealt by ranges of conversation and turn, so a conversation of any length is sorted and formatted by as many
tasks as it needs: its rows leave in stretches, one a task, and a stretch longer than PART_BYTES of text in parts.  Read
one after another by stretch and part they are the conversation; most are one row.  Only a digest over a conversation
that many tasks share must pass it in order: read_back() streams what may go on in another task to one that does, and
digests all others where they are.

Defined results: rows go by turn (null first), then role, then text; repeated rows are turns like any other.  A null
text or role is empty.  Null conv_ids are one conversation.  Rows with one conv_id and turn are in one stretch.  An
empty table gives no rows.  Other columns of the input are ignored.

Inside texts ``<``, any backslashes, ``|`` gets one backslash more, so no text holds ``<|``; roles escape backslash,
newline and bar.  Both are undone exactly by ``unescape`` and ``unescape_role``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helicase.llm.common import binary_parts, materialised, sliced

START, END = "<|im_start|>", "<|im_end|>"
PART_BYTES = 8 << 20
#: Formatted bytes of a conversation that a digest holds until it knows that the conversation ends in its task.
HELD_BYTES = 32 << 20
#: Segments up to this length are scattered by index, longer ones copied as slices.
SCATTER_BYTES = 4096

FORMATTED = "conv_id bigint, part int, n_turns int, formatted string, loss_start array<int>, loss_bytes array<int>"
DIGEST = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"

_ESCAPED = re.compile(r"<\\(\\*)\|")
_ROLE = re.compile(r"\\(.)", re.S)


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, r"<(\\*)\|", r"<\\\1|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_roles(roles: pa.Array) -> pa.Array:
    for what, by in (("\\", "\\\\"), ("\n", "\\n"), ("|", "\\p")):
        roles = pc.replace_substring(roles, what, by)
    return roles


def unescape_role(role: str) -> str:
    return _ROLE.sub(lambda m: {"n": "\n", "p": "|"}.get(m[1], m[1]), role)


def _scatter(out: np.ndarray, to: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
    """Copies data[start : start + length] to out[to : to + length], segment by segment."""
    for i in np.flatnonzero(length > SCATTER_BYTES):
        out[to[i] : to[i] + length[i]] = data[start[i] : start[i] + length[i]]
    small = np.flatnonzero((length > 0) & (length <= SCATTER_BYTES))
    for block in np.array_split(small, max(1, len(small) // 512)):
        if len(block):
            n = length[block]
            before = np.cumsum(n) - n
            step = np.arange(int(n.sum()))
            out[np.repeat(to[block] - before, n) + step] = data[np.repeat(start[block] - before, n) + step]


def _constant(out: np.ndarray, to: np.ndarray, value: str) -> None:
    raw = np.frombuffer(value.encode(), np.uint8)
    out[to[:, None] + np.arange(len(raw))] = raw


def assemble(conv: pa.Array, roles: pa.Array, texts: pa.Array, first: np.ndarray) -> list[pa.Array]:
    """One formatted string for each run of turns; first has the index of each run's first turn, ascending."""
    roles, texts = roles.fill_null(""), texts.fill_null("")
    answers = pc.equal(roles, "assistant").to_numpy(zero_copy_only=False)
    (ra, rdata), (ta, tdata) = binary_parts(escape_roles(roles)), binary_parts(escape(texts))
    rlen, tlen, n = np.diff(ra), np.diff(ta), len(texts)
    lengths = np.empty((n, 5), np.int64)
    lengths[:, 0], lengths[:, 1], lengths[:, 2], lengths[:, 3], lengths[:, 4] = len(START), rlen, 1, tlen, len(END) + 1
    ends = np.cumsum(lengths.ravel())
    starts = (ends - lengths.ravel()).reshape(n, 5)
    buffer = pa.allocate_buffer(int(ends[-1]) if n else 0)
    out = np.frombuffer(buffer, np.uint8)
    _constant(out, starts[:, 0], START)
    _scatter(out, starts[:, 1], rdata, ra[:-1], rlen)
    _constant(out, starts[:, 2], "\n")
    _scatter(out, starts[:, 3], tdata, ta[:-1], tlen)
    _constant(out, starts[:, 4], END + "\n")
    offsets = np.append(starts[first, 0], ends[-1]).astype(np.int32)
    formatted = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets.tobytes()), buffer)
    run = np.searchsorted(first, np.arange(n), side="right") - 1
    per_run = np.bincount(run[answers], minlength=len(first))
    lists = pa.array(np.concatenate([[0], np.cumsum(per_run)]), pa.int32())
    at = pa.array((starts[answers, 3] - starts[first, 0][run[answers]]).astype(np.int32))
    turns = np.diff(np.append(first, n)).astype(np.int32)
    return [
        conv.take(pa.array(first)),
        pa.array(turns),
        formatted,
        pa.ListArray.from_arrays(lists, at),
        pa.ListArray.from_arrays(lists, pa.array(tlen[answers].astype(np.int32))),
    ]


def _changes(conv: pa.Array) -> np.ndarray:
    """Indices at which another conversation begins."""
    value, null = conv.fill_null(0).to_numpy(zero_copy_only=False), conv.is_null().to_numpy(zero_copy_only=False)
    return np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (null[1:] != null[:-1])]))


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "part", "n_turns", "formatted", "loss_start", "loss_bytes"]
    held: list[pa.RecordBatch] = []
    last: tuple | None = None  # the conversation whose part was given last, and that part

    def give(table: pa.RecordBatch) -> pa.RecordBatch:
        nonlocal last
        first = _changes(table.column(0))
        conv, turns, *rest = assemble(table.column(0), table.column(1), table.column(2), first)
        part = np.zeros(len(first), np.int32)
        if last is not None and last[0] == conv[0].as_py():
            part[0] = last[1] + 1
        last = (conv[-1].as_py(), int(part[-1]))
        return pa.RecordBatch.from_arrays([conv, pa.array(part), turns, *rest], names=names)

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for whole in batches:
        for batch in sliced(whole, 2, PART_BYTES):
            held.append(batch)
            table = joined()
            begins = int(_changes(table.column(0))[-1])
            if begins:
                yield give(table.slice(0, begins))
            tail = table.slice(begins)
            if tail.column(2).nbytes >= PART_BYTES:
                yield give(tail)
                held = []
            else:
                held = [tail]
    if held:
        yield give(joined())


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, part, n_turns, formatted, the byte spans of the loss mask (assistant texts) in each part, and stretch."""
    rows = rows.select(F.col("conv_id").cast("bigint"), "role", "text", F.col("turn"))
    rows = rows.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.select("conv_id", "role", "text").mapInArrow(_format, FORMATTED).withColumn("stretch", F.spark_partition_id())


def read_part(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted part."""
    turns = []
    for piece in formatted.split(START)[1:]:
        role, _, body = piece.partition("\n")
        if not body.endswith(END + "\n"):
            raise ValueError("not a formatted conversation")
        turns.append((unescape_role(role), unescape(body[: -len(END) - 1])))
    return turns


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
_RAW = pa.schema([("part", pa.int32()), ("formatted", pa.string()), ("loss_start", pa.list_(pa.int32())), ("loss_bytes", pa.list_(pa.int32())), ("stretch", pa.int32())])
WITH_RAW = f"{DIGEST}, part int, formatted string, loss_start array<int>, loss_bytes array<int>, stretch int"


class Digest:
    """The digests of one conversation, part by part."""

    def __init__(self, conv: int | None) -> None:
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, at: list[int], size: list[int]) -> None:
        for role, text in read_part(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        raw = formatted.encode()
        for a, n in zip(at, size, strict=True):
            text = unescape(raw[a : a + n].decode())
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(formatted)

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(conv_id, part, formatted, loss_start, loss_bytes, stretch) of each row."""
    at = [batch.schema.get_field_index(c) for c in ("conv_id", "part", "formatted", "loss_start", "loss_bytes", "stretch")]
    yield from zip(*(batch.column(i).to_pylist() for i in at), strict=True)


def _told(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose parts come one after another."""
    now: Digest | None = None
    for batch in batches:
        done = []
        for conv, _, formatted, at, size, _ in _rows(batch):
            if now is None or now.conv != conv:
                if now:
                    done.append(now.row())
                now = Digest(conv)
            now.add(formatted, at, size)
        if done:
            yield _told(done, _DIGEST)
    if now:
        yield _told([now.row()], _DIGEST)


def _digest_inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations that begin and end in this task, and the rows of others as they are: those of the first and
    the last one, which may go on elsewhere, and of any that is longer than HELD_BYTES."""
    schema = pa.schema([*_DIGEST, *_RAW])
    now: Digest | None = None
    held: list[tuple] | None = None  # the rows of the present conversation; None once they pass as they are
    size = 0

    def raw(row: tuple) -> tuple:
        return (row[0], *[None] * 5, *row[1:])

    for batch in batches:
        out = []
        for row in _rows(batch):
            if now is None or now.conv != row[0]:
                if now and held is not None:
                    out.append((*now.row(), *[None] * 5))
                held, size = None if now is None else [], 0
                now = Digest(row[0])
            if held is None:
                out.append(raw(row))
                continue
            now.add(*row[2:5])
            held.append(row)
            size += len(row[2])
            if size > HELD_BYTES:
                out += map(raw, held)
                held = None
        if out:
            yield _told(out, schema)
    if held:
        yield _told(list(map(raw, held)), schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what format_conversations gave, read from its strings and mask."""
    found = materialised(formatted.mapInArrow(_digest_inside, WITH_RAW), "digests")
    names = _DIGEST.names
    parts = found.where("formatted IS NOT NULL").select("conv_id", *_RAW.names).repartition("conv_id").sortWithinPartitions("conv_id", "stretch", "part")
    return found.where("formatted IS NULL").select(*names).union(parts.mapInArrow(_digest, DIGEST))


SQL = f"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{END}{START}assistant ok' UNION ALL SELECT -1, 1, 'assistant', '{END}{START}assistant ok'),
f AS (SELECT *, {len(START) + len(END) + 2} + length(replace(replace(replace(role, '\\', '\\\\'), chr(10), '\\n'), '|', '\\p')) + length(regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g')) AS chars FROM r)
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = F.lit(f"{END}{START}assistant ok")
    own = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    return read_back(format_conversations(rows.unionByName(own)))
