"""Quality rules: counts of words, lines and repeats, and compression bands.

The base counts words, symbols, repeated lines and words in repeated five-word windows.  Texts that pass it are
compressed with zstandard, whole and in fixed chunks of bytes, an eighth of the text each but 512 bytes at least and 4096
at most, the last of which takes what is left.  A text whose whole ratio (compressed to plain bytes) leaves the band of its length, or of whose bytes more than
CHUNK_SHARE lie in chunks that leave theirs, is rejected: below a band text repeats itself, above it is not text.

Defined results: a null or empty text has no words and fails.  Repeated rows and other columns pass unchanged, but
columns named as a result are replaced.  Texts are measured whole.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import islice

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from helicase.llm.common import by_text

LEVEL = 3
CHUNK_BYTES = (512, 4096)
CHUNK_SHARE = 0.25
#: (from so many bytes, least ratio, largest ratio): the frame's fixed costs weigh more in short texts.  The largest lie
#: between prose and base64 noise in words; below 128 bytes zstandard stores much of both plainly, so none tells them apart.
BANDS = (
    (0, 0.40, 1.50), (128, 0.25, 0.98), (144, 0.25, 0.97), (160, 0.25, 0.94), (192, 0.25, 0.89), (224, 0.25, 0.87), (256, 0.20, 0.84), (320, 0.20, 0.82),
    (384, 0.20, 0.79), (512, 0.20, 0.75), (1024, 0.15, 0.70), (4096, 0.12, 0.70), (32768, 0.08, 0.65),
)
#: Of chunks of the largest size; others have the band of their length.
CHUNK_BAND = (0.12, 0.72)
# The symbols counted.
SYMBOLS = "#*$%&|<>"

_SPACES = re.compile(r"[\x20\x09-\x0d]+")
_OTHER_SPACES = re.compile("[\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
_WORD = re.compile(r"[^\x20\x09-\x0d]")

NAMES = {
    "n_words": T.LongType(), "word_chars": T.LongType(), "n_symbols": T.LongType(), "n_dup_lines": T.LongType(), "n_repeat_words": T.LongType(),
    "base_failed": T.BooleanType(), "kept": T.BooleanType(), "ratio": T.DoubleType(), "bad_chunks": T.DoubleType(),
}


def words(text: str) -> list[str]:
    if _OTHER_SPACES.search(text):
        return [w for w in _SPACES.split(text) if w]
    return text.split()


def repeat_words(ws: list[str], size: int = 5) -> int:
    """Words that lie in a window of so many words which the text holds twice or more."""
    n = len(ws) - size + 1
    if n < 2:
        return 0
    windows = list(zip(*(islice(ws, i, None) for i in range(size)), strict=False))
    if len(set(windows)) == n:
        return 0
    times = Counter(windows)
    total, covered = 0, 0  # covered: the end of the words counted so far
    for i, w in enumerate(windows):
        if times[w] > 1:
            total += i + size - max(i, covered)
            covered = i + size
    return total


def dup_lines(text: str) -> int:
    seen: set[str] = set()
    n = 0
    for line in text.split("\n"):
        if _WORD.search(line):
            n += line in seen
            seen.add(line)
    return n


def band(size: int) -> tuple[float, float]:
    return next((lo, hi) for least, lo, hi in reversed(BANDS) if size >= least)


def _fits(chunk: bytes, by: zstandard.ZstdCompressor) -> bool:
    lo, hi = CHUNK_BAND if len(chunk) == CHUNK_BYTES[1] else band(len(chunk))
    return lo <= len(by.compress(chunk)) / len(chunk) <= hi


def compression(raw: bytes, by: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """The whole ratio, the share of bytes in chunks outside their band, and whether the text stays."""
    if not raw:
        return 0.0, 0.0, False
    ratio = len(by.compress(raw)) / len(raw)
    lo, hi = band(len(raw))
    size = min(CHUNK_BYTES[1], max(CHUNK_BYTES[0], len(raw) // 8))
    chunks = [raw[i : i + size] for i in range(0, len(raw), size)]
    bad = sum(len(c) for c in chunks if not _fits(c, by)) / len(raw)
    return ratio, bad, lo <= ratio <= hi and bad <= CHUNK_SHARE


def measure(texts: list[str]) -> list[pa.Array]:
    by = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False)
    rows = []
    for text in texts:
        ws = words(text)
        repeats = repeat_words(ws)
        failed = len(ws) < 10 or 100 * repeats > 20 * len(ws)
        ratio, bad, fits = compression(text.encode(), by)
        rows.append((len(ws), sum(map(len, ws)), sum(map(text.count, SYMBOLS)), dup_lines(text), repeats, failed, not failed and fits, ratio, bad))
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
    return [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]


def measured(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """keep's columns with the counts, ratios and verdicts."""
    keep = [c for c in keep if c not in NAMES]
    fields = [docs.schema[c] for c in keep] + [T.StructField(k, v) for k, v in NAMES.items()]
    rows = docs.select(*keep, *([] if text in keep else [text]))
    return rows.mapInArrow(by_text(measure, list(NAMES), keep, text), T.StructType(fields))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), ["doc_id"])
