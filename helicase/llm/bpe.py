"""BPE encoding and decoding.

Symbols of a word stand in a doubly linked list; a priority queue holds merges by rank and place, entries whose
symbols have changed since are stale and skipped.  Decoding concatenates vocabulary strings, a space between, as the
tokenizers library does for a file without a decoder.

Normalising, splitting and merging never cross white space, so results are kept by white-space-free chunk in a
memory of two generations of CACHE_ENTRIES in each Python worker; another one holds words, which
chunks of other case and punctuation share.  Texts with special tokens or with the separators U+001C to
U+001F, which Python but not the file's pattern calls white space, are cut with patterns first; results are the same.

Defined results: a null or empty text has no tokens.  Repeated rows and other columns pass unchanged, but columns
named as a result are replaced.  Texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from helicase.llm.common import SLICE_BYTES, by_text

VOCABULARY = "word_bpe_49k.json"
#: Entries that a generation of a memory holds: a full one replaces the one before, and what is used moves on.
CACHE_ENTRIES = 120_000
#: Places that a queue entry has room for.
MOST_SYMBOLS = 1 << 28
#: Longer chunks and words are not remembered.
LONGEST_KEPT = 64


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Tokenizer:
    """Encoder and decoder for a file of the tokenizers library with the parts that word_bpe_49k.json has."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        #: By pair of symbols, left << 16 | right: rank << 44 | the symbol that it becomes.
        self.merges: dict[int, int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges[self.vocab[a] << 16 | self.vocab[b]] = rank << 44 | self.vocab[a + b]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        split = next(x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.word = regex.compile(split)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")")
        self.space = regex.compile(r"\p{White_Space}+")
        #: Ids of a byte inside a word and at its end; a symbol that the vocabulary lacks (None) is left out.
        self.inner = [self.vocab.get(c) for c in byte_symbols()]
        self.final = [self.vocab.get(c + self.suffix) for c in byte_symbols()]
        self.complete = None not in self.inner and None not in self.final
        #: Ids by chunk and by word, a character for each id: short strings are the smallest objects for that.
        self.memory: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.words: dict[str, str] = {}
        self.older_words: dict[str, str] = {}
        if max(self.strings) >= 0xD800:
            raise ValueError("ids do not fit characters")
        self.string_of = {chr(i): s for i, s in self.strings.items()}
        self.number_of = {chr(i): str(i) for i in self.strings}

    def merge(self, symbol: list[int]) -> list[int]:
        """Merges by rank, the leftmost of equals first.  Queue entries are rank << 44 | place << 16 | new symbol."""
        n, get = len(symbol), self.merges.get
        if n > MOST_SYMBOLS:
            raise ValueError("a word has too many symbols")
        queue = [found + (i << 16) for i, (a, b) in enumerate(zip(symbol, symbol[1:], strict=False)) if (found := get(a << 16 | b)) is not None]
        if not queue:
            return symbol
        heapq.heapify(queue)
        left, right = [*range(-1, n - 1)], [*range(1, n), -1]
        pop, push = heapq.heappop, heapq.heappush
        while queue:
            entry = pop(queue)
            i, new = entry >> 16 & 0xFFFFFFF, entry & 0xFFFF
            a, j = symbol[i], right[i]
            if a < 0 or j < 0:
                continue
            now = get(a << 16 | symbol[j])
            if now is None or now & 0xFFFF != new:
                continue
            symbol[i], symbol[j] = new, -1
            right[i] = k = right[j]
            if k >= 0:
                left[k] = i
                if (found := get(new << 16 | symbol[k])) is not None:
                    push(queue, found + (i << 16))
            h = left[i]
            if h >= 0 and (found := get(symbol[h] << 16 | new)) is not None:
                push(queue, found + (h << 16))
        return [s for s in symbol if s >= 0]

    def word_ids(self, word: str) -> str:
        """Ids of a normalised word, as characters."""
        found = self.older_words.get(word)
        if found is None:
            raw, inner = word.encode(), self.inner
            symbols = [inner[b] for b in raw]
            symbols[-1] = self.final[raw[-1]]
            if not self.complete:
                symbols = [i for i in symbols if i is not None]
            found = "".join(map(chr, self.merge(symbols)))
        if len(self.words) >= CACHE_ENTRIES:
            self.older_words, self.words = self.words, {}
        if len(word) <= LONGEST_KEPT:
            self.words[word] = found
        return found

    def chunk(self, chunk: str) -> str:
        """Ids of a chunk without white space, as characters."""
        found = self.older.get(chunk)
        if found is None:
            text = chunk if chunk.isascii() else unicodedata.normalize("NFC", chunk)
            text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
            if text.isalpha():  # the same as the pattern finds, without it
                words = (text,)
            elif text[-1] in ".,;:!?" and text[:-1].isalpha():
                words = (text[:-1], text[-1])
            else:
                words = self.word.findall(text)
            found = "".join([self.words.get(w) or self.word_ids(w) for w in words])
        if len(self.memory) >= CACHE_ENTRIES:
            self.older, self.memory = self.memory, {}
        if len(chunk) <= LONGEST_KEPT:
            self.memory[chunk] = found
        return found

    def ids(self, text: str) -> str:
        """The text's ids, as characters."""
        plain = not any("\x1c" <= c <= "\x1f" for c in set(text))
        out = []
        for i, part in enumerate(self.cut.split(text)):
            if i % 2:
                out.append(chr(self.special[part]))
            else:
                chunks = part.split() if plain else [c for c in self.space.split(part) if c]
                out += [self.memory.get(c) or self.chunk(c) for c in chunks]
        return "".join(out)

    def encode(self, text: str) -> list[int]:
        return [*map(ord, self.ids(text))]

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.strings[i] for i in ids if i in self.strings)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


#: Text bytes that are encoded at a time where ids or decoded texts leave.
STEP_BYTES = 2 << 20


def encoder(path: str, what: tuple[str, ...]) -> Callable[[list[str]], list[pa.Array]]:
    def run(texts: list[str]) -> list[pa.Array]:
        of = tokenizer(path)
        out: dict[str, list] = {k: [] for k in what}
        for text in texts:
            ids = of.ids(text)
            if "ids" in out:
                out["ids"].append(np.frombuffer(ids.encode("utf-16-le"), np.uint16).astype(np.int32))
            if "n_tokens" in out:
                out["n_tokens"].append(len(ids))
            if "ids_sha256" in out:
                out["ids_sha256"].append(hashlib.sha256(" ".join(map(of.number_of.__getitem__, ids)).encode()).hexdigest())
            if "decoded" in out or "decoded_sha256" in out:
                decoded = " ".join(map(of.string_of.__getitem__, ids))
                if "decoded" in out:
                    out["decoded"].append(decoded)
                if "decoded_sha256" in out:
                    out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
        kinds = {"n_tokens": pa.int64()}
        return [_lists(v) if k == "ids" else pa.array(v, kinds.get(k, pa.string())) for k, v in out.items()]

    return run


def _lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32)))


KINDS = {"n_tokens": T.LongType(), "ids": T.ArrayType(T.IntegerType())}


def encode(docs: DataFrame, path: str, what: tuple[str, ...] = ("n_tokens", "ids"), keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """docs with columns of: n_tokens, ids, decoded (from the ids' strings), ids_sha256, decoded_sha256.

    keep: columns of docs that stay (all but the text if None).
    """
    keep = [c for c in (keep if keep is not None else [c for c in docs.columns if c != text]) if c not in what]
    fields = [docs.schema[c] for c in keep] + [T.StructField(k, KINDS.get(k, T.StringType())) for k in what]
    rows = docs.select(*keep, *([text] if text not in keep else []))
    step = STEP_BYTES if {"ids", "decoded"} & {*what} else SLICE_BYTES
    return rows.mapInArrow(by_text(encoder(path, what), list(what), keep, text, step), T.StructType(fields))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, public_tokenizers.path(VOCABULARY), ("n_tokens", "ids_sha256", "decoded_sha256"))
