"""Secret scans: patterns, and password guess costs by dynamic programming.

Three patterns find assignments, access keys and long hex strings.  Beside them every value in a credential context
(``pwd:``, ``auth = ``, ``password=`` ...) is segmented at least cost into dictionary words, dates, repeats,
keyboard walks, sequences and brute-force spans; a value whose cheapest segmentation still needs 10**MIN_GUESSES
guesses is a secret, even where no pattern knows its form or all of it.  The dictionary ranks words frequent in
passwords, then the words of a public tokenizer's vocabulary in its order, which follows frequency.

Defined results: a null or empty text has no spans.  Spans are code points, end exclusive, of the whole match.  Spans
of the method never overlap those of the patterns or each other: of a value that patterns cover in part, the rest.  Repeated rows and other columns pass unchanged, but
columns named as a result are replaced.  Texts are scanned and values segmented whole, in time linear in their length:
segments other than repeats are bounded in length, and one pass from a value's end gives the cost of all its tails.  A
repeat is of a unit of up to MOST_UNIT characters, taken as often as it stands there or, up to MOST_COPIES times, less often.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from functools import lru_cache, partial

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from helicase.llm.common import by_text

KINDS = ("assign", "access", "hex", "guess")
#: Log10 of the guesses from which a value in a credential context counts as secret.
MIN_GUESSES = 10.0
#: File of public_tokenizers whose vocabulary is the dictionary where no path is given.
VOCABULARY = "word_bpe_49k.json"
#: Characters of a keyboard walk or sequence, at most; a longer one is several.
MOST_WALK = 32
#: Characters of a repeated unit, at most.
MOST_UNIT = 16
#: Copies of a unit up to which fewer of them are tried too.
MOST_COPIES = 16
#: Values up to this length are remembered.
LONGEST_KEPT = 64

ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
#: Every assignment has one of these in lower case.
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Names of credential fields; those of the assignment pattern count inside longer names too, as there.
ASSIGN_NAMES = ("password", "passwd", "secret", "token", "api_?key")
CONTEXT_NAMES = ("passphrase", "passcode", "pass", "pwd", "pin", "auth", "authorization", "bearer", "credential", "credentials", "login", "private_key", "access_key", "client_key", "session_key", "signature")
CONTEXT = re.compile(r"""(?:%s|(?<![a-z0-9])(?:%s))["']?\x20*[:=]\x20*["']?(?=[^\s"'<>,;]{6})""" % ("|".join(ASSIGN_NAMES), "|".join(CONTEXT_NAMES)), re.I | re.A)
VALUE = re.compile(r"""[^\s"'<>,;]+""", re.A)

# Frequent words in passwords, most frequent first.
WORDS = (
    "password", "qwerty", "dragon", "monkey", "letmein", "login", "princess", "master", "welcome", "shadow", "sunshine",
    "football", "baseball", "iloveyou", "admin", "secret", "summer", "winter", "spring", "autumn", "michael", "jordan",
    "superman", "batman", "trustno", "hunter", "killer", "soccer", "charlie", "freedom", "whatever", "access", "flower",
    "cheese", "computer", "internet", "hello", "love", "test", "user", "root", "guest", "default", "changeme", "pass",
    "home", "house", "horse", "battery", "staple", "correct", "money", "happy", "purple", "orange", "yellow", "green",
    "blue", "black", "white", "red", "silver", "golden", "tiger", "eagle", "falcon", "wizard", "star", "moon", "sun",
    "angel", "baby", "the", "and", "you", "for", "that", "with", "this", "from", "have", "not", "are", "was", "his",
    "her", "all", "one", "new", "man", "day", "get", "use", "way", "may", "say", "she", "how", "its", "our", "two",
    "key", "token", "value", "example", "sample", "string", "number", "name", "word", "code", "data", "none", "null",
)
# Characters that stand for letters.
LEET = str.maketrans("4301!5$7@", "aeolissta")
# Keyboard rows.
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
NEXT = {a + b for row in ROWS for s in (row, row[::-1]) for a, b in zip(s, s[1:], strict=False)}
DATE = re.compile(r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d")
YEAR = re.compile(r"(?:19|20)\d\d")
#: What each further segment costs: an attacker must guess where it ends.
CUT = 0.3


def _brute(c: str) -> float:
    if c.isdigit():
        return 1.0
    if c.isalpha():
        return math.log10(26) if c.islower() else math.log10(52)
    return math.log10(33) if c < "\x80" else 2.0


@lru_cache(maxsize=4)
def dictionary(vocabulary: str | None = None) -> tuple[dict[str, int], int]:
    """Ranks of words from 1 on, and the length of the longest."""
    with open(vocabulary or public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
        model = json.load(f)["model"]
    end = model.get("end_of_word_suffix") or ""
    ranks = {w: i + 1 for i, w in enumerate(WORDS)}
    for token, _ in sorted(model["vocab"].items(), key=lambda x: x[1]):
        word = token[: len(token) - len(end)]
        if token.endswith(end) and len(word) >= 3 and word.isascii() and word.isalpha() and word.islower():
            ranks.setdefault(word, len(ranks) + 1)
    return ranks, max(map(len, ranks))


def costs(value: str, vocabulary: str | None = None) -> list[float]:
    """From each place of the value: log10 of the guesses that the cheapest segmentation of the rest needs."""
    ranks, longest = dictionary(vocabulary)
    n = len(value)
    low = value.lower() if value.isascii() else "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    plain = low.translate(LEET)
    brute = [math.inf] * (n + 1)  # of the rest if it begins with a brute-force span
    known = [math.inf] * (n + 1)  # if it begins with a segment of a known kind
    rest = [0.0] * (n + 1)  # the cheaper one, with the cut before it
    same = [0] * (MOST_UNIT + 1)  # by period: how many characters from here on equal the one a period later
    walk, sequence, step = 0, 0, 0  # steps of the keyboard walk and of the sequence from here on, and its direction
    for i in range(n - 1, -1, -1):
        least = math.inf
        for j in range(i + 3, min(n, i + longest) + 1):
            rank, more = ranks.get(low[i:j]), 0.0
            if rank is None:
                rank, more = ranks.get(plain[i:j]), 0.6
            if rank is not None:
                case = 0.0 if value[i:j] == low[i:j] else 0.3 if value[i + 1 : j] == low[i + 1 : j] else 1.0
                least = min(least, math.log10(rank + 1) + more + case + rest[j])
        for pattern, cost in ((DATE, math.log10(365 * 120)), (YEAR, math.log10(120))):
            if m := pattern.match(value, i):
                least = min(least, cost + rest[m.end()])
        for p in range(1, min(MOST_UNIT, n - i - 1) + 1):
            same[p] = same[p] + 1 if value[i] == value[i + p] else 0
            if same[p] >= p:
                unit, most = _small(value[i : i + p], vocabulary), 1 + same[p] // p
                for copies in (*range(2, min(most, MOST_COPIES + 1)), most):
                    if copies * p >= 3:
                        least = min(least, unit + math.log10(copies + 1) + rest[i + copies * p])
        if i + 1 < n:
            walk = min(walk + 1, MOST_WALK - 1) if low[i : i + 2] in NEXT else 0
            now = ord(low[i + 1]) - ord(low[i])
            if abs(now) != 1 or not (low[i].isalnum() and low[i + 1].isalnum()):
                sequence, step = 0, 0
            else:
                sequence, step = (min(sequence + 1, MOST_WALK - 1), step) if now == step else (1, now)
            for steps, cost in ((walk, 1.7), (sequence, 1.3)):
                for k in range(2, steps + 1):
                    least = min(least, cost + math.log10(k + 1) + rest[i + k + 1])
        known[i] = least
        brute[i] = _brute(value[i]) + (min(brute[i + 1], CUT + known[i + 1]) if i + 1 < n else 0.0)
        rest[i] = CUT + min(brute[i], known[i])
    return [min(b, k) for b, k in zip(brute[:n], known[:n], strict=True)]


@lru_cache(maxsize=20_000)
def _small(value: str, vocabulary: str | None) -> float:
    return costs(value, vocabulary)[0]


def guesses(value: str, vocabulary: str | None = None) -> float:
    """Log10 of the guesses that the cheapest segmentation needs; 0 for an empty value."""
    if not value:
        return 0.0
    return _small(value, vocabulary) if len(value) <= LONGEST_KEPT else costs(value, vocabulary)[0]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the patterns' matches, in order."""
    found = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _union(found: list[tuple[int, int, int]]) -> list[list[int]]:
    """Disjoint [start, end] that cover the same, in order."""
    out: list[list[int]] = []
    for a, _, b in found:
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def guessed_spans(text: str, base: list[tuple[int, int, int]], least: float = MIN_GUESSES, vocabulary: str | None = None) -> list[tuple[int, int, int]]:
    """Spans of values in a credential context that need 10**least guesses, without what base covers of them."""
    found = []
    if ":" not in text and "=" not in text:
        return found
    covered, c = _union(base), 0
    tails, begin, end = [], 0, -1  # costs of the last value's tails, and where it lies
    m = CONTEXT.search(text)
    while m:
        at = m.end()
        if at >= end:
            begin, end = VALUE.match(text, at).span()
            tails = costs(text[begin:end], vocabulary) if end - begin > LONGEST_KEPT else None
        cost = tails[at - begin] if tails else _small(text[at:end], vocabulary)
        if cost < least:
            m = CONTEXT.search(text, at)  # a cheap value may be the next field's name
            continue
        while c < len(covered) and covered[c][1] <= at:
            c += 1
        while c < len(covered) and covered[c][0] < end:
            a, b = covered[c]
            if a > at:
                found.append((at, 3, a))
            at = max(at, b)
            if b > end:
                break
            c += 1
        if at < end:
            found.append((at, 3, end))
        m = CONTEXT.search(text, end)
    return found


def spans(text: str, least: float = MIN_GUESSES, vocabulary: str | None = None) -> list[tuple[int, int, int]]:
    base = base_spans(text)
    return sorted(base + guessed_spans(text, base, least, vocabulary))


def told(found: list[tuple[int, int, int]]) -> str:
    return ",".join([f"{KINDS[k]}:{a}:{b}" for a, k, b in found])


def redact(text: str, found: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the first names the whole."""
    out, at = [], 0
    for a, k, b in found:
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _scan(texts: list[str], vocabulary: str | None = None) -> list[pa.Array]:
    found = [spans(t, vocabulary=vocabulary) for t in texts]
    base = [[s for s in f if s[1] < 3] for f in found]
    counts = [pa.array([sum(s[1] == k for s in f) for f in base], pa.int64()) for k in range(3)]
    digests = [hashlib.sha256(told(f).encode()).hexdigest() for f in base]
    return [*counts, pa.array(digests), pa.array([told(f) for f in found])]


def _redacted(texts: list[str], vocabulary: str | None = None) -> list[pa.Array]:
    return [pa.array([redact(t, spans(t, vocabulary=vocabulary)) for t in texts], pa.string())]


def scan(docs: DataFrame, keep: list[str], text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """keep's columns with n_assign, n_access, n_hex, base_sha256 and spans; vocabulary: a path that all executors have."""
    names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    keep = [c for c in keep if c not in names]
    fields = [docs.schema[c] for c in keep] + [T.StructField(n, T.LongType() if n[:2] == "n_" else T.StringType()) for n in names]
    rows = docs.select(*keep, *([] if text in keep else [text]))
    return rows.mapInArrow(by_text(partial(_scan, vocabulary=vocabulary), names, keep, text), T.StructType(fields))


def redacted(docs: DataFrame, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """docs with every secret in the text replaced by a mark; null texts become empty."""
    keep = [c for c in docs.columns if c != text]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(text, T.StringType())])
    return docs.mapInArrow(by_text(partial(_redacted, vocabulary=vocabulary), [text], keep, text), schema).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), ["doc_id"])
