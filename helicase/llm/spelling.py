"""Spelling variant grouping: words one error apart, found through forward and backward minimal acyclic automata.

Words are counted in one pass; the vocabulary is then dealt twice, by the halves of the words and of the reversed words.
A task builds, for each length of half, the minimal automaton of its words, whose states know how many words follow, so
that a path through it sums up to the word's number (its place in order).  A query walks its own first half exactly and
completes the rest with one error: a letter replaced, left out or put in.  An error in the first half is found backwards,
where the second half is walked exactly.  All queries of a task walk at once, as arrays of states.

Nothing is found twice: of several errors that lead to the same word (which of two equal neighbours is left out) the last
one in the word counts, in both directions, so each pair belongs to one place and one direction.  So only counts and each
query's best partner leave a task, never pairs.

A half that more than MOST_HALF words share is cut into blocks of words and slices of queries, every block against every
slice, so no task holds more of one half than that; the work of such a half grows with its blocks.

Defined results: a null or empty text has no words.  A null doc_id counts as the empty text in the checksum.  Repeated rows
count like others.  Words without near words, or with none of enough occurrences, have no form and are their own root.
Forms have ten times the word's occurrences, so chains of them end.  Texts are read whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helicase.llm.common import discard, materialised, shared_dir, sliced

#: Words that a task counts before it hands them on.
MOST_COUNTED = 200_000
#: Rows of the dealt vocabulary (four a word) for each task, about.
TASK_ROWS = 60_000
#: Words of one half in one automaton, at most.
MOST_HALF = 100_000
#: Queries that walk at a time.
WALKING = 20_000
# The words' letters, their least length and occurrences, how many runs lose a letter, what makes a form.
RUN = re.compile("[A-Za-zÀ-ÿ]{7,}")
LEAST_LENGTH = 7
LEAST_COUNT = 2
DIVISOR = 31
FORM_TIMES = 10
#: Rounds in which chains of forms, doubled each time, must end: occurrences are below 2 ** 63.
MOST_ROUNDS = 8

FORWARD, BACKWARD = 0, 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) from rows (doc_id, text); a word comes again whenever the task hands on what it has."""
    counts: Counter = Counter()

    def told() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        counts.clear()
        return out

    for whole in batches:
        for batch in sliced(whole, 1):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                low = text.encode().lower().decode()  # of bytes, lower() changes A to Z only
                for run, times in Counter(RUN.findall(low)).items():
                    h = zlib.crc32(run.encode(), start)
                    if h % DIVISOR == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < LEAST_LENGTH:
                            continue
                    counts[run] += times
                if len(counts) > MOST_COUNTED:
                    yield told()
    yield told()


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n of docs (doc_id, text)."""
    counts = docs.select("doc_id", "text").mapInArrow(_count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


class Automaton:
    """The minimal acyclic automaton of rows of letters (numbers from 1 on, 0 after the end), sorted and distinct.

    An edge is (letter, whether a word ends, the list of edges that follow, the rest of its own list); equal edges are one,
    so equal lists, which are the states, are one too.  Edge 0 is none, list 0 is empty.
    """

    def __init__(self, rows: np.ndarray, letters: int) -> None:
        n, width = rows.shape
        there = rows != 0
        new = np.ones_like(there)
        new[1:] = np.logical_or.accumulate(rows[1:] != rows[:-1], axis=1)
        new &= there
        lengths = there.sum(1)
        known: dict[int, int] = {}
        letter, ends, child, rest, words = ([np.zeros(1, np.int64)] for _ in range(5))
        number = np.zeros(1, np.int64)  # by edge: the words of its list from it on
        below = np.zeros(n + 1, np.int64)  # by row: the list that begins at this row a column further right
        for j in range(width - 1, -1, -1):
            at = np.flatnonzero(new[:, j])
            final = lengths[at] == j + 1
            # the list that follows begins in the same row, or in the next one if the word ends here and that goes on
            first = below[at]
            last = at[final]
            first[final] = below[last + 1] * self._goes_on(rows, lengths, last, j)
            parent = np.maximum.accumulate(np.where(new[:, j - 1], np.arange(n), 0))[at] if j else np.zeros(len(at), np.int64)
            follows = np.append(parent[1:] == parent[:-1], False)
            stops = np.flatnonzero(~follows)
            back = stops[np.searchsorted(stops, np.arange(len(at)))] - np.arange(len(at))  # edges after this one in its list
            edge = np.zeros(len(at), np.int64)
            for k in range(int(back.max(initial=-1)) + 1):
                own = np.flatnonzero(back == k)
                after = edge[own + 1] if k else np.zeros(len(own), np.int64)
                signs, inverse = np.unique(rows[at[own], j].astype(np.int64) << 55 | final[own].astype(np.int64) << 54 | first[own] << 27 | after, return_inverse=True)
                before = len(known)
                ids = np.array([known.setdefault(sign, len(known) + 1) for sign in signs.tolist()], np.int64)
                made = signs[ids > before]
                parts = made >> 55, made >> 54 & 1, made >> 27 & (1 << 27) - 1, made & (1 << 27) - 1
                for column, part in zip((letter, ends, child, rest), parts, strict=True):
                    column.append(part)
                number = np.concatenate([number, parts[1] + number[parts[2]] + number[parts[3]]])
                edge[own] = ids[inverse]
            below = np.zeros(n + 1, np.int64)
            below[at] = edge
        self.letter, self.ends, self.child, rest = (np.concatenate(c) for c in (letter, ends, child, rest))
        self.start = int(below[0])
        # by list and letter: the edge, and the words that the list's earlier edges hold
        heads = np.unique(np.concatenate([self.child, [self.start]]))
        heads = heads[heads > 0]
        self.row = np.zeros(len(self.letter), np.int64)
        self.row[heads] = np.arange(1, len(heads) + 1)
        self.edge = np.zeros((len(heads) + 1, letters + 1), np.int32)
        self.skipped = np.zeros_like(self.edge)
        lists, current, passed = np.arange(1, len(heads) + 1), heads, np.zeros(len(heads), np.int64)
        while len(current):
            self.edge[lists, self.letter[current]] = current
            self.skipped[lists, self.letter[current]] = passed
            passed = passed + self.ends[current] + number[self.child[current]]
            current = rest[current]
            alive = current > 0
            lists, current, passed = lists[alive], current[alive], passed[alive]
        self.fan = (self.edge > 0).sum(1)
        self.first = np.concatenate([[0], np.cumsum(self.fan)[:-1]])
        self.fanned = np.nonzero(self.edge)[1]  # letters, by list

    @staticmethod
    def _goes_on(rows: np.ndarray, lengths: np.ndarray, at: np.ndarray, j: int) -> np.ndarray:
        """Whether the row after each begins with the same j + 1 letters and is longer."""
        after = np.minimum(at + 1, len(rows) - 1)
        return (at + 1 < len(rows)) & (lengths[after] > j + 1) & (rows[after, : j + 1] == rows[at, : j + 1]).all(1)

    def step(self, state: np.ndarray, ended: np.ndarray, number: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Whether there is an edge with that letter; the state after it, whether a word ends there, and the words before."""
        row = self.row[state]
        edge = self.edge[row, letter]
        return edge > 0, self.child[edge], self.ends[edge], number + ended + self.skipped[row, letter]


def near(automaton: Automaton, queries: np.ndarray, depth: int, way: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, word's number) of words that share depth letters with the query and differ by one error after them."""
    lengths = (queries != 0).sum(1)
    padded = np.concatenate([queries, np.zeros((len(queries), 2), queries.dtype)], axis=1)
    who = np.arange(len(queries))
    state, ended, number = np.full(len(queries), automaton.start), np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def complete(who: np.ndarray, state: np.ndarray, ended: np.ndarray, number: np.ndarray, at: np.ndarray) -> None:
        """Walks what is left of the queries exactly and keeps the words that end there."""
        while len(who):
            done = at == lengths[who]
            hits = done & (ended > 0)
            found.append((who[hits], number[hits]))
            who, state, ended, number, at = (x[~done] for x in (who, state, ended, number, at))
            alive, state, ended, number = automaton.step(state, ended, number, padded[who, at])
            who, state, ended, number, at = who[alive], state[alive], ended[alive], number[alive], at[alive] + 1

    for j in range(int(lengths.max(initial=0)) + 1):
        if j >= depth:
            here, before, after = padded[who, j], padded[who, j - 1], padded[who, j + 1]
            rows = automaton.row[state]
            fan = automaton.fan[rows]
            each = np.repeat(np.arange(len(who)), fan)
            letter = automaton.fanned[np.repeat(automaton.first[rows], fan) + np.arange(len(each)) - np.repeat(np.cumsum(fan) - fan, fan)]
            _, *taken = automaton.step(state[each], ended[each], number[each], letter)
            # put in: the same as putting it in after an equal letter
            ok = letter != (here if way == FORWARD else before)[each]
            ok &= j > depth if way == BACKWARD else True
            complete(who[each][ok], *(x[ok] for x in taken), np.full(int(ok.sum()), j))
            # replaced
            ok = (letter != here[each]) & (here[each] > 0)
            complete(who[each][ok], *(x[ok] for x in taken), np.full(int(ok.sum()), j + 1))
            # left out: the same as leaving out an equal letter after it
            ok = (here > 0) & (here != (after if way == FORWARD else before))
            complete(who[ok], state[ok], ended[ok], number[ok], np.full(int(ok.sum()), j + 1))
        alive, state, ended, number = automaton.step(state, ended, number, padded[who, j])
        who, state, ended, number = who[alive], state[alive], ended[alive], number[alive]
    return np.concatenate([f[0] for f in found] or [who]), np.concatenate([f[1] for f in found] or [who])


def _search(way: int, depth: int, texts: np.ndarray, n: np.ndarray, held: np.ndarray, asks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(word, n_near, near_n, near_word) of the asking texts among the held ones, all with that depth and way."""
    points = texts.view(np.uint32).reshape(len(texts), -1)
    alphabet = np.unique(points[points > 0])
    letters = np.where(points > 0, np.searchsorted(alphabet, points) + 1, 0).astype(np.uint8 if len(alphabet) < 255 else np.uint16)
    own = np.flatnonzero(held)
    own = own[np.argsort(texts[own], kind="stable")]
    own = own[np.concatenate([[True], texts[own][1:] != texts[own][:-1]])] if len(own) else own
    asking = np.flatnonzero(asks)
    if not len(own) or not len(asking):
        return
    automaton = Automaton(letters[own], len(alphabet))
    words = [w if way == FORWARD else w[::-1] for w in texts[own].tolist()]
    order = np.empty(len(own), np.int64)  # by number: the place of the word itself
    order[np.argsort(np.array(words), kind="stable")] = np.arange(len(own))
    counted = n[own]
    for at in range(0, len(asking), WALKING):
        part = asking[at : at + WALKING]
        who, number = near(automaton, letters[part], depth, way)
        if not len(who):
            continue
        by = np.lexsort((order[number], -counted[number], who))
        who, number = who[by], number[by]
        first = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
        times = np.diff(np.append(first, len(who)))
        told = [w if way == FORWARD else w[::-1] for w in texts[part[who[first]]].tolist()]
        best = number[first]
        columns = pa.array(told, pa.string()), pa.array(times, pa.int64()), pa.array(counted[best], pa.int64()), pa.array([words[i] for i in best.tolist()], pa.string())
        yield pa.RecordBatch.from_arrays(list(columns), names=["word", "n_near", "near_n", "near_word"])


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a task's rows (way, depth, text, n, held, asks, block, slice) find among each other."""
    table = pa.Table.from_batches([b for b in batches if b.num_rows] or [])
    if not table.num_rows:
        return
    way, depth, n, held, asks, block, piece = (table[c].to_numpy() for c in ("way", "depth", "n", "held", "asks", "block", "slice"))
    texts = np.array(table["text"].to_pylist())
    cells = np.stack([way, depth, block, piece], axis=1).astype(np.int64)
    kinds, inverse = np.unique(cells, axis=0, return_inverse=True)
    inverse = inverse.ravel()
    for i, (w, d, _, _) in enumerate(kinds.tolist()):
        own = np.flatnonzero(inverse == i)
        yield from _search(w, d, np.ascontiguousarray(texts[own]), n[own], held[own], asks[own])


def _halves(word: Column) -> Column:
    """Structs (way, depth, text, asks): where a word is held, and of them those where it asks."""
    size, reverse = F.char_length(word), F.reverse(word)
    half = lambda n: F.floor(n / 2).cast("int")
    place = lambda way, depth, asks: F.struct(F.lit(way).alias("way"), depth.alias("depth"), (word if way == FORWARD else reverse).alias("text"), asks.alias("asks"))
    yes, no = F.lit(True), F.lit(False)
    odd = size % 2 == 1
    # queries are one letter shorter, as long, or one longer, so that two depths hold all that can find the word
    return F.array(
        place(FORWARD, half(size), yes), place(FORWARD, F.when(odd, half(size + 1)).otherwise(half(size - 1)), no),
        place(BACKWARD, half(size + 1), yes), place(BACKWARD, F.when(odd, half(size)).otherwise(half(size + 2)), no),
    )


def dealt(words: DataFrame, n_words: int) -> DataFrame:
    """The rows that tasks search, dealt by way, depth, half, block and slice."""
    rows = words.select("n", F.explode(_halves(F.col("word"))).alias("p")).select("p.way", "p.depth", "p.text", "n", "p.asks")
    rows = rows.withColumn("head", F.substring("text", F.lit(1), F.col("depth")))
    keys = ["way", "depth", "head"]
    blocks = F.lit(1)
    if n_words > MOST_HALF:  # else no half can hold so many
        large = rows.groupBy(*keys).count().where(F.col("count") > MOST_HALF).select(*keys, F.ceil(F.col("count") / MOST_HALF).cast("int").alias("blocks"))
        large = materialised(large, "halves")
        if n_large := large.count():
            rows = rows.join(F.broadcast(large) if n_large <= 100_000 else large, keys, "left")
            blocks = F.coalesce("blocks", F.lit(1))
    rows = rows.withColumn("blocks", blocks)
    at = lambda seed: F.pmod(F.xxhash64("text", F.lit(seed)), F.col("blocks")).cast("int")
    cell = lambda block, piece, held, asks: F.struct(block.alias("block"), piece.alias("slice"), held.alias("held"), asks.alias("asks"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    one = F.array(cell(F.lit(0), F.lit(0), F.lit(True), F.col("asks")))
    many = F.concat(
        F.transform(every, lambda s: cell(at("block"), s, F.lit(True), F.lit(False))),
        F.when(F.col("asks"), F.transform(every, lambda b: cell(b, at("slice"), F.lit(False), F.lit(True)))).otherwise(F.array().cast("array<struct<block:int,slice:int,held:boolean,asks:boolean>>")),
    )
    rows = rows.withColumn("c", F.explode(F.when(F.col("blocks") == 1, one).otherwise(many)))
    rows = rows.select("way", "depth", "text", "n", "c.held", "c.asks", "c.block", "c.slice", "head")
    tasks = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-4 * n_words // TASK_ROWS))
    return rows.repartition(tasks, *keys, "block", "slice").drop("head")


def grouped(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of docs (doc_id, text)."""
    spark = docs.sparkSession
    words = materialised(vocabulary(docs), "words")
    found = dealt(words, words.count()).mapInArrow(_found, "word string, n_near bigint, near_n bigint, near_word string")
    rows = words.select("word", "n", F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast("bigint").alias("near_n"), F.lit(None).cast("string").alias("near_word"))
    rows = rows.unionByName(found.withColumn("n", F.lit(None).cast("bigint")))
    best = F.min(F.when(F.col("near_n").isNotNull(), F.struct((-F.col("near_n")).alias("less"), F.col("near_word").alias("form"))))
    rows = rows.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= F.col("n") * FORM_TIMES
    rows = rows.select("word", "n", "n_near", F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"))
    rows = materialised(rows, "forms")
    return rows.join(roots(rows), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(rows: DataFrame) -> DataFrame:
    """word, root of the words that have a form: chains of forms, doubled until none goes on."""
    spark = rows.sparkSession
    path = shared_dir(spark, "roots")
    links = materialised(rows.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots", path)
    for _ in range(MOST_ROUNDS):
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if links.join(further, "root", "left_semi").isEmpty():
            return links
        last, path = path, shared_dir(spark, "roots")
        links = materialised(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots", path)
        discard(spark, last)
    raise RuntimeError("chains of forms did not end")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


SQL = f"""
WITH RECURSIVE
t AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT) ORDER BY i) AS tbl FROM range(256) r(i)),
r AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' AS start, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]{{7,}}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
c AS (SELECT start, run, count(*) AS k FROM r GROUP BY ALL),
h AS (
  SELECT run, k, xor(list_reduce(flatten(list_transform(string_split(start || run, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195, unicode(x)::BIGINT - 64] END)),
    lambda c, b: xor(c >> 8, tbl[1 + (xor(c, b) & 255)]), 4294967295), 4294967295) AS h
  FROM c, t),
w AS (SELECT CASE WHEN h % {DIVISOR} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM h),
v AS (SELECT word, sum(k)::BIGINT AS n FROM w WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(k) >= {LEAST_COUNT}),
d AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
p AS (
  SELECT a.word, b.word AS other, b.n FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT d.word, v.word, v.n FROM d JOIN v ON d.rest = v.word
  UNION SELECT v.word, d.word, d.n FROM d JOIN v ON d.rest = v.word),
b AS (SELECT word, count(*) AS n_near, min({{'less': -n, 'form': other}}) AS best FROM p GROUP BY word),
f AS (
  SELECT v.word, v.n, coalesce(b.n_near, 0)::BIGINT AS n_near, CASE WHEN -best.less >= {FORM_TIMES} * v.n THEN best.form END AS form, CASE WHEN -best.less >= {FORM_TIMES} * v.n THEN -best.less END::BIGINT AS form_n
  FROM v LEFT JOIN b ON v.word = b.word),
s AS (SELECT word, word AS root FROM f UNION ALL SELECT s.word, f.form FROM s JOIN f ON s.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, s.root, f.n, f.n_near, f.form_n FROM f JOIN s ON f.word = s.word JOIN f g ON s.root = g.word AND g.form IS NULL
"""
