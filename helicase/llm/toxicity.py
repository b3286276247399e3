"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols: insult or threat (with a weight), target, negation, contrast, reporting, or none; a tick follows
each word; quotation opens before a word and closes after one, as its marks stand.  Six weighted transducers read them: insults and threats emit matches; targets scale a match by whether one
stands near it, before or after (then a path awaits it); negations scale every match up to the clause's end or a
contrast; reporting verbs open reported speech up to the clause's end, marks up to the closing one, over clauses too; the last one counts a clause's strongest match
whole and a share of the others.  They are composed once; a clause scores its best path, the sum of its matches times
their factors.  A text sums its different words, each at its best (repeated lines add nothing), and a logistic curve
turns sums into scores.

Lexicon and curve are learned from labelled rows: insults from words and word beginnings that toxic texts hold far
more often than clean ones, counted in a distributed pass over at most MOST_LABELLED labelled rows (those of least
hash); a short fixed list is their prior.  No label, language, source or number enters a score.

Defined results: a null or empty text scores by its empty sum.  Repeated rows and other columns pass unchanged, but
columns named as a result are replaced.  Texts are read whole.  Without labelled rows of both kinds the prior alone
decides.  A null doc_id counts as the empty text where labels are split.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helicase.llm.common import by_text, materialised, sliced

#: Different labelled texts that the lexicon and the curve are learned from, at most.
MOST_LABELLED = 20_000
#: Features that a task keeps before it hands counts on.
MOST_COUNTED = 150_000
BEGINNINGS = (4, 5, 6)
#: Natural log of how much more often toxic texts must hold an entry; entries near it weigh little, and only several tell.
LEAST_ODDS = 1.5
#: Log likelihood ratio against chance that an entry must reach, so that rare words of few toxic texts stay out.
LEAST_EVIDENCE = 13.0
MEMORY = 150_000

# Prior lexicon and the words of the other classes, in four languages.
INSULTS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "clown", "pathetic", "worthless", "disgusting", "imbecile", "bastard", "dumb", "filth", "vermin", "idiota", "imbécile", "dummkopf", "abschaum", "crétin", "estúpido", "basura")
THREATS = ("kill", "hurt", "destroy", "crush", "beat", "burn", "hang", "shoot", "töten", "tuer", "matar", "vernichten", "détruire", "destruir")
TARGETS = ("you", "your", "you're", "they", "them", "he", "she", "him", "her", "this", "these", "those", "all", "du", "dich", "ihr", "euch", "sie", "tu", "toi", "vous", "ils", "elles", "tú", "ustedes", "ellos", "ellas")
NEGATIONS = ("not", "no", "never", "isn't", "aren't", "don't", "wasn't", "nicht", "kein", "keine", "nie", "pas", "jamais", "nunca", "jamás")
REPORTS = ("said", "says", "say", "wrote", "called", "quoted", "claimed", "sagte", "schrieb", "dit", "écrit", "dijo", "escribió")
CONTRASTS = ("but", "however", "aber", "sondern", "mais", "pero", "sino")

TICK, INSULT, THREAT, TARGET, NEGATION, REPORT, CONTRAST, OPEN, CLOSE = range(9)
FIXED = {w: c for c, ws in ((CONTRAST, CONTRASTS), (REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS), (THREAT, THREATS)) for w in ws}
#: How near a target must be (words).
NEAR = 4
NEGATED, REPORTED, TARGETED, FURTHER = 0.3, 0.5, 1.25, 0.5
#: A threat counts only with a target.
THREAT_WEIGHT = 2.0

#: A transducer: by state and symbol the arcs (next state, factor), and the final states.  It starts in state 0; symbols
#: without arcs leave the state as it is; a state that is not final must be left.
Arcs = dict[tuple[int, int], list[tuple[int, float]]]
Transducer = tuple[Arcs, set[int]]


def _targets() -> Transducer:
    """State k > 0: a target stood so near that k - 1 more words may follow; -k: one must come within k - 1 words."""
    reach = NEAR + 1
    arcs: Arcs = {(0, INSULT): [(0, 1.0), (-reach, TARGETED)], (0, THREAT): [(-reach, 1.0)], (0, TARGET): [(reach, 1.0)]}
    arcs[0, THREAT].append((0, 0.0))
    for k in range(1, reach + 1):
        arcs |= {(k, INSULT): [(k, TARGETED)], (k, TARGET): [(reach, 1.0)], (k, TICK): [(k - 1, 1.0)]}
        arcs |= {(-k, INSULT): [(-k, TARGETED)], (-k, TARGET): [(reach, 1.0)], (-k, TICK): [(1 - k, 1.0)] if k > 1 else []}
    return arcs, set(range(reach + 1))


#: Insult, threat, target, negation, reported speech, and which match counts whole.
GRAMMAR: tuple[Transducer, ...] = (
    ({(0, INSULT): [(0, 1.0)]}, {0}),
    ({(0, THREAT): [(0, THREAT_WEIGHT)]}, {0}),
    _targets(),
    ({(0, NEGATION): [(1, 1.0)], (1, CONTRAST): [(0, 1.0)], (1, INSULT): [(1, NEGATED)], (1, THREAT): [(1, NEGATED)]}, {0, 1}),
    (
        {(0, REPORT): [(1, 1.0)], (0, OPEN): [(2, 1.0)], (1, OPEN): [(2, 1.0)], (2, CLOSE): [(0, 1.0)]}
        | {(q, c): [(q, REPORTED)] for q in (1, 2) for c in (INSULT, THREAT)}, {0, 1, 2},
    ),
    ({(0, c): [(1, 1.0), (0, FURTHER)] for c in (INSULT, THREAT)} | {(1, c): [(1, FURTHER)] for c in (INSULT, THREAT)}, {0, 1}),
)


def composed(parts: tuple[Transducer, ...]) -> tuple[list[list[list[tuple[int, float]]]], list[bool]]:
    """Their composition over common symbols: by state and symbol the arcs, and which states are final."""
    number = {(0,) * len(parts): 0}
    arcs, states = [], [(0,) * len(parts)]
    for state in states:
        by_symbol = []
        for symbol in range(CLOSE + 1):
            ways: list[tuple[tuple[int, ...], float]] = [((), 1.0)]
            for (own, _), q in zip(parts, state, strict=True):
                ways = [((*to, q2), f * f2) for to, f in ways for q2, f2 in own.get((q, symbol), [(q, 1.0)])]
            for to, _ in ways:
                if to not in number:
                    number[to] = len(states)
                    states.append(to)
            by_symbol.append([(number[to], f) for to, f in ways])
        arcs.append(by_symbol)
    return arcs, [all(q in final for q, (_, final) in zip(state, parts, strict=True)) for state in states]


ARCS, FINAL = composed(GRAMMAR)

_EDGE = re.compile(r"^[^\w]+|[^\w]+$")


def bare(word: str) -> str:
    return _EDGE.sub("", word.lower())


# Marks of quotation; where a mark stands in its word tells whether it opens or closes.
_MARKS = re.compile('["“”„«»]')
_BEFORE, _AFTER = re.compile(r"^\W*"), re.compile(r"\W*$")


def quoted(words: list[str]) -> tuple[set[int], set[int]]:
    """Places of the words before which quotation opens and after which it closes; marks without a partner are none."""
    opens, closes, open_at = set(), set(), -1
    for i, word in enumerate(words):
        if not _MARKS.search(word):
            continue
        alone = not re.search(r"\w", word)
        starts = bool(_MARKS.search(_BEFORE.search(word).group())) and (not alone or open_at < 0)
        ends = bool(_MARKS.search(_AFTER.search(word).group())) and (not alone or open_at >= 0)
        if starts:
            open_at = i
        if ends and open_at >= 0:
            opens.add(open_at)
            closes.add(i)
            open_at = -1
    return opens, closes


def features(word: str) -> list[str]:
    """The word and its beginnings, marked apart."""
    return [f"={word}", *(f"^{word[:n]}" for n in BEGINNINGS if len(word) >= n)]


def _ticked(paths: dict[int, tuple[float, tuple]]) -> dict[int, tuple[float, tuple]]:
    now: dict[int, tuple[float, tuple]] = {}
    for q, found in paths.items():
        for to, _ in ARCS[q][TICK]:
            if to not in now or found[0] > now[to][0]:
                now[to] = found
    return now


class Grammar:
    def __init__(self, lexicon: dict[str, float], slope: float, offset: float) -> None:
        self.lexicon, self.slope, self.offset = lexicon, slope, offset
        self.memory: dict[str, tuple[int, float] | None] = {}

    def symbol(self, word: str) -> tuple[int, float] | None:
        """Class and weight of a word as it stands in a text; None for other words."""
        w = bare(word)
        found = None
        if w:
            weight = max((self.lexicon.get(f, 0.0) for f in features(w)), default=0.0)
            found = (INSULT, weight) if weight > 0 else (FIXED[w], 0.0) if w in FIXED else None
        if len(self.memory) >= MEMORY:
            self.memory.clear()
        self.memory[word] = found
        return found

    def matches(self, text: str) -> float:
        """The text's sum over its clauses."""
        memory, symbol = self.memory, self.symbol
        words = text.split()
        known = [memory[w] if w in memory else symbol(w) for w in words]
        if not any(k is not None and (k[0] == INSULT or k[0] == THREAT) for k in known):
            return 0.0
        best: dict[str, float] = {}
        clause: list[tuple[int, int, float]] = []
        opens, closes = quoted(words)
        inside = False
        for i, (word, k) in enumerate(zip(words, known, strict=True)):
            if i in opens:
                clause.append((i, OPEN, 0.0))
                inside = True
            if k is not None:
                clause.append((i, *k))
            if i in closes:
                clause.append((i, CLOSE, 0.0))
                inside = False
            if word[-1] in ".!?;:" or i + 1 == len(words):
                for place, weight in self.clause(clause):
                    w = bare(words[place])
                    best[w] = max(best.get(w, 0.0), weight)
                clause = [(i + 1, OPEN, 0.0)] if inside else []
        return sum(best.values())

    @staticmethod
    def clause(symbols: list[tuple[int, int, float]]) -> list[tuple[int, float]]:
        """The matches, with their scaled weights, of the best path over (place, class, weight) of a clause."""
        paths: dict[int, tuple[float, tuple]] = {0: (0.0, ())}  # by state: the best sum and, from the last on, its matches
        at = symbols[0][0] if symbols else 0
        for place, symbol, weight in symbols:
            for _ in range(min(place - at, NEAR + 2)):
                paths = _ticked(paths)
            at = place
            now: dict[int, tuple[float, tuple]] = {}
            gain = weight if symbol == INSULT else 1.0
            match = symbol in (INSULT, THREAT)
            for q, (total, back) in paths.items():
                for to, factor in ARCS[q][symbol]:
                    new = total + factor * gain if match else total
                    if to not in now or new > now[to][0]:
                        now[to] = (new, (place, factor * gain, back) if match else back)
            paths = now
        _, back = max((found for q, found in paths.items() if FINAL[q]), key=lambda x: x[0], default=(0.0, ()))
        out = []
        while back:
            out.append((back[0], back[1]))
            back = back[2]
        return out[::-1]

    def score(self, text: str) -> float:
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, self.offset + self.slope * math.log1p(self.matches(text))))))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, toxic texts, clean texts) from rows (toxic, text)."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def told() -> pa.RecordBatch:
        names = list(counts[0].keys() | counts[1].keys())
        columns = [pa.array(names, pa.string()), *(pa.array([c[n] for n in names], pa.int64()) for c in (counts[1], counts[0]))]
        for c in counts:
            c.clear()
        return pa.RecordBatch.from_arrays(columns, names=["feature", "toxic", "clean"])

    for whole in batches:
        for batch in sliced(whole, 1):
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                distinct = {bare(w) for w in set((text or "").split())} - {""}
                counts[int(toxic == 1)].update({f for w in distinct for f in features(w)})
                if len(counts[0]) + len(counts[1]) > MOST_COUNTED:
                    yield told()
    yield told()


def lexicon(counts: DataFrame, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Weights by feature: shrunken log odds of standing in a toxic text, with the prior."""
    least = max(3, math.ceil(0.002 * n_toxic))
    odds = F.ln((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.ln((F.col("clean") + 0.5) / (n_clean + 1.0))
    sums = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.col("toxic") >= least)
    toxic, clean, base = F.col("toxic"), F.col("clean"), n_toxic / (n_toxic + n_clean)
    seen = toxic + clean
    evidence = toxic * F.ln(toxic / (seen * base)) + F.when(clean > 0, clean * F.ln(F.greatest(clean, F.lit(1)) / (seen * (1 - base)))).otherwise(0.0)
    kept = sums.where((odds >= LEAST_ODDS) & (evidence >= LEAST_EVIDENCE))
    found = {r.feature: (r.toxic, r.clean) for r in kept.collect()}  # few: MOST_LABELLED bounds the texts they come from
    weights = {f"={w}": 1.5 for w in INSULTS}
    longer: dict[str, list[tuple[int, int]]] = {}
    for f, counted in found.items():
        for n in BEGINNINGS:
            if n < len(f) - 1:
                longer.setdefault(f[1 : n + 1], []).append(counted)
    for f, (toxic, clean) in found.items():
        # a feature that a shorter beginning explains as well adds nothing
        shorter = [f"^{f[1:][:n]}" for n in BEGINNINGS if n < len(f) - 1 or (f[0] == "=" and n <= len(f) - 1)]
        if any(s in found and found[s][0] >= toxic and found[s][1] <= clean + 0.1 * found[s][0] for s in shorter):
            continue
        # nor does a beginning whose toxic texts nearly all hold a longer one that fewer clean texts hold
        if f[0] == "^" and any(t >= 0.8 * toxic and c < clean for t, c in longer.get(f[1:], ())):
            continue
        strength = math.log((toxic + 0.5) / (n_toxic + 1.0)) - math.log((clean + 0.5) / (n_clean + 1.0))
        sure = toxic / (toxic + 8.0)
        weights[f] = max(weights.get(f, 0.0), min(3.0, 0.6 * strength * sure))
    return weights


def curve(sums: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a ridge logistic regression on log(1 + sum), by Newton's method."""
    x = np.column_stack([np.log1p(sums), np.ones(len(sums))])
    beta, ridge = np.array([2.0, -2.0]), np.array([1e-2, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (toxic - p) - ridge * beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), grad)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def _sums(grammar: Grammar) -> Callable[[list[str]], list[pa.Array]]:
    return lambda texts: [pa.array([grammar.matches(t) for t in texts], pa.float64())]


def learned(docs: DataFrame, labels: DataFrame) -> Grammar:
    """The grammar from labelled rows outside the held-out fold; labels: doc_id, toxic."""
    usable = labels.where("toxic IN (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(~held_out(F.col("doc_id")))
    sample = usable.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(MOST_LABELLED)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").withColumn("digest", F.xxhash64("text", "toxic"))
    chosen = rows.select("doc_id", "toxic", "digest").distinct().orderBy(F.xxhash64("doc_id", "digest"), "doc_id", "digest", "toxic").limit(MOST_LABELLED)
    # a labelled doc_id may have any number of rows: what is learned from are as many different texts at most
    rows = rows.join(F.broadcast(chosen), ["doc_id", "toxic", "digest"]).groupBy("doc_id", "toxic", "digest").agg(F.first("text").alias("text")).select("toxic", "text")
    rows = materialised(rows, "labelled")
    sizes = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    weights = {f"={w}": 1.5 for w in INSULTS}
    if not n_toxic or not n_clean:
        return Grammar(weights, 4.0, -2.5)
    weights = lexicon(rows.mapInArrow(_count, "feature string, toxic bigint, clean bigint"), n_toxic, n_clean)
    known = rows.mapInArrow(by_text(_sums(Grammar(weights, 1.0, 0.0)), ["total"], ["toxic"]), "toxic int, total double").toArrow()
    slope, offset = curve(known["total"].to_numpy(), known["toxic"].to_numpy().astype(float))
    return Grammar(weights, slope, offset)


def scored(docs: DataFrame, grammar: Grammar, keep: list[str], text: str = "text", names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """keep's columns with the score and, under the second name, whether it is one half or more."""

    def run(texts: list[str]) -> list[pa.Array]:
        scores = [grammar.score(t) for t in texts]
        return [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())]

    keep = [c for c in keep if c not in names]
    fields = [docs.schema[c] for c in keep] + [T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())]
    rows = docs.select(*keep, *([] if text in keep else [text]))
    return rows.mapInArrow(by_text(run, list(names), keep, text), T.StructType(fields))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = scored(docs.select("doc_id", "text"), learned(docs, labels), ["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
