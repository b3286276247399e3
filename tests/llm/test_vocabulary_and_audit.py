"""Spelling variants, quality classifier and filter audit: brute force over small tables, odd inputs, blocks and slices."""

import itertools
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard

from helicase.llm import audit, classifier, spelling

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id bigint, text string, lang string, word string, mask string, kind string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, g, "x", "y", "z") for i, t, g in rows], DOCS).repartition(3)


# spelling


def near(a, b):
    """Whether one inserted, deleted or replaced code point turns a into b."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute_words(rows):
    counts = Counter()
    for i, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    form, times = {}, {}
    for w, n in counts.items():
        others = [v for v in counts if near(w, v)]
        times[w] = len(others)
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, times[w], counts[form[w]] if form[w] else None))
    return out


def variants(rnd, n):
    """Texts of frequent words, their misspellings, and long runs of equal letters."""
    base = ["".join(rnd.choice(["ab", "an", "né", "tt", "s", "ÿ", "o"]) for _ in range(rnd.randint(4, 8))) for _ in range(12)]
    letters = "abnétsÿoz"

    def wrong(w):
        for _ in range(rnd.choice([1, 1, 2])):
            i = rnd.randrange(len(w))
            w = rnd.choice([w[:i] + w[i + 1 :], w[:i] + rnd.choice(letters) + w[i:], w[:i] + rnd.choice(letters) + w[i + 1 :]])
        return w

    rows = []
    for i in range(n):
        words = [rnd.choice(base) for _ in range(40)] + [wrong(rnd.choice(base)) for _ in range(10)] + ["aaaaaaa", "a" * rnd.randint(7, 11), "short", "ABNEABNE", "Ünantaß"]
        rnd.shuffle(words)
        rows.append((i if i % 9 else None, rnd.choice([" ", "-", "9"]).join(words), "de"))
    return rows


@pytest.mark.parametrize("half", [100_000, 5])
def test_spelling_equals_brute_force(spark, monkeypatch, half):
    """With small halves every one is cut into blocks of words and slices of queries."""
    monkeypatch.setattr(spelling, "MOST_HALF", half)
    rows = [*variants(random.Random(4), 60), (3, None, None), (4, "", "x"), (5, "the same words here", "x"), (5, "the same words here", "x")]
    found = spelling.grouped(documents(spark, rows))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in found.collect()]
    expected = brute_words(rows)
    assert len(got) == len(expected) > 50
    assert set(got) == expected


def test_forms_are_followed_to_the_last(spark):
    """A chain of four words, each ten times as frequent as the one before; chains are doubled, not walked."""
    chain = ["abcdefghi", "abcdefghj", "abcdefgkj", "abcdefgkjz"]
    rows = [(i, " ".join(w for k, w in enumerate(chain) if i % 13**k == 0), "de") for i in range(4000)]
    found = {r.word: r for r in spelling.grouped(documents(spark, rows)).collect()}
    assert {tuple(r) for r in found.values()} == brute_words(rows)
    assert [found[w].form for w in chain] == [None, *chain[:3]]
    assert {found[w].root for w in chain} == {chain[0]}


def test_spelling_on_an_empty_table(spark):
    assert spelling.grouped(documents(spark, [(1, "x", "y")]).limit(0)).count() == 0


def test_automaton_is_minimal_and_numbers_words():
    rnd = random.Random(6)
    words = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 7))) for _ in range(300)} | {"a", "ab", "abc", "ca"})
    rows = np.zeros((len(words), 7), np.uint8)
    for i, w in enumerate(words):
        rows[i, : len(w)] = [ord(c) - 96 for c in w]
    found = spelling.Automaton(rows, 3)
    for i, w in enumerate(words):
        state, ended, number = np.array([found.start]), np.zeros(1, np.int64), np.zeros(1, np.int64)
        for c in w:
            alive, state, ended, number = found.step(state, ended, number, np.array([ord(c) - 96]))
            assert alive[0]
        assert (int(ended[0]), int(number[0])) == (1, i), w
    # states: the different sets of endings after a beginning of some word
    after = {w[:i] for w in words for i in range(len(w) + 1)}
    endings = {frozenset(w[len(p) :] for w in words if w.startswith(p) and w != p) for p in after}
    assert len(found.edge) == len(endings)  # the empty list is row 0


# quality classifier


def test_classifier_equals_a_plain_discriminant(spark):
    """Scores are the logistic of log densities from plainly pooled and shrunken covariances, solved without factors."""
    rnd, rows, labels = random.Random(2), [], []
    for i in range(160):
        good = i % 4 != 0
        words = ["".join(rnd.choice(["th", "er", "on", "an", "re"]) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(5, 80))]
        rows.append((i, " ".join(words) + "." if good else "&&& ".join(w.upper() for w in words[:20] * 2), "en"))
        labels.append((i, int(good)))
    rows += [(None, None, None), (7, "", "x"), (8, rows[8][1], "en"), (500, "x" * 100_000, "en")]
    labels += [(9, 1), (9, 1), (12, None), (13, 5)]
    docs, told = documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int")
    found = classifier.classified(docs, told, ["doc_id", "text", "kind"]).collect()
    assert len(found) == len(rows)
    by = zstandard.ZstdCompressor(level=classifier.LEVEL, write_checksum=False)
    vector = lambda t: np.array([round(x * classifier.SCALE) for x in classifier.statistics(t or "", by)], float)
    kinds = {(i, q) for i, q in labels if q in (0, 1) and zlib.crc32(str(i).encode()) % 5}
    own = [np.array([vector(t) for i, t, _ in rows for j, q in kinds if j == i and q == k]) for k in (0, 1)]
    every = np.concatenate(own)
    scale = np.sqrt(np.maximum(every.var(0), 1.0))
    covariance = [np.cov((x / scale).T, bias=True) for x in own]
    pooled = sum(len(x) * c for x, c in zip(own, covariance, strict=True)) / len(every)
    share = (len(own[1]) + 1) / (len(every) + 2)
    for r in found:
        odds = np.log(share / (1 - share))
        for sign, x, c in zip((-1, 1), own, covariance, strict=True):
            c = (1 - classifier.POOLED) * c + classifier.POOLED * pooled
            c = (1 - classifier.ROUND) * c + classifier.ROUND * max(np.trace(c) / len(c), 1e-3) * np.eye(len(c))
            d = (vector(r.text) - x.mean(0)) / scale
            odds += sign * (-0.5 * d @ np.linalg.inv(c) @ d - 0.5 * np.linalg.slogdet(c)[1])
        assert r.score == pytest.approx(1 / (1 + np.exp(-np.clip(odds, -700, 700))), abs=1e-6)
        assert r.predicted == int(r.score >= 0.3)
    right = [r.predicted == int(r.doc_id % 4 != 0) for r in found if r.doc_id is not None and r.doc_id < 160 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.text]
    assert sum(right) >= 0.9 * len(right) > 0


def test_classifier_without_both_classes(spark):
    docs = documents(spark, [(i, f"word {i}", "en") for i in range(20)])
    for labels in ([(i, 1) for i in range(20)], []):
        found = classifier.classified(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"), ["doc_id"]).collect()
        n = sum(zlib.crc32(str(i).encode()) % 5 > 0 for i, _ in labels)
        assert {round(r.score, 9) for r in found} == {round((n + 1) / (n + 2), 9)}
    assert classifier.classified(docs.limit(0), spark.createDataFrame([], "doc_id bigint, quality int"), ["doc_id"]).count() == 0


def test_classifier_finds_held_out_junk(spark):
    found = classifier.query(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = found.join(labels, "doc_id").where("held_out AND quality IS NOT NULL").collect()
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert sum(r.predicted == r.quality for r in rows) >= 0.85 * len(rows)


# filter audit


def brute_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    told = []
    for i, text, lang in rows:
        text = text or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = set()
        fails |= {"A"} if len(ws) < 200 else set()
        fails |= {"B"} if 100 * len(set(ws)) < 50 * len(ws) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        fails |= {"E"} if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows) else set()
        told.append((lang or "", fails, i in good, i in toxic))
    out = []
    for part in {p for p, *_ in told}:
        own = [t[1:] for t in told if t[0] == part]
        made = []
        for order in itertools.permutations("ABCDE"):
            left = list(own)
            for step, f in enumerate(order, 1):
                gone = [t for t in left if f in t[0]]
                redundant = sum(f in t[0] for t in own) - len(gone)
                left = [t for t in left if f not in t[0]]
                made.append((part, "".join(order), step, len(left), len(gone), redundant, sum(t[0] == {f} for t in own), sum(t[1] for t in gone), sum(t[2] for t in gone)))
        shares = Counter()
        for m in made:
            shares[m[1][m[2] - 1]] += m[4]
        out += [(*m, shares[m[1][m[2] - 1]]) for m in made]
    return sorted(out)


def test_audit_equals_running_every_order(spark):
    rnd = random.Random(9)
    texts = ["", None, "short", " ".join(f"w{i}" for i in range(250)), " ".join(["again"] * 300), " ".join(f"W{i} X" for i in range(300)), "a | b", " ".join(f"w{i}#" for i in range(220)), "é😀 " * 100]
    rows = [(rnd.choice([*range(30), None]), rnd.choice(texts), rnd.choice(["en", "de", None, ""])) for _ in range(150)]
    rows += [(3, "short", "fr"), (3, "short", "fr")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(20)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1)]
    told = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = audit.audited(documents(spark, rows), told)
    assert sorted(tuple(r) for r in found.collect()) == brute_audit(rows, labels)
    assert audit.audited(documents(spark, rows).limit(0), told).count() == 0


def test_first_rows_are_joined_by_text_and_id(spark):
    """One text over most rows is spread: the join that finds first rows has the doc_id in its key."""
    docs = documents(spark, [(i, "the same", "en") for i in range(600)] + [(i, f"other {i}", "en") for i in range(600, 700)])
    rows = audit.masked(docs, spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(digest#\d+, doc_id#\d+L", plan) or "BroadcastHashJoin" in plan
    assert rows.where("mask >= 16").count() == 599
