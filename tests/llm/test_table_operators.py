"""Fingerprints, toxicity, sharding, WARC, join and mixing: brute force, optimality, damage and odd inputs."""

import base64
import hashlib
import itertools
import math
import os
import random
import subprocess
import sys
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from helicase.llm import fingerprints, graph, mixing, nearjoin, sharding, toxicity, warc
from helicase.llm.common import discard, shared_dir

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORDS = [f"{a}{b}" for a in ("th", "er", "on", "an", "re", "he", "in") for b in ("a", "e", "o", "ing", "ed", "ly")]


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) + rnd.choice(WORDS) for _ in range(n))


def documents(spark, rows, partitions=3):
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, key string, bucket string, seq string").repartition(partitions)


def doc(i, text, source="s"):
    return (i, text, source, "k", "b", "q")


def written(df, tmp_path, name="documents"):
    df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_fingerprint_edits_and_order(spark, tmp_path):
    rnd = random.Random(1)
    texts = {5: prose(rnd, 300), 9: prose(rnd, 40), 2: "", 40: None, 41: "one two", 100: "é " * 7, 7: "   "}
    texts[200] = texts[5]
    rows = [doc(i, t) for i, t in texts.items()]
    found = {r.doc_id: r for r in fingerprints.query(spark, written(documents(spark, rows), tmp_path)).collect()}
    order = sorted(texts)
    for i, key in enumerate(order):
        own, following = texts[key] or "", texts[order[(i + 1) % len(order)]] or ""
        n = len(own) // 4
        edited = own[: len(own) - n] + following[:n]
        assert found[key].n_chars == len(own)
        assert found[key].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest(), key
    assert found[5].fingerprint == found[200].fingerprint
    assert found[2].fingerprint == found[40].fingerprint == found[7].fingerprint
    assert found[2].near_edited == 1.0
    assert 0.35 < found[5].near_edited < 0.85
    assert found[5].near_next < 0.1


def test_fingerprints_of_edited_equal_fingerprints_of_that_text(spark, tmp_path):
    """The shared front is sampled once: the result is that of sampling the edited text by itself."""
    rnd = random.Random(2)
    rows = [doc(i, prose(rnd, rnd.choice([1, 3, 5, 6, 20, 90]))) for i in range(30)]
    a = {r.doc_id: r for r in fingerprints.query(spark, written(documents(spark, rows), tmp_path / "a")).collect()}
    edited = []
    for i in range(30):
        own, following = rows[i][1], rows[(i + 1) % 30][1]
        n = len(own) // 4
        edited.append(doc(i, own[: len(own) - n] + following[:n]))
    b = {r.doc_id: r for r in fingerprints.query(spark, written(documents(spark, edited), tmp_path / "b")).collect()}
    assert all(a[i].edited_fingerprint == b[i].fingerprint for i in range(30))


def weighted(text):
    w = text.split()
    terms = [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []
    return {t: n * sum(map(len, t)) for t, n in Counter(terms).items()}


def generalised_jaccard(x, y):
    a, b = weighted(x), weighted(y)
    larger = sum(max(a.get(k, 0), b.get(k, 0)) for k in a.keys() | b.keys())
    return sum(min(a[k], b[k]) for k in a.keys() & b.keys()) / larger if larger else 1.0


def gamma_at(p):
    """The quantile of gamma(2, 1) by bisection on ln x, without cancellation at either end."""
    lo, hi = -40.0, 5.0
    for _ in range(80):
        x = math.exp((lo + hi) / 2)
        below = x * x / 2 * (1 - 2 * x / 3 + x * x / 4) if x < 1e-4 else -math.expm1(-x) - x * math.exp(-x)
        lo, hi = ((lo + hi) / 2, hi) if below < p else (lo, (lo + hi) / 2)
    return math.exp((lo + hi) / 2)


def sampled(text, k):
    """The code of the k-th sample, term by term, with exact quantiles."""
    bits = lambda h, at, n: (h >> at) & ((1 << n) - 1)
    best = None
    for term, weight in weighted(text).items():
        h = 42
        for word in term:
            h = xxhash.xxh64_intdigest(word.encode(), h)
        h = h & ~0xFFFF | sum(map(len, term))
        own = xxhash.xxh64_intdigest(k.to_bytes(4, "little"), xxhash.xxh64_intdigest(h.to_bytes(8, "little"), 42))
        more, fine = (xxhash.xxh64_intdigest(x.to_bytes(4, "little"), own) for x in (1, 2))
        ri, ci = bits(own, 0, 12), bits(own, 12, 12)
        end = gamma_at(4095 / 4096)
        r = end - math.log((bits(more, 0, 32) + 0.5) * 2.0**-32 * min(1.0, (bits(more, 32, 32) + 0.5) * 2.0**-32 * (1 + end))) if ri == 4095 else gamma_at((ri + (bits(own, 44, 10) + 0.5) / 1024) / 4096)
        c = gamma_at((ci + ((fine >> 12) + 0.5) * 2.0**-52) / 4096 if ci < fingerprints.LOW_CELLS else (ci + (bits(own, 54, 10) + 0.5) / 1024) / 4096)
        b = bits(own, 24, 20) * 2.0**-20
        t = math.floor(math.log(weight) / r + b)
        found = (math.log(c) - r * (t - b + 1), ((h >> 16) ^ (t << 7)) & 0xFFFFFFFF)
        best = found if best is None else min(best, found)
    return best[1]


def test_fingerprints_equal_an_exact_sampler(spark, tmp_path):
    rnd = random.Random(22)
    rows = [doc(i, " ".join([prose(rnd, rnd.randint(5, 30))] * rnd.randint(1, 3))) for i in range(12)] + [doc(50, "one two")]
    found = {r.doc_id: r.fingerprint for r in fingerprints.query(spark, written(documents(spark, rows), tmp_path)).collect()}
    same = [int(found[i][8 * k : 8 * k + 8], 16) == sampled(text, k) for i, text, *_ in rows for k in range(fingerprints.SAMPLES)]
    assert np.mean(same) > 0.985  # the table is interpolated: near ties may fall otherwise


def test_collision_rate_is_generalised_jaccard(spark, tmp_path):
    """Of texts whose shingles differ, and of texts that only repeat them differently often."""
    rnd = random.Random(3)
    rows = [doc(i, prose(rnd, 250)) for i in range(60)]
    found = {r.doc_id: r.near_edited for r in fingerprints.query(spark, written(documents(spark, rows), tmp_path / "a")).collect()}
    off = []
    for i in range(60):
        own, following = rows[i][1], rows[(i + 1) % 60][1]
        n = len(own) // 4
        off.append(found[i] - generalised_jaccard(own, own[: len(own) - n] + following[:n]))
    assert abs(np.mean(off)) < 0.02
    assert np.std(off) < 0.1
    rows = []
    for i in range(0, 120, 2):
        line, rest = prose(rnd, 30), prose(rnd, 40)
        rows += [doc(i, f"{line} {rest}"), doc(i + 1, " ".join([line] * (2 + i // 40)) + f" {rest}")]
    found = {r.doc_id: r.near_next for r in fingerprints.query(spark, written(documents(spark, rows), tmp_path / "b")).collect()}
    off = [found[i] - generalised_jaccard(rows[i][1], rows[i + 1][1]) for i in range(0, 120, 2)]
    assert abs(np.mean(off)) < 0.02
    assert max(found[i] for i in range(80, 120, 2)) < 0.75


def test_least_samples_of_many_terms_follow_their_law(spark):
    """The least a of terms of total weight W is exponential with mean 1 / W, for few terms and for many."""
    for groups, terms, weight in ((400, 20, 3.0), (8, 60_000, 40.0)):
        rows = spark.range(groups * terms).select((F.col("id") % groups).alias("g"), F.xxhash64("id").alias("term"), *fingerprints.tables(F.col("id") >= 0))
        rows = rows.select("*", F.explode(F.lit([0])).alias("zero"))
        least = [F.min(fingerprints.packed_sample(F.col("term"), F.lit(math.log(weight)), F.lit(k))).alias(f"m{k}") for k in range(8)]
        found = rows.groupBy("g").agg(*least).drop("g").collect()
        a = np.array([[math.exp((m >> 32) / (1 << 23) - 101.0) for m in r] for r in found]).ravel() * weight * terms
        assert abs(a.mean() - 1) < 5 / math.sqrt(len(a))
        assert abs((a < math.log(2)).mean() - 0.5) < 3 / math.sqrt(len(a))


def test_next_of_null_and_repeated_doc_ids(spark, tmp_path):
    """One doc_id over most rows, and null ones: each row has one next, which the order by doc_id allows."""
    rnd = random.Random(23)
    rows = [doc(7 if i % 5 else rnd.choice([None, 3, 900]), prose(rnd, 6) + f" {i}") for i in range(1500)] + [doc(7, "same text here")] * 20
    found = fingerprints.with_next(documents(spark, rows).select("doc_id", "text")).where("NOT ghost").collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter((r[0], r[1]) for r in rows)
    assert Counter(r.next_text for r in found) == Counter(r[1] for r in rows)  # one cycle or several: each row follows once
    ids = {}
    for i, text, *_ in rows:
        ids.setdefault(text, i)
    order = [None, 3, 7, 900]
    steps = Counter((order.index(r.doc_id), order.index(ids[r.next_text])) for r in found)
    assert [steps[x] for x in ((0, 1), (1, 2), (2, 3), (3, 0))] == [1] * 4
    assert sum(n for (a, b), n in steps.items() if a != b) == 4
    assert max(Counter(r.bucket for r in found).values()) < 150
    assert fingerprints.query(spark, written(documents(spark, rows), tmp_path)).count() == len(rows)


def test_single_and_no_document(spark, tmp_path):
    one = fingerprints.query(spark, written(documents(spark, [doc(3, "abcdefgh")]), tmp_path / "a")).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    assert fingerprints.query(spark, written(documents(spark, [doc(3, "a")]).limit(0), tmp_path / "b")).count() == 0


def test_toxicity_learns_held_out(spark, tmp_path):
    rnd = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        words = prose(rnd, 80).split()
        if toxic:
            for _ in range(4):
                words.insert(rnd.randrange(80), rnd.choice(["idiot", "vequta", "vequille", "lowehr"]) + rnd.choice(["", ",", "."]))
        rows.append(doc(i, " ".join(words)))
        labels.append((i, int(toxic), "x"))
    rows += [doc(900, None), doc(901, ""), doc(902, "x" * 100_000)]
    written(spark.createDataFrame(labels, "doc_id bigint, toxic int, score string"), tmp_path, "labels")
    found = {r.doc_id: r for r in toxicity.query(spark, written(documents(spark, rows), tmp_path)).collect()}
    assert len(found) == 603
    for i, r in found.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.5)
    held = [i for i in range(600) if found[i].held_out]
    assert np.mean([found[i].predicted == int(i % 6 == 0) for i in held]) > 0.97
    assert found[900].score == found[901].score


def test_grammar_composes():
    g = toxicity.Grammar({"=idiot": 2.0}, 4.0, -2.5)
    plain, aimed, negated, told = (g.matches(t) for t in ("the idiot went", "you are an idiot.", "he is not an idiot.", "she said idiot."))
    assert aimed > plain > 0
    assert negated < aimed
    assert told < plain
    assert g.matches("kill the bug") == 0
    assert g.matches("i will kill you") > 0
    assert g.matches("nothing here") == 0
    assert g.matches("idiot. idiot.") == plain


def every_path(symbols):
    """The best sum over all paths through the single transducers, none of them composed."""
    steps, at = [], symbols[0][0]
    for place, symbol, weight in symbols:
        steps += [(toxicity.TICK, 0.0)] * (place - at) + [(symbol, weight)]
        at = place
    best = None
    paths = [((0,) * len(toxicity.GRAMMAR), 0.0)]
    for symbol, weight in steps:
        longer = []
        for state, total in paths:
            ways = itertools.product(*(arcs.get((q, symbol), [(q, 1.0)]) for q, (arcs, _) in zip(state, toxicity.GRAMMAR, strict=True)))
            for way in ways:
                gain = math.prod(f for _, f in way) * {toxicity.INSULT: weight, toxicity.THREAT: 1.0}.get(symbol, 0.0)
                longer.append((tuple(q for q, _ in way), total + gain))
        paths = longer
    for state, total in paths:
        if all(q in final for q, (_, final) in zip(state, toxicity.GRAMMAR, strict=True)):
            best = total if best is None else max(best, total)
    return best


def test_best_path_equals_all_paths():
    rnd = random.Random(20)
    for _ in range(400):
        places = sorted(rnd.choices(range(14), k=rnd.randint(1, 7)))
        symbols = [(p, c, rnd.choice([0.5, 1.5, 3.0]) if c == toxicity.INSULT else 0.0) for p in places for c in [rnd.choice([1, 1, 2, 3, 4, 5, 6])]]
        assert sum(w for _, w in toxicity.Grammar.clause(symbols)) == pytest.approx(every_path(symbols))


def test_query_equals_all_paths(spark, tmp_path, monkeypatch):
    """The whole query against a reading of every text by itself that enumerates paths; repeated rows score alike."""
    rnd = random.Random(21)
    rows, labels = [], []
    bits = ["you", "not", "never", "said", "but", "idiot", "moron.", "kill", "they", "vequille", "fine,", "word", '"loser"', "here!"]
    for i in range(300):
        words = prose(rnd, 12).split() + [rnd.choice(bits[:3] + bits[4:5] + bits[11:12]) for _ in range(4)] + ([rnd.choice(bits) for _ in range(5)] + ["vequille"] if i % 4 == 0 else [])
        rnd.shuffle(words)
        rows.append(doc(i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    rows += rows[:7] + [doc(None, "you idiot"), doc(None, None)]
    written(spark.createDataFrame(labels, "doc_id bigint, toxic int"), tmp_path, "labels")
    docs = documents(spark, rows)
    found = toxicity.query(spark, written(docs, tmp_path)).collect()
    grammar = toxicity.learned(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    held = {}
    for i, text, *_ in rows:
        best = {}
        words = (text or "").split()
        opens = closes = {i for i, w in enumerate(words) if w == '"loser"'}
        clause = []
        for place, word in enumerate(words):
            k = grammar.symbol(word)
            clause += ([(place, toxicity.OPEN, 0.0)] if place in opens else []) + ([(place, *k)] if k else []) + ([(place, toxicity.CLOSE, 0.0)] if place in closes else [])
            if word[-1] in ".!?;:" or place + 1 == len(words):
                if clause:
                    assert sum(w for _, w in toxicity.Grammar.clause(clause)) == pytest.approx(every_path(clause))
                for at, weight in toxicity.Grammar.clause(clause):
                    w = toxicity.bare(words[at])
                    best[w] = max(best.get(w, 0.0), weight)
                clause = []
        held.setdefault(i, []).append(round(1 / (1 + math.exp(-(grammar.offset + grammar.slope * math.log1p(sum(best.values()))))), 9))
    got = defaultdict(list)
    for r in found:
        got[r.doc_id].append(round(r.score, 9))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in held.items()}


def test_quotation_ends_where_its_mark_closes():
    g = toxicity.Grammar({"=idiot": 2.0}, 4.0, -2.5)
    plain = g.matches("you idiot")
    for text in ('"Hello there" you idiot', "“Hello there” you idiot", 'a 5" pipe, you idiot', "« Hello » you idiot"):
        assert g.matches(text) == plain, text
    for text in ('you "idiot"', "you «idiot»", "„du idiot“", '"you idiot" was the word', '"Go away. you idiot" they answered', 'they answered "you idiot"', '" you idiot "'):
        assert g.matches(text) == pytest.approx(0.5 * plain), text


def test_labelled_rows_are_bounded(spark, monkeypatch):
    """One labelled doc_id over many rows is learned from as a bounded number of different texts."""
    monkeypatch.setattr(toxicity, "MOST_LABELLED", 40)
    kept = []
    real = toxicity.materialised
    monkeypatch.setattr(toxicity, "materialised", lambda df, name: kept.append(real(df, name)) or kept[-1])
    rows = [doc(1, f"you idiot {i % 200}") for i in range(2000)] + [doc(i, "fine words") for i in range(2, 30)]
    toxicity.learned(documents(spark, rows), spark.createDataFrame([(i, int(i == 1)) for i in range(30)], "doc_id bigint, toxic int"))
    assert 0 < kept[0].count() <= 40


def test_negation_reaches_the_clauses_end():
    g = toxicity.Grammar({"=idiot": 2.0}, 4.0, -2.5)
    plain = g.matches("i will kill you")
    assert g.matches("I will not, ever, at any time, kill you") == pytest.approx(0.3 * plain)
    assert g.matches("not now but i will kill you") == plain
    assert g.matches("not now. i will kill you") == plain
    assert g.matches("never did anyone there say you idiot") < 0.5 * g.matches("you idiot")
    assert g.matches("idiot you idiot") == g.matches("you idiot")


def test_toxicity_without_labels(spark):
    docs = documents(spark, [doc(1, "you idiot"), doc(2, "fine")])
    grammar = toxicity.learned(docs, spark.createDataFrame([], "doc_id bigint, toxic int"))
    found = {r.doc_id: r.predicted for r in toxicity.scored(docs, grammar, ["doc_id"]).collect()}
    assert found == {1: 1, 2: 0}


def brute_cost(supply, demand):
    """Least bytes moved where staying is free and any move costs one."""
    return sum(supply) - sum(min(s, d) for s, d in zip(supply, demand, strict=False))


def test_min_cost_flow_is_least():
    rnd = random.Random(5)
    for _ in range(100):
        m, n = rnd.randint(1, 5), rnd.randint(1, 6)
        supply = [rnd.randint(0, 50) for _ in range(m)]
        cuts = sorted(rnd.randint(0, sum(supply)) for _ in range(n - 1))
        demand = [b - a for a, b in zip([0, *cuts], [*cuts, sum(supply)], strict=True)]
        flow = sharding.min_cost_flow(supply, demand, [[int(i != j) for j in range(n)] for i in range(m)])
        assert [sum(r) for r in flow] == supply
        assert [sum(flow[i][j] for i in range(m)) for j in range(n)] == demand
        assert sum(flow[i][j] for i in range(m) for j in range(n) if i != j) == brute_cost(supply, demand)


def test_min_cost_flow_with_costs():
    flow = sharding.min_cost_flow([3, 3], [3, 3], [[1, 2], [5, 9]])
    assert sum(flow[i][j] * c for i, r in enumerate([[1, 2], [5, 9]]) for j, c in enumerate(r)) == 21


def test_resharding(spark, tmp_path):
    rnd = random.Random(6)
    rows = [doc(i, prose(rnd, rnd.randint(1, 60))) for i in range(800)] + [doc(5000, "x" * 6000), doc(5001, None), doc(7, "again"), doc(7, "again"), doc(None, "no id")]
    found = sharding.query(spark, written(documents(spark, rows), tmp_path)).collect()
    assert Counter((r.doc_id, r.size) for r in found) == Counter((r[0], len((r[1] or "").encode()) + 8) for r in rows)
    by = defaultdict(list)
    for r in found:
        by[r.shard].append(r)
    assert set(by) == set(range(24))
    sizes = [sum(r.size for r in by[s]) for s in by]
    largest = max(r.size for r in found)
    assert max(sizes) - min(sizes) <= largest
    for s in by:
        assert sorted(r.slot for r in by[s]) == list(range(len(by[s])))
    crc = {r.doc_id: r.text_crc32 for r in found}
    assert crc[5000] == zlib.crc32(b"x" * 6000)
    assert {r.law for r in found} == {"bytes"}


def test_resharding_of_hot_doc_ids(spark, tmp_path):
    """One doc_id, and null, over most rows: no block holds them all, and shards are as equal as ever."""
    rnd = random.Random(24)
    rows = [doc((7, None, 7, i)[i % 4], prose(rnd, rnd.randint(1, 40))) for i in range(2000)] + [doc(7, "y" * 5000), doc(None, "z" * 5000), doc(7, "w" * 4000)] * 2
    found = sharding.query(spark, written(documents(spark, rows), tmp_path)).collect()
    assert Counter((r.doc_id, r.size) for r in found) == Counter((r[0], len(r[1]) + 8) for r in rows)
    sizes, slots = Counter(), defaultdict(list)
    for r in found:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * 5008
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    sharding.write_shards(documents(spark, rows).select("doc_id", "text"), f"{tmp_path}/old")
    blocks = spark.read.parquet(f"{tmp_path}/old").groupBy("old_shard", "block").count().collect()
    assert max(r["count"] for r in blocks) < 40
    empty = documents(spark, rows).limit(0)
    assert sharding.query(spark, written(empty, tmp_path / "none")).count() == 0


def test_resharding_rewrites_only_what_moves(spark, tmp_path):
    rnd = random.Random(7)
    docs = documents(spark, [doc(i, prose(rnd, 30)) for i in range(3000)])
    old, new = f"{tmp_path}/old", f"{tmp_path}/new"
    sharding.write_shards(docs.select("doc_id", "text"), old, 4)
    sizes = {r.old_shard: r.s for r in spark.read.parquet(old).groupBy("old_shard").agg(F.sum("size").alias("s")).collect()}
    capacity = [sizes[0], sizes[1], sizes[2], sizes[3] // 2, sizes[3] - sizes[3] // 2]
    rows = sharding.reshard(spark, old, new, 5, capacity)
    assert rows.count() == 3000
    assert spark.read.parquet(new).select("old_shard").distinct().collect()[0].old_shard == 3
    moved = rows.where("shard <> old_shard").agg(F.sum("size")).first()[0]
    assert moved == pytest.approx(capacity[4], rel=0.02)
    same = spark.createDataFrame([], "doc_id bigint, text string")
    sharding.write_shards(same, f"{tmp_path}/none")


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, file string")


def test_warc_round_trip(spark, tmp_path):
    rnd = random.Random(8)
    rows = [(i, f"http://x/{i}\n", prose(rnd, 50) if i % 4 else "same é payload", "f") for i in range(60)] + [(70, None, None, "f"), (71, "u", "", "f")]
    written(pages(spark, rows), tmp_path, "pages")
    found = {r.page_id: r for r in warc.query(spark, str(tmp_path)).collect()}
    first = {}
    for i, _, html, _ in sorted(rows):
        first.setdefault(html or "", i)
    for i, _, html, _ in rows:
        raw = (html or "").encode()
        r = found[i]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        assert r.record_type == ("response" if first[html or ""] == i else "revisit")
        assert r.refers_to == (None if first[html or ""] == i else first[html or ""])
    written(pages(spark, rows).limit(0), tmp_path / "none", "pages")
    assert warc.query(spark, str(tmp_path / "none")).count() == 0


def members(n, compress=True):
    out = []
    for i in range(n):
        raw = warc.record(i, f"http://x/{i}", f"payload {i} ".encode() * 50, None, True)
        by = zlib.compressobj(6, zlib.DEFLATED, 31)
        out.append(by.compress(raw) + by.flush() if compress else raw)
    return out


@pytest.mark.parametrize("compress", [True, False])
def test_warc_salvage(compress):
    parts = members(12, compress)
    data = b"".join(parts)
    clean = list(warc.salvage(data))
    assert [r[2] for r in clean] == ["record"] * 12
    assert [r[5] for r in clean] == [f"<urn:x-page:{i}>" for i in range(12)]
    ends = np.cumsum([0, *map(len, parts)])
    for bad in (0, 5, 11):
        middle = int(ends[bad] + len(parts[bad]) // 2)
        for hurt in (data[:middle] + b"\x00\xff" * 4 + data[middle + 8 :], data[:middle] + data[middle + 9 :], data[:middle] + b"junk!" + data[middle:]):
            rows = list(warc.salvage(hurt))
            records, gaps = [r for r in rows if r[2] == "record"], [r for r in rows if r[2] == "gap"]
            assert [r[5] for r in records] == [f"<urn:x-page:{i}>" for i in range(12) if i != bad]
            assert len(gaps) == 1
            assert gaps[0][0] == ends[bad]
            assert sum(r[1] for r in rows) == len(hurt)
    cut = data[: ends[7] + 10]
    rows = list(warc.salvage(cut))
    assert [r[2] for r in rows] == ["record"] * 7 + ["gap"]
    assert list(warc.salvage(b"")) == []
    assert [r[2] for r in warc.salvage(b"no archive")] == ["gap"]


def test_warc_salvage_inside_members():
    """Archives gzipped as one member, or with several records a member, lose only the records that are hurt."""
    records = members(12, False)
    ids = [f"<urn:x-page:{i}>" for i in range(12)]

    def packed(raw):
        by = zlib.compressobj(6, zlib.DEFLATED, 31)
        return by.compress(raw) + by.flush()

    hurt = [r.replace(b"payload 5 ", b"payload X ", 1) for r in records]
    for data in (packed(b"".join(hurt)), packed(b"".join(hurt[:4])) + packed(b"".join(hurt[4:8])) + packed(b"".join(hurt[8:]))):
        rows = list(warc.salvage(data))
        assert [r[5] for r in rows if r[2] == "record"] == ids[:5] + ids[6:]
        assert ["block digest differs" in r[3] for r in rows if r[2] == "gap"] == [True]
    rnd = random.Random(19)
    long = [warc.record(i, f"http://x/{i}", rnd.randbytes(3000), None, True) for i in range(12)]
    whole = packed(b"".join(long))
    for data in (whole[: len(whole) // 2], whole[: len(whole) // 2] + packed(long[11])):
        rows = list(warc.salvage(data))
        found = [r[5] for r in rows if r[2] == "record"]
        assert found[:5] == ids[:5]
        assert ("<urn:x-page:11>" in found) == (len(data) != len(whole) // 2)
        assert sum(r[2] == "gap" for r in rows) == 1
    rows = list(warc.salvage(whole[:-8] + b"\0" * 8))
    assert [r[5] for r in rows if r[2] == "record"] == ids


def test_warc_salvage_takes_linear_time():
    """Damaged bytes full of marks, of half-valid records and of cut gzip headers: twice the bytes, about twice the time."""
    record = members(1, False)[0]
    made = (
        lambda n: b"WARC/1.1\r\n" * n, lambda n: b"\x1f\x8b\x08" * n, lambda n: b"\x1f\x8b\x08\x00\0\0\0\0\0\x03ab" * n, lambda n: b"\x1f\x8b\x08\x08\0\0\0\0\0\x03name" * (n // 4),
        lambda n: record[:-9] * (n // 50), lambda n: (record[:60] + b"\x1f\x8b") * (n // 8), lambda n: zlib.compress(b"x" * n, 0, 31)[:-1],
    )
    for make in made:
        times = []
        for n in (15_000, 60_000):
            began = time.time()
            assert all(r[2] == "gap" for r in warc.salvage(make(n)))
            times.append(time.time() - began)
        assert times[1] < 10 * times[0] + 1.0, (make(2)[:20], times)
    noise = random.Random(5).randbytes(4 << 20)
    began = time.time()
    assert [r[2] for r in warc.salvage(noise * 4 + members(1)[0])] == ["gap", "record"]
    assert time.time() - began < 20


def test_warc_of_odd_page_ids(spark, tmp_path):
    """Null and repeated page_ids: every row is written and read; the least page_id of a payload is a response."""
    rows = [(1, "a", "x", "f"), (1, "b", "x", "f"), (None, "c", "x", "f"), (2, "d", "x", "f"), (None, "e", "y", "f"), (None, "f", "y", "f"), (3, "g", None, "f"), (3, "g", None, "f")]
    written(pages(spark, rows), tmp_path, "pages")
    found = warc.query(spark, str(tmp_path)).collect()
    got = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in found)
    assert got == Counter({(1, 1, "response", None): 2, (None, 1, "revisit", 1): 1, (2, 1, "revisit", 1): 1, (None, 1, "response", None): 2, (3, 0, "response", None): 2})


def test_warc_salvage_through_spark(spark, tmp_path):
    parts = members(5)
    (tmp_path / "a.warc.gz").write_bytes(parts[0] + b"garbage" + parts[1] + parts[2][:-9] + parts[3])
    (tmp_path / "b.warc.gz").write_bytes(b"")
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    assert Counter(r.kind for r in rows) == {"record": 3, "gap": 2}
    assert all(r.problem for r in rows if r.kind == "gap")


def brute_join(texts):
    rep, sets = {}, {}
    for i in sorted(texts):
        rep.setdefault(texts[i] or "", i)
    for t, i in rep.items():
        w = t.split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    links, parent = Counter(), {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 5 * common >= 4 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    copies = Counter(t or "" for t in texts.values())
    return {i: (root(rep[t or ""]), rep[t or ""], copies[t or ""], links[rep[t or ""]]) for i, t in texts.items()}


def planted(seed):
    rnd = random.Random(seed)
    passage = prose(rnd, 60)
    texts = {i: prose(rnd, rnd.randint(1, 120)) for i in range(80)}
    for i in range(100, 150):
        texts[i] = f"{prose(rnd, 40)} {passage} {prose(rnd, 40)}"
    base = prose(rnd, 200).split()
    for i in range(200, 260):
        w = [*base]
        for _ in range(rnd.randint(0, 5)):
            w[rnd.randrange(200)] = rnd.choice(WORDS)
        texts[i] = " ".join(w)
    texts |= {300 + k: texts[k] for k in range(20)} | {400: "", 401: None, 402: "a b", 403: "a b", 404: "a  b", 405: "a b c d e", 406: passage}
    return texts


def test_join_equals_brute_force(spark):
    texts = planted(9)
    found = nearjoin.joined(documents(spark, [doc(i, t) for i, t in texts.items()])).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == brute_join(texts)


def test_join_with_large_buckets(spark, monkeypatch):
    """Tiny limits send the near copies through leaders, splits and pairs of blocks."""
    monkeypatch.setattr(nearjoin, "BUCKET", 8)
    monkeypatch.setattr(nearjoin, "BLOCK", 16)
    texts = planted(10)
    found = nearjoin.joined(documents(spark, [doc(i, t) for i, t in texts.items()])).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == brute_join(texts)


def test_join_of_odd_tables(spark):
    assert nearjoin.joined(documents(spark, [doc(1, "a")]).limit(0)).count() == 0
    rows = nearjoin.joined(documents(spark, [doc(None, "x y"), doc(4, "x y"), doc(4, "x y")])).collect()
    assert sorted((r.doc_id or -1, r.n_copies) for r in rows) == [(-1, 3), (4, 3), (4, 3)]
    kept = nearjoin.representatives(documents(spark, [doc(4, "x y"), doc(4, "x y"), doc(5, "x y"), doc(6, "z")])).collect()
    assert sorted(r.doc_id for r in kept) == [4, 6]
    assert len(kept[0]) == 6


def test_join_of_different_texts_with_one_id(spark):
    """Texts are judged by themselves where doc_ids repeat or are null."""
    rnd = random.Random(17)
    base = prose(rnd, 100).split()
    near = [" ".join([*base[:k], "other", *base[k:]]) for k in (10, 50, 90)]
    lone = [prose(rnd, 40) for _ in range(4)]
    rows = [doc(None, near[0]), doc(None, near[1]), doc(8, near[2]), doc(None, lone[0]), doc(None, lone[1]), doc(None, None), doc(9, lone[2]), doc(9, lone[3]), doc(9, lone[3])]
    found = nearjoin.joined(documents(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.class_id or -1, r.n_copies, r.n_links) for r in found) == [
        (-1, -1, 1, 0), (-1, -1, 1, 0), (-1, -1, 1, 0), (-1, -1, 1, 2), (-1, -1, 1, 2), (8, -1, 1, 2), (9, 9, 1, 0), (9, 9, 2, 0), (9, 9, 2, 0),
    ]
    kept = nearjoin.representatives(documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(None, min(near[:2])), (None, lone[0]), (None, lone[1]), (None, None), (9, lone[2]), (9, lone[3])])


def test_runs_reach_the_target():
    assert nearjoin.runs(0.999) > nearjoin.runs(0.9) >= 1


def test_tokens_equal_words():
    rnd = random.Random(11)
    import pyarrow as pa

    from helicase.llm.common import binary_parts

    texts = ["", "a", " a  b\tc\nd\x0be f ", "é ü ñ ß x é ü ñ ß x", *("".join(rnd.choice("ab \n é") for _ in range(50)) for _ in range(200))]
    token, row = nearjoin.tokens(*binary_parts(pa.array(texts)))
    import re

    seen = {}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        expect = [tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))] if w else []
        got = token[row == i].tolist()
        assert len(got) == len(expect)
        for g, e in zip(got, expect, strict=True):
            assert seen.setdefault(g, e) == e
    assert len(set(seen.values())) == len(seen)


def test_components(spark):
    rnd = random.Random(12)
    edges = [(i, i + 1) for i in range(200)] + [(rnd.randint(300, 400), rnd.randint(300, 400)) for _ in range(60)] + [(500, 500 + i) for i in range(1, 300)]
    found = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    assert found == {x: root(x) for a, b in edges if a != b for x in (a, b)}
    node, star = graph.local_stars(*np.array([e for e in edges if e[0] != e[1]]).T)
    assert dict(zip(node.tolist(), star.tolist(), strict=True)) == {x: r for x, r in found.items() if x != r}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def waterfill(sizes, weights):
    total, target = 1.5 * sum(sizes), [0.0] * len(sizes)
    free, left = set(range(len(sizes))), total
    while True:
        share = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = [i for i in free if share[i] > 2 * sizes[i]]
        if not over:
            for i in free:
                target[i] = share[i]
            return target
        for i in over:
            target[i] = 2 * sizes[i]
            left -= target[i]
            free.discard(i)
        if not free:
            return target


def test_mixing_meets_targets(spark, tmp_path):
    rnd = random.Random(13)
    rows = [doc(i, prose(rnd, rnd.randint(0, 30)), rnd.choice(["a", "b", "b", "b", "Z", "é", None])) for i in range(900)] + [doc(5000, None, "empty"), doc(5001, "", "empty")]
    rows += [doc(3, "twice", rows[3][2])] * 2
    path = written(documents(spark, rows), tmp_path)
    found = mixing.query(spark, path).collect()
    again = mixing.query(spark, path).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))
    names = sorted({r[2] for r in rows if r[2] is not None}, key=lambda s: s.encode()) + [None]
    sizes = [sum(len((r[1] or "").split()) for r in rows if r[2] == n) for n in names]
    expected = dict(zip(names, waterfill(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))]), strict=True))
    source = {r[0]: r[2] for r in rows}
    taken = Counter()
    for r in found:
        assert 0 <= r.taken <= 2 * r.size
        assert r.target == pytest.approx(expected[source[r.doc_id]])
        assert r.source_size == sizes[names.index(source[r.doc_id])]
        taken[source[r.doc_id]] += r.taken
    for n in names:
        assert abs(taken[n] - expected[n]) <= 1
    assert mixing.mixed(documents(spark, rows).limit(0)).count() == 0


def test_mixing_prefers_quality(spark):
    rows = [doc(i, "good plain words here", "a") if i % 2 else doc(i, "### bad $$$ text ###", "a") for i in range(600)] + [doc(1000 + i, "w x y z " * 60, "b") for i in range(40)]
    found = {r.doc_id: r for r in mixing.mixed(documents(spark, rows)).collect()}
    extra = lambda odd: np.mean([found[i].taken / found[i].size % 1.0001 if found[i].target < found[i].source_size else found[i].taken / found[i].size for i in range(600) if i % 2 == odd])
    assert extra(1) >= extra(0)


def test_whole_documents_are_repeated(spark):
    rnd = random.Random(14)
    rows = [doc(i, prose(rnd, 20), "abc"[i % 3]) for i in range(90)]
    found = mixing.mixed(documents(spark, rows), whole=True).collect()
    assert {r.taken / r.size for r in found} <= {0.0, 1.0, 2.0}
    out = mixing.repeated(documents(spark, rows))
    assert out.columns == ["doc_id", "text", "source", "key", "bucket", "seq"]
    assert Counter(r.doc_id for r in out.collect()) == Counter({r.doc_id: int(r.taken / r.size) for r in found if r.taken})


def test_repeated_rows_give_what_the_mix_takes(spark):
    """One doc_id over unlike texts, null ids and repeated rows: the words written are those taken."""
    rnd = random.Random(15)
    rows = [doc(rnd.choice([1, 2, None, i]), prose(rnd, rnd.randint(1, 30)), rnd.choice("abc")) for i in range(120)]
    rows += [doc(7, "the same row again", "a")] * 41 + [doc(None, "no id and many of it", "b")] * 30 + [(7, None, None, None, None, None), (7, "x", None, None, "", None), (7, "x", None, "", None, None)]
    docs = documents(spark, rows)
    taken = mixing.mixed(docs, whole=True).agg(F.sum("taken")).first()[0]
    out = mixing.repeated(docs)
    got = Counter(map(tuple, out.collect()))
    assert sum(len(r[1].split()) * n for r, n in got.items()) == taken
    assert set(got) <= set(rows)
    held = Counter(rows)
    assert all(n <= 2 * held[r] for r, n in got.items())
    clash = docs.withColumns({"size": F.lit(1), "taken": F.lit(2), "skey": F.lit("z"), "n": F.lit(3), "times": F.lit(4)})
    assert mixing.repeated(clash).columns == clash.columns
    assert mixing.repeated(clash).count() == sum(got.values())


def test_gamma_quantiles():
    q = fingerprints.gamma2_quantiles(6)
    assert list(q) == sorted(q)
    assert len(q) == 65
    assert all(q[i] == pytest.approx(gamma_at(i / 64), rel=1e-9) for i in range(1, 64))


def test_shared_folder(spark, tmp_path):
    path = shared_dir(spark, "x")
    assert path.startswith("file:")
    assert path != shared_dir(spark, "x")
    assert os.path.dirname(path) == os.path.dirname(shared_dir(spark, "y"))
    spark.range(3).write.parquet(path)
    discard(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))
    code = f"""
from pyspark.sql import SparkSession
from helicase.llm.common import materialised
s = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "{tmp_path}").getOrCreate()
assert materialised(s.range(3), "x").count() == 3
"""
    subprocess.run([sys.executable, "-c", code], check=True, capture_output=True)
    left = lambda: [x for x in os.listdir(tmp_path) if x.startswith("local-")]
    for _ in range(50):
        if not left():
            break
        time.sleep(0.2)
    assert not left()
