"""The pipeline's stages against plain functions, and queries against SQL on the smallest tables."""

import os

import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
if not os.path.isdir(SF):
    pytest.skip("no tables", allow_module_level=True)

import corpus_pipeline  # noqa: E402
from helicase.llm import bpe, mixing, nearjoin, queries, secretscan, toxicity  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS)
    kept = corpus_pipeline.drop_toxic(spark, docs, SF).cache()
    assert kept.columns == COLUMNS
    scores = {r.doc_id: r.predicted for r in toxicity.query(spark, SF).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, p in scores.items() if not p}
    single = corpus_pipeline.drop_near_duplicates(spark, kept, SF).cache()
    assert single.columns == COLUMNS
    classes = {r.doc_id: r.class_id for r in nearjoin.joined(kept).collect()}
    assert {r.doc_id for r in single.collect()} == set(classes.values())
    masked = corpus_pipeline.mask_secrets(spark, single, SF).cache()
    assert masked.columns == COLUMNS
    before = {r.doc_id: r.text or "" for r in single.collect()}
    assert {r.doc_id: r.text for r in masked.collect()} == {i: secretscan.redact(t, secretscan.spans(t)) for i, t in before.items()}
    mixed = corpus_pipeline.mix_sources(spark, masked, SF).cache()
    assert mixed.columns == COLUMNS
    taken = {r.doc_id: r.taken // r.size for r in mixing.mixed(masked, whole=True).collect() if r.taken}
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == taken
    out = corpus_pipeline.encode(spark, mixed, SF).collect()
    texts = {r.doc_id: r.text for r in mixed.collect()}
    own = bpe.tokenizer(bpe.public_tokenizers.path(bpe.VOCABULARY))
    assert len(out) == sum(taken.values())
    for r in out[:50]:
        assert r.ids == own.encode(texts[r.doc_id])
        assert r.decoded == own.decode(r.ids)


def test_stages_on_odd_rows(spark):
    """Nulls in every column, repeated rows and columns named like the stages' own."""
    rows = [(None, "no id here", None, None, None, 1.0, 2, 3), (1, None, "en", "a", 4, 1.0, 2, 3), (2, "one two three", None, "a", 13, 1.0, 2, 3), (2, "one two three", None, "a", 13, 1.0, 2, 3), (3, "", "en", None, 0, 1.0, 2, 3), (4, "password: hunter2hunter", "en", "b", 9, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, times int, copy int")
    for empty in (False, True):
        now = docs.limit(0) if empty else docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, now, SF).cache()
            assert out.columns == docs.columns, name
            assert {r.score for r in out.collect()} <= {1.0, None}
            now = out
        last = corpus_pipeline.encode(spark, now, SF)
        assert last.count() == now.count()
        if empty:
            assert now.count() == 0
        else:
            assert {r.doc_id for r in now.collect()} <= {None, 1, 2, 3, 4}
            assert now.where("text LIKE '%hunter2%'").count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "n_tokens", "ids", "decoded"]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "secrets", "mixing", "bpe"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = c.sql(queries.ORACLE_SQL[name])
    df = queries.QUERIES[name](spark, SF)
    order = sorted(df.columns)
    assert sorted(found.columns) == order
    rows = sorted(tuple(str(r[k]) for k in order) for r in df.collect())
    assert rows == sorted(tuple(str(r[found.columns.index(k)]) for k in order) for r in found.fetchall())


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
