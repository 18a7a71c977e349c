"""SQL twins of the corpus queries, and the pipeline's stages."""

import duckdb
import pytest

import corpus_pipeline
from covoxel.llm.queries import ORACLES, QUERIES

TABLES = ("documents", "embeddings", "pages", "labels")


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql_twin(name, spark, sf):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got, want = QUERIES[name](spark, sf).toPandas(), db.sql(ORACLES[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    a, b = (x[cols].sort_values(cols).reset_index(drop=True).astype(str) for x in (got, want))
    assert len(a) == len(b) and (a == b).all().all()


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "\n".join(f"line {i} of a text that goes on with words like alpha{i} beta{i * 7} gamma{i * 3}" for i in range(40))


@pytest.fixture(scope="module")
def docs(spark, sf):
    odd = [(10**6 + 1, LONG, "en", "x", 1), (10**6 + 2, LONG, "en", "x", 1), (10**6 + 3, LONG.replace("alpha5 ", "other "), "en", None, None), (10**6 + 4, None, None, None, None), (10**6 + 5, "", "en", "x", 0), (10**6 + 6, "123 !", "en", "x", 0), (None, "a text without an id", None, None, None), (10**6 + 7, "twice", "en", "y", 5), (10**6 + 7, "twice", "en", "y", 5)]
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(odd, DOCS))


def test_stages_keep_columns_and_take_effect(spark, sf, docs):
    ids = lambda d: sorted(r.doc_id for r in d.select("doc_id").where("doc_id >= 1000000").collect())
    at = lambda *n: [10**6 + i for i in n]
    known = corpus_pipeline.language_id(spark, docs, sf)
    assert known.columns == docs.columns and ids(known) == at(1, 2, 3, 7, 7)
    assert known.count() >= docs.count() - 4
    lines = corpus_pipeline.remove_lines(spark, docs, sf)
    assert lines.columns == docs.columns and 10**6 + 2 not in ids(lines) and 10**6 + 1 in ids(lines)
    assert {r.text for r in lines.where("doc_id = 1000001").collect()} == {LONG}
    once = corpus_pipeline.near_duplicates(spark, docs, sf)
    assert once.columns == docs.columns and ids(once) == at(1, 4, 5, 6, 7)
    assert once.where("doc_id is null").count() == 1
    mixed = corpus_pipeline.mix_sources(spark, docs, sf)
    assert mixed.columns == docs.columns and mixed.count() > 0
    assert max(r["count"] for r in mixed.where("doc_id < 1000000").groupBy("doc_id").count().collect()) <= 3


def test_unlearned_scripts_go_and_short_texts_stay(spark, sf, docs):
    import random

    rng = random.Random(4)
    words = lambda first, n: " ".join("".join(chr(first + rng.randrange(32)) for _ in range(rng.randint(2, 9))) for _ in range(n))
    strange = [(2 * 10**6 + i, words((0x430, 0x4E00, 0x627, 0xAC00)[i % 4], 40), None, "x", 1) for i in range(80)]
    short = [(3 * 10**6 + i, t, None, "x", 1) for i, t in enumerate(["Avec.", "Re.", "A", "ж", "Edrere."])]
    out = corpus_pipeline.language_id(spark, docs.unionByName(spark.createDataFrame(strange + short, DOCS)), sf)
    assert out.where("doc_id between 2000000 and 2999999").count() <= 8 and out.where("doc_id >= 3000000").count() == 5
    letters = docs.where("doc_id < 1000000 and text rlike '[A-Za-zÀ-ÿ]'")
    assert out.where("doc_id < 1000000").count() == letters.count()


def test_unlike_texts_with_one_id_stay(spark, sf):
    other = LONG.replace("line", "verse").replace("alpha", "delta").replace("beta", "zeta").replace("gamma", "eta")
    rows = [(1, LONG, "en", "x", 1), (1, other, "en", "x", 1), (1, LONG + " end", "en", "x", 1), (1, other, "en", "x", 1), (2, other, "en", "x", 1), (3, "short", "en", "x", 1), (None, LONG, "en", "x", 1)]
    once = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, DOCS), sf)
    assert sorted((r.doc_id or 0, r.text) for r in once.collect()) == sorted([(0, LONG), (1, LONG), (1, other), (3, "short")])


def test_run(spark, sf, tmp_path, docs):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "jaccard_join", "mixing", "packing"]
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() > 0 and "sequence_id" in out.columns
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
