"""The registered queries against DuckDB where they have SQL, and the pipeline's stages."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_support import documents, odd_texts, text
from oracle_compare import compare, duck
from phenoscope.llm import common, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    problems, *_ = compare(spark, duck(SF), name, queries.QUERIES[name], queries.ORACLE_SQL[name], SF)
    assert not problems


def test_queries_and_five_stages():
    assert [q.split("_")[0] for q in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_dedup", "mix_sources", "bpe"]


@pytest.fixture(scope="module")
def corpus(spark):
    rows = odd_texts() + [(i, text(i // 2, 30) + "\n" + text(i, 40)) for i in range(100, 130)]
    return documents(spark, rows)


def test_stages_keep_the_columns_and_take_effect(spark, corpus, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs, kept = corpus, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.schema.names == corpus.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in corpus.schema]
            out.write.parquet(str(tmp_path / name))
            docs = spark.read.parquet(str(tmp_path / name))
            kept[name] = docs.collect()
    assert len(kept["toxicity"]) == corpus.count()
    sizes = [(r.text, r.n_chars) for r in kept["line_dedup"]]
    assert all(n == (None if t is None else len(t)) for t, n in sizes)
    assert sum(n or 0 for _, n in sizes) < sum(r.n_chars or 0 for r in kept["toxicity"])
    ids = [r.doc_id for r in kept["simhash_dedup"] if r.doc_id is not None]
    assert len(ids) < len(kept["line_dedup"])
    words = lambda rows: sum(len((r.text or "").split()) for r in rows)
    assert words(kept["mix_sources"]) == pytest.approx(1.5 * words(kept["simhash_dedup"]), rel=0.35)
    final = out.collect()
    assert len(final) == len(kept["mix_sources"]) and out.columns[:2] == ["doc_id", "n_tokens"]


def test_stages_judge_rows_not_ids(spark, tmp_path):
    """Repeated and null ids with other texts, and columns with the names that stages use inside."""
    bad = " ".join(["you stupid pathetic idiot moron"] * 12)
    rows = [(i, bad if i % 2 else text(i, 25)) for i in range(60)] + [(2, bad), (None, bad), (None, text(900, 25)), (4, text(901, 25))]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t), "k", 1, 2, 3, 4) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, row_key string, repeats int, epoch int, _key int, _epoch int")
    spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    clean = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).collect()
    assert sorted(str((r.doc_id, r.text)) for r in clean) == sorted(str(r) for r in rows if r[1] != bad)
    copies = docs.filter(F.col("text") != bad).union(docs.filter("doc_id = 4").withColumn("epoch", F.lit(1)))
    once = corpus_pipeline.drop_near_copies(spark, copies, str(tmp_path)).collect()
    assert sorted(str((r.doc_id, r.text)) for r in once) == sorted(str(r) for r in rows if r[1] != bad)
    assert {r.epoch for r in once if r.doc_id == 4} == {1}
    mixed = corpus_pipeline.mix(spark, copies, str(tmp_path)).collect()
    assert mixed and set(mixed[0].__fields__) == set(docs.columns) and {r.row_key for r in mixed} == {"k"}


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_of_no_rows(spark, corpus, stage, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert stage[1](spark, corpus.filter(F.lit(False)), str(tmp_path)).collect() == []


def test_pipeline_keeps_only_its_last_table(spark, corpus, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    corpus.write.parquet(str(tmp_path / "in/documents.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "in/labels.parquet"))
    monkeypatch.setattr(common, "shared_dir", lambda spark: str(tmp_path / "shared"))
    coded = corpus_pipeline.run(spark, str(tmp_path / "in"))
    left = {p.parent.name for p in (tmp_path / "shared").glob("llm-*/*/*.parquet")}
    assert left == {"mix_sources"} and coded.count() > 0
    assert (tmp_path / "in/documents.parquet").exists() and (tmp_path / "in/labels.parquet").exists()


def test_without_drops_the_rows_of_the_keys_alone(spark):
    rows = spark.createDataFrame([(str(i % 90), i) for i in range(300)], "k string, near int")
    left = corpus_pipeline.without(rows, rows.filter("cast(k as int) % 4 = 1"), "k")
    assert left.columns == rows.columns
    assert sorted(map(tuple, left.collect())) == sorted((str(i % 90), i) for i in range(300) if i % 90 % 4 != 1)
    assert corpus_pipeline.without(rows, rows.filter("false"), "k").count() == 300
