"""The registered queries and the pipeline on the driver's smallest tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from folioflow import session
from folioflow.llm import registry
from folioflow.llm.scratch import materialize

from . import brute

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))
    assert set(registry.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_rows(spark, name):
    got = registry.QUERIES[name](spark, SF)
    if name.startswith(("op5", "op12", "op13")):
        with duckdb.connect() as db:
            for t in ("conversations", "documents", "embeddings"):
                db.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
            want = db.sql(registry.ORACLE_SQL[name]).df()
        assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.itertuples(index=False)))
    elif not name.startswith(("op1_", "op11")):
        assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_pipeline(spark):
    """Each stage against what the plain versions say of its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, materialize(stage(spark, kept, SF), name)
        assert kept.columns == docs.columns
        old, new = [(r["doc_id"], r["text"]) for r in before.collect()], {r["doc_id"]: r["text"] for r in kept.collect()}
        if name == "quality_rules":
            bad = {d for d, t in old for m in [brute.base_metrics(t)] if m[0] < 10 or 100 * m[4] > 20 * m[0]}
            assert not bad & set(new) and len(new) > 0.9 * (len(old) - len(bad))
        elif name == "ngram_jaccard_join":
            assert set(new) == {d for d, _, c in brute.components(old) if d == c}
        elif name == "benchmark_decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert all(brute.contamination(t, items)[1] == 0 for d, t in new.items() if brute.contamination(dict(old)[d], items)[1] == 0)
            assert sum(brute.contamination(t, items)[1] for t in new.values()) == 0
        else:
            assert set(new) == {d for d, _ in old}
            assert any("[SECRET]" in t for t in new.values()) == any("token = " in t for _, t in old)
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in kept.collect()}
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).drop("sequence_id", "offset").collect())) == sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed)


#: Names that stages use for columns of their own.
CLASHING = "n_words word_chars n_events bits base_failed kept band_low band_high band_lang band_mid _text _lang n_hit items hit_spans cleaned _hits _items _h _cut _r _text_hash row found hash r h cut new doc d first node label gid part text_hash kept_hash drop_id twice_id component_id _k0 _k1 _k9 piece start length ids_crc32 rank sequence_id offset".split()


@pytest.mark.parametrize("rows", ["odd", "repeated", "empty"])
def test_stages_keep_columns_of_any_name(spark, tmp_path, rows):
    """Nulls, repeated ids and empty tables go through all stages; columns named like a stage's own come back with their values."""
    real = [(1000 + r["doc_id"], f"{r['text']} token = 'abcdef{r['doc_id']}'", r["lang"], f"s{r['doc_id']}", 1) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    table = brute.odd_rows() + real
    if rows == "repeated":
        table = [*table, *table[::2]]
    df = spark.createDataFrame(table if rows != "empty" else [], brute.DDL)
    df = df.select("*", *(F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in CLASHING))
    path = f"file://{tmp_path}"
    df.write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{path}/benchmark.parquet")
    kept = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = materialize(stage(spark, kept, path), name)
        assert kept.columns == df.columns and kept.dtypes == df.dtypes
        for r in kept.collect():
            assert all(r[c] == f"{c}:{'none' if r['doc_id'] is None else r['doc_id']}" for c in CLASHING)
    masked = kept.filter("doc_id >= 1000").collect()
    assert (len(masked) > 100 or rows == "empty") and all("[SECRET]" in r["text"] for r in masked)
    packed = corpus_pipeline.run(spark, path)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in kept.collect()}


def _there(spark, path):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def test_a_stage_by_hand_gives_back_what_the_one_before_wrote(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    corpus_pipeline._by_hand.clear()
    kept = materialize(corpus_pipeline.STAGES[0][1](spark, docs, SF), "kept")
    key = (id(spark), SF, 0)
    tables = [path for _, path in corpus_pipeline._by_hand[key][0].tables]
    assert tables and all(_there(spark, p) for p in tables)
    corpus_pipeline.STAGES[1][1](spark, kept, SF)
    assert not any(_there(spark, p) for p in tables)
    two = [corpus_pipeline.STAGES[0][1](spark, docs, SF) for _ in range(2)]
    corpus_pipeline.STAGES[1][1](spark, kept, SF)
    assert two[0].count() == two[1].count() == kept.count()  # of two results none is taken away


def test_two_results_of_run_live_side_by_side(spark):
    open_ = len(session._OPEN)
    with session.scoped() as scope:
        one, two = corpus_pipeline.run(spark, SF), corpus_pipeline.run(spark, SF)
        assert sorted(map(tuple, one.drop("sequence_id", "offset").collect())) == sorted(map(tuple, two.drop("sequence_id", "offset").collect()))
    paths = [path for _, path in scope.tables]
    scope.release()
    assert paths and not any(_there(spark, p) for p in paths) and len(session._OPEN) == open_


def test_a_stage_that_fails_leaves_no_tables(spark, monkeypatch):
    made = []

    def fails(spark_, docs, sf_dir):
        made.append(session.write_table(docs, "half"))
        raise RuntimeError("lost")

    monkeypatch.setattr(corpus_pipeline.STAGES[2][1], "plain", fails)
    with session.passing() as scope:
        with pytest.raises(RuntimeError, match="lost"):
            corpus_pipeline.run(spark, SF)
        assert made and not _there(spark, made[0]) and not scope.tables
