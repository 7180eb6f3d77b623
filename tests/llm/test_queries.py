"""The opN_ queries against their SQL, and the pipeline as a whole."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chalkline.llm import mixing, queries
from chalkline.llm.common import land
from tests.llm.test_brute_force import brute_components
from tools.oracle_check import check, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    res = check(spark, duck(SF), name, queries.QUERIES[name], queries.SQL[name], SF)
    assert res.get("ok") is True, res


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_mix_stays_near_targets_and_repeats(spark):
    rows = [(i, " ".join(["w"] * (1 + (i * 37) % 90)), f"s{min(i % 11, 4)}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    runs = [sorted((r["doc_id"], r["_mix"]["copies"]) for r in mixing.mix(df.repartition(n)).collect()) for n in (2, 7)]
    assert runs[0] == runs[1]
    per = (mixing.mix(df).groupBy("source").agg(F.sum(F.col("_mix.copies") * F.col("_mix.size")).alias("taken"),
                                                F.first("_mix.target").alias("target"), F.max("_mix.copies").alias("most")).collect())
    assert all(abs(r["taken"] - r["target"]) <= 100 and r["most"] <= 3 for r in per)
    assert sum(r["target"] for r in per) == pytest.approx(sum(len(t.split()) for _, t, _ in rows))
    assert mixing.emit(df).count() == sum(c for _, c in runs[0])


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "exact dedup", "n-gram jaccard join", "source mixing", "bpe encoding and decoding"]
    states = [docs]
    for name, stage in corpus_pipeline.STAGES:
        states.append(land(stage(spark, states[-1], SF), "test-stage"))
    assert all(s.columns == docs.columns for s in states[:-1])
    good = states[1].collect()
    by_text = {}
    for r in good:
        by_text[r["text"]] = max(by_text.get(r["text"], -1), r["doc_id"])
    assert {r["doc_id"] for r in states[2].collect()} == set(by_text.values())
    classes, _ = brute_components({r["doc_id"]: r["text"] for r in states[2].collect()}, 5, 80)
    assert {r["doc_id"] for r in states[3].collect()} == {d for d, (_, c) in classes.items() if d == c}
    assert states[5].count() == states[4].count()
    assert states[5].select("doc_id").distinct().count() == states[4].select("doc_id").distinct().count()
