"""The corpus pipeline, stage by stage, against plain versions of each decision."""

from pyspark.sql import functions as F

import corpus_pipeline
from rsvpflow.llm import toxicity
from tests.llm.helpers import docs_table, hard_rows, jaccard_groups
from tests.llm.test_pairs import plain_leaks, plain_lines

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    outs = []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
        outs.append(docs)
    source = spark.read.parquet(f"{SF}/documents.parquet")
    assert all(o.columns == source.columns for o in outs[:-1])
    rows = lambda df: sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())

    model = toxicity.fit(source, spark.read.parquet(f"{SF}/labels.parquet"), F.lit(True))
    clean = {r.doc_id for r in toxicity.score(source, model).collect() if r.predicted == 0}
    first = [r for r in rows(source) if r[0] in clean]
    assert rows(outs[0]) == first
    gone = plain_lines(first, 40)
    second = [(i, "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[i]) if gone[i] else t) for i, t in first]
    second = [(i, t) for i, t in second if not gone[i] or t.split()]
    assert rows(outs[1]) == second
    groups = jaccard_groups(second, 5, 0.8)
    third = [(i, t) for i, t in second if groups[i][1] == i]
    assert rows(outs[2]) == third
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {d for d, *_ in plain_leaks(third, bench)}
    fourth = [(i, t) for i, t in third if i not in dirty]
    assert rows(outs[3]) == fourth
    assert {r.doc_id for r in outs[4].collect()} == {i for i, _ in fourth}
    whole = corpus_pipeline.run(spark, SF)
    assert whole.columns == outs[4].columns and whole.count() == outs[4].count()


def test_stages_survive_hard_rows(spark, tmp_path):
    docs = docs_table(spark, hard_rows(), True)
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        assert stage(spark, docs.limit(0), SF).count() == 0
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
    assert docs.count() > 0
