"""The corpus pipeline, stage by stage, against what its operators are held to."""

from collections import Counter

import corpus_pipeline
from quarterbell.llm.decontamination import find_leaks
from quarterbell.llm.nearduplicates import near_duplicates
from quarterbell.llm.toxicity import score_toxicity
from tests.llm.odd import documents, folder
from tests.llm.test_groups import shard_facts

SF = "/root/testdata/sf0.01"


def test_stages_take_effect(spark, tmp_path):
    docs = before = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/{name}"
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = docs
        if name != "sharding":
            assert docs.columns == before.columns
    ids = {name: {r.doc_id for r in rows.select("doc_id").collect()} for name, rows in kept.items()}
    toxic = {r.doc_id for r in score_toxicity(before, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").collect()}
    assert ids["toxicity"] == set(range(1000)) - toxic
    assert ids["near_duplicates"] == {r.doc_id for r in near_duplicates(kept["toxicity"]).where("kept").collect()}
    leaks = {r.doc_id for r in find_leaks(kept["near_duplicates"], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert leaks and ids["decontamination"] == ids["near_duplicates"] - leaks
    assert ids["mixing"] <= ids["decontamination"] and kept["mixing"].count() > kept["decontamination"].count()
    sizes = shard_facts(docs.collect())
    assert docs.count() == kept["mixing"].count() and max(sizes.values()) < 1.01 * min(sizes.values())
    assert Counter(r.doc_id for r in docs.collect()) == Counter(r.doc_id for r in kept["mixing"].collect())


def test_pipeline_of_odd_rows(spark, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, "nothing that occurs")], "item_id long, text string")
    sf_dir = folder(spark, tmp_path, documents=documents(spark), labels=labels, benchmark=benchmark)
    assert corpus_pipeline.run(spark, sf_dir).where("doc_id = 7").count() in (1, 2, 3)
