import os
import uuid

import corpus_pipeline
from pyspark.sql import functions as F

from veilcorpus.llm import queries
from veilcorpus.llm.near_copies import near_copy_classes
from veilcorpus.session import shared_dir

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_decide_on_their_own_input(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    folder = f"{shared_dir(spark)}/stages-{uuid.uuid4().hex}"
    sizes = [docs.count()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        assert after.select("doc_id").exceptAll(docs.select("doc_id")).isEmpty()
        assert i + 1 == len(corpus_pipeline.STAGES) or after.columns == columns
        if name == "near_dedup":
            assert near_copy_classes(after).filter("class_docs > 1").isEmpty()
        docs = after
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[0] > sizes[-1] > sizes[0] // 2
    assert docs.filter("NOT lossless").isEmpty()
    assert sorted(corpus_pipeline.run(spark, FOLDER).select("doc_id").collect()) == sorted(docs.select("doc_id").collect())


def test_stages_take_odd_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    odd = spark.createDataFrame([(None, None, None, None, None), (7000, "", "en", "s", 0), (7000, "", "en", "s", 0), (7001, "12", None, None, 2)], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.unionByName(odd), FOLDER).count() > 0
        assert stage(spark, docs.limit(0), FOLDER).count() == 0


def test_stages_keep_columns_of_any_name(spark):
    names = ["_near_key", "_near_digest", "_near_nth", "_found", "_language", "language", "contamination", "row", "digest"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40)
    docs = docs.unionByName(docs.limit(3)).unionByName(docs.limit(1).withColumn("text", F.repeat("text", F.lit(200))))
    for name in names:
        docs = docs.withColumn(name, F.lit("user"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        assert all(r[n] == "user" for r in out.select(*names).collect() for n in names), name
        assert out.count() > 0


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert os.path.exists(os.path.join(os.path.dirname(corpus_pipeline.__file__), "veilcorpus"))
