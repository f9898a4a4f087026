"""Pipeline stages keep columns that are named like their own."""

import pytest
from pyspark.sql import functions as F

from martloom.llm import exact_dedup, quality, simhash, toxicity

MODEL = toxicity.Model(-1.0, {b"bad": 5.0})
STAGES = {
    "toxicity": lambda df: toxicity.clean(df, MODEL),
    "quality": quality.passing,
    "exact_dedup": exact_dedup.without_duplicates,
    "near_dedup": simhash.without_near_duplicates,
}
NAMES = ["__row", "__lang", "__ref", "__quality", "__toxicity", "doc", "name", "h", "id", "key", "fp", "root", "body"]


@pytest.mark.parametrize("stage", STAGES)
def test_columns_stay(spark, stage):
    text = " ".join(f"word{i} of the text" for i in range(30))
    rows = [(1, text, "en"), (2, text + " more words here at the end", "en"), (3, None, None), (4, "", "en"), (5, "bad " + text[::-1], "de")]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING")
    df = df.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in NAMES])
    got = STAGES[stage](df)
    assert got.schema.names == df.columns
    kept = got.collect()
    assert kept and all(r[n] == f"{n} {r.doc_id}" for r in kept for n in NAMES)
    assert STAGES[stage](df.limit(0)).collect() == []


def test_few_labelled_texts_make_a_model(spark):
    """The shipped settings on the smallest table: more than one score, and toxic texts above others."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    got = toxicity.predictions(docs, toxicity.train(docs, labels))
    assert got.select(F.countDistinct("score")).first()[0] > 1
    by_label = {r["toxic"]: r for r in got.join(labels, "doc_id").groupBy("toxic").agg(F.avg("score").alias("mean"), F.avg("predicted").alias("found")).collect()}
    assert by_label[1]["mean"] > by_label[0]["mean"] and by_label[1]["found"] > 0.5 and by_label[0]["found"] < 0.05
