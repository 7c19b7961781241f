"""Toxicity learns from all labelled rows, in shards; its cuts are exact."""

import numpy as np
from pyspark.sql import functions as F

from creditlens.llm import toxicity
from creditlens.operators import quantiles


def corpus(spark, size):
    """Short texts; every second is toxic by one of two words, and the second word is rare among low hashes of ids."""
    rows = spark.range(size).withColumnRenamed("id", "doc_id").withColumn("toxic", (F.col("doc_id") % 2).cast("int"))
    low = F.percent_rank().over(toxicity.Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"))) < 0.9
    word = F.when(F.col("toxic") == 0, "calm").when(low, "vile").otherwise("rotten")
    filler = F.concat_ws(" ", *[F.concat(F.lit("word"), F.pmod(F.xxhash64("doc_id", F.lit(k)), F.lit(50)).cast("string")) for k in range(6)])
    docs = rows.select("doc_id", F.concat_ws(" ", filler, word, F.lit("end")).alias("text"), F.lit("en").alias("lang"))
    return docs, rows.select("doc_id", "toxic")


def test_all_labelled_rows_teach(spark, monkeypatch):
    """More of a class than was taken before; what the last ones alone show is learned."""
    docs, labels = corpus(spark, 9200)
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 4000)
    rows, shards = toxicity.labelled(docs, labels, "toxic", F.lit(True))
    assert rows.count() == 9200 and shards == 3 == rows.select("shard").distinct().count()
    net = toxicity.fit(docs, labels, F.lit(True))
    asked = spark.createDataFrame([(1, "word3 word9 rotten end", "en"), (2, "word3 word9 calm end", "en"), (3, "word1 vile end", "en")], docs.schema)
    found = {r["doc_id"]: r["score"] for r in toxicity.score(asked, net).collect()}
    assert found[1] > toxicity.CUT > found[2] and found[3] > toxicity.CUT


def test_shards_learn_together_and_repeat(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 300)
    monkeypatch.setattr(toxicity, "BROADCAST_IDS", 10)
    docs, labels = corpus(spark, 1200)
    first = toxicity.fit(docs, labels, F.lit(True))
    again = toxicity.fit(docs.repartition(5), labels, F.lit(True))
    assert (first.tables == again.tables).all() and first.cut == again.cut and first.bias == again.bias
    right = toxicity.score(docs, first).join(labels, "doc_id").where((F.col("score") >= toxicity.CUT) == (F.col("toxic") == 1))
    assert right.count() > 1100


def plain_cut(value, labels):
    """All cuts tried in turn."""
    at = max(sorted(set(value), reverse=True), key=lambda v: 2 * labels[value >= v].sum() / ((value >= v).sum() + max(labels.sum(), 1)))
    below = [v for v in value if v < at]
    return (at + (max(below) if below else at - 1)) / 2


def test_cuts_equal_plain_search(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SLICE_VALUES", 40)
    rng = np.random.default_rng(4)
    rows = [(g, float(np.round(x, 1 + k)), int(x + rng.normal() > 0.3)) for k, g in enumerate(("a", "b")) for x in rng.normal(size=300)]
    rows += [("one", 0.5, 1), ("none", 0.1, 0), ("none", 0.2, 0)]
    found = toxicity.best_cuts(spark.createDataFrame(rows, "group string, value double, label int"))
    for g in {r[0] for r in rows}:
        value, labels = (np.array([r[i] for r in rows if r[0] == g]) for i in (1, 2))
        assert found[g] == (plain_cut(value, labels), labels.sum(), len(labels))
