"""Bounded samples of training rows."""

import pytest
from pyspark.sql import functions as F

from voxsift.llm import common, toxicity


@pytest.mark.parametrize("parts", [1, 5])
def test_a_group_of_copies_counts_once(spark, parts):
    rows = [(f"copy {i % 3}", "aa") for i in range(600)] + [(f"text {i}", "bb") for i in range(900)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(parts)
    by = F.col("text"), F.col("lang")
    expected = sorted(df.distinct().select(F.xxhash64(*by).alias("h"), "text", "lang").collect())
    for most in (1, 100, 903, 2000):
        got = sorted(map(tuple, common.bounded_sample(df, most, *by).collect()))
        assert got == sorted((r.text, r.lang) for r in expected[:most])


def test_one_key_of_all_rows_and_no_rows(spark):
    df = spark.createDataFrame([("same",)] * 500, "text string").repartition(4)
    assert [r.text for r in common.bounded_sample(df, 50, F.col("text")).collect()] == ["same"]
    assert common.bounded_sample(df.limit(0), 50, F.col("text")).collect() == []


def test_toxicity_rows_of_repeated_ids_do_not_depend_on_partitions(spark, monkeypatch):
    """One id holds most rows of the documents, copies of a text among them."""
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id bigint, toxic int")
    rows = [(0, "same text")] * 200 + [(0, f"other text {i}") for i in range(60)] + [(i, f"doc {i}") for i in range(20)]
    fitted = []
    monkeypatch.setattr(toxicity, "fit", lambda found: fitted.append(found))
    for parts in (1, 6):
        docs = spark.createDataFrame(rows[::1 if parts == 1 else -1], "doc_id bigint, text string").repartition(parts)
        toxicity.learn(docs, labels, max_fit_docs=20)
    assert fitted[0] == fitted[1] and len(fitted[0]) == 40
    assert sum(text == "same text" for text, _ in fitted[0]) <= 1
