"""Relevance by naive Bayes over token counts (TXT-1, checkable in SQL).

Training counts in how many documents of each class a token occurs, in one
aggregate with partial aggregation.  A token's weight is the difference of
its smoothed log probabilities in the two classes, in integer micros, so the
same counts give the same decision in any engine.  A document's score is the
sum over its distinct known tokens plus the classes' log ratio.  The
vocabulary grows with the corpus and is joined, not broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxsift.functions.text import token_set

MICROS = 1_000_000


def _micros(x: Column) -> Column:
    return F.floor(F.lit(MICROS) * F.ln(x)).cast("bigint")


def token_weights(train: DataFrame, text: str = "text", label: str = "relevant") -> DataFrame:
    """(tok, weight) of labelled rows (boolean ``label``; nulls do not train)."""
    hits = train.where(F.col(label).isNotNull()).select(
        F.col(label).alias("y"), F.explode(token_set(F.col(text))).alias("tok"))
    counts = hits.groupBy("tok").agg(F.count_if("y").alias("n1"), F.count_if(~F.col("y")).alias("n0"))
    total1 = counts.select(F.sum("n1") + F.count("*")).scalar()
    total0 = counts.select(F.sum("n0") + F.count("*")).scalar()
    return counts.select("tok", (_micros((F.col("n1") + 1) / total1)
                                 - _micros((F.col("n0") + 1) / total0)).alias("weight"))


def prior(train: DataFrame, label: str = "relevant") -> Column:
    """Log ratio of the classes' document counts, as a one-row scalar."""
    y = F.col(label)
    return train.select(_micros((F.count_if(y) + 1) / (F.count_if(~y) + 1))).scalar()


def relevance_by_bayes(df: DataFrame, train: DataFrame, key: str, text: str = "text",
                       label: str = "relevant") -> DataFrame:
    """(key, bayes_score, relevant) of every row of ``df``; rows that repeat
    a key are scored each."""
    tokens = df.select(key, F.monotonically_increasing_id().alias("_row"), token_set(F.col(text)).alias("_toks")).select(
        key, "_row", F.explode_outer("_toks").alias("tok"))
    scored = tokens.join(token_weights(train, text, label), "tok", "left").groupBy(key, "_row").agg(
        F.coalesce(F.sum("weight"), F.lit(0)).cast("bigint").alias("tokens"))
    score = (F.col("tokens") + prior(train, label)).cast("bigint")
    return scored.select(key, score.alias("bayes_score"), (score > 0).alias("relevant"))


# --- registered query ------------------------------------------------------

def relevance_bayes_query(spark, d):
    """Labelled documents with ``doc_id % 5 = 0`` by a model of the others."""
    from voxsift.sources import tables
    rows = tables.labeled_documents(spark, d)
    held = F.col("doc_id") % 5 == 0
    out = relevance_by_bayes(rows.where(held).select("doc_id", "text"), rows.where(~held), "doc_id")
    return out.join(rows.where(held).select("doc_id", F.col("relevant").alias("labelled")), "doc_id")


def relevance_bayes_all_query(spark, d):
    """Every document by the same model; ``labelled`` is null without a label,
    ``held_out`` is true for the fold that no training row comes from."""
    from voxsift.sources import tables
    rows = tables.labeled_documents(spark, d)
    held = F.col("doc_id") % 5 == 0
    docs = tables.table(spark, d, "documents").select("doc_id", "text")
    out = relevance_by_bayes(docs, rows.where(~held), "doc_id")
    # one label an id; an id whose labels disagree has none
    labels = rows.groupBy("doc_id").agg(F.min("relevant").alias("labelled"), F.max("relevant").alias("_most")).where(
        "labelled = _most").drop("_most")
    return out.join(labels, "doc_id", "left").withColumn("held_out", held)
