"""MLlib variants of the relevance and category steps (TXT-1(c), TXT-3 ML).

``RegexTokenizer → HashingTF → IDF → LogisticRegression``: tokenizing and
hashing are map-side; IDF and the logistic-regression gradients are
``treeAggregate`` jobs, so training and scoring scale with the cluster.
Relevance learns from ``labels.quality``; the category model learns from the
rule-based categories (weak supervision) and scores every review.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxsift.functions.text import TOKEN_PATTERN
from voxsift.session import stage

NUM_FEATURES = 1 << 16


def text_classifier(label_col: str = "label", num_features: int = NUM_FEATURES,
                    max_iter: int = 20, reg: float = 0.01) -> Pipeline:
    return Pipeline(stages=[
        RegexTokenizer(inputCol="text", outputCol="_words", pattern=TOKEN_PATTERN, gaps=False,
                       toLowercase=True),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="_features"),
        LogisticRegression(featuresCol="_features", labelCol=label_col, maxIter=max_iter,
                           regParam=reg, predictionCol="_prediction",
                           probabilityCol="_probability", rawPredictionCol="_raw"),
    ])


def _training(rows: DataFrame) -> DataFrame:
    """Training rows staged once (the indexer, the IDF pass and the optimizer
    read them), in no more partitions than there are cores: every optimizer
    pass shuffles one dense gradient per partition, so what a fit shuffles
    must not grow with the number of input partitions."""
    return stage(rows).coalesce(max(1, rows.sparkSession.sparkContext.defaultParallelism))


def relevance_model(labeled: DataFrame):
    """Fit on ``(text, relevant)``."""
    train = labeled.select("text", F.col("relevant").cast("double").alias("label"))
    return text_classifier().fit(_training(train))


def predict_relevance(model, df: DataFrame) -> DataFrame:
    out = model.transform(df)
    return out.withColumn("relevant", F.col("_prediction") == 1.0).drop(
        "_words", "_tf", "_features", "_raw", "_probability", "_prediction")


def category_model(labeled: DataFrame):
    """Fit on ``(text, category)``; labels are indexed by frequency."""
    indexer = StringIndexer(inputCol="category", outputCol="label", stringOrderType="alphabetAsc")
    labeled = _training(labeled.select("text", "category"))
    idx = indexer.fit(labeled)
    model = text_classifier().fit(idx.transform(labeled))
    return idx, model


def predict_category(idx, model, df: DataFrame) -> DataFrame:
    labels = idx.labels
    out = model.transform(df)
    mapping = F.array(*[F.lit(x) for x in labels])
    return out.withColumn("category", F.element_at(mapping, F.col("_prediction").cast("int") + 1)) \
        .drop("_words", "_tf", "_features", "_raw", "_probability", "_prediction")


# --- registered queries (rows-only checks: no SQL form) -------------------

def relevance_ml_query(spark, d):
    from voxsift.sources import tables
    model = relevance_model(tables.labeled_documents(spark, d))
    reviews = tables.reviews(spark, d).select("review_id", "text")
    return predict_relevance(model, reviews).select("review_id", "relevant")


def category_ml_query(spark, d):
    from voxsift.operators.classify import categorize_by_rules
    from voxsift.sources import tables
    reviews = tables.reviews(spark, d).select("review_id", "text")
    weak = categorize_by_rules(reviews).select("text", "category")
    idx, model = category_model(weak)
    return predict_category(idx, model, reviews).select("review_id", "category")
