"""Readers for the provided Parquet tables and the adapters that turn them
into triage inputs (reviews, commands, labels, config).

All adapters are lazy DataFrame expressions: column pruning and predicate
pushdown reach the Parquet scan through Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxsift.functions.jsstr import js_int_prefix, js_int_value

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """feedback rows (store reviews and social posts) from
    ``documents ⋈ events`` on ``event_id = doc_id``.

    Both sides are large at scale, so this stays an equi-join that Catalyst
    plans as sort-merge (or broadcast when AQE measures a small side).
    """
    return reviews_from(table(spark, sf_dir, "documents"), table(spark, sf_dir, "events"))


def reviews_from(docs: DataFrame, ev: DataFrame) -> DataFrame:
    """The F1 adapter over any documents/events frames (batch or a
    micro-batch of a stream)."""
    j = docs.join(ev, docs.doc_id == ev.event_id, "inner")
    username = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    return j.select(
        F.col("doc_id").alias("review_id"),
        F.col("source").alias("app_id"),
        F.col("text"),
        F.col("lang").alias("language"),
        F.floor("value").cast("bigint").alias("votes"),
        F.col("ts").alias("created_at"),
        username.alias("username"),
        F.concat(F.lit("https://example.com/"), username, F.lit("/status/"),
                 F.col("doc_id").cast("string")).alias("url"),
        F.when(F.col("doc_id") % 2 == 0, F.lit("store")).otherwise(F.lit("social"))
        .alias("channel"),
    )


def command_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one command per event; the argument is ``props.$.k`` as text."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("command_id"),
        F.get_json_object("props", "$.k").alias("parameters"),
        F.col("ts").alias("issued_at"),
    )


def command_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Command texts at volume: events become store commands (even ids) or
    social commands (odd ids) whose argument string is derived from the
    event's type and ``props.$.k``, so every parser branch (help, empty,
    hex, trailing junk, unknown mode, out-of-range counts) occurs.  ``app_id``
    is the app of the installation that sent the command."""
    ev = (table(spark, sf_dir, "events")
          .withColumn("_k", F.get_json_object("props", "$.k"))
          .withColumn("_digits", js_int_prefix("_k"))
          .withColumn("_kn", js_int_value("_digits")))
    k, kn = F.col("_k"), F.col("_kn")
    app = F.concat(F.lit("src"), (kn % 20).cast("string"))
    store_arg = (
        F.when(F.col("event_type") == "view", k)
        .when(F.col("event_type") == "click", F.concat(F.lit(" "), k, F.lit("abc\n")))
        .when(F.col("event_type") == "signup", F.concat(k, F.lit(".7")))
        .when(F.col("event_type") == "purchase", F.concat(F.lit("0x"), F.hex(kn)))
        .when(kn % 10 == 0, F.lit(" help\ufeff"))
        .when(kn % 10 == 1, F.lit("  \n"))
        .when(kn % 10 == 2, F.lit("abc"))
        .otherwise((kn * 3).cast("string"))
    )
    social_arg = (
        F.when(F.col("event_type") == "view", F.concat(F.lit("search "), app, F.lit(" "), k))
        .when(F.col("event_type") == "click", F.concat(F.lit("hashtag "), app, F.lit(" "), k))
        .when(F.col("event_type") == "signup",
              F.concat(F.lit("search "), app, F.lit(" "), k, F.lit(" extra")))
        .when(F.col("event_type") == "purchase", F.concat(F.lit("trend "), app, F.lit(" "), k))
        .when(kn % 10 == 0, F.lit("help"))
        .when(kn % 10 == 1, F.lit(""))
        .when(kn % 10 == 2, F.concat(F.lit("search  "), app, F.lit(" "), k))
        .otherwise(F.concat(F.lit("search "), app, F.lit(" "), (kn * 3).cast("string")))
    )
    is_store = F.col("event_id") % 2 == 0
    return ev.select(
        F.col("event_id").alias("command_id"),
        F.when(is_store, F.lit("playstore_reviews_process"))
        .otherwise(F.lit("twitter_reviews_process")).alias("command"),
        F.when(is_store, store_arg).otherwise(social_arg).alias("parameters"),
        F.col("ts").alias("issued_at"),
        app.alias("app_id"),
    )


def labeled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``labels ⋈ documents`` with ``relevant = quality = 1``."""
    lab = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lab.join(docs, "doc_id").select(
        "doc_id", "text", (F.col("quality") == 1).alias("relevant"),
        (F.col("toxic") == 1).alias("toxic"))


# Defaults applied when an app leaves its part or owner unset (the
# organization-level defaults of the deployment).
DEFAULT_PART_ID = "part:default"
DEFAULT_OWNER_ID = "owner:default"
# The social command's default argument string and the search
# start date the social search uses.
SOCIAL_DEFAULT_ARGS = "search blinkiteng 10"
SOCIAL_START_DATE = "2022-01-01"
STORE_DEFAULT_ARGS = "10"
# The search start date of the registered queries: inside the events' span,
# so that the filter drops rows.
SEARCH_FROM = "2024-01-02"

CONFIG_SCHEMA = T.StructType([
    T.StructField("app_id", T.StringType()),
    T.StructField("app_name", T.StringType()),
    T.StructField("default_part_id", T.StringType()),
    T.StructField("default_owner_id", T.StringType()),
])


def app_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-app organization inputs, one row per app seen in ``documents``.

    Part and owner are left unset for some apps (the manifest default
    applies) and one app in ten has an empty required name (rejected)."""
    docs = table(spark, sf_dir, "documents").select("source").distinct()
    num = F.regexp_extract("source", r"([0-9]+)$", 1).try_cast("int")
    return docs.select(
        F.col("source").alias("app_id"),
        F.when(num % 10 == 7, F.lit("")).otherwise(F.concat(F.lit("App "), F.upper("source")))
        .alias("app_name"),
        F.when(num % 3 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("part/"), num.cast("string"))).alias("default_part_id"),
        F.when(num % 4 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("owner/"), num.cast("string"))).alias("default_owner_id"),
    )


# The seven tag names of the manifest, in manifest order.
TAG_NAMES = ["bug", "feature_request", "question", "logistics_experience",
             "positive_feedback", "negative_feedback", "failed_to_infer_category"]
FAILED_CATEGORY = "failed_to_infer_category"


def tags(spark: SparkSession) -> DataFrame:
    """D7: tag dimension (name → id); a fixed 7-row table."""
    rows = [(name, f"tag:{name}", i) for i, name in enumerate(TAG_NAMES)]
    return spark.createDataFrame(rows, "category string, tag_id string, tag_order int")


# Routing of commands and event types to step functions.
ROUTES = [
    ("command", "playstore_reviews_process", "process_playstore_reviews"),
    ("command", "twitter_reviews_process", "process_twitter_reviews"),
    ("event", "work_created", "on_work_creation"),
    ("event", "purchase", "record_purchase"),
    ("event", "error", "open_ticket"),
]


def routes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ROUTES, "source string, event_type string, function string")
