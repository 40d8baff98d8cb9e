"""Severity, priority and the ticket / issue / message records (SCA-16,
SCA-17, FLT-5, JN-1, JN-5, JN-8, PRJ-8..11, SNK-5, SCA-13, SRC-10).

Records are plain projections plus broadcast joins to the fixed tag table
and the size-checked per-app config, so they add no shuffle of their own.
Ids are deterministic (``sha2`` of command and review), which makes writes
idempotent across task retries and reruns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxsift.operators.joins import small_dim
from voxsift.sources.tables import (DEFAULT_OWNER_ID, DEFAULT_PART_ID, FAILED_CATEGORY,
                                    SOCIAL_DEFAULT_ARGS, TAG_NAMES)

MESSAGE_LIFETIME_MINUTES = 1
MAX_BROADCAST_APPS = 100_000

# Message texts.
FETCHING = "Fetching reviews from {}"
FETCHED = "Fetched {} reviews, creating tickets now."
CREATING_TICKET = "Creating ticket for review: {}"
CREATED_TICKET = "Created ticket: <{}> and it is categorized as {}"
CREATED_TICKET_FAILED = "Created ticket: <{}> and it failed to be categorized"
CREATING_ISSUE = "Creating issue for review: {}"
CREATED_ISSUE = "Created issue: <{}> and it is categorized as {}"
NOT_A_NUMBER = "Please enter a valid number"
OVER_LIMIT = "Please enter a number less than 100"


STORE_HELP = (
    "playstore_reviews_process - fetch store reviews and turn them into tickets.\n\n"
    "Usage: /playstore_reviews_process <number_of_reviews_to_fetch>\n\n"
    "number_of_reviews_to_fetch: how many reviews to fetch, 1 to 100; default 10.")
SOCIAL_HELP = (
    "twitter_reviews_process - fetch social posts and turn them into tickets.\n\n"
    "Usage: /twitter_reviews_process <hashtag/search> <item_to_search> "
    "<number_of_reviews_to_fetch>\n\n"
    "number_of_reviews_to_fetch: how many posts to fetch, 1 to 100; "
    f"default: {SOCIAL_DEFAULT_ARGS}.")


def filled(message: str, *values: Column) -> Column:
    """A message text with its places filled by columns."""
    parts = message.split("{}")
    out = [F.lit(parts[0])]
    for value, part in zip(values, parts[1:]):
        out += [value, F.lit(part)]
    return F.concat(*out)


def command_messages(parsed: DataFrame, store_command: str = "playstore_reviews_process"
                     ) -> DataFrame:
    """PRJ-11 message log of each parsed command: help text, or the fetch
    notice, the validation message and the fetched notice, in ``seq``
    order.  All entries of a command share one message id (the command)."""
    is_store = F.col("command") == store_command
    label = F.when(is_store, F.lit("Playstore")).otherwise(F.lit("Twitter"))
    st = F.col("status")
    first = F.when(st == "help", F.when(is_store, F.lit(STORE_HELP)).otherwise(F.lit(SOCIAL_HELP))
                   ).otherwise(filled(FETCHING, label))
    second = (F.when(st == "reject_not_integer", F.lit(NOT_A_NUMBER))
              .when(st.isin("warn_over_100", "reject_over_100"), F.lit(OVER_LIMIT)))
    third = F.when(st.isin("ok", "warn_over_100", "warn_non_positive"),
                   filled(FETCHED, F.col("requested").cast("string")))
    entries = F.array(F.struct(F.lit(1).alias("seq"), first.alias("body")),
                      F.struct(F.lit(2).alias("seq"), second.alias("body")),
                      F.struct(F.lit(3).alias("seq"), third.alias("body")))
    return (parsed.select("command_id", "issued_at", F.explode(entries).alias("m"))
            .where(F.col("m.body").isNotNull())
            .select("command_id", F.col("m.seq").cast("bigint").alias("seq"),
                    F.col("m.body").alias("body"), "issued_at"))


def latest_messages(log: DataFrame, key: str = "command_id") -> DataFrame:
    """SNK-4 latest-wins upsert: the last body per message id by ``seq``,
    as an aggregate (partial on the map side), not a window sort."""
    last = F.max_by(F.struct("seq", "body"), F.col("seq"))
    return log.groupBy(key).agg(last.alias("_m")).select(
        key, F.col("_m.seq").alias("seq"), F.col("_m.body").alias("body"))


def severity(category: Column) -> Column:
    """SCA-16 decision table; ``blocker`` marks praise (no issue)."""
    return (F.when(category == "positive_feedback", F.lit("blocker"))
            .when(category.isin("feature_request", "question"), F.lit("low"))
            .when(category.isin("negative_feedback", "logistics_experience"), F.lit("medium"))
            .otherwise(F.lit("high")))


def priority(sev: Column) -> Column:
    """SCA-17: low → p3, medium → p2, anything else but blocker → p1."""
    return (F.when(sev == "blocker", F.lit(None).cast("string"))
            .when(sev == "low", F.lit("p3")).when(sev == "medium", F.lit("p2"))
            .otherwise(F.lit("p1")))


def resolve_config(config: DataFrame) -> DataFrame:
    """SRC-10: manifest defaults for unset ids; a required value that is
    still empty marks the app as misconfigured."""
    part = F.coalesce(F.nullif(F.col("default_part_id"), F.lit("")), F.lit(DEFAULT_PART_ID))
    owner = F.coalesce(F.nullif(F.col("default_owner_id"), F.lit("")), F.lit(DEFAULT_OWNER_ID))
    name = F.coalesce(F.col("app_name"), F.lit(""))
    missing = F.concat_ws(",", F.when(name == "", F.lit("app_name")),
                          F.when(F.coalesce(F.col("app_id"), F.lit("")) == "", F.lit("app_id")))
    return config.select("app_id", name.alias("app_name"), part.alias("part_id"),
                         owner.alias("owner_id"), F.nullif(missing, F.lit("")).alias("config_error"))


def attach_config(df: DataFrame, config: DataFrame) -> DataFrame:
    """JN-5: per-app config on every row; broadcast only below the bound.  An
    app without a config row lacks its required inputs."""
    resolved = resolve_config(config).withColumn("_known", F.lit(True))
    out = df.join(small_dim(resolved, MAX_BROADCAST_APPS), "app_id", "left")
    error = F.when(F.col("_known").isNull(), F.lit("app_id")).otherwise(F.col("config_error"))
    return out.withColumn("config_error", error).drop("_known")


def attach_tags(df: DataFrame, tags: DataFrame) -> DataFrame:
    """JN-1 / JN-2: category → tag id against the fixed 7-row tag table;
    a category outside the tags becomes failed_to_infer_category."""
    t = small_dim(tags.select(F.col("category").alias("_tag"), "tag_id"), 1000,
                  known_rows=len(TAG_NAMES))
    out = df.join(t, F.col("category") == F.col("_tag"), "left")
    fixed = F.when(F.col("_tag").isNull(), F.lit(FAILED_CATEGORY)).otherwise(F.col("category"))
    failed_id = F.lit(f"tag:{FAILED_CATEGORY}")
    return (out.withColumn("category", fixed)
            .withColumn("tag_id", F.coalesce(F.col("tag_id"), failed_id)).drop("_tag"))


def ticket_id(command_id: Column, review_id: Column, kind: str = "ticket") -> Column:
    return F.sha2(F.concat_ws(":", F.lit(kind), command_id.cast("string"),
                              review_id.cast("string")), 256)


def tickets(df: DataFrame, extra: list[str] | tuple = ()) -> DataFrame:
    """PRJ-8 / SNK-1 records.  Needs ``command_id, review_id, url, title,
    summary, category, tag_id, part_id, owner_id``; ``extra`` columns are
    carried along."""
    sev = severity(F.col("category"))
    return df.select(
        "command_id", "review_id", "source",
        ticket_id(F.col("command_id"), F.col("review_id")).alias("ticket_id"),
        F.col("title"),
        F.array(F.struct(F.col("tag_id").alias("id"))).alias("tags"),
        F.concat(F.col("summary"), F.lit("\n"), F.col("url")).alias("body"),
        F.lit("ticket").alias("type"),
        F.array(F.col("owner_id")).alias("owned_by"),
        F.col("part_id").alias("applies_to_part"),
        sev.alias("severity"),
        (sev != "blocker").alias("needs_issue"),
        "category", *extra,
    )


def issues(tix: DataFrame, issue_text: DataFrame, reuse_ticket_text: bool = False) -> DataFrame:
    """FLT-5 / SCA-17 / PRJ-9 / PRJ-10 / JN-8 / SNK-2.

    Store issues: ``issue_title + "Ticket ID:" + ticket_id`` and
    ``issue_summary\\nurl``.  Social issues, and all issues with
    ``reuse_ticket_text``, take the ticket's title and body (Q14).
    ``issue_text`` is ``(command_id, review_id, issue_title, issue_summary,
    url)`` of the store reviews that need an issue: a review fetched by two
    commands has a ticket and an issue in each."""
    return issue_rows(tix.where(F.col("needs_issue")).join(issue_text, ["command_id", "review_id"], "left"),
                      reuse_ticket_text)


def issue_rows(rows: DataFrame, reuse_ticket_text: bool = False) -> DataFrame:
    """The issues of ticket rows that carry their issue text already."""
    j = rows.where(F.col("needs_issue"))
    is_store = (F.col("source") == "store") & F.lit(not reuse_ticket_text)
    title = F.when(is_store, F.concat(F.col("issue_title"), F.lit("Ticket ID:"),
                                      F.col("ticket_id"))).otherwise(F.col("title"))
    body = F.when(is_store, F.concat(F.col("issue_summary"), F.lit("\n"), F.col("url"))) \
        .otherwise(F.col("body"))
    return j.select(
        "command_id", "review_id", "source",
        ticket_id(F.col("command_id"), F.col("review_id"), "issue").alias("issue_id"),
        "ticket_id", title.alias("title"), "tags", body.alias("body"),
        F.lit("issue").alias("type"), "owned_by", "applies_to_part",
        priority(F.col("severity")).alias("priority"), "category")


def ticket_messages(rows: DataFrame, at: str = "created_at") -> DataFrame:
    """PRJ-11 / SNK-3 / SNK-5 in one pass over ticket rows (``ticket_id``,
    ``category``, ``needs_issue``): the two ticket messages, plus the two
    issue messages when an issue is due — one explode, no union of
    branches, so the rows are computed once."""
    cat = F.col("category")
    created_ticket = F.when(cat != FAILED_CATEGORY, filled(CREATED_TICKET, F.col("ticket_id"), cat)
                            ).otherwise(filled(CREATED_TICKET_FAILED, F.col("ticket_id")))
    issue_id = ticket_id(F.col("command_id"), F.col("review_id"), "issue")
    rid = F.col("review_id").cast("string")
    need = F.col("needs_issue")
    entries = F.array(
        F.struct(F.lit(1).alias("seq"), filled(CREATING_TICKET, rid).alias("body")),
        F.struct(F.lit(2).alias("seq"), created_ticket.alias("body")),
        F.struct(F.lit(3).alias("seq"),
                 F.when(need, filled(CREATING_ISSUE, rid)).alias("body")),
        F.struct(F.lit(4).alias("seq"),
                 F.when(need, filled(CREATED_ISSUE, issue_id, cat)).alias("body")))
    m = rows.select("command_id", "review_id", F.col(at).alias("at"), F.explode(entries).alias("m"))
    return m.where(F.col("m.body").isNotNull()).select(
        "command_id", "review_id", F.col("m.seq").cast("bigint").alias("seq"),
        F.col("m.body").alias("body"),
        F.lit("text").alias("body_type"), F.lit("internal").alias("visibility"),
        F.col("at").alias("posted_at"),
        (F.col("at") + F.make_interval(mins=F.lit(MESSAGE_LIFETIME_MINUTES)))
        .alias("expires_at"))


def active_messages(messages: DataFrame, now: Column) -> DataFrame:
    """STR-3 reader view: messages not yet expired at ``now``."""
    return messages.where(F.col("expires_at") > now)
