"""Registered queries: one ``(spark, sf_dir) -> DataFrame`` per operator
group of the survey.  Every query reads the provided tables (or data Spark
derives from them) in full; limits appear only where the limit is the
feature (top-N fetches, the first work item).

The matching DuckDB SQL lives in ``voxsift.plans.oracle``; column names and
types line up one to one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxsift.functions.jsstr import iso_utc, longer_than, utf16_length
from voxsift.functions.replies import (field_type, is_duplicate, keep_relevant, match_index,
                                       parse_reply)
from voxsift.operators.classify import (categorize_by_rules, noise_filter,
                                        relevance_by_rules)
from voxsift.operators.commands import STORE, parse_commands, route
from voxsift.operators.dedup import (exact_groups, exact_membership, leader_context,
                                     replay_duplicates)
from voxsift.operators.fetch import (PAGE_SIZE, build_pages, explode_pages, normalize_sources, page_log,
                                     search_posts, social_posts, top_n, with_order_key)
from voxsift.operators.model import (RELEVANCE_TEMPLATE, model_map, prompts,
                                     replay_replies, token_count_model)
from voxsift.operators import reply_gate
from voxsift.operators.summarize import summarize
from voxsift.operators.tickets import (active_messages, attach_config, attach_tags,
                                       command_messages, latest_messages, priority,
                                       resolve_config, ticket_id,
                                       ticket_messages)
from voxsift.plans.triage import feedback, flat_tickets, ticket_rows, triage
from voxsift.session import materialize, scratch_path
from voxsift.sources import connector, tables

TOP_N = 10
ACTIVE_AT = "2024-01-02 12:00:00"
Query = Callable[[SparkSession, str], DataFrame]


def _reviews(spark: SparkSession, d: str) -> DataFrame:
    return tables.reviews(spark, d)


def _per_app(spark: SparkSession, d: str) -> DataFrame:
    return _reviews(spark, d).withColumn("command_id", F.col("app_id"))


def _all_in_one(spark: SparkSession, d: str) -> DataFrame:
    """Dedup queries use one command for every row: copies cross apps."""
    return with_order_key(_reviews(spark, d)).withColumn("command_id", F.lit("all"))


# --- fetch, commands, routing -------------------------------------------

def topn_helpful(spark, d):
    r = top_n(_per_app(spark, d), TOP_N, ["command_id"])
    return r.select("command_id", "review_id", "votes", F.col("rank").cast("bigint").alias("rank"))


def noise_filter_q(spark, d):
    r = noise_filter(_reviews(spark, d))
    return r.select("review_id", utf16_length("text").alias("text_units"),
                    longer_than(F.col("text"), 20).alias("over_20"))


_PARSED_COLS = ["command_id", "command", "trimmed", "mode", "term", "requested", "status",
                "fetch_n"]


def command_parse(spark, d):
    return parse_commands(tables.command_events(spark, d)).select(*_PARSED_COLS)


def command_count_from_props(spark, d):
    c = tables.command_counts(spark, d).withColumn("command", F.lit(STORE))
    return parse_commands(c).select("command_id", "parameters", "requested", "status", "fetch_n")


def route_events(spark, d):
    ev = tables.table(spark, d, "events").select("event_id", "event_type")
    return route(ev, tables.routes(spark), known_rows=len(tables.ROUTES)).select(
        "event_id", "event_type", "function", "route_status")


def config_defaults(spark, d):
    r = _reviews(spark, d).select("review_id", "app_id")
    return attach_config(r, tables.app_config(spark, d)).select(
        "review_id", "app_id", "app_name", "part_id", "owner_id", "config_error")


def union_sources(spark, d):
    return normalize_sources(_reviews(spark, d)).select(
        "source", "review_id", "app_id", "url", "votes", "title", "ticket_text")


def _parsed(spark, d):
    """Parsed commands, checkpointed: filters on parse results would
    otherwise be pushed into the parser's staged projections."""
    return materialize(parse_commands(tables.command_events(spark, d)))


def _search_commands(spark, d, mode):
    c = _parsed(spark, d)
    return c.where((F.col("mode") == mode) & (F.col("fetch_n") > 0))


def _max_fetch(cmds: DataFrame) -> int:
    return int(cmds.agg(F.max("fetch_n")).first()[0] or 0)


def _search(spark, d, mode, page_size=1, with_commands=False):
    cmds = _search_commands(spark, d, mode)
    posts = social_posts(_reviews(spark, d))
    found = search_posts(posts, cmds, mode, _max_fetch(cmds), page_size, tables.SEARCH_FROM)
    return (found, cmds) if with_commands else found


def mention_search(spark, d):
    return _search(spark, d, "search").select(
        "command_id", "review_id", F.col("rank").cast("bigint").alias("rank"))


def hashtag_search(spark, d):
    return _search(spark, d, "hashtag").select(
        "command_id", "review_id", F.col("rank").cast("bigint").alias("rank"))


def page_log_q(spark, d):
    return page_log(_search(spark, d, "search"), start_date=tables.SEARCH_FROM)


def page_log_hashtag(spark, d):
    return page_log(_search(spark, d, "hashtag"), mode="hashtag")


def page_explode(spark, d):
    offered, cmds = _search(spark, d, "search", page_size=PAGE_SIZE, with_commands=True)
    # The wanted counts come from the (checkpointed) commands, not from a
    # second pass over the offered rows; the join to pages keeps only
    # commands that were offered something.
    return explode_pages(build_pages(offered), cmds.select("command_id", "fetch_n"))


def _stored_pages(spark, d):
    """The offered pages stored by two fetches, even commands and odd ones."""
    offered, cmds = _search(spark, d, "search", page_size=PAGE_SIZE, with_commands=True)
    pages = materialize(build_pages(offered).join(cmds.select("command_id", "fetch_n"), "command_id"))
    folder = scratch_path(spark, f"pages/{uuid.uuid4().hex}")
    for fetch in (0, 1):
        connector.store_pages(pages.where(F.col("command_id") % 2 == fetch), folder, fetch)
    return folder


def page_connector(spark, d):
    return connector.read_pages(spark, _stored_pages(spark, d))


def page_connector_stream(spark, d):
    folder = _stored_pages(spark, d)
    sink = f"{folder}-sink"
    q = (connector.stream_pages(spark, folder).writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", f"{folder}-checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink)


def work_list_first(spark, d):
    tix = triage(spark, d).tickets
    return (tix.where(F.col("type") == "ticket").orderBy("ticket_id").limit(1)
            .select("ticket_id", "review_id", "title"))


# --- replies, relevance, categories -------------------------------------

def replies_from_labels(spark: SparkSession, d: str) -> DataFrame:
    """Recorded model replies stood in by the ``labels`` table: the label
    decides the answer; the reply form (string, boolean, null, missing,
    malformed, fenced) rotates with the id so every parse branch occurs."""
    lab = tables.table(spark, d, "labels")
    q = F.when(F.col("quality") == 1, F.lit("true")).otherwise(F.lit("false"))
    m6 = F.col("doc_id") % 6
    rel = (F.when(m6 == 0, F.concat(F.lit('{"relevance":"'), q, F.lit('","reason":"label"}')))
           .when(m6 == 1, F.concat(F.lit('{"relevance":'), q, F.lit("}")))
           .when(m6 == 2, F.lit('{"relevance":null}'))
           .when(m6 == 3, F.lit("{}"))
           .when(m6 == 4, F.lit("not json"))
           .otherwise(F.concat(F.lit('```json\n{"relevance":"'), q, F.lit('"}\n```'))))
    m5 = F.col("doc_id") % 5
    dup = (F.when(m5 == 0, F.concat(F.lit('{"is_duplicate":"true","match_with":'),
                                    F.col("toxic").cast("string"), F.lit("}")))
           .when(m5 == 1, F.concat(F.lit('{"is_duplicate":"true","match_with":"'),
                                   (F.col("toxic") + 1).cast("string"), F.lit('"}')))
           .when(m5 == 2, F.lit('{"is_duplicate":"true","match_with":-1}'))
           .when(m5 == 3, F.lit('{"is_duplicate":true,"match_with":0}'))
           .otherwise(F.lit('{"is_duplicate":"false","match_with":-1}')))
    return lab.select("doc_id", rel.alias("relevance_reply"), dup.alias("duplicate_reply"))


def reply_parse(spark, d):
    r = replies_from_labels(spark, d)
    rv = parse_reply(F.col("relevance_reply"))
    dv = parse_reply(F.col("duplicate_reply"))
    return r.select("doc_id", field_type(rv, "relevance").alias("relevance_type"),
                    keep_relevant(rv).alias("keep"), is_duplicate(dv).alias("is_dup"),
                    match_index(dv).alias("match_with"))


def reply_rejects(spark, d):
    """Both steps' replies, split and stored in one pass; the rejects of the stored table."""
    gated = reply_gate.gate(replies_from_labels(spark, d), ["doc_id"], {
        "relevance": ("relevance_reply", reply_gate.RELEVANCE),
        "duplicate": ("duplicate_reply", reply_gate.DUPLICATE)})
    path = scratch_path(spark, f"replies/{uuid.uuid4().hex}")
    reply_gate.write_split(gated, path)
    stored = spark.read.schema(f"{gated.schema.toDDL()}, accepted boolean").parquet(path)
    return reply_gate.rejects(stored.where(~F.col("accepted")), ["doc_id"])


def relevance_rules(spark, d):
    return relevance_by_rules(_reviews(spark, d)).select(
        "review_id", "relevance_score", "relevant")


def category_rules(spark, d):
    c = attach_tags(categorize_by_rules(_reviews(spark, d)), tables.tags(spark))
    return c.select("review_id", "category", F.col("category_score").cast("bigint")
                    .alias("category_score"), "tag_id")


def _ticket_rows(spark, d):
    return ticket_rows(spark, d, tables.reviews(spark, d))


def severity_tickets(spark, d):
    return _ticket_rows(spark, d).drop("created_at", "text")


def _active(spark, d):
    return active_messages(ticket_messages(_ticket_rows(spark, d)),
                           F.lit(ACTIVE_AT).cast("timestamp_ntz"))


def messages_active(spark, d):
    return _active(spark, d).select("command_id", "review_id", "seq", "body",
                                    iso_utc(F.col("expires_at")).alias("expires_at"))


def messages_latest(spark, d):
    log = command_messages(parse_commands(tables.command_events(spark, d)))
    return latest_messages(log)


def rejects(spark, d):
    parsed = _parsed(spark, d)
    cmd = parsed.where(F.col("status").startswith("reject")).select(
        F.lit("command").alias("step"), F.col("command_id").cast("string").alias("key"),
        F.col("status").alias("message"), F.to_json(F.struct("parameters")).alias("detail"))
    ev = tables.table(spark, d, "events").select("event_id", "event_type")
    rt = route(ev, tables.routes(spark), known_rows=len(tables.ROUTES)).where(
        F.col("route_status") == "rejected").select(
        F.lit("route").alias("step"), F.col("event_id").cast("string").alias("key"),
        F.lit("no route for event type").alias("message"),
        F.to_json(F.struct("event_type")).alias("detail"))
    cf = resolve_config(tables.app_config(spark, d)).where(F.col("config_error").isNotNull()).select(
        F.lit("config").alias("step"), F.col("app_id").alias("key"),
        F.lit("missing required input").alias("message"),
        F.to_json(F.struct("config_error")).alias("detail"))
    return cmd.unionByName(rt).unionByName(cf)


# --- dedup ----------------------------------------------------------------

def dedup_exact(spark, d):
    return exact_groups(noise_filter(_all_in_one(spark, d))).select(
        "command_id", "leader_id", "total_reviews", "total_votes")


def _topn_leaders(spark, d):
    r = noise_filter(top_n(_per_app(spark, d), TOP_N, ["command_id"]))
    return exact_membership(r).where(F.col("is_leader"))


def dedup_context(spark, d):
    leaders = _topn_leaders(spark, d).withColumnRenamed("text", "summary")
    return leader_context(leaders)


def dedup_replay(spark, d):
    r = top_n(_per_app(spark, d), TOP_N, ["command_id"])
    m = F.col("review_id") % 4
    reply = (F.when(m == 0, F.lit('{"is_duplicate":"false","match_with":-1}'))
             .when(m == 1, F.concat(F.lit('{"is_duplicate":"true","match_with":'),
                                    (F.col("votes") % 3).cast("string"), F.lit("}")))
             .when(m == 2, F.concat(F.lit('{"is_duplicate":"true","match_with":"'),
                                    (F.col("votes") % 2).cast("string"), F.lit('"}')))
             .otherwise(F.lit('{"is_duplicate":true}')))
    return replay_duplicates(r.withColumn("reply", reply))


# --- text steps -----------------------------------------------------------

def summary_extract(spark, d):
    return summarize(_reviews(spark, d).select("review_id", "text")).select(
        "review_id", "title", "summary")


def triage_end_to_end(spark, d):
    return flat_tickets(triage(spark, d).tickets)


def issues_q(spark, d):
    iss = triage(spark, d).issues
    return iss.select("command_id", "review_id", "issue_id", "ticket_id", "title", "body",
                      "priority", "category")


def issues_typical(spark, d):
    return triage(spark, d, typical_issues=True).issues.select(
        "command_id", "review_id", "issue_id", "title", "body", "priority", "category")


def _prompts(spark, d):
    r = _reviews(spark, d).select("review_id", "app_id", "text")
    return prompts(attach_config(r, tables.app_config(spark, d)), RELEVANCE_TEMPLATE)


def model_map_replay(spark, d):
    p = _prompts(spark, d)
    lab = replies_from_labels(spark, d).select(
        F.col("doc_id").alias("review_id"), F.col("relevance_reply").alias("reply"))
    recorded = p.join(lab, "review_id").select(F.lit("relevance").alias("step"), "prompt_sha",
                                               "reply")
    out = replay_replies(p, recorded, "relevance")
    return out.select("review_id", "prompt_sha", F.col("reply").isNotNull().alias("has_reply"),
                      keep_relevant(parse_reply(F.col("reply"))).alias("keep"))


def model_map_udf(spark, d):
    out = model_map(_prompts(spark, d), token_count_model)
    return out.select("review_id", "reply", keep_relevant(parse_reply(F.col("reply"))).alias("keep"))


def _registry() -> dict[str, Query]:
    from voxsift.operators import bayes, ml, neardup, rank, summary_dedup
    from voxsift.plans import command_triage
    from voxsift.streaming import command_stream, leader_state, triage_stream
    return {
        "topn_helpful": topn_helpful,
        "noise_filter": noise_filter_q,
        "command_parse": command_parse,
        "command_count_from_props": command_count_from_props,
        "route_events": route_events,
        "config_defaults": config_defaults,
        "union_sources": union_sources,
        "mention_search": mention_search,
        "hashtag_search": hashtag_search,
        "page_log": page_log_q,
        "page_log_hashtag": page_log_hashtag,
        "page_explode": page_explode,
        "page_connector": page_connector,
        "page_connector_stream": page_connector_stream,
        "engagement_rank": rank.engagement_rank_query,
        "work_list_first": work_list_first,
        "reply_parse": reply_parse,
        "reply_rejects": reply_rejects,
        "relevance_rules": relevance_rules,
        "relevance_ml": ml.relevance_ml_query,
        "relevance_bayes": bayes.relevance_bayes_query,
        "relevance_bayes_all": bayes.relevance_bayes_all_query,
        "category_rules": category_rules,
        "category_ml": ml.category_ml_query,
        "severity_tickets": severity_tickets,
        "issues": issues_q,
        "issues_typical": issues_typical,
        "messages_active": messages_active,
        "messages_latest": messages_latest,
        "rejects": rejects,
        "dedup_exact": dedup_exact,
        "dedup_pairs": neardup.dedup_pairs_query,
        "dedup_leaders": neardup.dedup_leaders_query,
        "dedup_summary": summary_dedup.dedup_summary_query,
        "dedup_context": dedup_context,
        "dedup_replay": dedup_replay,
        "summary_extract": summary_extract,
        "model_map_replay": model_map_replay,
        "model_map_udf": model_map_udf,
        "triage_end_to_end": triage_end_to_end,
        "command_tickets": command_triage.command_tickets_query,
        "command_issues": command_triage.command_issues_query,
        "stream_triage": triage_stream.stream_triage_query,
        "stream_leaders": triage_stream.stream_leaders_query,
        "stream_events_once": triage_stream.stream_events_once_query,
        "stream_command_leaders": leader_state.stream_command_leaders_query,
        "webhook_once": triage_stream.webhook_once_query,
        "stream_commands": command_stream.stream_commands_query,
    }


def queries() -> dict[str, Query]:
    return _registry()


__all__ = ["queries", "feedback"]
