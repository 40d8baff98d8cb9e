"""Command parsing, validation and routing (PRJ-1..3, FLT-1, FLT-10..12,
SCA-1..5, JN-7).

A command row is ``(command_id, command, parameters, ...)``.  Parsing is a
pure projection, so a billion commands parse in one map stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxsift.functions.jsstr import js_int_prefix, js_int_value, js_split3, js_trim
from voxsift.operators.joins import small_dim
from voxsift.sources.tables import SOCIAL_DEFAULT_ARGS, STORE_DEFAULT_ARGS

STORE = "playstore_reviews_process"
SOCIAL = "twitter_reviews_process"
MAX_ADVISED = 100

# status values
OK = "ok"
HELP = "help"
WARN_OVER = "warn_over_100"
WARN_NON_POSITIVE = "warn_non_positive"
REJECT_NAN = "reject_not_integer"
REJECT_MODE = "reject_unknown_mode"


def parse_commands(commands: DataFrame, over_limit: str = "warn") -> DataFrame:
    """Parse store and social commands in one projection.

    ``over_limit`` picks the policy for counts above 100: ``warn`` (the
    reference: keep the count), ``clamp`` (use 100) or ``reject``.
    Non-integers and unknown modes become reject statuses instead of a NaN
    fetch or an aborted run; counts ``<= 0`` fetch nothing and warn.
    """
    if over_limit not in ("warn", "clamp", "reject"):
        raise ValueError(f"over_limit must be warn, clamp or reject, not {over_limit!r}")
    st = STORE_DEFAULT_ARGS
    # Staged projections: each step is an attribute for the next, so the
    # generated code stays small and every regex runs once per row.
    d = commands.withColumn("trimmed", js_trim(F.col("parameters")))
    d = d.withColumn("_store", F.col("command") == STORE).withColumn(
        "_help", F.col("trimmed") == "help")
    d = d.withColumn("_eff", F.when(F.col("trimmed") == "", F.when(
        F.col("_store"), F.lit(st)).otherwise(F.lit(SOCIAL_DEFAULT_ARGS))).otherwise(F.col("trimmed")))
    d = d.withColumn("_pieces", js_split3(F.col("_eff")))
    is_store = F.col("_store")
    none = F.lit(None).cast("string")
    d = (d.withColumn("_mode", F.when(is_store, none).otherwise(F.try_element_at("_pieces", F.lit(1))))
         .withColumn("_term", F.when(is_store, none).otherwise(F.try_element_at("_pieces", F.lit(2))))
         .withColumn("_digits", js_int_prefix(F.when(is_store, F.col("_eff"))
                                              .otherwise(F.try_element_at("_pieces", F.lit(3)))))
         .withColumn("_n", js_int_value("_digits")))
    n, mode, is_help = F.col("_n"), F.col("_mode"), F.col("_help")
    over_status = {"warn": WARN_OVER, "clamp": WARN_OVER, "reject": "reject_over_100"}[over_limit]
    status = (
        F.when(is_help, F.lit(HELP))
        .when(n.isNull(), F.lit(REJECT_NAN))
        .when(~is_store & ~mode.isin("hashtag", "search"), F.lit(REJECT_MODE))
        .when(n > MAX_ADVISED, F.lit(over_status))
        .when(n <= 0, F.lit(WARN_NON_POSITIVE))
        .otherwise(F.lit(OK))
    )
    d = d.withColumn("status", status)
    fetch_n = (
        F.when(F.col("status").isin(OK, WARN_OVER),
               F.least(n, F.lit(MAX_ADVISED)) if over_limit == "clamp" else n)
        .when(F.col("status") == WARN_NON_POSITIVE, F.lit(0).cast("bigint"))
    )
    return (d.withColumn("mode", F.when(is_help, none).otherwise(mode))
            .withColumn("term", F.when(is_help, none).otherwise(F.col("_term")))
            .withColumn("requested", F.when(is_help, F.lit(None).cast("bigint")).otherwise(n))
            .withColumn("fetch_n", fetch_n.cast("bigint"))
            .drop("_store", "_help", "_eff", "_pieces", "_mode", "_term", "_digits", "_n"))


def route(events: DataFrame, routes: DataFrame, source: str = "event",
          key: str = "event_type", known_rows: int | None = None) -> DataFrame:
    """JN-7 / FLT-15: attach the handling function; unmatched rows keep a
    NULL function and a ``rejected`` status instead of stopping the run.
    The route table is a fixed handful of rows and is broadcast."""
    r = routes.where(F.col("source") == source).select(
        F.col("event_type").alias("_route_key"), "function")
    out = events.join(small_dim(r, 10_000, known_rows), events[key] == F.col("_route_key"), "left")
    return out.drop("_route_key").withColumn(
        "route_status",
        F.when(F.col("function").isNull(), F.lit("rejected")).otherwise(F.lit("routed")))
