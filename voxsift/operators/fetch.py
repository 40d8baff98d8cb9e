"""Fetch-side operators: per-command top-N, social search, paging and the
union of sources (SRC-2..6, JN-6, WIN-3, WIN-4, SRT-1..3, LIM-1, LIM-2,
SET-1, PRJ-4..7, AGG-3).

Top-N uses ``row_number() <= literal`` so Catalyst inserts a *partial*
``WindowGroupLimit`` before the shuffle: each map task forwards at most N
rows per key, so a key holding a third of all rows never lands whole in one
task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxsift.functions.jsstr import js_or
from voxsift.functions.text import tags_of
from voxsift.operators.joins import small_dim
from voxsift.session import materialize
from voxsift.sources.tables import SOCIAL_START_DATE

PAGE_SIZE = 20
# Provenance only: the request a cursor read would make (neutral host).
SEARCH_ENDPOINT = "https://social.example/search/search"
HASHTAG_ENDPOINT = "https://social.example/hashtag/hashtag"
# Source labels used in ticket texts.
STORE_LABEL = "Playstore"
SOCIAL_LABEL = "Twitter"


def helpfulness_order() -> list[Column]:
    """SRT-1/SRT-2: most votes first; the id makes the order total."""
    return [F.col("votes").desc(), F.col("review_id").asc()]


def top_n(df: DataFrame, n: int, keys: list[str], order: list[Column] | None = None,
          rank_col: str = "rank") -> DataFrame:
    """WIN-4 / LIM-1: first ``n`` rows per key in ``order`` with a 1-based
    rank column.  ``n`` must be a literal for the partial group limit."""
    w = Window.partitionBy(*keys).orderBy(*(order or helpfulness_order()))
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= int(n))


def with_order_key(df: DataFrame, rank_col: str = "rank") -> DataFrame:
    """SRT-3 without a window: ``rank`` becomes the sortable key
    ``(-votes, review_id)``.  It orders rows exactly like the helpfulness
    rank, so ``min(rank)`` picks the same first row, but it needs no
    per-command sort — a command holding a third of all rows is never
    gathered into one task.  Use ``top_n`` when positions are needed."""
    return df.withColumn(rank_col, F.struct((-F.col("votes")).alias("neg_votes"),
                                            F.col("review_id").alias("id")))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread input that Spark would read in fewer tasks than the
    cluster has cores (a small single-file table would otherwise run its text
    work in one task).  Larger inputs are left alone, so they never pay an
    extra shuffle here.  Nothing runs: only the scan's partitions are planned."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


HOT_COMMANDS = 10_000


def join_on_hot_keys(commands: DataFrame, ranked: DataFrame, key: str, hot: int = HOT_COMMANDS) -> DataFrame:
    """``commands`` joined to the ``ranked`` rows of their key.  A key with
    more than ``hot`` commands (found by a count) is dealt into salts of about
    ``hot`` commands, and its ranked rows, and no others, are copied to each
    salt: at most one copy for each ``hot`` commands, and no task gathers all
    commands of a key."""
    counts = commands.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > hot)
    salts = materialize(counts.select(F.col(key).alias("_key"), F.ceil(F.col("_n") / hot).cast("int").alias("_salts")))
    if salts.isEmpty():
        return commands.join(ranked, key)
    n = F.coalesce("_salts", F.lit(1))
    dealt = commands.join(salts, commands[key] == salts["_key"], "left").withColumn(
        "_salt", F.pmod(F.xxhash64("command_id"), n).cast("int")).drop("_key", "_salts")
    copied = ranked.join(salts, ranked[key] == salts["_key"], "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), n - 1))).drop("_key", "_salts")
    return dealt.join(copied, [key, "_salt"]).drop("_salt")


#: Joined rows of a task, about; a key's commands are dealt in quarters of it.
TASK_ROWS = 1_000_000
MAX_BROADCAST_KEYS = 100_000


def join_by_rows(commands: DataFrame, ranked: DataFrame, key: str, rows: int = TASK_ROWS) -> DataFrame:
    """``commands`` joined to the ``ranked`` rows of their key (both cheap to
    read: they are counted first), in tasks of about ``rows`` joined rows.  The
    join is many times its input, from which AQE would size the tasks.  A
    key's commands are dealt into salts of at most a quarter of ``rows``, if it
    has that many commands, and its ranked rows are copied to each salt."""
    counts = commands.groupBy(key).agg(F.count("*").alias("_n"))
    sizes = counts.join(ranked.groupBy(key).agg(F.count("*").alias("_m")), key).withColumn(
        "_rows", F.col("_n") * F.col("_m"))
    salts = F.least(F.ceil(F.col("_rows") * 4 / rows), F.col("_n")).cast("int")
    sizes = materialize(sizes.select(key, "_rows", salts.alias("_salts")))
    total = sizes.agg(F.sum("_rows")).first()[0] or 0
    if total <= rows:
        return commands.join(ranked, key)
    # Spark would deal both sides again into fewer tasks than its own number
    tasks = max(int(commands.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // rows))
    dims = small_dim(sizes.select(key, "_salts"), MAX_BROADCAST_KEYS)
    dealt = commands.join(dims, key).withColumn(
        "_salt", F.pmod(F.xxhash64("command_id"), F.col("_salts")).cast("int")).drop("_salts")
    copied = ranked.join(dims, key).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    return dealt.repartition(tasks, key, "_salt").join(
        copied.repartition(tasks, key, "_salt"), [key, "_salt"]).drop("_salt")


def top_n_per_command(candidates: DataFrame, commands: DataFrame, key: str,
                      max_n: int, order: list[Column] | None = None,
                      page_size: int = 1, hot: int = HOT_COMMANDS) -> DataFrame:
    """JN-6: each command gets the first ``fetch_n`` candidates of its key.

    Candidates are ranked once per key (not per command) and cut at the
    largest requested count, then joined to the commands up to each
    command's own count.  With a ``page_size``, counts are rounded up to
    whole pages: what a paged source would offer before the stop rule.
    """
    offered = F.ceil(F.col("fetch_n") / page_size) * page_size
    # the partial group limit takes an int; no rank goes beyond it
    bound = min(-(-max(int(max_n), 0) // page_size) * page_size, (1 << 31) - 1)
    ranked = top_n(candidates, bound, [key], order)
    return join_on_hot_keys(commands, ranked, key, hot).where(F.col("rank") <= offered)


def social_posts(reviews: DataFrame) -> DataFrame:
    """F1 social rows as posts addressed to the app's handle and tagged with
    the app's hashtag, so mention and hashtag search have targets (the
    provided texts carry none; their e-mail addresses must not match)."""
    return reviews.where(F.col("channel") == "social").select(
        "review_id", "app_id", "language", "votes", "created_at", "username",
        F.concat(F.lit("@"), F.col("app_id"), F.lit(" "), F.col("text"), F.lit(" #"),
                 F.col("app_id")).alias("text"))


def search_posts(posts: DataFrame, commands: DataFrame, mode: str,
                 max_n: int, page_size: int = 1, start_date: str = SOCIAL_START_DATE) -> DataFrame:
    """SRC-3 (``search``: mention, English, on/after the start date) and
    SRC-4 (``hashtag``: no language or date filter); engagement = votes.

    The posts are indexed by their distinct mention/hashtag names (an
    explode, not a scan per command) and equi-joined with the commands.
    """
    sigil = "@" if mode == "search" else "#"
    p = posts
    if mode == "search":
        p = p.where((F.col("language") == "en") &
                    (F.col("created_at") >= F.lit(start_date).cast("timestamp_ntz")))
    indexed = p.select("review_id", "votes", F.explode(F.array_distinct(tags_of("text", sigil)))
                       .alias("term"))
    cmds = commands.where(F.col("mode") == mode).select("command_id", F.lower("term").alias("term"),
                                                        "fetch_n")
    return top_n_per_command(indexed, cmds, "term", max_n, page_size=page_size)


def page_log(fetched: DataFrame, page_size: int = PAGE_SIZE, mode: str = "search",
             start_date: str = SOCIAL_START_DATE) -> DataFrame:
    """SRC-5 / WIN-3 / LIM-2 / AGG-3 / SCA-6 / SCA-15 / SCA-19: the page
    requests a cursor read makes for each command's ranked rows: page
    number, rows on the page, rows seen before, the requested limit
    ``min(20, n - seen)``, the running count and the request URL (the
    continuation token of the previous page from page 2 on).  Exactly N
    rows are read (no overshoot).  A command's pages are bounded by its N."""
    pages = (fetched.withColumn("page_no", F.ceil(F.col("rank") / page_size).cast("bigint"))
             .groupBy("command_id", "page_no")
             .agg(F.count("*").alias("rows_in_page"), F.max("fetch_n").alias("fetch_n"),
                  F.max("term").alias("term")))
    w = Window.partitionBy("command_id").orderBy("page_no")
    seen_before = F.coalesce(
        F.sum("rows_in_page").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    limit = F.least(F.lit(page_size).cast("bigint"), F.col("fetch_n") - seen_before)
    token = F.when(F.col("page_no") > 1, F.concat(
        F.lit("&continuation_token="), F.col("command_id").cast("string"), F.lit(":"),
        F.col("page_no").cast("string"))).otherwise(F.lit(""))
    if mode == "search":
        request = F.concat(F.lit(f"{SEARCH_ENDPOINT}?query=%40"), F.col("term"),
                           F.lit(f"&section=top&language=en&start_date={start_date}"))
    else:
        request = F.concat(F.lit(f"{HASHTAG_ENDPOINT}?hashtag=%23"), F.col("term"))
    url = F.concat(request, token, F.lit("&limit="), limit.cast("string"))
    return pages.select(
        "command_id", "page_no", "rows_in_page",
        seen_before.cast("bigint").alias("seen_before"),
        limit.cast("bigint").alias("page_limit"),
        F.sum("rows_in_page").over(w.rowsBetween(Window.unboundedPreceding, 0))
        .cast("bigint").alias("seen_after"),
        url.alias("request_url"),
    )


def build_pages(fetched: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """D5 page documents ``(command_id, page_no, results, continuation_token)``;
    a page holds at most ``page_size`` rows, so each group is bounded."""
    g = (fetched.withColumn("page_no", F.ceil(F.col("rank") / page_size).cast("bigint"))
         .groupBy("command_id", "page_no")
         .agg(F.array_sort(F.collect_list(F.struct("rank", "review_id"))).alias("results")))
    full = F.size("results") == page_size
    token = F.when(full, F.concat_ws(":", F.col("command_id").cast("string"),
                                     (F.col("page_no") + 1).cast("string")))
    return g.withColumn("continuation_token", token)


def explode_pages(pages: DataFrame, wanted: DataFrame, page_size: int = PAGE_SIZE,
                  on_error: str = "empty", failed: str | None = None) -> DataFrame:
    """SET-1 with the cursor stop rule: a page is read only while every
    earlier page was full and fewer than ``fetch_n`` rows were seen; rows past
    ``fetch_n`` are cut (Q6).  ``wanted`` is ``(command_id, fetch_n)``.

    ``failed`` names a boolean column of pages whose request failed.  When
    such a page is reached, ``on_error`` says what its command gets (Q5):
    ``empty`` nothing at all, ``partial`` the rows of the pages before it."""
    if on_error not in ("empty", "partial"):
        raise ValueError(f"unknown error policy {on_error!r}")
    w = Window.partitionBy("command_id").orderBy("page_no")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    bad = F.coalesce(F.col(failed), F.lit(False)) if failed else F.lit(False)
    p = (pages.withColumn("_failed", bad)
         .withColumn("results", F.when(F.col("_failed"), F.slice("results", 1, 0)).otherwise(F.col("results")))
         .join(wanted, "command_id")
         .withColumn("seen_before", F.coalesce(F.sum(F.size("results")).over(before), F.lit(0)))
         .withColumn("short_before",
                     F.coalesce(F.max((F.size("results") != page_size).cast("int")).over(before),
                                F.lit(0))))
    read = p.where((F.col("short_before") == 0) & (F.col("seen_before") < F.col("fetch_n")))
    if failed and on_error == "empty":
        # a failed page is read last: an empty page ends the cursor
        broken = read.where("_failed").select("command_id")
        read = read.join(broken, "command_id", "left_anti")
    rows = read.select("command_id", "page_no", "seen_before", "fetch_n",
                       F.posexplode("results").alias("pos", "r"))
    return rows.where(F.col("seen_before") + F.col("pos") < F.col("fetch_n")).select(
        "command_id", "page_no", (F.col("pos") + 1).cast("bigint").alias("pos"),
        F.col("r.review_id").alias("review_id"))


def normalize_sources(reviews: DataFrame) -> DataFrame:
    """PRJ-4..7 + SRC-6: store and social rows in one shape, as a single
    projection (one scan, one codegen stage) rather than a union of two
    filtered branches.

    Store: url is the review url, the ticket text names the url.  Social:
    url is ``https://twitter.com/<user>/status/<id>``, the text names the id.
    ``title`` falls back with JavaScript ``||`` semantics (the store rows of
    F1 carry no title of their own)."""
    is_store = F.col("channel") == "store"
    sid = F.col("review_id").cast("string")
    url = F.when(is_store, F.col("url")).otherwise(
        F.concat(F.lit("https://twitter.com/"), F.col("username"), F.lit("/status/"), sid))
    label = F.when(is_store, F.lit(STORE_LABEL)).otherwise(F.lit(SOCIAL_LABEL))
    ref = F.when(is_store, F.col("url")).otherwise(sid)
    default_title = F.concat(F.lit("Ticket created from "), label, F.lit(" review "), ref)
    own_title = F.lit(None).cast("string")
    return reviews.select(
        F.when(is_store, F.lit("store")).otherwise(F.lit("social")).alias("source"),
        "review_id", "app_id", "text", "language", "votes", "created_at", url.alias("url"),
        F.when(is_store, js_or(own_title, default_title)).otherwise(default_title).alias("title"),
        F.concat(default_title, F.lit("\n\n"), F.col("text")).alias("ticket_text"))
