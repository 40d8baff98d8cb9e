"""Rows are known by (command, review): a review may be in many commands."""
from pyspark.sql import functions as F

from voxsift.operators.classify import CATEGORY_RULES, categorize_by_rules
from voxsift.operators.fetch import build_pages, explode_pages
from voxsift.operators.neardup import near_duplicate_leaders
from voxsift.operators.tickets import attach_config
from voxsift.plans.triage import triage

COMMON = "one two three four five six seven eight nine ten"


def _feedback(spark, rows):
    df = spark.createDataFrame(rows, "command_id string, review_id long, text string, votes long")
    return df.withColumn("rank", F.struct((-F.col("votes")).alias("neg_votes"), F.col("review_id").alias("id")))


def test_near_duplicates_of_overlapping_commands(spark):
    rows = [("A", 1, COMMON, 9), ("A", 2, COMMON + " eleven", 5), ("B", 2, COMMON + " eleven", 5),
            ("B", 3, "something else entirely for the other", 4)]
    got = near_duplicate_leaders(_feedback(spark, rows))["mapping"].collect()
    assert sorted((r.command_id, r.review_id, r.leader_id) for r in got) == [
        ("A", 1, 1), ("A", 2, 1), ("B", 2, 2), ("B", 3, 3)]


def test_triage_of_overlapping_commands(spark, sf):
    text = "the app is slow with this for was not the is with this"
    base = [("A", 1, text, 9), ("B", 1, text, 9), ("B", 2, text + " more words. again", 5)]
    fb = _feedback(spark, base).select(
        "*", F.lit("src1").alias("app_id"), F.lit("store").alias("source"), F.lit("en").alias("language"),
        F.current_timestamp().cast("timestamp_ntz").alias("created_at"), F.lit("u").alias("url"),
        F.lit(None).cast("string").alias("title"))
    result = triage(spark, sf, fb=fb)
    keys = [("A", 1), ("B", 1), ("B", 2)]
    assert sorted((r.command_id, r.review_id) for r in result.tickets.collect()) == keys
    need = {(r.command_id, r.review_id) for r in result.tickets.where("needs_issue").collect()}
    issues = [(r.command_id, r.review_id) for r in result.issues.collect()]
    assert sorted(issues) == sorted(need)
    assert "issues" not in triage(spark, sf, fb=fb).__dict__


def test_app_without_config_is_rejected(spark):
    config = spark.createDataFrame([("known", "App", None, None)],
                                   "app_id string, app_name string, default_part_id string, default_owner_id string")
    rows = spark.createDataFrame([(1, "known"), (2, "unknown"), (3, None)], "review_id long, app_id string")
    got = {r.review_id: r.config_error for r in attach_config(rows, config).collect()}
    assert got == {1: None, 2: "app_id", 3: "app_id"}


def test_rules_agree_as_list_and_as_table(spark):
    rules = [("bug", "was", 0.6), ("bug", "broken", 0.6), ("question", "is", 1.0), ("spam", "win", 5.0),
             ("question", "bad", -3.0)]
    table = spark.createDataFrame(rules, "label string, term string, weight double")
    df = spark.createDataFrame([(1, "was broken is"), (2, "is"), (3, "win was"), (4, "none"), (5, "bad"),
                                (6, "was bad"), (7, None)], "review_id long, text string")
    want = {1: ("bug", 1.2), 2: ("question", 1.0), 3: ("failed_to_infer_category", 5.0),
            4: ("failed_to_infer_category", 0), 5: ("failed_to_infer_category", 0), 6: ("bug", 0.6),
            7: ("failed_to_infer_category", 0)}
    for given in (rules, table):
        got = {r.review_id: (r.category, r.category_score) for r in categorize_by_rules(df, given).collect()}
        assert got == want
    fixed = spark.createDataFrame(CATEGORY_RULES, "label string, term string, weight long")
    texts = spark.createDataFrame([(i, " ".join(t for _, t, _ in CATEGORY_RULES[i % 5::3])) for i in range(20)],
                                  "review_id long, text string")
    one, two = (sorted(map(str, categorize_by_rules(texts, r).select("review_id", "category", "category_score")
                           .collect())) for r in (CATEGORY_RULES, fixed))
    assert one == two


def test_page_error_policy(spark):
    offered = spark.createDataFrame([(c, r, 100 * c + r) for c in (1, 2) for r in range(1, 61)],
                                    "command_id long, rank long, review_id long")
    pages = build_pages(offered).withColumn("failed", (F.col("command_id") == 1) & (F.col("page_no") == 2))
    wanted = spark.createDataFrame([(1, 50), (2, 50)], "command_id long, fetch_n long")
    count = lambda policy: {r.command_id: r["count"] for r in explode_pages(
        pages, wanted, on_error=policy, failed="failed").groupBy("command_id").count().collect()}
    assert count("partial") == {1: 20, 2: 50}
    assert count("empty") == {2: 50}


def test_bayes_learns_the_labels(spark):
    from voxsift.operators.bayes import relevance_by_bayes
    train = [(i, "good useful words here" if i % 3 else "junk spam noise here", bool(i % 3)) for i in range(60)]
    df = spark.createDataFrame([*train, (99, "no label", None)], "id long, text string, relevant boolean")
    rows = spark.createDataFrame([(1, "useful good thing"), (2, "spam spam noise"), (3, None), (4, "")],
                                 "id long, text string")
    got = {r.id: r for r in relevance_by_bayes(rows, df, "id").collect()}
    assert got[1].relevant and not got[2].relevant and len(got) == 4
    assert got[3].bayes_score == got[4].bayes_score


def test_bayes_scores_repeated_ids_each(spark, sf, tmp_path):
    import __spark_entry__ as entry
    query = entry.queries()["relevance_bayes_all"]
    want = {r.doc_id: tuple(r) for r in query(spark, sf).collect()}
    again = next(i for i, r in sorted(want.items()) if i % 5 == 0)  # in the fold that does not train
    for name in ("documents", "labels"):
        table = spark.read.parquet(f"{sf}/{name}.parquet")
        one = table.where(F.col("doc_id") == again)
        table.unionByName(one).unionByName(one).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = query(spark, str(tmp_path)).collect()
    assert len(got) == len(want) + 2 and all(tuple(r) == want[r.doc_id] for r in got)


def test_bayes_scores_every_document(spark, sf):
    import __spark_entry__ as entry
    import duckdb
    got = entry.queries()["relevance_bayes_all"](spark, sf).select(
        "doc_id", "bayes_score", "relevant", "labelled", "held_out").collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert {r.labelled for r in got} == {True, False, None}
    assert all(r.held_out == (r.doc_id % 5 == 0) for r in got)
    # the same model as the query of the fold alone
    fold = {r.doc_id: r for r in entry.queries()["relevance_bayes"](spark, sf).collect()}
    mine = {r.doc_id: r for r in got if r.held_out and r.labelled is not None}
    assert {k: (r.bayes_score, r.relevant, r.labelled) for k, r in mine.items()} == {
        k: (r.bayes_score, r.relevant, r.labelled) for k, r in fold.items()}
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    rows = con.execute(entry.oracle_sql()["relevance_bayes_all"]).fetchall()
    assert sorted(rows) == sorted(map(tuple, got))
