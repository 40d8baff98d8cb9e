"""Quality rules: statistics against brute force, the learner on known rules."""

import random
import re

from pyspark.sql import functions as F

from voxsift.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    inside = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(inside))


def measured(spark, rows, schema="doc_id bigint, text string"):
    df = spark.createDataFrame(rows, schema).withColumn("s", quality.measured("text", lambda s: s))
    return {r[0]: tuple(r)[1:] for r in df.select(
        "doc_id", "s.w.n_words", "s.w.word_chars", "s.n_symbols", "s.l.n_dup_lines", "s.w.n_repeat_words").collect()}


def test_statistics_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(0, None), (1, ""), (2, " \n\t\x0b "), (3, "a b c a b c"), (4, "a a a a"), (5, "a a a"),
            (6, "l\n\nl\n l\nl"), (7, "x y  z ab\x85c"), (8, "# * $ % & | < > €"),
            (9, "a b a b a b a b"), (10, "one\r\ntwo\r\none\r\n")]
    for i in range(11, 80):
        n = rng.choice([3, 4, 10, 60, 500])
        vocabulary = [rng.choice("abcdeé€😀") * rng.randrange(1, 4) for _ in range(rng.choice([2, 8, 40]))]
        rows.append((i, "".join(rng.choice(vocabulary) + rng.choice([" ", "\n", "  ", "\t"]) for _ in range(n))))
    rows.append((99, " ".join(rng.choice("abcdefghij") + str(rng.randrange(60)) for _ in range(30_000))))
    got = measured(spark, rows)
    for i, text in rows:
        assert got[i] == brute(text), (i, text and text[:80])


def training(n=1500):
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(80)]
        kind = i % 10
        if kind == 0:
            words = [w + "###" for w in words]
        if kind == 1:
            words = [w.upper() for w in words]
        docs.append((i, " ".join(words)))
        labels.append((i, int(kind > 1)))
    return docs, labels


def test_learns_the_planted_rules_and_keeps_the_rest(spark):
    docs, labels = training()
    d = spark.createDataFrame([(*x, 1, "y") for x in docs], "doc_id bigint, text string, stats int, rule string")
    lab = spark.createDataFrame([*labels, (None, 0), (5, None)], "doc_id bigint, quality int")
    rules = quality.learn(d.select("doc_id", "text"), lab)
    assert rules and all(r.precision >= 0.9 for r in rules)
    kept = quality.keep_good(d, rules)
    assert kept.columns == d.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert ids == {i for i, good in labels if good}
    plan = kept._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_no_labels_and_empty_tables(spark):
    docs, _ = training(20)
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality.learn(d, none) == []
    assert quality.keep_good(d, []).count() == 20
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert quality.learn(empty, none) == []
    assert quality.judge(empty, []).collect() == []


def test_base_rule(spark):
    rows = [(1, "w " * 49), (2, " ".join(f"w{i}" for i in range(50))), (3, "same " * 60), (4, None)]
    got = quality.judge(spark.createDataFrame(rows, "doc_id int, text string"), [])
    assert {r.doc_id: r.judged.rule for r in got.collect()} == {1: -1, 2: 0, 3: -1, 4: -1}


def test_conditions_read_as_rules():
    c = quality.Condition("upper_share", True, 0.5)
    assert str(quality.Rule((c,), 1.0, 3)) == "upper_share > 0.5"
    assert F is not None


def test_repeated_label_rows_change_nothing(spark):
    """A third of all label rows equal, beyond the bound, and copies of that
    document: the rules stay."""
    docs, labels = training(600)
    frame = lambda rows: spark.createDataFrame(rows, "doc_id bigint, text string")
    known = lambda rows: spark.createDataFrame(rows, "doc_id bigint, quality int")
    want = quality.learn(frame(docs), known(labels), max_fit_rows=700)
    first = min(range(600), key=lambda i: spark_hash(spark, i))
    repeated = known(labels).unionByName(known([labels[first]]).crossJoin(spark.range(1000)).drop("id"))
    copies = frame(docs).unionByName(frame([docs[first]]).crossJoin(spark.range(300)).drop("id"))
    assert want and quality.learn(copies, repeated, max_fit_rows=700) == want


def spark_hash(spark, i, memo={}):  # noqa: B006
    if not memo:
        memo.update({r.id: r.h for r in spark.range(2000).select("id", F.xxhash64("id").alias("h")).collect()})
    return memo[i]


def test_labels_that_disagree_do_not_train(spark):
    docs, labels = training(600)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    both = [(i, 1 - y) for i, y in labels[::7]]
    got = quality.learn(frame, spark.createDataFrame(labels + both, "doc_id bigint, quality int"))
    want = quality.learn(frame, spark.createDataFrame(
        [x for k, x in enumerate(labels) if k % 7], "doc_id bigint, quality int"))
    assert got == want


def test_very_long_text(spark):
    text = "word " * 300_000 + "#"
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    row = quality.judge(docs, []).select("judged.statistics.w.n_words", "judged.rule").first()
    assert (row.n_words, row.rule) == (300_001, -1)
