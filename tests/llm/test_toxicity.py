"""Toxicity: held-out documents, unseen forms, defined results."""

import random

import pytest

from voxsift.llm import toxicity

STEMS = ["grumbulk", "snorvex", "plitzor"]
SYLLABLES = "an ter ing lo mi ra de st on ka he".split()


def word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4)))


def corpus(n, seed, ends=("a", "en", "ito", "ul", "ema", "ors", "ick", "by")):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [word(rng) for _ in range(rng.choice([5, 60, 300]))]
        bad = i % 8 == 0
        if bad:
            for _ in range(rng.randrange(1, 4)):
                words[rng.randrange(len(words))] = rng.choice(["{}", "{}!!", "({})", "{}***"]).format(
                    (rng.choice(STEMS) + rng.choice(ends)).title())
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return docs, labels


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = corpus(1200, 1)
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    lab = spark.createDataFrame([*labels, (None, 1), (3, None), (4, 7)], "doc_id bigint, toxic int")
    return toxicity.learn(d, lab)


def rates(spark, model, docs, labels):
    df = spark.createDataFrame([(*r, 0.1, "x") for r in docs], "doc_id bigint, text string, score double, labels string")
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    caught = sum(got[i].predicted for i, y in labels if y) / sum(y for _, y in labels)
    wrong = sum(got[i].predicted for i, y in labels if not y) / sum(not y for _, y in labels)
    return caught, wrong


def test_held_out_documents(spark, model):
    caught, wrong = rates(spark, model, *corpus(600, 2))
    assert caught >= 0.97 and wrong <= 0.01


def test_unseen_forms_share_their_ngrams(spark, model):
    caught, _ = rates(spark, model, *corpus(400, 3, ends=("uzz", "ox", "emp")))
    assert caught >= 0.9


def test_one_insult_in_a_long_text(spark, model):
    rng = random.Random(5)
    clean = [word(rng) for _ in range(20_000)]
    toxic = [*clean[:9000], "snorvexa", *clean[9000:]]
    caught, wrong = rates(spark, model, [(1, " ".join(clean)), (2, " ".join(toxic))], [(1, 0), (2, 1)])
    assert (caught, wrong) == (1, 0)


def test_defined_results(spark, model):
    rows = [(1, None), (2, ""), (3, "!!! ..."), (4, "ter"), (4, "ter"), (None, "grumbulka")]
    got = toxicity.score(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect()
    assert len(got) == 6
    by = {r.doc_id: r for r in got}
    assert by[1].score == by[2].score == by[3].score and by[1].predicted == 0 and by[None].predicted == 1


def test_degenerate_training_sets(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id bigint, text string")
    one_sided = spark.createDataFrame([(1, 0), (2, 0)], "doc_id bigint, toxic int")
    got = toxicity.score(docs, toxicity.learn(docs, one_sided)).collect()
    assert {r.predicted for r in got} == {0}
    nothing = one_sided.where("false")
    assert {r.score for r in toxicity.score(docs, toxicity.learn(docs, nothing)).collect()} == {0.0}
    assert toxicity.score(docs.where("false"), toxicity.learn(docs, nothing)).collect() == []


def test_repeated_label_rows_change_nothing(spark):
    """A third of all label rows equal, beyond the bound: the scores stay."""
    docs, labels = corpus(500, 6)
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    again = known.where("doc_id = 8").crossJoin(spark.range(900)).drop("id")
    conflict = spark.createDataFrame([(10_000, 0), (10_000, 1)], "doc_id bigint, toxic int")
    more = d.unionByName(spark.createDataFrame([(10_000, "grumbulk " * 9)], "doc_id bigint, text string"))
    score = lambda model: [r.score for r in toxicity.score(d, model).orderBy("doc_id").collect()]
    want = score(toxicity.learn(d, known, max_fit_docs=600))
    got = score(toxicity.learn(more, known.unionByName(again).unionByName(conflict), max_fit_docs=600))
    assert got == want and max(got) > 0.5
