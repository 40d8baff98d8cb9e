"""Language identification: held-out accuracy and defined results."""

import random

import pytest

from voxsift.llm import langid

SOUNDS = {"aa": "ka to mi ra su no".split(), "bb": "sch ver ung tz ich kei".split(),
          "cc": "eau que tion oi é ré".split()}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 4))) + rng.choice(["", ",", ".", "!"])
                    for _ in range(n))


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(sorted(SOUNDS))
        out.append((i, text(rng, lang, rng.choice([3, 20, 200])), lang))
    return out


@pytest.fixture(scope="module")
def model(spark):
    df = spark.createDataFrame([(*r, "src") for r in corpus()] + [(None, None, "aa", None), (7, "text", None, None)],
                               "doc_id bigint, text string, lang string, source string")
    return langid.learn(df)


def test_held_out_accuracy_and_calibration(spark, model):
    rows = corpus(400, seed=2)
    df = spark.createDataFrame([(i, t, "zz", 0.5) for i, t, _ in rows],
                               "doc_id bigint, text string, lang string, score double")
    got = {r.doc_id: r for r in langid.identify(df, model).collect()}
    truth = {i: lang for i, _, lang in rows}
    assert sum(got[i].lang_pred == truth[i] for i in truth) >= 0.98 * len(rows)
    kept = [i for i in truth if not got[i].rejected]
    assert len(kept) > 300 and sum(got[i].lang_pred == truth[i] for i in kept) >= 0.99 * len(kept)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_defined_results(spark, model):
    rng = random.Random(3)
    rows = [(1, None), (2, ""), (3, "123 !! \n"), (4, "x"), (5, "😀"), (6, "KATOMI RASU"), (6, "KATOMI RASU"),
            (None, "katomi"), (8, text(rng, "bb", 40_000)), (9, "İÑ")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(tuple, langid.identify(df, model).collect()), key=str)
    assert len(got) == len(rows)
    by = {r[0]: r for r in got}
    for i in (1, 2, 3, 5):
        assert by[i][1:] == ("und", 0.0, True)
    assert by[6][1] == by[None][1] == "aa" and by[8][1] == "bb"
    assert by[4][1] in SOUNDS and by[9][1] in SOUNDS


def test_a_prediction_depends_on_its_text_only(model):
    rng = random.Random(4)
    texts = [text(rng, lang, 15) for lang in sorted(SOUNDS) * 3]
    together = langid.predict_texts(texts, model)
    for i, t in enumerate(texts):
        alone = langid.predict_texts([t], model)
        assert alone[0][0] == together[0][i] and abs(alone[1][0] - together[1][i]) < 1e-9


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert langid.learn(empty) is None
    assert langid.identify(empty, None).collect() == []
    one = spark.createDataFrame([(1, "abc")], "doc_id bigint, text string")
    assert tuple(langid.identify(one, None).first()) == (1, "und", 0.0, True)


def test_a_rare_language_is_learned(spark):
    rng = random.Random(5)
    rows = [(text(rng, rng.choice(["aa", "bb"]), 12), None) for _ in range(600)]
    rows = [(t, "aa" if any(x in t for x in ("ka", "to", "mi", "ra", "su", "no")) else "bb") for t, _ in rows]
    rows += [("copy " + text(random.Random(9), "bb", 9), "bb")] * 300
    rare = [(text(rng, "cc", 40), "cc") for _ in range(8)]
    df = spark.createDataFrame(rows + rare, "text string, lang string")
    got = langid.sample(df, 60, 10).collect()
    assert len(got) == len(set(got)) <= 120
    assert {r.text for r in got if r.lang == "cc"} == {t for t, _ in rare}
    # one row of every language comes before the second of any
    assert {r.lang for r in langid.sample(df, 3, 10).collect()} >= {"aa", "bb", "cc"}


def test_documents_take_turns():
    import numpy as np
    of = np.array([7] * 1000 + [3, 3, 1, 5, 5, 5])
    got = langid.fair_share(of, 10, np.random.default_rng(1))
    counts = {d: int((of[got] == d).sum()) for d in (1, 3, 5, 7)}
    assert len(got) == 10 and counts[1] == 1 and counts[3] == 2 and counts[5] == 3 and counts[7] == 4
