"""The pipeline's stages against brute-force versions of them."""

import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
P = pytest.importorskip("public_tokenizers")

from test_fmindex import brute as brute_hits  # noqa: E402
from test_simhash import brute_components, brute_fp  # noqa: E402

from voxsift.llm import fmindex, pii, quality  # noqa: E402

BENCH = [(1, "the quick brown fox jumps over the lazy dog and then it sleeps all day long near home")]


def corpus():
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(rng.randrange(2, 8)))
    docs, labels = [], []
    for i in range(240):
        words = [word() for _ in range(rng.randrange(55, 140))]
        if i % 6 == 0:
            words = [w + "##" for w in words]
        if i % 7 == 1:
            words[20:20] = BENCH[0][1].split()[:rng.randrange(9, 17)]
        if i % 7 == 2:
            words[10] = f"me.{i}@mail.example.com"
            words[40] = f"+1 (212) 555-{1000 + i}"
        docs.append([i, " ".join(words), "en", f"src{i % 3}", 0, i])
        labels.append((i, int(i % 6 != 0), 0))
        if i % 9 == 4:
            docs.append([1000 + i, " ".join(words), "en", "copy", 0, i])
        if i % 9 == 5:
            words[-1] = "changed"
            docs.append([2000 + i, " ".join(words), "en", "near", 0, i])
    docs += [[3000, None, None, None, None, None], [3001, "", "en", "s", 0, 0], [3002, "short", "en", "s", 5, 0]]
    docs.append(list(docs[1]))
    return [tuple(d) for d in docs], labels


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp int"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("pipeline")
    docs, labels = corpus()
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame(BENCH, "item_id bigint, text string").write.parquet(f"{out}/benchmark.parquet")
    return str(out)


def test_stages_against_brute_force(spark, folder):
    import re

    import sentencepiece

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    # quality rules: what the planted rule says
    got = stages["quality_rules"](spark, docs, folder)
    assert got.columns == docs.columns
    want = [r for r in rows if len((r[1] or "").split()) >= 50 and "##" not in r[1]]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    # near-duplicates: smallest id of each component, one row
    docs, rows = spark.createDataFrame(want, SCHEMA), want
    got = stages["simhash_near_dedup"](spark, docs, folder)
    assert got.columns == docs.columns
    component = brute_components([(r[0], brute_fp(r[1])) for r in rows])
    want = sorted({r for r, c in zip(rows, component) if r[0] == c})
    assert sorted(map(tuple, got.collect())) == want
    assert len(want) < len(rows)
    # decontamination: no window is left, words outside windows stay
    docs, rows = spark.createDataFrame(want, SCHEMA), want
    got = {r.doc_id: r for r in stages["benchmark_decontamination"](spark, docs, folder).collect()}
    assert len(got) == len(rows)
    touched = 0
    for r in rows:
        n, hit, _ = brute_hits(r[1], BENCH)
        after = got[r[0]].text
        assert len(after.split()) == n - hit + (0 if "@" not in r[1] else len(r[1].split()) - n)
        assert (after == r[1]) == (hit == 0) and got[r[0]].n_chars == len(after)
        touched += hit > 0
    assert touched > 5
    # personal data: rule spans are gone
    docs = spark.createDataFrame([tuple(r) for r in got.values()], SCHEMA)
    clean = {r.doc_id: r for r in stages["pii"](spark, docs, folder).collect()}
    assert set(clean) == set(got)
    for i, r in clean.items():
        assert not pii.rule_spans(r.text) and r.n_chars == len(r.text)
        assert ("<EMAIL>" in r.text) == ("@" in got[i].text)
        assert re.sub("<[A-Z]+>", "", r.text) == r.text or "@" in got[i].text
    # token ids: the library's
    library = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    docs = spark.createDataFrame([tuple(r) for r in clean.values()], SCHEMA)
    for r in stages["sentencepiece"](spark, docs, folder).collect():
        assert r.ids == library.encode(clean[r.doc_id].text) and r.decoded == clean[r.doc_id].text


def test_run_equals_the_stages_one_after_the_other(spark, folder):
    got = corpus_pipeline.run(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, folder)
        docs = spark.createDataFrame(rows.collect(), rows.schema)
    assert sorted(map(str, got)) == sorted(map(str, docs.collect()))
    assert quality and fmindex


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
