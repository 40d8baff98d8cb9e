"""Packing: the library's ids, capacities, and differencing by hand."""

import random
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from voxsift.llm import packing, registry


@pytest.fixture(scope="module")
def model():
    with open(registry.tokenizer_path(), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(model):
    from tokenizers import Tokenizer

    t = Tokenizer.from_buffer(model)
    t.encode_special_tokens = True
    return t


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [0]


def test_differencing_by_hand():
    # 8 and 7 differ most from empty windows; 6 joins 5 beside them, then 4
    window, sums = packing.differencing([8, 7, 6, 5, 4], 2)
    assert sorted(sums.tolist()) == [14, 16]  # the known result of the two-way method
    assert sum(s for s, w in zip([8, 7, 6, 5, 4], window) if w == 0) == sums[0]


@pytest.mark.parametrize("seed", range(30))
def test_differencing_keeps_every_size(seed):
    rng = random.Random(seed)
    sizes = [rng.randrange(1, 512) for _ in range(rng.choice([1, 2, 5, 60, 400]))]
    k = rng.randrange(1, len(sizes) + 3)
    window, sums = packing.differencing(sizes, k)
    assert len(sums) <= k and window.max() < len(sums)
    assert np.bincount(window, weights=sizes, minlength=len(sums)).tolist() == sums.tolist()
    packed = packing.pack(sizes, 512)
    assert np.bincount(packed, weights=sizes).max() <= 512


def test_small_sizes_give_near_equal_windows():
    rng = random.Random(2)
    sizes = [rng.randrange(1, 60) for _ in range(600)]
    _, sums = packing.differencing(sizes, 16)
    assert sums.max() - sums.min() <= 3


def test_window_count_rises_when_capacity_is_exceeded():
    packed = packing.pack([700] * 6)  # 4200 tokens would need five windows; no two fit
    assert len(set(packed.tolist())) == 6


ALPHABET = ([*"aB1.,'s \n\t\r\x0b\x1c\x1f\x85\xa0  ​éñ漢字😀<|>_²ª"]
            + ["<|endoftext|>", "'re", "  ", "\n\n", " the", "\r\n"] + [" ", "a b"] * 6)


@pytest.mark.parametrize("seed", range(6))
def test_ids_equal_the_library(model, library, seed):
    rng = random.Random(seed)
    encoder = packing.Encoder(model)
    texts = [None, "", " ", "x"] + ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40)))
                                    for _ in range(1500)]
    ids, ends = encoder.encode(pa.array(texts, pa.string()))
    starts = [0, *ends.tolist()]
    for text, a, b in zip(texts, starts, ends.tolist()):
        assert ids[a:b].tolist() == ids_of(library, text), repr(text)


def test_ids_of_real_texts(spark, sf, library, model):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    ids, ends = packing.Encoder(model).encode(pa.array(texts, pa.string()))
    for text, a, b in zip(texts, [0, *ends.tolist()], ends.tolist()):
        assert ids[a:b].tolist() == ids_of(library, text)


def test_tokenizers_of_another_kind_get_whole_texts(tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f:
        raw = f.read()
    assert not packing.cuts_at_blanks(raw)
    t = Tokenizer.from_buffer(raw)
    ids, ends = packing.Encoder(raw).encode(pa.array(["Some words, more words", None, "end"]))
    assert ids[:ends[0]].tolist() == t.encode("Some words, more words", add_special_tokens=False).ids + [0]
    assert ends.tolist()[1] - ends.tolist()[0] == 1


def check(rows, docs, library, window=1024):
    """Every id once, sequences without gaps and within the window; padding."""
    of_doc, of_sequence = {}, {}
    for r in rows:
        of_doc.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
        of_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.length == len(r.ids) // 4 >= 1
    for i, text in docs.items():
        whole = ids_of(library, text)
        at = 0
        for start, ids, total in sorted(of_doc[i]):
            assert start == at and total == len(whole) and ids == whole[at:at + len(ids)]
            at += len(ids)
        assert at == len(whole)
    padding = 0
    for pieces in of_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def documents():
    rng = random.Random(5)
    docs = {0: None, 1: "", 2: " \n ", 3: "<|endoftext|>", 4: "long text, " * 30_000}
    for i in range(5, 700):
        docs[i] = " ".join(rng.choice(["word", "Wörter", "and", "12", "x\ny"]) for _ in range(rng.choice([1, 40, 900])))
    return docs


def test_sequences(spark, library):
    docs = documents()
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in docs.items()],
                               "doc_id bigint, text string, start int, offset string").repartition(3)
    rows = packing.pack_documents(df, registry.tokenizer_path(), bin_pieces=200).collect()
    padding = check(rows, docs, library)
    assert padding < 0.02 * sum(r.length for r in rows)


def test_repeated_rows_and_null_ids(spark, library):
    df = spark.createDataFrame([(1, "a b c")] * 3 + [(None, "x")], "doc_id bigint, text string")
    rows = packing.pack_documents(df, registry.tokenizer_path()).collect()
    assert sorted((str(r.doc_id), r.start, r.doc_tokens) for r in rows) == [("1", 0, 4)] * 3 + [("None", 0, 2)]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 4


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.pack_documents(df, registry.tokenizer_path()).collect() == []


def test_registered_query_digests(spark, sf, library):
    rows = registry.op12_packing(spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in rows:
        ids = ids_of(library, texts[r.doc_id])[r.start:r.start + r.length]
        assert r.ids_crc32 == crc32(np.array(ids, "<u4").tobytes())
