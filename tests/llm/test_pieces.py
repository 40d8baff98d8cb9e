"""The merge rounds against the sentencepiece library on the same model."""

import hashlib
import random

import pytest

P = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

from voxsift.llm import pieces  # noqa: E402

MODEL = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def codec():
    with open(MODEL, "rb") as f:
        return pieces.Codec(pieces.read_model(f.read()))


def texts():
    rng = random.Random(11)
    alphabets = ["abcdefghij", "aeiou ", "  \n\t", "the and ", "äöüßéèçñ", "中文字符日本語", "😀👩‍👩‍👧é́",
                 "▁ a", "<>/s|_", "0123456789.,", "\x00\x01\x7f​﻿", "аби", "aaaa", "hello world"]
    out = ["", " ", "  ", "a", " a", "a ", "\n", "</s><s><unk>", "a▁b ▁", "▁", "aaaaaaaaaaaaaaaaaaaaa",
           "                       x", "ab" * 500, "Ünïcödé " * 50, "�", "x" * 3000]
    out += ["".join(rng.choice("ab") for _ in range(300)) for _ in range(60)]
    out += ["".join(rng.choice(["in", "er", "z", "aa", "\n\n", "  "]) for _ in range(200)) for _ in range(60)]
    out.append("".join(rng.choice("etaoinshr") for _ in range(60_000)))
    for _ in range(400):
        pool = "".join(rng.sample(alphabets, rng.randrange(1, 4)))
        out.append("".join(rng.choice(pool) for _ in range(rng.randrange(1, 60))))
    return out


def test_ids_and_decoding_equal_the_library(library, codec):
    for text in texts():
        want = library.encode(text)
        chunks = codec.chunks_of(text)
        got = [i for ids in codec.encode_chunks(chunks) for i in ids] if chunks else []
        assert got == want, repr(text)
        assert codec.decode(got) == library.decode(want), repr(text)


def test_decodes_any_ids_like_the_library(library, codec):
    rng = random.Random(2)
    n = library.get_piece_size()
    for _ in range(400):
        low = rng.choice([n, 300, 262])
        ids = [rng.randrange(low) for _ in range(rng.randrange(1, 12))]
        assert codec.decode(ids) == library.decode(ids), ids


def test_query_rows(spark, library):
    rows = list(enumerate(texts()))
    rows += [(9000, None), (9001, "repeated"), (9001, "repeated"), (None, "no id"),
             (9002, "long word " * 30_000 + "z" * 5000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, ids int, n_tokens string")
    got = pieces.encode(df, MODEL, digest=True).collect()
    want = []
    for i, t in rows:
        ids = library.encode(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((library.decode(ids) if ids else "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    whole = pieces.encode(df.where("doc_id < 5"), MODEL, extra=["n_tokens"]).collect()
    assert whole and all(r.decoded == rows[r.doc_id][1] for r in whole)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert pieces.encode(df, MODEL).collect() == []
