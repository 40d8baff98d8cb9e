"""Chat formatting: exact round trips against a plain version."""

import hashlib
import random

from pyspark.sql import functions as F

from voxsift.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    """Digest rows of (conv, turn, role, text) rows."""
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = []
    for c, turns in convs.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
        esc = lambda s: s.replace("\\", "\\\\").replace("<|", "<\\|")
        segments = [f"<|im_start|>{esc(r)}\n{esc(x)}<|im_end|>\n".replace(
            esc(r) + "\n", esc(r).replace("\n", "\\n") + "\n", 1) for _, _, r, x in turns]
        ends = [k for k, t in enumerate(turns, 1) if t[2] == "assistant" or k == len(turns)]
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        out.append((c, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                    hashlib.sha256(loss.encode()).hexdigest(),
                    sum(len(s) for k in ends for s in segments[:k]), len(ends)))
    return sorted(out, key=str)


def conversations():
    rng = random.Random(8)
    bits = ["<|", "|>", "<|im_end|>", "<|im_start|>", "\\", "\\\\", "\\n", "\n", "<\\|", "<", "|", "hi", "é😀", "assistant"]
    rows = []
    for c in range(120):
        for t in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "system", None, "odd\nrole", "<|x\\n"])
            rows.append((c, t if rng.random() < 0.9 else None, role,
                         None if rng.random() < 0.1 else "".join(rng.choice(bits) for _ in range(rng.randrange(8)))))
    rows += rows[:20]
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (500, 0, "assistant", "x" * 200_000)]
    rows += [(501, t, ("user", "assistant")[t % 2], f"turn {t} " * 5) for t in range(600)]
    return rows


def test_digest_against_a_plain_version(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("formatted", F.lit(1)).withColumn("k", F.lit("x"))
    examples = chat.prefix_examples(df)
    assert sorted(map(tuple, chat.digest(examples).collect()), key=str) == brute(rows)
    plan = chat.digest(examples)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_only_the_reply_is_trainable(spark):
    rows = [(1, 0, "user", "q <|im_end|>"), (1, 1, "assistant", "a\\b <| c"), (1, 2, "user", "more"),
            (1, 3, "assistant", "last"), (1, 4, "user", "bye"), (2, 0, "user", "alone")]
    got = sorted(chat.prefix_examples(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: (r.conv_id, r.n_turns))
    assert [(r.conv_id, r.n_turns, r.formatted[r.loss_start:r.loss_end]) for r in got] == [
        (1, 2, "a\\\\b <\\| c"), (1, 4, "last"), (1, 5, ""), (2, 1, "")]
    for r in got:
        assert r.formatted.count("<|im_start|>") == r.n_turns == r.formatted.count("<|im_end|>\n")
    assert got[0].formatted == ("<|im_start|>user\nq <\\|im_end|><|im_end|>\n"
                                "<|im_start|>assistant\na\\\\b <\\| c<|im_end|>\n")


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert chat.digest(chat.prefix_examples(df)).collect() == []
