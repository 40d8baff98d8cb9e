"""Model-backed text steps (TXT-0, UDF-1, SCA-7).

* ``prompts``: fill a template with built-in ``replace`` expressions and key
  each prompt by ``sha2(prompt, 256)``.
* ``replay_replies``: left join to a recorded ``(step, prompt_sha, reply)``
  table — reproducible, offline, and a plain equi-join at any scale.
* ``model_map``: an iterator ``pandas_udf`` (Arrow batches; the model is
  loaded once per task, not per row).  Real models are non-deterministic,
  so by default the UDF is marked so, which keeps Catalyst from running it
  twice or pushing filters through it; apply cheap filters *before* it.

Replies are parsed strictly by ``voxsift.functions.replies``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The relevance prompt.  What replies depend on: the two placeholders, the
# reply's field names and the values "true" and "false".  Recorded replies are
# keyed by the sha of the filled text.
RELEVANCE_TEMPLATE = (
    "Decide whether feedback about the app {app_name} deserves a support agent's time.\n"
    "It does if it reports a problem, asks something, complains, wishes for a change, or says "
    "what the app or its service did well or badly. Greetings, adverts and noise do not.\n"
    'Answer with one JSON object and nothing else: "relevance" is the string "true" or "false", '
    '"reason" is one short sentence.\n\nFeedback:\n{review}\n\nAnswer:\n')

# Threshold of the local stand-in model: prompts with at least this many
# word tokens are answered relevant.
LOCAL_MODEL_MIN_TOKENS = 200


def prompts(df: DataFrame, template: str, text: str = "text",
            app_name: str = "app_name") -> DataFrame:
    """Adds ``prompt`` and ``prompt_sha``; the app name is filled first so a
    review containing the placeholder text is left as written."""
    p = F.replace(F.replace(F.lit(template), F.lit("{app_name}"),
                            F.coalesce(F.col(app_name), F.lit(""))),
                  F.lit("{review}"), F.coalesce(F.col(text), F.lit("")))
    return df.withColumn("prompt", p).withColumn("prompt_sha", F.sha2(F.col("prompt"), 256))


def replay_replies(df: DataFrame, recorded: DataFrame, step: str) -> DataFrame:
    """Recorded replies of one step, one per prompt (the least reply text
    when a prompt was recorded twice); missing replies stay NULL and are
    read fail-open downstream."""
    r = (recorded.where(F.col("step") == step).groupBy("prompt_sha")
         .agg(F.min("reply").alias("reply")))
    return df.join(r, "prompt_sha", "left")


def model_map(df: DataFrame, model_factory: Callable[[], Callable[[pd.Series], pd.Series]],
              prompt: str = "prompt", out: str = "reply",
              deterministic: bool = False) -> DataFrame:
    """Apply a model to every prompt in Arrow batches.

    ``model_factory()`` runs once per task and returns a function from a
    pandas Series of prompts to a Series of JSON reply texts."""

    @F.pandas_udf("string")
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = model_factory()
        for batch in batches:
            yield model(batch)

    udf = call if deterministic else call.asNondeterministic()
    return df.withColumn(out, udf(F.col(prompt)))


def token_count_model() -> Callable[[pd.Series], pd.Series]:
    """A deterministic local stand-in for a chat model: answers relevant
    when the prompt has at least ``LOCAL_MODEL_MIN_TOKENS`` word tokens."""
    yes = '{"relevance":"true","reason":"long enough"}'
    no = '{"relevance":"false","reason":"too short"}'

    def run(s: pd.Series) -> pd.Series:
        counts = s.fillna("").str.count(r"\w+")
        return pd.Series(["" if c is None else (yes if c >= LOCAL_MODEL_MIN_TOKENS else no)
                          for c in counts], index=s.index)

    return run
