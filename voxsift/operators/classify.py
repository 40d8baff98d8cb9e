"""Noise, relevance and category steps (FLT-2, FLT-3, FLT-16, TXT-1, TXT-3,
JN-2).

The program's own rules are scored inside each row: they become one literal
map, and every review looks its distinct tokens up once with higher-order
functions (interpreted, but without a token table or a shuffle).  Rules given
as a DataFrame, of any size, are joined on the term.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxsift.functions.jsstr import longer_than
from voxsift.functions.text import token_set, tokens
from voxsift.sources.tables import FAILED_CATEGORY, TAG_NAMES

MIN_REVIEW_SIZE = 3

# Relevance rule terms and weights.  The provided texts are
# invented prose, so the terms are frequent function words of each of the
# four languages; a review is relevant at a score of RELEVANCE_THRESHOLD.
RELEVANCE_RULES = [
    ("the", 1), ("is", 1), ("with", 1), ("this", 1), ("for", 1), ("was", 1),
    ("est", 1), ("pour", 1), ("avec", 1), ("pas", 1), ("dans", 1),
    ("ist", 1), ("nicht", 1), ("mit", 1), ("für", 1), ("sich", 1),
    ("para", 1), ("con", 1), ("no", 1), ("por", 1), ("es", 1),
]
RELEVANCE_THRESHOLD = 3

# Category rule terms (label, term, weight).  ``spam`` is not
# a tag, so a review won by it falls back to failed_to_infer_category.
CATEGORY_RULES = [
    ("bug", "was", 2), ("bug", "nicht", 2), ("bug", "pas", 2), ("bug", "no", 2),
    ("feature_request", "for", 1), ("feature_request", "pour", 1),
    ("feature_request", "für", 1), ("feature_request", "para", 1),
    ("question", "is", 1), ("question", "est", 1), ("question", "ist", 1),
    ("question", "es", 1),
    ("logistics_experience", "from", 1), ("logistics_experience", "by", 1),
    ("logistics_experience", "von", 1), ("logistics_experience", "par", 1),
    ("logistics_experience", "del", 1),
    ("positive_feedback", "with", 1), ("positive_feedback", "avec", 1),
    ("positive_feedback", "mit", 1), ("positive_feedback", "con", 1),
    ("negative_feedback", "that", 1), ("negative_feedback", "qui", 1),
    ("negative_feedback", "das", 1), ("negative_feedback", "que", 1),
    ("spam", "ha", 3), ("spam", "ché", 3),
]


def noise_filter(df: DataFrame, min_size: int = MIN_REVIEW_SIZE, text: str = "text") -> DataFrame:
    """FLT-2 + Q15: keep rows whose JavaScript length exceeds ``min_size``;
    NULL text is noise."""
    return df.where(longer_than(F.col(text), min_size))


def _weights(pairs) -> dict:
    """Summed weight of each term; the weights' number type is kept."""
    out: dict = {}
    for term, w in pairs:
        out[term] = out.get(term, 0) + w
    return out


def _score(tokens: Column, weights: dict) -> Column:
    if not weights:
        return F.lit(0).cast("bigint")
    kind = "bigint" if all(isinstance(v, int) for v in weights.values()) else "double"
    m = F.create_map(*[x for k, v in sorted(weights.items()) for x in (F.lit(k), F.lit(v).cast(kind))])
    return F.aggregate(tokens, F.lit(0).cast(kind),
                       lambda acc, t: acc + F.coalesce(F.try_element_at(m, t), F.lit(0).cast(kind)))


def _score_of(text: Column, weights: dict) -> Column:
    """The sum of the weights of the text's distinct tokens.  Whole numbers add up in
    any order: one intersection for each weight, in place of a look-up of every token."""
    if not weights or not all(isinstance(w, int) for w in weights.values()):
        return _score(token_set(text), weights)
    by_weight: dict = {}
    for term, w in sorted(weights.items()):
        by_weight.setdefault(w, []).append(term)
    hits = [F.size(F.array_intersect(tokens(text), F.array(*map(F.lit, terms)))).cast("bigint") * w
            for w, terms in sorted(by_weight.items())]
    return reduce(Column.__add__, hits)


def relevance_by_rules(df: DataFrame, rules: list[tuple[str, int]] | None = None,
                       threshold: int = RELEVANCE_THRESHOLD, text: str = "text") -> DataFrame:
    """TXT-1(b): score = sum of weights of the distinct tokens hit."""
    score = _score_of(F.col(text), _weights(rules or RELEVANCE_RULES))
    return df.withColumn("relevance_score", score).withColumn(
        "relevant", F.col("relevance_score") >= threshold)


def categorize_by_rules(df: DataFrame, rules=None, text: str = "text",
                        tags_list: list[str] | None = None,
                        keys: list[str] | None = None) -> DataFrame:
    """TXT-3 + JN-2 + FLT-16: the label with the highest rule score (ties to
    the earlier label: tags in manifest order, then other labels by name);
    no positive score, or a label outside the tag set, gives
    failed_to_infer_category.

    ``rules`` is a list of ``(label, term, weight)``, part of the program and
    scored inside the row, or a DataFrame with those columns of any size,
    joined on the term.  Both add up the weights as they are."""
    tag_set = tags_list or TAG_NAMES
    if isinstance(rules, DataFrame):
        best = _best_by_join(df, rules, text, tag_set, keys)
    else:
        best = _best_in_row(df, rules or CATEGORY_RULES, text, tag_set)
    in_tags = F.col("_best.label").isin(*tag_set)
    hit = F.coalesce(F.col("_best.score") > 0, F.lit(False))
    return (best.withColumn("category_score", F.when(hit, F.col("_best.score")).otherwise(F.lit(0)))
            .withColumn("category", F.when(hit & in_tags, F.col("_best.label"))
                        .otherwise(F.lit(FAILED_CATEGORY))).drop("_best"))


def _best_in_row(df: DataFrame, rules, text: str, tag_set) -> DataFrame:
    """Fixed rules: each term's weights are one array over the labels, so a
    review's distinct tokens are looked up once, in one pass."""
    present = {label for label, _, _ in rules}
    order = [x for x in tag_set if x in present] + sorted(present.difference(tag_set))
    kind = "bigint" if all(isinstance(w, int) for _, _, w in rules) else "double"
    by_term: dict[str, list] = {}
    for label, term, w in rules:
        by_term.setdefault(term, [0] * len(order))[order.index(label)] += w
    zero = F.array(*[F.lit(0).cast(kind) for _ in order])
    m = F.create_map(*[x for term, ws in sorted(by_term.items()) for x in (
        F.lit(term), F.array(*[F.lit(w).cast(kind) for w in ws]))])
    hits = F.array_intersect(tokens(F.col(text)), F.array(*map(F.lit, sorted(by_term))))
    scores = F.aggregate(hits, zero, lambda acc, t: F.zip_with(
        acc, F.try_element_at(m, t), lambda a, b: a + b))
    out = df.withColumn("_scores", scores)
    # max() of structs: the highest score, then the earliest label
    ranked = F.transform(F.col("_scores"), lambda s, i: F.struct(s.alias("score"), (-i).alias("neg_order")))
    best = F.array_max(ranked)
    labels = F.array(*map(F.lit, order))
    return (out.withColumn("_best", best)
            .withColumn("_best", F.struct(F.col("_best.score").alias("score"),
                                          F.get(labels, -F.col("_best.neg_order")).alias("label")))
            .drop("_scores"))


def _best_by_join(df: DataFrame, rules: DataFrame, text: str, tag_set, keys=None) -> DataFrame:
    """Rule tables of any size: explode distinct tokens, join the rules on
    the term, aggregate per (row key, label) with partial aggregation."""
    keys = keys or [c for c in ("command_id", "review_id") if c in df.columns]
    label_rank = F.array_position(F.array(*[F.lit(t) for t in tag_set]), F.col("label"))
    hits = (df.select(*keys, F.explode(token_set(F.col(text))).alias("term"))
            .join(rules.select("label", "term", "weight"), "term")
            .groupBy(*keys, "label").agg(F.sum("weight").alias("score")))
    best = hits.groupBy(*keys).agg(F.max(F.struct(
        "score", F.when(label_rank > 0, -label_rank).otherwise(F.lit(-1000)).alias("neg_order"),
        "label")).alias("_best"))
    return df.join(best, keys, "left")
