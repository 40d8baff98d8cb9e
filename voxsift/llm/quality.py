"""Quality rules as a learned decision list, in DataFrame functions only.

``measured`` computes the text statistics inside the row (no shuffle, no
Python).  ``learn`` fits an ordered list of threshold conjunctions to
labelled rows by sequential covering: a rule grows one condition at a time by
information gain on two thirds of the rows, is pruned on the other third, is
kept if it is precise enough there, and the rows it covers leave the training
set.  The training set is a bounded sample of the labelled rows
(``max_fit_rows``, taken by a hash of the id); it is measured and reduced to
counts per cell of feature bins by Spark, and only those counts reach the
driver.  ``verdict`` turns the list into one ordered Spark conditional
expression.

Defined results: a null or blank text has no words and fails the base rule;
rows without a label, with a null label or a null id do not train, nor do ids
whose labels disagree; repeated label rows, and repeated rows of a document,
train once; repeated rows are judged each; without labelled junk the list is empty and only the
base rule rejects; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, col, one_label

MAX_FIT_ROWS = 20_000
BINS = 24
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


# -- statistics of a text -------------------------------------------------

def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: a lambda variable, which
    the optimizer cannot copy into the places that use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def repeated_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the text.  A
    window is its 64-bit hash; equal ones meet by sorting (hash, place)."""
    n = F.size(words)

    def covered(places: Column) -> Column:
        """Size of the union of [p, p + 2] over the sorted places."""
        gaps = F.transform(places, lambda p, i: F.least(
            F.coalesce(F.get(places, i + 1) - p, F.lit(3)), F.lit(3)))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, g: a + g)

    def repeats(pairs: Column) -> Column:
        equal = lambda e, at: F.coalesce(e["h"] == F.get(pairs, at)["h"], F.lit(False))
        same = F.filter(pairs, lambda e, i: equal(e, i - 1) | equal(e, i + 1))
        return let(F.sort_array(F.transform(same, lambda e: e["p"])), covered)

    def of_hashes(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(pairs, repeats)).otherwise(
            F.lit(0).cast("bigint"))

    windows = F.transform(F.slice(words, F.lit(1), F.greatest(n - 2, F.lit(0))),
                          lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(n >= 4, let(windows, of_hashes)).otherwise(F.lit(0).cast("bigint"))


def statistics(text: Column) -> Column:
    """A struct of the text's counts."""
    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("bigint").alias("n_lines"),
                        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            F.size(F.array_distinct(words)).cast("bigint").alias("n_distinct"),
            repeated_words(words).alias("n_repeat_words"))

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.struct(
        let(words_of(text), of_words).alias("w"),
        let(lines, of_lines).alias("l"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("bigint").alias("n_upper"),
        F.regexp_count(text, F.lit(r"[0-9]")).cast("bigint").alias("n_digits"),
        F.regexp_count(text, F.lit(r"[!?]")).cast("bigint").alias("n_marks"))


def measured(text_col: str, body) -> Column:
    """``body(statistics)`` of a text column, everything in one expression:
    as columns of their own, the optimizer would copy the statistics into
    every filter and projection that reads them."""
    return let(statistics(F.coalesce(col(text_col).cast("string"), F.lit(""))), body)


def features(s: Column) -> dict[str, Column]:
    """Interpretable rates of a text's statistics."""
    number = lambda x: x.cast("double")
    words = F.greatest(number(s["w"]["n_words"]), F.lit(1.0))
    chars = F.greatest(number(s["w"]["word_chars"]), F.lit(1.0))
    return {
        "words": number(s["w"]["n_words"]),
        "word_length": number(s["w"]["word_chars"]) / words,
        "distinct_share": number(s["w"]["n_distinct"]) / words,
        "repeat_share": number(s["w"]["n_repeat_words"]) / words,
        "symbols_per_word": number(s["n_symbols"]) / words,
        "dup_line_share": number(s["l"]["n_dup_lines"]) / F.greatest(number(s["l"]["n_lines"]), F.lit(1.0)),
        "upper_share": number(s["n_upper"]) / chars,
        "digit_share": number(s["n_digits"]) / chars,
        "marks_per_word": number(s["n_marks"]) / words,
    }


def base_failed(s: Column) -> Column:
    n, repeat = s["w"]["n_words"], s["w"]["n_repeat_words"]
    return (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)


# -- the decision list ----------------------------------------------------

@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature > threshold, else feature <= threshold
    threshold: float

    def column(self, of: dict[str, Column]) -> Column:
        x = of[self.feature]
        return x > self.threshold if self.above else x <= self.threshold

    def __str__(self):
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    precision: float
    covered: int

    def __str__(self):
        return " and ".join(map(str, self.conditions))


def cover(cells, names, thresholds, min_precision=0.9, min_covered=5, max_conditions=4, max_rules=16):
    """Sequential covering over cells (bins by feature, prune part?, junk
    count, clean count) with numpy."""
    import numpy as np

    if not cells:
        return []
    bins = np.array([c[0] for c in cells], np.int64)
    held = np.array([c[1] for c in cells], bool)
    junk = np.array([c[2] for c in cells], float)
    clean = np.array([c[3] for c in cells], float)
    rules: list[Rule] = []
    live = np.ones(len(cells), bool)

    def options():
        for f, cuts in enumerate(thresholds):
            for b in range(len(cuts)):
                yield f, b, True
                yield f, b, False

    def mask(f, b, above):
        return bins[:, f] > b if above else bins[:, f] <= b

    masks = {o: mask(*o) for o in options()}
    while len(rules) < max_rules:
        grow = live & ~held
        inside, chosen = grow.copy(), []
        if junk[grow].sum() < 1:
            break
        while len(chosen) < max_conditions and clean[inside].sum() > 0:
            p0, n0 = junk[inside].sum(), clean[inside].sum()
            best, at = 1e-9, None
            for o, m in masks.items():
                p, n = junk[inside & m].sum(), clean[inside & m].sum()
                if p < 1:
                    continue
                gain = p * (log2((p + 0.5) / (p + n + 1)) - log2((p0 + 0.5) / (p0 + n0 + 1)))
                if gain > best:
                    best, at = gain, o
            if at is None:
                break
            chosen.append(at)
            inside &= masks[at]
        if not chosen:
            break
        # prune: the shortest prefix of the best worth on the held-back part
        def worth(prefix, where):
            m = where.copy()
            for o in prefix:
                m &= masks[o]
            return junk[m].sum(), clean[m].sum()

        scored = []
        for size in range(1, len(chosen) + 1):
            p, n = worth(chosen[:size], live & held)
            scored.append(((p - n) / (p + n) if p + n else -1.0, -size))
        size = -max(scored)[1]
        chosen = chosen[:size]
        p, n = worth(chosen, live)
        hp, hn = worth(chosen, live & held)
        if p < min_covered or p < min_precision * (p + n) or hp < min_precision * (hp + hn):
            break
        conditions = tuple(Condition(names[f], above, float(thresholds[f][b])) for f, b, above in chosen)
        rules.append(Rule(conditions, p / (p + n), int(p + n)))
        gone = live.copy()
        for o in chosen:
            gone &= masks[o]
        live &= ~gone
    return rules


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_fit_rows: int = MAX_FIT_ROWS, bins: int = BINS) -> list[Rule]:
    """Fit the list to labels (0: junk, else clean) of at most
    ``max_fit_rows`` labelled ids, chosen by a hash of the id.  The sample
    is bounded by that parameter, so it is broadcast to the scan."""
    sample = (one_label(labels, id_col, col(label_col) == 0).withColumnRenamed("y", "junk")
              .orderBy(F.xxhash64("id"), "id").limit(max_fit_rows))
    rows = docs.select(col(id_col).alias("id"), col(text_col).alias("text")).join(F.broadcast(sample), "id")
    shown = measured("text", lambda s: F.struct(
        base_failed(s).alias("failed"), *[x.alias(n) for n, x in features(s).items()]))
    # copies of a document count once
    every = rows.select("id", "junk", (F.pmod(F.xxhash64("id", F.lit("prune")), F.lit(3)) == 0).alias("held"),
                        shown.alias("f")).distinct().persist()
    names = list(features(F.struct()))
    table = every.where("NOT f.failed").select("junk", "held", *[F.col(f"f.{n}").alias(n) for n in names])
    try:
        levels = [i / bins for i in range(bins + 1)]
        cuts = table.groupBy("junk").agg(*[
            F.percentile_approx(n, levels, 2000).alias(n) for n in names]).collect()
        seen = [sorted({float(v) for r in cuts for v in (r[n] or [])}) for n in names]
        # cut midway between neighbouring quantiles of either class: as far from both as can be
        thresholds = [[(a + b) / 2 for a, b in zip(x, x[1:])] for x in seen]
        binned = [sum([(F.col(n) > t).cast("int") for t in cut], F.lit(0)).alias(n)
                  for n, cut in zip(names, thresholds)]
        cells = table.select("junk", "held", *binned).groupBy(*names, "held").agg(
            F.sum(F.col("junk").cast("int")).alias("n_junk"),
            F.sum((~F.col("junk")).cast("int")).alias("n_clean")).collect()
    finally:
        every.unpersist()
    return cover([([r[n] for n in names], r["held"], r["n_junk"], r["n_clean"]) for r in cells],
                 names, thresholds)


def verdict(rules: list[Rule], s: Column) -> Column:
    """Number of the rule that rejects a text of these statistics: -1 the
    base rule, from 1 the first rule of the list, 0 none; one ordered
    conditional."""
    feats = features(s)
    out = F.when(base_failed(s), -1)
    for i, rule in enumerate(rules, 1):
        met = rule.conditions[0].column(feats)
        for c in rule.conditions[1:]:
            met = met & c.column(feats)
        out = out.when(met, i)
    return out.otherwise(0)


def judge(docs: DataFrame, rules: list[Rule], text_col: str = "text", name: str = "judged") -> DataFrame:
    """The documents with a struct column ``name``: their ``statistics`` and
    the number of the rejecting ``rule``."""
    return docs.withColumn(name, measured(text_col, lambda s: F.struct(
        s.alias("statistics"), verdict(rules, s).alias("rule"))))


def keep_good(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """The documents, all columns, that no rule rejects."""
    return docs.where(measured(text_col, lambda s: verdict(rules, s) == 0))
