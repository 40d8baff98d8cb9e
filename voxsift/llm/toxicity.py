"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (see ``subword``), so unseen forms
and misspellings share the vectors of known ones.  Embeddings and softmax are
trained together on the words of a bounded sample of labelled documents
(``max_fit_docs``, by a hash of the id): a word's target is the share of its
documents that are toxic beyond the base rate, shrunken by a prior.  A
document is as toxic as its worst words: the chance that any of its three
highest-scored words is toxic, put through a logistic link that is fitted on
documents held back from the words' training, is its score.  One insult in a
very long text thus still counts.

Scores read the text only.  Scoring runs inside the scan, without shuffles.

Defined results: null, empty and wordless texts score like a text whose words
are all harmless; rows without an id or a label do not train, nor do ids whose
labels disagree; repeated label rows train once; a training set
without both labels gives every text its base rate; repeated rows give a row
each; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, one_label, slices
from .subword import averages, train

SIZES, BITS, DIM = (3, 4, 5, 6), 18, 8
MAX_FIT_DOCS = 8_000
PRIOR_DOCS = 5.0
TOP_WORDS = 3
FLOOR = -12.0
MEMO_WORDS = 400_000
SLICE_BYTES = 4 << 20
THRESHOLD = 0.3
EDGES = "#*$%&!.,;:?\"'|()[]{}<>-_/\\=+~^`«»“”„’‘…"


# -- inside tasks ---------------------------------------------------------

def words_of(text) -> set:
    """Distinct lower-case words without the marks around them."""
    if not text:
        return set()
    return {w.strip(EDGES) for w in set(text.lower().split())} - {""}


def word_scores(words, model):
    """Log odds of each word."""
    return averages(words, [model["scores"]], SIZES, BITS)[:, 0] + model["bias"]


class Scorer:
    """Word scores, kept for words seen before (a bounded memo)."""

    def __init__(self, model):
        self.model, self.memo = model, {}

    def highest(self, texts):
        """The highest word scores of each text (texts x TOP_WORDS)."""
        import numpy as np

        bags = [words_of(t) for t in texts]
        new = list(set().union(*bags).difference(self.memo))
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.memo.clear()
            new = list(set().union(*bags))
        for start in range(0, len(new), 1 << 16):
            part = new[start:start + (1 << 16)]
            self.memo.update(zip(part, word_scores(part, self.model).tolist()))
        out = np.full((len(texts), TOP_WORDS), FLOOR)
        for i, bag in enumerate(bags):
            top = sorted(map(self.memo.__getitem__, bag), reverse=True)[:TOP_WORDS]
            out[i, :len(top)] = top
        return out

    def log_odds(self, texts):
        """Log odds that any of a text's highest words is toxic."""
        import numpy as np

        clean = -np.logaddexp(0, np.clip(self.highest(texts), FLOOR, -FLOOR)).sum(1)
        return np.log(-np.expm1(clean)) - clean

    def probabilities(self, texts):
        import numpy as np

        if "rate" in self.model:
            return np.full(len(texts), self.model["rate"])
        slope, constant = self.model["link"]
        return 1 / (1 + np.exp(-np.clip(slope * self.log_odds(texts) + constant, -30, 30)))


# -- learning -------------------------------------------------------------

def logistic(x, y, steps=40, decay=1e-3):
    """Slope and constant by Newton steps on the penalized loss."""
    import numpy as np

    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + decay * len(y) * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + (decay * len(y) + 1e-6) * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(rows, seed=5) -> dict:
    """A model of (text, label 0/1) rows."""
    from collections import Counter

    import numpy as np

    rng = np.random.default_rng(seed)
    positive = sum(y for _, y in rows)
    rate = (positive + 0.5) / (len(rows) + 1) if rows else 0.0
    if not 0 < positive < len(rows):
        return {"rate": rate if rows else 0.0}
    order = rng.permutation(len(rows))
    held, learned = order[:len(rows) // 4], order[len(rows) // 4:]
    toxic, every = Counter(), Counter()
    for i in learned:
        words = words_of(rows[i][0])
        every.update(words)
        if rows[i][1]:
            toxic.update(words)
    words = sorted(every)
    if not words:
        return {"rate": rate}
    n = np.array([every[w] for w in words], float)
    n_toxic = np.array([toxic[w] for w in words], float)
    share = (n_toxic + PRIOR_DOCS * rate) / (n + PRIOR_DOCS)
    excess = np.clip((share - rate) / (1 - rate), 0, 1)
    scores, bias = train(words, np.stack([1 - excess, excess], 1), np.sqrt(n), SIZES, BITS, DIM, 6, 0.5, 1024)
    model = {"scores": scores[1] - scores[0], "bias": float(bias[1] - bias[0])}
    scorer = Scorer(model)
    use = held if len({rows[i][1] for i in held}) == 2 else order
    x = np.concatenate([scorer.log_odds([rows[i][0] for i in use[at:at + 200]]) for at in range(0, len(use), 200)])
    model["link"] = logistic(x, np.array([rows[i][1] for i in use], float))
    return model


def learn(docs: DataFrame, labels: DataFrame, train_rows: Column | None = None, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic", max_fit_docs: int = MAX_FIT_DOCS) -> dict:
    """Fit on at most ``max_fit_docs`` labelled ids of those that
    ``train_rows`` (of the labels) holds for, chosen by a hash of the id.
    The sample is bounded by that parameter, so it is broadcast to the scan."""
    src = labels if train_rows is None else labels.where(train_rows)
    value = col(label_col).cast("int")
    sample = one_label(src, id_col, F.when(value.isin(0, 1), value)).orderBy(
        F.xxhash64("id"), "id").limit(max_fit_docs)
    rows = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text")).join(
        F.broadcast(sample), "id").select("id", "text", "y")
    # ids may repeat in docs: the bound holds for rows too, of which copies count once
    rows = rows.distinct().orderBy(F.xxhash64("id", "text"), "id", "text", "y").limit(2 * max_fit_docs)
    return fit(sorted(((r.text or "", r.y) for r in rows.toLocalIterator())))


# -- Spark plan -----------------------------------------------------------

def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: the id, ``score`` and ``predicted``."""
    src = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        scorer = Scorer(shared.value)
        for batch in batches:
            for start, stop in slices(batch, 1, SLICE_BYTES):
                part = batch.slice(start, stop - start)
                p = scorer.probabilities(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                    names=["id", "score", "predicted"])

    kind = src.schema["id"].dataType.simpleString()
    out = src.mapInArrow(run, f"id {kind}, score double, predicted int")
    return out.withColumnRenamed("id", id_col)
