"""Language identification by averaged hashed subword embeddings.

Letters are lower-cased, everything else is a blank; a text is the bag of its
character n-grams (see ``subword``).  The model is trained on pieces of a
bounded sample of labelled documents (by a hash), so that short texts are known
to it; it is applied to whole texts.  The sample has ``max_fit_docs`` documents
of the whole table and the first ``per_language`` of each language, at most
``max_fit_docs`` more, so that a rare language is learned too.  Of at most
``max_pieces`` pieces every document gives its first, then its second and so
on, so that few very long documents do not take them all.  A temperature
fitted on held-back documents calibrates the scores, and the lowest score at
which those documents are right at ``target_precision`` is the rejection
threshold: texts below it keep their best language and are marked rejected.

Prediction reads the text only.  It runs inside the scan, without shuffles.

Defined results: null texts and texts without a letter are ``und`` with score
0 and rejected; rows without a language, an id or a text may be predicted,
but a null language or text does not train; without training rows everything
is ``und``; repeated rows give a row each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_sample, col, slices
from .subword import averages, code_points, ngrams, train

SIZES, BITS, DIM = (3, 4), 16, 8
MAX_FIT_DOCS = 3_000
PER_LANGUAGE = 50
PIECE_WORDS = 30
MAX_PIECES = 24_000
TARGET_PRECISION = 0.99
SLICE_BYTES = 4 << 20
UNKNOWN = "und"


# -- inside tasks ---------------------------------------------------------

def letters_of(texts):
    """(code points with blanks for all but letters, text of each place,
    letters of each text); a blank stands before, between and after texts."""
    import numpy as np

    low = [(t or "").lower() for t in texts]
    codes = code_points(" " + " ".join(low) + " ").copy()
    seen = np.flatnonzero(np.bincount(codes))
    alphabet = np.zeros(int(seen[-1]) + 1, bool)
    alphabet[[c for c in seen.tolist() if chr(c).isalpha()]] = True
    letter = alphabet[codes]
    codes[~letter] = 32
    chars = np.fromiter(map(len, low), np.int64, len(low)) + 1
    owner = np.repeat(np.arange(len(low) + 1), np.append(1, chars)) - 1
    return codes, owner, np.bincount(owner[letter], minlength=len(low))


def predict_texts(texts, model):
    """(label number or -1, score) of each text."""
    import numpy as np

    codes, owner, letters = letters_of(texts)
    place, bucket = ngrams(codes, SIZES, BITS)
    owner = owner[place]
    size = np.maximum(np.bincount(owner, minlength=len(texts)), 1)
    logits = np.stack([np.bincount(owner, s[bucket], len(texts)) for s in model["scores"]], 1)
    logits = (logits / size[:, None] + model["bias"]) / model["temperature"]
    p = np.exp(logits - logits.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    best = p.argmax(1)
    known = letters > 0
    return np.where(known, best, -1), np.where(known, p.max(1), 0.0)


# -- learning -------------------------------------------------------------

def fair_share(of_doc, most: int, rng):
    """Places of at most ``most`` pieces, documents taking turns at random."""
    import numpy as np

    chance = rng.permutation(len(of_doc))
    order = np.lexsort((chance, of_doc))
    first = np.searchsorted(of_doc[order], of_doc[order])
    turn = np.empty(len(order), np.int64)
    turn[order] = np.arange(len(order)) - first
    return np.sort(np.lexsort((chance, turn))[:most])


def fit(rows, target_precision=TARGET_PRECISION, seed=11, max_pieces: int = MAX_PIECES) -> dict | None:
    """A model of (text, label) rows, or None without usable rows."""
    import numpy as np

    rng = np.random.default_rng(seed)
    labels = sorted({label for _, label in rows})
    number = {label: i for i, label in enumerate(labels)}
    order = rng.permutation(len(rows))
    held = [rows[i] for i in order[:len(rows) // 5]]
    pieces, of, of_doc = [], [], []
    for i in order[len(rows) // 5:]:
        text, label = rows[i]
        codes, _, n = letters_of([text])
        if not n[0]:
            continue
        words = codes.tobytes().decode("utf-32-le").split()
        for start in range(0, len(words), PIECE_WORDS):
            pieces.append(" ".join(words[start:start + PIECE_WORDS]))
            of.append(number[label])
            of_doc.append(i)
    if not pieces:
        return None
    if len(pieces) > max_pieces:
        chosen = fair_share(np.array(of_doc), max_pieces, rng)
        pieces, of = [pieces[i] for i in chosen], [of[i] for i in chosen]
    targets = np.eye(len(labels))[of]
    scores, bias = train(pieces, targets, np.ones(len(pieces)), SIZES, BITS, DIM, 3, 0.5, 64)
    model = {"labels": labels, "scores": scores, "bias": bias, "temperature": 1.0, "threshold": 0.0}
    held = [(t, number[label]) for t, label in held if letters_of([t])[2][0]]
    if not held:
        return model
    logits = np.log(np.maximum(np.concatenate([
        whole_scores([t for t, _ in held[i:i + 64]], model) for i in range(0, len(held), 64)]), 1e-300))
    truth = np.array([y for _, y in held])

    def loss(temperature):
        z = logits / temperature
        z = z - z.max(1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(1)) - z[np.arange(len(truth)), truth]))

    model["temperature"] = min(np.geomspace(0.05, 20, 61), key=loss)
    best, score = (np.concatenate(x) for x in zip(*(
        predict_texts([t for t, _ in held[i:i + 64]], model) for i in range(0, len(held), 64))))
    by = np.argsort(-score)
    right = np.cumsum(best[by] == truth[by]) / np.arange(1, len(by) + 1)
    good = np.flatnonzero(right >= target_precision)
    model["threshold"] = float(score[by][good[-1]]) if len(good) else 1.0
    return model


def whole_scores(texts, model):
    """Label probabilities of each text before calibration."""
    import numpy as np

    units = ["".join(c) for c in (letters_of([t])[0].tobytes().decode("utf-32-le") for t in texts)]
    logits = averages(units, model["scores"], SIZES, BITS) + model["bias"]
    p = np.exp(logits - logits.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def sample(src: DataFrame, max_fit_docs: int, per_language: int) -> DataFrame:
    """Distinct (text, lang) rows of the smallest hashes: ``max_fit_docs`` of
    all, and the first ``per_language`` of each language, of which the bound
    ``max_fit_docs`` cuts the later rows of every language first.  Only hashes
    are shuffled; the group limit is partial, so no task gathers a language."""
    by = F.xxhash64("text", "lang")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    first = (src.select("lang", by.alias("hash")).distinct().withColumn("place", place)
             .where(F.col("place") <= per_language).orderBy("place", "hash").limit(max_fit_docs).select("hash"))
    rows = src.withColumn("hash", by).join(F.broadcast(first), "hash", "left_semi").drop("hash")
    return bounded_sample(src, max_fit_docs, F.col("text"), F.col("lang")).union(rows).distinct()


def learn(docs: DataFrame, train_rows: Column | None = None, text_col: str = "text",
          lang_col: str = "lang", max_fit_docs: int = MAX_FIT_DOCS, per_language: int = PER_LANGUAGE,
          max_pieces: int = MAX_PIECES) -> dict | None:
    """Fit on a bounded ``sample`` of those rows that ``train_rows`` holds
    for; equal rows train once."""
    src = docs if train_rows is None else docs.where(train_rows)
    src = src.select(col(text_col).cast("string").alias("text"), col(lang_col).cast("string").alias("lang"))
    src = src.where("text IS NOT NULL AND lang IS NOT NULL")
    rows = sample(src, max_fit_docs, per_language)
    return fit(sorted((r.text, r.lang) for r in rows.toLocalIterator()), max_pieces=max_pieces)


# -- Spark plan -----------------------------------------------------------

def identify(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, ``lang_pred``, ``score`` and ``rejected``."""
    src = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        model = shared.value
        for batch in batches:
            for start, stop in slices(batch, 1, SLICE_BYTES):
                part = batch.slice(start, stop - start)
                if model is None:
                    best, score, least = np.full(part.num_rows, -1), np.zeros(part.num_rows), 1.0
                else:
                    best, score = predict_texts(part.column(1).to_pylist(), model)
                    least = model["threshold"]
                names = [model["labels"][i] if i >= 0 else UNKNOWN for i in best.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names), pa.array(score),
                     pa.array((best < 0) | (score < least))], names=["id", "lang_pred", "score", "rejected"])

    kind = src.schema["id"].dataType.simpleString()
    out = src.mapInArrow(run, f"id {kind}, lang_pred string, score double, rejected boolean")
    return out.withColumnRenamed("id", id_col)
