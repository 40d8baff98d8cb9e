"""Periodic runs of words by recursive frequency splitting.

A run is a stretch of consecutive words whose smallest period is q (words q
apart are identical), of at least max(6, 4 q) words, that no neighbouring word
extends keeping q.  A word of such a run occurs at least four times in it.  So
inside a segment (at first the whole document) each word that occurs fewer
than four times splits it, and the parts are counted anew until no part has a
rare word left: natural text falls apart within a few steps and only
repetitive stretches survive.  No run crosses a split, and none is extended
across one.

A surviving segment of m words is scanned lag by lag.  Words q apart agree
over at least 3 q places in a run of period q, so three consecutive multiples
of q agree as well: only those are compared (m log m steps for all lags), and
a place where they agree is extended to both sides.  A lag whose stretch lies
in a run of a period that divides it is that run again and is skipped.

Documents are independent: one Arrow pass inside the scan, no shuffle.  The
splitting works on all documents of a slice at once.

Defined results: null, empty and blank texts have no words, no runs and an
empty collapsed text; repeated rows give a row each; a null id is kept; an
empty table gives an empty result; other columns are not read, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, release, slices

MIN_WORDS = 6
MIN_EXPONENT = 4
SLICE_BYTES = 4 << 20

RUN = "struct<start:bigint,length:bigint,period:bigint>"


# -- inside tasks ---------------------------------------------------------

def surviving(words, segment):
    """Maximal stretches (start, stop) of a flat array of word numbers that
    may hold runs: in each one, every word occurs often enough.  ``segment``
    gives the document of each word (ascending)."""
    import numpy as np

    at = np.arange(len(words))
    done = []
    while len(at):
        key = segment * (int(words.max()) + 1) + words[at]
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        common = count[which] >= MIN_EXPONENT
        split = np.zeros(int(segment[-1]) + 1, bool)
        split[segment[~common]] = True
        # whole segments are stable; the others go on with their common words
        stable = ~split[segment]
        done.append(stretches(at[stable], segment[stable]))
        left = common & ~stable
        at, segment = at[left], segment[left]
        if len(at):
            new = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(segment) != 0)])
            segment = np.cumsum(new) - 1
            long = (np.bincount(segment) >= MIN_WORDS)[segment]
            at, segment = at[long], segment[long]
    return sorted(span for spans in done for span in spans)


def stretches(at, segment):
    """(start, stop) of each segment of at least MIN_WORDS places."""
    import numpy as np

    if not len(at):
        return []
    first = np.flatnonzero(np.concatenate([[True], np.diff(segment) != 0]))
    last = np.append(first[1:], len(at)) - 1
    return [(a, b + 1) for a, b in zip(at[first].tolist(), at[last].tolist()) if b + 1 - a >= MIN_WORDS]


def agreeing(words, lag, at):
    """The maximal stretch [start, stop) around ``at`` of places whose word
    equals the one ``lag`` later."""
    import numpy as np

    n = len(words) - lag
    stop, step = at, 64
    while stop < n:
        end = min(n, stop + step)
        differ = words[stop:end] != words[stop + lag:end + lag]
        if differ.any():
            stop += int(differ.argmax())
            break
        stop, step = end, 2 * step
    start, step = at, 64
    while start > 0:
        low = max(0, start - step)
        differ = np.flatnonzero(words[low:start] != words[low + lag:start + lag])
        if len(differ):
            start = low + int(differ[-1]) + 1
            break
        start, step = low, 2 * step
    return start, stop


def scan(words):
    """The runs (start, length, period) of one segment, by start and period."""
    import numpy as np

    found: list[tuple[int, int, int]] = []
    known: set[tuple[int, int]] = set()
    owner = np.full(len(words), -1, np.int64)
    for lag in range(1, len(words) // MIN_EXPONENT + 1):
        marks = words[::lag]
        same = marks[1:] == marks[:-1]
        hits = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * lag if len(same) > 2 else ()
        if not len(hits):
            continue
        if found:  # inside a run of a period that divides the lag, nothing is new
            start, length, period = np.array(found).T
            own = owner[hits]
            old = (own >= 0) & (lag % period[own] == 0) & (hits + lag < (start + length)[own])
            hits = hits[~(old & (length[own] >= lag + period[own]))]
        beyond = 0
        for at in hits.tolist():
            if at < beyond:
                continue
            start, beyond = agreeing(words, lag, at)
            length = beyond - start + lag
            # an equal stretch of a smaller lag has the smallest period
            if length >= max(MIN_WORDS, MIN_EXPONENT * lag) and (start, length) not in known:
                known.add((start, length))
                owner[start:start + length] = len(found)
                found.append((start, length, lag))
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_of(texts):
    """For each list of words, its runs."""
    import numpy as np

    numbers: dict = {}
    flat = np.array([numbers.setdefault(w, len(numbers)) for words in texts for w in words], np.int64)
    sizes = np.array([len(words) for words in texts], np.int64)
    first = np.cumsum(sizes) - sizes
    out: list[list] = [[] for _ in texts]
    if len(flat):
        for start, stop in surviving(flat, np.repeat(np.arange(len(texts)), sizes)):
            doc = int(np.searchsorted(first, start, side="right")) - 1
            out[doc] += [(start - int(first[doc]) + s, n, q) for s, n, q in scan(flat[start:stop])]
    return out


def collapsed(words, runs):
    """The words without those after the first period of any run."""
    if not runs:
        return words
    import numpy as np

    turns = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        turns[start + period] += 1
        turns[start + length] -= 1
    return [w for w, inside in zip(words, np.cumsum(turns[:-1]).tolist()) if not inside]


# -- Spark plan -----------------------------------------------------------

def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per document: the id, ``n_words``, ``runs`` (start, length and
    period in words, by start and period) and ``collapsed``, the words that
    stay when each run is cut to its first period, joined by one space."""
    src = docs.select(col(id_col).alias("id"), col(text_col).cast("string").cast("binary").alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        run_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
        for batch in batches:
            for start, stop in slices(batch, 1, slice_bytes):
                part = batch.slice(start, stop - start)
                # bytes.split() splits at the ASCII white space of the word rule
                texts = [(t or b"").split() for t in part.column(1).to_pylist()]
                runs = runs_of(texts)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(words) for words in texts], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs],
                             run_type),
                    pa.array([b" ".join(collapsed(w, r)) for w, r in zip(texts, runs)], pa.binary()).cast(
                        pa.string())], names=["id", "n_words", "runs", "collapsed"])
            release()

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, n_words bigint, runs array<{RUN}>, collapsed string").withColumnRenamed(
        "id", id_col)


def strongest(runs: Column) -> Column:
    """The run of the greatest exact length / period (ties: the smallest
    start, then period); null without runs."""
    def order(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        return (F.when(left != right, F.when(left > right, -1).otherwise(1))
                .when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
                .when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0))

    return F.get(F.array_sort(runs, order), F.lit(0))
