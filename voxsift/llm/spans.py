"""Substring deduplication by sliding sentence spans.

A text is cut into sentences at line ends and after sentence and clause marks
that a blank follows; a sentence of over ``LONG_WORDS`` words is also cut after
the word of the smallest hash (the last of equal ones) of each window of
``CUT_WINDOW`` words, so no part is longer than a window.  Between the first and
the last window that lie inside a shared passage, the cuts are the same in every
document: each of its ends loses ``LONG_WORDS`` words at most.  Every run of
consecutive sentences, from each sentence on, that first holds at least
``min_sentences`` sentences and ``min_words`` words is hashed (96 bits, lower
case, blanks alike); with ``both_ends`` also the shortest such run up to each
sentence, so that the last sentences of a shared passage lie in a run too.
Which runs there are depends on their own sentences only, so a shared passage
has the same runs in every document; with the default sizes, one of over 50 words
has a run.  Equal runs are joined over the whole corpus, and sentences that lie in
any but the first occurrence (smallest id, then place) of a run are removed.

Each slice of a task keeps the first occurrence of a run for the global join
and marks its others at once, as they cannot be the first: a passage that a
third of all documents share costs one row for each slice.  Runs are shuffled
once as (hash, id, place), marks once by id with the texts that they cut.

Defined results: null and blank texts have no sentences; texts without a full
run are never cut; equal rows of one id count as the same document, so they do
not remove each other's text; other rows of one id are documents of their own,
ordered by the hash of their text; null ids come last; an empty table gives an
empty result; of the documents, only id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, shuffle_partitions, slices

MIN_SENTENCES = 2
MIN_WORDS = 20
LONG_WORDS = 15
CUT_WINDOW = 11
SLICE_BYTES = 4 << 20
WORD = re.compile(r"\S+")
CUT = re.compile(r"[.!?;:,](?=\s)|\n")


# -- inside tasks ---------------------------------------------------------

def long_cuts(words):
    """Numbers of the words with the smallest hash of any window of
    ``CUT_WINDOW`` words, the last of equal ones."""
    from zlib import crc32

    hashes = [crc32(w.encode("utf-8", "surrogatepass")) for w in words]
    out, least = [], -1
    for end in range(CUT_WINDOW, len(hashes) + 1):
        start = end - CUT_WINDOW
        if least < start:
            least = start
            for i in range(start + 1, end):
                if hashes[i] <= hashes[least]:
                    least = i
        elif hashes[end - 1] <= hashes[least]:
            least = end - 1
        else:
            continue
        out.append(least)
    return out


def sentences_of(text):
    """(spans, number of words, digest) of the sentences that have words;
    the spans tile the text but for blank sentences."""
    from xxhash import xxh3_128_digest

    spans, sizes, digests = [], [], []

    def add(start, end, words):
        spans.append((start, end))
        sizes.append(len(words))
        digests.append(xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass")))

    start = 0
    ends = [m.end() for m in CUT.finditer(text)]
    for end in (*ends, len(text)):
        words = text[start:end].lower().split()
        if len(words) > LONG_WORDS:
            first = 0
            word_ends = [m.end() for m in WORD.finditer(text, start, end)]
            for i in long_cuts(words):
                if i < len(words) - 1:
                    add(start, word_ends[i], words[first:i + 1])
                    start, first = word_ends[i], i + 1
            words = words[first:]
        if words:
            add(start, end, words)
        start = end
    return spans, sizes, digests


def runs_of(sizes, digests, min_sentences, min_words, both_ends=False):
    """(first sentence, number of sentences, digest) of every run, once."""
    from xxhash import xxh3_128_digest

    out, last, words = [], 0, 0  # the run is [first, last)
    for first in range(len(sizes)):
        while last < len(sizes) and (words < min_words or last - first < min_sentences):
            words += sizes[last]
            last += 1
        if words < min_words or last - first < min_sentences:
            break
        out.append((first, last - first, xxh3_128_digest(b"".join(digests[first:last]))))
        words -= sizes[first]
    first = words = 0
    for last in range(len(sizes) if both_ends else 0):  # the run is [first, last]
        words += sizes[last]
        while words - sizes[first] >= min_words and last - first >= min_sentences:
            words -= sizes[first]
            first += 1
        # if it is full without its last sentence, it is not the first full run from its start
        if words - sizes[last] >= min_words and last - first >= min_sentences:
            out.append((first, last - first + 1, xxh3_128_digest(b"".join(digests[first:last + 1]))))
    return out


def cut_text(text, places):
    """(sentences, removed spans, text without them); places: packed runs."""
    spans, _, _ = sentences_of(text)
    gone = set()
    for place in places:
        first, size = place >> 24, place & 0xFFFFFF
        gone.update(range(first, first + size))
    removed: list[list[int]] = []
    for i in sorted(gone):
        start, end = spans[i]
        if removed and removed[-1][2] == i - 1:
            removed[-1][1:] = [end, i]
        else:
            removed.append([start, end, i])
    kept, last = [], 0
    for start, end, _ in removed:
        kept.append(text[last:start])
        last = end
    kept.append(text[last:])
    return len(spans), len(gone), [(a, b) for a, b, _ in removed], "".join(kept)


def document_codes(ids, versions):
    """Arrays that are equal in two places of a batch for equal documents."""
    import numpy as np
    import pyarrow.compute as pc

    code = pc.dictionary_encode(ids, null_encoding="encode").indices
    return np.asarray(code), np.asarray(versions)


# -- Spark plans ----------------------------------------------------------

def _versions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    return rows.withColumn("version", F.hash("text"))


def later_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS,
               both_ends: bool = False) -> DataFrame:
    """(id, version, place) of every run that is not the first of its text;
    version is the text's hash, place packs the first sentence and the number
    of sentences."""
    src = _versions(docs, id_col, text_col)
    kind = src.schema["id"].dataType.simpleString()

    def runs(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            for start, stop in slices(batch, 1, SLICE_BYTES):
                part = batch.slice(start, stop - start)
                # in the order of documents, the first row of a hash is its first occurrence
                order = pc.sort_indices(part, [("id", "ascending"), ("version", "ascending")],
                                        null_placement="at_end")
                part = part.take(order)
                owner, place, digests = [], [], []
                ids, versions = part.column(0), part.column(2)
                for i, text in enumerate(part.column(1).to_pylist()):
                    if not text:
                        continue
                    _, sizes, own = sentences_of(text)
                    for first, size, digest in runs_of(sizes, own, min_sentences, min_words, both_ends):
                        owner.append(i)
                        place.append(first << 24 | size)
                        digests.append(digest)
                if not owner:
                    continue
                hashes = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2).copy()
                hashes[:, 1] &= 0x7FFFFFFF
                owner = np.array(owner)
                place = np.array(place)
                # equal rows of one id are one document
                code, version = document_codes(ids, versions)
                dense = np.cumsum(np.concatenate([[0], (code[1:] != code[:-1]) | (version[1:] != version[:-1])]))[owner]
                by = np.lexsort((place, dense, hashes[:, 1], hashes[:, 0]))
                h, o, p = hashes[by], dense[by], place[by]
                fresh = np.concatenate([[True], (h[1:] != h[:-1]).any(axis=1)])
                group = np.cumsum(fresh) - 1
                starts = np.flatnonzero(fresh)
                same = (o == o[starts][group]) & (p == p[starts][group])
                first = np.zeros(len(by), bool)
                first[by[same]] = True
                # marked rows are dealt by their own place, not by the hash
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.where(first, hashes[:, 0], owner * 7919 + place)),
                    pa.array(hashes[:, 1].astype(np.int32)), pa.array(first), ids.take(pa.array(owner)),
                    versions.take(pa.array(owner)), pa.array(place)],
                    names=["h1", "h2", "open", "id", "version", "place"])

    def later(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        last = None  # (h1, h2, id, version, place) of the open run's first occurrence
        for batch in batches:
            if not batch.num_rows:
                continue
            h1, h2 = (np.asarray(batch.column(i)) for i in (0, 1))
            open_ = np.asarray(batch.column(2).to_numpy(zero_copy_only=False))
            ids, place = batch.column(3), np.asarray(batch.column(5))
            code, version = document_codes(ids, batch.column(4))
            fresh = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
                                    | (open_[1:] != open_[:-1])])
            if last is not None and open_[0] and (int(h1[0]), int(h2[0])) == last[:2]:
                fresh[0] = False
            starts = np.flatnonzero(fresh)
            group = np.cumsum(fresh) - 1
            first_at = starts[np.maximum(group, 0)] if len(starts) else np.zeros(len(h1), np.int64)
            same = (code == code[first_at]) & (version == version[first_at]) & (place == place[first_at])
            for i in np.flatnonzero(group < 0):  # the run goes on from the last batch
                same[i] = (ids[int(i)].as_py(), int(version[i]), int(place[i])) == last[2:]
            out = np.flatnonzero(~open_ | ~same)
            if open_[-1]:
                if len(starts):
                    at = int(starts[-1])
                    last = (int(h1[at]), int(h2[at]), ids[at].as_py(), int(version[at]), int(place[at]))
            else:
                last = None
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(out)), pa.array(version[out]), pa.array(place[out])],
                names=["id", "version", "place"])

    found = src.mapInArrow(runs, f"h1 bigint, h2 int, open boolean, id {kind}, version int, place bigint")
    dealt = found.repartition(shuffle_partitions(docs.sparkSession), "h1")
    ordered = dealt.sortWithinPartitions("open", "h1", "h2", F.col("id").asc_nulls_last(), "version", "place")
    return ordered.mapInArrow(later, f"id {kind}, version int, place bigint")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS,
                   both_ends: bool = False) -> DataFrame:
    """One row per document: the id, ``n_sentences``, ``n_removed``,
    ``removed`` (spans in code points, end exclusive) and ``text`` without
    them (null stays null)."""
    marks = later_runs(docs, id_col, text_col, min_sentences, min_words, both_ends).groupBy(
        F.col("id").alias("of"), F.col("version").alias("of_version")).agg(F.collect_set("place").alias("places"))
    src = _versions(docs, id_col, text_col)
    both = src.join(marks, src.id.eqNullSafe(marks.of) & (src.version == marks.of_version), "left").select(
        "id", "text", "places")
    kind = src.schema["id"].dataType.simpleString()

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for start, stop in slices(batch, 1, SLICE_BYTES):
                part = batch.slice(start, stop - start)
                n, gone, removed, texts = [], [], [], []
                for text, places in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    a, b, c, d = cut_text(text or "", places or ())
                    n.append(a)
                    gone.append(b)
                    removed.append([{"start": x, "end": y} for x, y in c])
                    texts.append(None if text is None else d)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                     pa.array(removed, span_type), pa.array(texts, pa.string())],
                    names=["id", "n_sentences", "n_removed", "removed", "text"])

    out = both.mapInArrow(cut, f"id {kind}, n_sentences bigint, n_removed bigint, "
                               "removed array<struct<start:bigint,end:bigint>>, text string")
    return out.toDF(id_col, "n_sentences", "n_removed", "removed", "text")
