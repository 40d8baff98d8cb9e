"""Benchmark decontamination with an FM-index per training shard.

A shard is a few megabytes of consecutive documents of one task.  Its words
are numbered by the vocabulary of the test phrases; a run of documents' words
in that vocabulary that is shorter than the shortest phrase cannot hold an
occurrence, so only the longer runs are indexed (no occurrence is lost).  The
index is the suffix array's BWT in a wavelet matrix with packed bits and
block counts, the symbol counts, and suffix positions sampled at every
eighth position and at each run's start.  All phrases of a shard are searched
together, backwards, symbol by symbol; occurrences are located by LF steps up
to a sampled position, and the words they cover are merged into removal spans.

A phrase is a window of ``window`` consecutive words of an item, or the whole
item if it has fewer words.  The test set reaches the tasks in blocks whose
text is at most about ``block_bytes``, each searched in every shard, one in
memory at a time.  Rows are dealt to blocks by item and text, repeats once, so
an item of very many rows spreads too.  At most ``broadcast_bytes`` of text are
broadcast at once: a larger test set takes more passes, each with broadcasts of its
own; what a pass found rides with the rows, checkpointed in the shared folder,
to the next.  Documents are not shuffled and no task holds more than one
shard's index.

Defined results: null and wordless texts have no words and no hits, null and
wordless items have no phrases, items without an id are not searched; several
rows of one item id count as one item; repeated documents give one row each;
empty tables give empty results; other columns of documents are kept by
``decontaminate`` whatever their names, and not read by ``contamination``.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from .common import col, cut, fresh, slices

WINDOW_WORDS = 10
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 16 << 20
BROADCAST_BYTES = 128 << 20
SAMPLE = 8


# -- words ----------------------------------------------------------------

def word_bytes() -> bytes:
    """Translation table: lower-cases A-Z, keeps 0-9, a-z and every byte of
    non-ASCII characters, makes the rest blanks.  Offsets do not change."""
    out = bytearray(b" " * 128 + bytes(range(128, 256)))
    for c in b"0123456789abcdefghijklmnopqrstuvwxyz":
        out[c] = c
    for c in range(ord("A"), ord("Z") + 1):
        out[c] = c + 32
    return bytes(out)


def phrases_of(items, window):
    """(vocabulary word -> number from 1, phrases as word-number tuples,
    items of each phrase) of (item id, text) rows."""
    table = word_bytes()
    vocabulary: dict[bytes, int] = {}
    phrases: dict[tuple, set] = {}
    for item, text in items:
        words = text.encode("utf-8", "surrogatepass").translate(table).split() if text else []
        if not words or item is None:
            continue
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words]
        size = min(window, len(ids))
        for i in range(len(ids) - size + 1):
            phrases.setdefault(tuple(ids[i:i + size]), set()).add(item)
    return vocabulary, list(phrases), [sorted(x) for x in phrases.values()]


# -- the index ------------------------------------------------------------

class Bits:
    """A bit vector with rank: packed words and the count before each."""

    def __init__(self, bits):
        import numpy as np

        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.zeros = len(bits) - int(counts.sum())

    def rank(self, i):
        """Ones before each position."""
        import numpy as np

        at = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at] + np.bitwise_count(self.words[at] & mask)

    def get(self, i):
        import numpy as np

        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


def suffix_order(ranks):
    """Suffix array of integer ranks by prefix doubling."""
    import numpy as np

    n, step = len(ranks), 1
    rank = np.asarray(ranks, np.int64)
    order = np.argsort(rank, kind="stable")
    while True:
        ordered = rank[order]
        fresh = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1
        rank = rank * (n + 1) + after
        order = np.argsort(rank, kind="stable")
        step *= 2


class ShardIndex:
    """FM-index of runs of word numbers (1..n_symbols)."""

    def __init__(self, runs, n_symbols, sample=SAMPLE):
        import numpy as np

        sizes = np.array([len(r) for r in runs], np.int64)
        total = int(sizes.sum() + len(runs))
        text = np.zeros(total, np.int64)
        self.run_starts = np.cumsum(sizes + 1) - (sizes + 1)
        ends = self.run_starts + sizes
        inside = np.ones(total, bool)
        inside[ends] = False
        text[inside] = np.concatenate(runs)
        # each run ends in a sentinel of its own, smaller than all words
        ranks = text + len(runs)
        ranks[ends] = np.arange(len(runs))
        order = suffix_order(ranks)
        bwt = text[order - 1]
        bwt[order == 0] = 0
        counts = np.bincount(text, minlength=n_symbols + 1)
        self.n, self.n_symbols = total, n_symbols
        self.first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.counts = counts
        self.levels = []
        for level in reversed(range(max(1, int(n_symbols).bit_length()))):
            bit = ((bwt >> level) & 1).astype(bool)
            self.levels.append((level, Bits(bit)))
            bwt = np.concatenate([bwt[~bit], bwt[bit]])
        self.base = self._descend(np.arange(n_symbols + 1), np.zeros(n_symbols + 1, np.int64))
        sampled = order % sample == 0
        at_start = np.zeros(total, bool)
        at_start[self.run_starts] = True
        sampled |= at_start[order]
        self.sampled, self.positions = Bits(sampled), order[sampled]

    def _descend(self, symbols, i):
        import numpy as np

        for level, bits in self.levels:
            one = ((symbols >> level) & 1).astype(bool)
            ranks = bits.rank(i)
            i = np.where(one, bits.zeros + ranks, i - ranks)
        return i

    def occurrences(self, symbols, i):
        """How often each symbol stands in the BWT before its position."""
        return self._descend(symbols, i) - self.base[symbols]

    def step_back(self, rows):
        """LF: the row of the suffix one position earlier."""
        import numpy as np

        i, symbols = rows, np.zeros(len(rows), np.int64)
        for level, bits in self.levels:
            one = bits.get(i)
            ranks = bits.rank(i)
            symbols |= one.astype(np.int64) << level
            i = np.where(one, bits.zeros + ranks, i - ranks)
        return self.first[symbols] + i - self.base[symbols]

    def search(self, phrases, lengths):
        """Row ranges [low, high) of phrases (a matrix padded with zeros on
        the right), by backward search of all of them together."""
        import numpy as np

        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.n, np.int64)
        for at in reversed(range(phrases.shape[1])):
            live = np.flatnonzero((lengths > at) & (low < high))
            if not len(live):
                continue
            symbols = phrases[live, at]
            low[live] = self.first[symbols] + self.occurrences(symbols, low[live])
            high[live] = self.first[symbols] + self.occurrences(symbols, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows):
        """Text position of each row's suffix."""
        import numpy as np

        out = np.empty(len(rows), np.int64)
        waiting, steps = np.arange(len(rows)), 0
        rows = rows.copy()
        while len(waiting):
            known = self.sampled.get(rows)
            out[waiting[known]] = self.positions[self.sampled.rank(rows[known])] + steps
            waiting, rows = waiting[~known], rows[~known]
            if len(rows):
                rows = self.step_back(rows)
            steps += 1
        return out


def shard_hits(numbers, phrases, lengths, n_symbols):
    """(position, phrase) of every occurrence of the phrases in a shard;
    numbers: word numbers, 0 for other words and between documents."""
    import numpy as np

    none = np.zeros(0, np.int64)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], numbers > 0, [0]])))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= lengths.min()
    starts, ends = starts[long], ends[long]
    if not len(starts):
        return none, none
    index = ShardIndex([numbers[a:b] for a, b in zip(starts, ends)], n_symbols)
    present = index.counts[phrases]
    possible = np.flatnonzero(((present > 0) | (phrases == 0)).all(axis=1))
    low, high = index.search(phrases[possible], lengths[possible])
    found = high - low
    which = np.repeat(possible, found)
    rows = np.arange(found.sum()) - np.repeat(np.cumsum(found) - found, found) + np.repeat(low, found)
    at = index.locate(rows)
    run = np.searchsorted(index.run_starts, at, side="right") - 1
    return starts[run] + at - index.run_starts[run], which


def search_texts(texts, blocks):
    """Per text: number of words, sorted numbers of the words hit, sorted
    items hit.  blocks: callables that give (vocabulary, phrases, items)."""
    from itertools import repeat

    import numpy as np

    table = word_bytes()
    words, sizes = [], []
    for text in texts:
        if text:
            mine = text.encode("utf-8", "surrogatepass").translate(table).split()
            words += mine
            sizes.append(len(mine))
        else:
            sizes.append(0)
        words.append(b"")  # no vocabulary word: texts stay apart
    sizes = np.array(sizes, np.int64)
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    covered = np.zeros(len(words) + 1, np.int64)
    items: dict[int, set] = {}
    for block in blocks:
        vocabulary, phrases, owners = block()
        if not phrases:
            continue
        numbers = np.fromiter(map(vocabulary.get, words, repeat(0)), np.int64, len(words))
        lengths = np.array([len(p) for p in phrases], np.int64)
        matrix = np.zeros((len(phrases), int(lengths.max())), np.int64)
        for at in range(matrix.shape[1]):
            has = lengths > at
            matrix[has, at] = [p[at] for p in phrases if len(p) > at]
        at, which = shard_hits(numbers, matrix, lengths, len(vocabulary))
        if not len(at):
            continue
        np.add.at(covered, at, 1)
        np.add.at(covered, at + lengths[which], -1)
        text_of = np.searchsorted(begins, at, side="right") - 1
        for text, phrase in set(zip(text_of.tolist(), which.tolist())):
            items.setdefault(text, set()).update(owners[phrase])
    hit = np.flatnonzero(np.cumsum(covered[:-1]) > 0)
    of_text = np.searchsorted(begins, hit, side="right") - 1
    found, first = np.unique(of_text, return_index=True)
    hits = {t: own - begins[t] for t, own in zip(found.tolist(), np.split(hit, first[1:]))}
    return sizes, hits, {t: sorted(x) for t, x in items.items()}


def removal_spans(text, hits):
    """Merged byte spans [start, end) of the hit words; words that follow
    each other make one span."""
    import re

    data = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in re.finditer(rb"[^ ]+", data.translate(word_bytes()))]
    spans: list[list[int]] = []
    previous = None
    for i in hits.tolist():
        if previous is not None and i == previous + 1:
            spans[-1][1] = at[i][1]
        else:
            spans.append([at[i][0], at[i][1]])
        previous = i
    return data, spans


def clean_text(text, hits):
    """The text without the spans of its hit words."""
    data, spans = removal_spans(text, hits)
    kept, last = [], 0
    for start, end in spans:
        kept.append(data[last:start])
        last = end
    kept.append(data[last:])
    return b"".join(kept).decode("utf-8", "surrogatepass")


# -- Spark plans ----------------------------------------------------------

def query_passes(benchmark: DataFrame, id_col: str, text_col: str, window: int,
                 block_bytes: int, broadcast_bytes: int) -> Iterator[tuple[list, bool]]:
    """(broadcast phrase tables, whether it is the last) of each pass; a table
    is of about ``block_bytes`` of text (one row may exceed it alone), a pass of
    ``broadcast_bytes``.  The driver holds one block's rows at a time."""
    spark = benchmark.sparkSession
    items = benchmark.select(col(id_col).cast("string").alias("item"), col(text_col).cast("string").alias("text"))
    items = items.where("item IS NOT NULL AND text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    each = max(1, broadcast_bytes // block_bytes)
    if n > 1:
        items = cut(items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n))))
    for first in range(0, n, each):
        blocks = []
        for k in range(first, min(n, first + each)):
            rows = (items.where(F.col("block") == k) if n > 1 else items).select("item", "text").collect()
            blocks.append(spark.sparkContext.broadcast(phrases_of(rows, window)))
        yield blocks, first + each >= n


def loaders(broadcasts):
    """One callable for each block; of several blocks, the last stays loaded only."""
    def loader(b):
        def load():
            for other in broadcasts:
                if other is not b:
                    other.__dict__.pop("_value", None)
            return b.value
        return load
    return [loader(b) for b in broadcasts]


def search_part(part, text_at: int, blocks, carried_at: int | None):
    """``search_texts`` of an Arrow batch, with what earlier passes found."""
    import numpy as np

    texts = part.column(text_at).to_pylist()
    sizes, hits, items = search_texts(texts, loaders(blocks))
    if carried_at is not None:
        for i, old in enumerate(part.column(carried_at).to_pylist()):
            if old["words"]:
                hits[i] = np.union1d(hits.get(i, np.zeros(0, np.int64)), np.array(old["words"], np.int64))
                items[i] = sorted({*items.get(i, ()), *old["items"]})
    return texts, sizes, hits, items


def search_but_last(docs: DataFrame, text_at: int, passes: Iterator, shard_bytes: int):
    """(docs, with a last column of what all passes but the last found if there
    are several; that column's place or None; blocks of the last pass)."""
    name, width = fresh(docs, "_found"), len(docs.columns)
    kind = StructType().add("words", ArrayType(LongType())).add("items", ArrayType(StringType()))
    frame, carried_at = docs, None
    for blocks, last in passes:
        if last:
            break

        def run(batches: Iterator, blocks=blocks, carried_at=carried_at) -> Iterator:
            import pyarrow as pa

            found_type = pa.struct([("words", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])
            for batch in batches:
                for start, stop in slices(batch, text_at, shard_bytes):
                    part = batch.slice(start, stop - start)
                    _, _, hits, items = search_part(part, text_at, blocks, carried_at)
                    found = [{"words": hits[i].tolist() if i in hits else [], "items": items.get(i, [])}
                             for i in range(part.num_rows)]
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns[:width], pa.array(found, found_type)],
                        names=[*part.schema.names[:width], name])

        frame = cut(frame.mapInArrow(run, StructType([*docs.schema.fields]).add(name, kind)))
        carried_at = width
        for block in blocks:
            block.destroy()
    return frame, carried_at, blocks


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW_WORDS,
                  shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document: the id, ``n_words``, ``n_hit``, ``items`` (ids
    of the items with occurring phrases, sorted as strings) and ``spans``
    (merged removal spans in code points, end exclusive)."""
    src = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    passes = query_passes(benchmark, item_col, item_text_col, window, block_bytes, broadcast_bytes)
    frame, carried_at, blocks = search_but_last(src, 1, passes, shard_bytes)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for start, stop in slices(batch, 1, shard_bytes):
                part = batch.slice(start, stop - start)
                texts, sizes, hits, items = search_part(part, 1, blocks, carried_at)
                spans = []
                for i, text in enumerate(texts):
                    found = []
                    if i in hits:
                        data, at = removal_spans(text, hits[i])
                        place = lambda b, d=data: len(d[:b].decode("utf-8", "surrogatepass"))
                        found = [{"start": place(a), "end": place(b)} for a, b in at]
                    spans.append(found)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(sizes),
                    pa.array([len(hits.get(i, ())) for i in range(len(texts))], pa.int64()),
                    pa.array([items.get(i, []) for i in range(len(texts))], pa.list_(pa.string())),
                    pa.array(spans, span_type)], names=["id", "n_words", "n_hit", "items", "spans"])

    kind = src.schema["id"].dataType.simpleString()
    found = frame.mapInArrow(run, f"id {kind}, n_words bigint, n_hit bigint, items array<string>, "
                                "spans array<struct<start:bigint,end:bigint>>")
    return found.withColumnRenamed("id", id_col)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text",
                  window: int = WINDOW_WORDS, shard_bytes: int = SHARD_BYTES,
                  block_bytes: int = BLOCK_BYTES, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The documents, all columns, with the removal spans cut out of the text."""
    at, width = docs.columns.index(text_col), len(docs.columns)
    passes = query_passes(benchmark, item_col, item_text_col, window, block_bytes, broadcast_bytes)
    frame, carried_at, blocks = search_but_last(docs, at, passes, shard_bytes)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for start, stop in slices(batch, at, shard_bytes):
                part = batch.slice(start, stop - start)
                texts, _, hits, _ = search_part(part, at, blocks, carried_at)
                part = part.select(list(range(width)))
                if hits:
                    for i, found in hits.items():
                        texts[i] = clean_text(texts[i], found)
                    columns = list(part.columns)
                    columns[at] = pa.array(texts, columns[at].type)
                    part = pa.RecordBatch.from_arrays(columns, schema=part.schema)
                yield part

    return frame.mapInArrow(run, docs.schema)
