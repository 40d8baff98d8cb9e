"""Packing documents into fixed windows by Karmarkar-Karp multiway differencing.

A document's ids (and one end id) are cut at the window size: full windows
stand alone, and what remains is cut into pieces of at most ``max_piece``
tokens.  Pieces gather into bins of ``bin_pieces``.  A bin is split into k
windows of near-equal sums: each piece starts as a partial partition of its
own; the two partial partitions of the largest spread are merged again and
again, the largest sums of one with the smallest of the other, until one
partition is left.  k starts at the least number of windows that could hold the
bin and rises whenever a window exceeds the capacity.

A bin belongs to one task, so nothing is shuffled, and a task holds one bin and
one slice of texts.  A window's number is made of the partition's number and a
counter, so a retried task gives the same numbers.

Ids come from the ``tokenizers`` library.  A byte-level pre-tokenizer never
joins characters across a single blank or line break between two words, nor a
word's last letter and the marks after it, so texts are cut there and each
distinct part is encoded once (``Encoder``).  Texts with several white spaces
in a row go to the library whole, as do all texts if the tokenizer is of another
kind.  A test compares the ids with the library's for whole texts.

Defined results: a null or empty text has the end id only; repeated rows and
repeated or null ids give their pieces each; an empty table gives an empty
result; a document of any length is cut, so none fails to fit; other columns
are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame

from .common import col, release, slices

WINDOW = 1024
MAX_PIECE = 512
BIN_PIECES = 1024
END_ID = 0
SLICE_BYTES = 16 << 20
MEMO_PARTS = 400_000

#: Cuts are marked by this character; texts that hold it go to the library whole.
CUT = "\0"
#: White space, texts for the library, letters, and marks after a word, in the syntax
#: of Arrow's regular expressions; an apostrophe may begin a contraction and is no such mark.
WHITE = r"[\s\v\x{85}\pZ]"
ODD = rf"{WHITE}{{2}}|{CUT}|^[^\S\n]|[^\S\n]$|^[\v\x{{85}}\pZ]|[\v\x{{85}}\pZ]$"
LETTERS, MARKS = r"A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}", r"!-&(-/:-@\[-`{-~"


# -- differencing ---------------------------------------------------------

def differencing(sizes, k: int):
    """Split the sizes into k windows by multiway differencing; the window of
    each size and the windows' sums."""
    import heapq

    import numpy as np

    sizes = np.asarray(sizes, np.int64)
    n, descending = len(sizes), np.argsort(-np.asarray(sizes, np.int64), kind="stable")
    # a partial partition: its non-empty windows' sums, descending, and their nodes.  While it has an
    # empty window, that of the largest size has the largest spread and takes the next size into
    # that window, so the k largest sizes are merged at once.
    head = descending[:k]
    parts = {i: (sizes[i:i + 1], np.array([i])) for i in descending[k:].tolist()}
    heap = [(-int(s), i) for i, (s,) in ((i, x[0]) for i, x in parts.items())]
    parts[n] = sizes[head], head
    heap.append((int(sizes[head[-1]]) * (len(head) == k) - int(sizes[head[0]]), n))
    heapq.heapify(heap)
    joined, fresh = [], n
    for key in range(n + 1, n + len(heap)):
        (a, a_node), (b, b_node) = (parts.pop(heapq.heappop(heap)[1]) for _ in range(2))
        # the largest windows of one meet the smallest, mostly empty, of the other
        both = max(0, len(a) + len(b) - k)
        if both:
            x, y = a_node[len(a) - both:], b_node[len(b) - both:][::-1]
            new = np.arange(fresh, fresh + both)
            fresh += both
            joined.append((new, x, y))
            sums = np.concatenate([a[:len(a) - both], b[:len(b) - both],
                                   a[len(a) - both:] + b[len(b) - both:][::-1]])
            nodes = np.concatenate([a_node[:len(a) - both], b_node[:len(b) - both], new])
        else:
            sums, nodes = np.concatenate([a, b]), np.concatenate([a_node, b_node])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        parts[key] = sums, nodes
        spread = sums[0] - (sums[-1] if len(sums) == k else 0)
        heapq.heappush(heap, (-int(spread), key))
    (sums, nodes), = parts.values()
    window = np.empty(fresh, np.int64)
    window[nodes] = np.arange(len(nodes))
    for new, x, y in reversed(joined):
        window[x] = window[y] = window[new]
    return window[:n], sums


def pack(sizes, capacity: int = WINDOW):
    """The window of each size, none above the capacity."""
    import numpy as np

    total = int(np.sum(sizes))
    k = -(-total // capacity)
    while True:
        window, sums = differencing(sizes, k)
        if sums[0] <= capacity:
            return window
        # enough windows to lower their mean by half of what the largest has too much
        k = max(k + 1, -(-2 * total // (3 * capacity - int(sums[0]))) if sums[0] < 2 * capacity else 0)


# -- ids ------------------------------------------------------------------

def cuts_at_blanks(model: bytes) -> bool:
    """Whether the tokenizer is byte-level with the usual pattern, for which
    the cuts of this module are safe."""
    import json

    about = json.loads(model)
    kind = about.get("pre_tokenizer") or {}
    return (about.get("normalizer") is None and kind.get("type") == "ByteLevel"
            and kind.get("use_regex", True) and not kind.get("add_prefix_space"))


class Encoder:
    """Ids of texts; parts seen before are kept (a bounded memo)."""

    def __init__(self, model: bytes, end_id: int = END_ID):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        import numpy as np
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_buffer(model)
        self.library.encode_special_tokens = True  # their strings in a text are text
        line, = self.whole(["\n"])
        self.cuts, self.line = cuts_at_blanks(model) and len(line) == 1, line
        self.end = np.array([end_id], np.uint32).tobytes()
        self.forget()

    def whole(self, texts) -> list:
        import numpy as np

        return [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def forget(self) -> None:
        self.memo = {"": b"", "\n": self.line.tobytes()}

    def learn(self, parts) -> None:
        """Put the ids of parts without a line break into the memo, some
        thousands at a time, a part a line: line breaks have their own id."""
        import numpy as np

        for start in range(0, len(parts), 2048):
            block = parts[start:start + 2048]
            ids, = self.whole(["\n".join(block) + "\n"])
            ends = np.flatnonzero(ids == self.line[0])
            if len(ends) != len(block):
                raise ValueError("the tokenizer joins lines")
            data, ends = ids.tobytes(), (4 * ends).tolist()
            self.memo.update(zip(block, [data[a:b] for a, b in zip([0, *[e + 4 for e in ends]], ends)]))

    def parts(self, texts):
        """The texts cut into parts (an Arrow array of lists)."""
        import pyarrow.compute as pc

        marked = pc.replace_substring(pc.replace_substring(texts, " ", CUT + " "), "\n", f"{CUT}\n{CUT}")
        marked = pc.replace_substring_regex(
            marked, rf"([{LETTERS}])([{MARKS}]+)({CUT}|$)", rf"\1{CUT}\2\3")
        return pc.split_pattern(marked, CUT)

    def encode(self, texts):
        """Of an Arrow array of strings: the ids of all texts in a row, each
        with the end id after it, and where each text's ids end."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts, "")
        odd = np.asarray(pc.match_substring_regex(texts, ODD)) | (not self.cuts)
        cut = self.parts(pc.if_else(pa.array(odd), "", texts))
        sizes = np.asarray(pc.list_value_length(cut), np.int64)
        coded = cut.flatten().dictionary_encode()
        codes, distinct = np.asarray(coded.indices, np.int64), coded.dictionary.to_pylist()
        if len(self.memo) > MEMO_PARTS:
            self.forget()
        self.learn([p for p in distinct if p not in self.memo])
        # a table of ids: distinct parts, odd texts, the end id
        data = [*map(self.memo.__getitem__, distinct),
                *[ids.tobytes() for ids in self.whole(texts.filter(pa.array(odd)).to_pylist())], self.end]
        ends = np.cumsum(sizes)
        codes[(ends - sizes)[odd]] = len(distinct) + np.arange(int(odd.sum()))
        codes = np.insert(codes, ends, len(data) - 1)
        lengths = np.array([len(d) // 4 for d in data], np.int64)
        n = lengths[codes]
        stops = np.cumsum(n)
        at = np.repeat((np.cumsum(lengths) - lengths)[codes] - (stops - n), n) + np.arange(stops[-1])
        return np.frombuffer(b"".join(data), "<u4")[at], stops[np.cumsum(sizes + 1) - 1]


# -- Spark plan -----------------------------------------------------------

def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, max_piece: int = MAX_PIECE, bin_pieces: int = BIN_PIECES,
                   end_id: int = END_ID) -> DataFrame:
    """One row per piece: the id, ``start`` (the document's ids before it),
    ``length``, ``ids`` (little-endian unsigned 32-bit numbers), ``doc_tokens``
    (with the end id), ``sequence_id`` and ``offset`` in that sequence.  A
    sequence's pieces leave no gaps.  The tokenizer's file is read on the
    driver and sent to the tasks (a vocabulary, not data that grows)."""
    with open(tokenizer_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    src = docs.select(col(text_col).cast("string").alias("text"), col(id_col).alias("id"))
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encoder = Encoder(model.value, end_id)
        sequence = TaskContext.get().partitionId() << 33
        id_type = None
        waiting: list[tuple] = []  # pieces (id, start, ids, doc_tokens) of the bin

        def rows(pieces, sequences, offsets):
            ids, starts, data, totals = zip(*pieces)
            return pa.RecordBatch.from_arrays([
                pa.array(ids, id_type), pa.array(starts, pa.int64()),
                pa.array([len(d) // 4 for d in data], pa.int64()), pa.array(data, pa.binary()),
                pa.array(totals, pa.int64()), pa.array(sequences, pa.int64()),
                pa.array(offsets, pa.int64())], names=names)

        def packed(pieces):
            nonlocal sequence
            sizes = np.array([len(d) // 4 for _, _, d, _ in pieces])
            which = pack(sizes, window)
            order = np.argsort(which, kind="stable")
            before = np.cumsum(sizes[order]) - sizes[order]
            first = np.concatenate([[True], np.diff(which[order]) != 0])
            offsets = before - np.maximum.accumulate(np.where(first, before, 0))
            out = rows([pieces[i] for i in order], sequence + which[order], offsets)
            sequence += int(which.max()) + 1
            return out

        for batch in batches:
            id_type = batch.column(1).type
            for low, high in slices(batch, 0, SLICE_BYTES):
                part = batch.slice(low, high - low)
                ids, ends = encoder.encode(part.column(0))
                full: list[tuple] = []
                for id_, first, stop in zip(part.column(1).to_pylist(), [0, *ends.tolist()], ends.tolist()):
                    data = ids[first:stop].tobytes()
                    total, at = stop - first, 0
                    while total - at >= window:
                        full.append((id_, at, data[4 * at:4 * (at + window)], total))
                        at += window
                    while at < total:
                        size = min(max_piece, total - at)
                        waiting.append((id_, at, data[4 * at:4 * (at + size)], total))
                        at += size
                if full:
                    yield rows(full, range(sequence, sequence + len(full)), [0] * len(full))
                    sequence += len(full)
                while len(waiting) >= bin_pieces:
                    yield packed(waiting[:bin_pieces])
                    del waiting[:bin_pieces]
            release()
        if waiting:
            yield packed(waiting)

    kind = src.schema["id"].dataType.simpleString()
    out = src.mapInArrow(run, f"id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, "
                              "sequence_id bigint, offset bigint")
    return out.withColumnRenamed("id", id_col)
