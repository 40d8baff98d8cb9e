"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The model file (a public tokenizer's, its path a parameter) is read here:
pieces, scores, kinds and the normalizer's switches.  Texts are normalized
(dummy prefix, blanks to the blank mark) and cut in chunks that no piece can
cross; the distinct chunks of a slice of texts are encoded together in flat
numpy symbol arrays.  Each round finds every chunk's minimum pair rank and
its leftmost places by segmented minima, merges that pair in all chunks
simultaneously, renews the neighbouring pairs, and compacts the arrays:
merged symbols and chunks without a pair leave.  Rounds go on until no pair
remains.  Symbols outside the vocabulary become byte pieces.

Ids of chunks are kept for the rest of the task (a bounded memo), since words
repeat.  Only models of the kinds used by the public BPE files are read:
identity normalization, byte fallback, no user-defined symbols; others raise.

Defined results: null and empty texts have no ids and decode to the empty
text; texts of any length are encoded whole; repeated rows give a row each;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame

from .common import col, release, slices

SLICE_BYTES = 2 << 20
MEMO_CHUNKS = 300_000
BLANK = "▁"
# Fixed values of the model file: kinds of pieces.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: What an unknown id decodes to, where the file does not say.
UNKNOWN_TEXT = " ⁇ "


# -- the model file -------------------------------------------------------

def fields(data):
    """(field number, value) of a protocol-buffers message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        elif kind == 2:
            size = varint()
            value = data[at:at + size]
            at += size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value = data[at:at + size]
            at += size
        else:
            raise ValueError(f"unknown wire type {kind}")
        yield key >> 3, value


def read_model(data: bytes) -> dict:
    """Pieces, scores, kinds and switches of a model file's bytes."""
    import struct

    pieces, scores, kinds = [], [], []
    trainer, normalizer = {}, {}
    for number, value in fields(data):
        if number == 1:
            got = dict(fields(value))
            pieces.append(got.get(1, b"").decode("utf-8"))
            scores.append(struct.unpack("<f", got[2])[0] if 2 in got else 0.0)
            kinds.append(got.get(3, NORMAL))
        elif number == 2:
            trainer = dict(fields(value))
        elif number == 3:
            normalizer = dict(fields(value))
    if trainer.get(3, 1) != 2 or not trainer.get(35, 0):
        raise ValueError("only BPE models with byte fallback are read")
    if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1) or trainer.get(24, 0):
        raise ValueError("only identity normalization with escaped blanks before words is read")
    if USER in kinds:
        raise ValueError("models with user-defined symbols are not read")
    unknown = trainer.get(44)
    return {"pieces": pieces, "scores": scores, "kinds": kinds,
            "prefix": bool(normalizer.get(3, 1)),
            "unknown_text": unknown.decode("utf-8") if unknown else UNKNOWN_TEXT}


class Codec:
    """Encoder and decoder over a read model."""

    def __init__(self, model: dict):
        import numpy as np

        self.pieces, self.kinds = model["pieces"], model["kinds"]
        self.prefix, self.unknown_text = model["prefix"], model["unknown_text"]
        self.unknown = self.kinds.index(UNKNOWN)
        self.bytes = [0] * 256
        for i, kind in enumerate(self.kinds):
            if kind == BYTE:
                self.bytes[int(self.pieces[i][1:-1], 16)] = i
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k in (NORMAL, UNUSED)}
        if any(BLANK in p.lstrip(BLANK) for p in self.ids):
            raise ValueError("a piece holds a blank after other characters")
        # a pair may merge if its concatenation is a piece; all splits count
        left, right, made = [], [], []
        self.symbols = {p: i for p, i in self.ids.items()}
        for piece, i in self.ids.items():
            for at in range(1, len(piece)):
                for part in (piece[:at], piece[at:]):
                    if len(part) == 1:
                        self.symbols.setdefault(part, len(self.pieces) + len(self.symbols))
                a, b = self.symbols.get(piece[:at]), self.symbols.get(piece[at:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    made.append(i)
        self.n = max(self.symbols.values()) + 1
        order = np.unique(-np.asarray(model["scores"], np.float64))
        rank = np.searchsorted(order, -np.asarray(model["scores"], np.float64))
        keys = (np.asarray(left, np.int64) << 32) | np.asarray(right, np.int64)
        by = np.argsort(keys)
        self.keys, self.made = keys[by], np.asarray(made, np.int64)[by]
        self.ranks = rank[self.made].astype(np.int64)
        self.none = int(len(order)) + 1
        pieces_of_rank = np.bincount(rank[list(self.ids.values())], minlength=self.none + 1)
        self.sole = pieces_of_rank == 1
        # most pairs are no piece: a hashed bit table answers those
        self.slots = 1 << 20
        hashed = self._hash(self.keys)
        self.filter = np.zeros(self.slots, bool)
        self.filter[hashed] = True
        self.strange = np.array([k not in (NORMAL, UNUSED) for k in self.kinds])
        self.digits = [str(i) for i in range(len(self.pieces))]
        self.memo: dict[str, str] = {}  # ids of a chunk, joined by commas
        self.other_text: dict[str, str] = {}  # decoded chunks that are not their own text

    def _hash(self, keys):
        import numpy as np

        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(44)).astype(np.int64)

    def pair_ranks(self, left, right):
        """(rank, merged symbol) of each pair; rank ``none`` if no piece."""
        import numpy as np

        keys = (left << 32) | right
        rank = np.full(len(keys), self.none, np.int64)
        made = np.zeros(len(keys), np.int64)
        maybe = np.flatnonzero(self.filter[self._hash(keys)])
        at = np.searchsorted(self.keys, keys[maybe])
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == keys[maybe]
        rank[maybe[hit]] = self.ranks[at[hit]]
        made[maybe[hit]] = self.made[at[hit]]
        return rank, made

    def _all_safe(self, at, least_rank, counts, symbols, word, rank, made):
        """The places to merge in this round: each word's leftmost place, and
        its further non-overlapping places of the same pair where merging
        them one after the other could not let another pair go first (no
        pair that the merged symbol makes ranks lower, no other piece has
        the rank)."""
        import numpy as np

        same = (rank == np.repeat(least_rank, counts)) & (made == np.repeat(made[at], counts))
        places = np.flatnonzero(same)
        if len(places) == len(at):
            return at
        joined = (np.diff(places, prepend=-2) == 1) & (np.diff(word[places], prepend=-1) == 0)
        run_start = np.flatnonzero(~joined)
        offset = np.arange(len(places)) - np.repeat(run_start, np.diff(np.append(run_start, len(places))))
        places = places[offset % 2 == 0]
        owner = np.cumsum(np.diff(word[places], prepend=-1) != 0) - 1
        several = np.bincount(owner, minlength=len(at))[owner] > 1
        check = places[several]
        merged = made[check]
        least = rank[check]
        unsafe = ~self.sole[least]
        before, after = np.maximum(check - 1, 0), np.minimum(check + 2, len(symbols) - 1)
        for left, right in ((symbols[before], merged), (merged, symbols[after]), (merged, merged)):
            unsafe |= self.pair_ranks(left, right)[0] < least
        bad = np.zeros(len(at), bool)
        bad[owner[several][unsafe]] = True
        first = np.diff(owner, prepend=-1) != 0
        return places[first | ~bad[owner]]

    def merge_rounds(self, symbols, sizes):
        """(symbols, word of each) of all words after every merge; symbols:
        flat array, sizes: symbols of each word."""
        import numpy as np

        word = np.repeat(np.arange(len(sizes)), sizes)
        done_at, done_symbols, done_words = [], [], []
        place = np.arange(len(symbols))  # keeps the order over rounds
        rank = np.full(len(symbols), self.none, np.int64)
        made = np.zeros(len(symbols), np.int64)
        pair = np.flatnonzero(word[:-1] == word[1:])
        rank[pair], made[pair] = self.pair_ranks(symbols[pair], symbols[pair + 1])
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            counts = np.diff(np.concatenate([starts, [len(symbols)]]))
            # the leftmost place of each word's minimum rank
            coded = rank * len(symbols) + np.arange(len(symbols))
            least = np.minimum.reduceat(coded, starts)
            at, least_rank = least % len(symbols), least // len(symbols)
            open_ = least_rank < self.none
            if not open_.all():
                closed = np.repeat(~open_, counts)
                done_at.append(place[closed])
                done_symbols.append(symbols[closed])
                done_words.append(word[closed])
                if not open_.any():
                    break
                stay = ~closed
                shift = np.cumsum(stay) - 1
                at, least_rank, counts = shift[at[open_]], least_rank[open_], counts[open_]
                symbols, word, rank, made, place = (x[stay] for x in (symbols, word, rank, made, place))
            at = self._all_safe(at, least_rank, counts, symbols, word, rank, made)
            symbols[at] = made[at]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            shift = np.cumsum(stay) - 1
            at = shift[at]
            symbols, word, rank, made, place = (x[stay] for x in (symbols, word, rank, made, place))
            # renew the pairs that begin with and end in the merged symbols
            first = np.concatenate([at, at[at > 0] - 1])
            last = len(symbols) - 1
            follows = np.minimum(first + 1, last)
            valid = (first < last) & (word[first] == word[follows])
            rank[first[~valid]] = self.none
            fresh = first[valid]
            rank[fresh], made[fresh] = self.pair_ranks(symbols[fresh], symbols[fresh + 1])
        none = np.zeros(0, np.int64)
        order = np.argsort(np.concatenate([none, *done_at]), kind="stable")
        return np.concatenate([none, *done_symbols])[order], np.concatenate([none, *done_words])[order]

    def encode_flat(self, chunks: list[str]):
        """Ids of all chunks in one array, and the ids of each chunk."""
        import numpy as np

        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4")
        distinct, inverse = np.unique(codes, return_inverse=True)
        # a character that is in no piece gets a number of its own for now
        table = np.array([self.symbols.get(chr(c), self.n + k) for k, c in enumerate(distinct.tolist())], np.int64)
        symbols, words = self.merge_rounds(table[inverse], sizes)
        n = len(self.pieces)
        outside = np.flatnonzero(symbols >= n)
        if len(outside):
            character = {k: c for c, k in self.symbols.items() if k >= n}
            character |= {self.n + k: chr(c) for k, c in enumerate(distinct.tolist())}
            which, at = np.unique(symbols[outside], return_inverse=True)
            ids = [[self.bytes[b] for b in character[k].encode("utf-8", "surrogatepass")] for k in which.tolist()]
            sizes_of = np.array([len(x) for x in ids])
            times = np.ones(len(symbols), np.int64)
            times[outside] = sizes_of[at]
            symbols, words = np.repeat(symbols, times), np.repeat(words, times)
            new = np.flatnonzero(symbols >= n)
            step = np.arange(len(new)) - np.repeat(np.cumsum(sizes_of[at]) - sizes_of[at], sizes_of[at])
            flat = np.array([i for x in ids for i in x], np.int64)
            begin = np.cumsum(sizes_of) - sizes_of
            symbols[new] = flat[np.repeat(begin[at], sizes_of[at]) + step]
        return symbols, np.bincount(words, minlength=len(chunks))

    def encode_chunks(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each chunk."""
        symbols, counts = self.encode_flat(chunks)
        flat, out, start = symbols.tolist(), [], 0
        for size in counts.tolist():
            out.append(flat[start:start + size])
            start += size
        return out

    def chunks_of(self, text: str) -> list[str]:
        """The normalized text in chunks that no piece crosses: blank marks
        and the characters up to the next ones."""
        import re

        if not text:
            return []
        whole = (BLANK if self.prefix else "") + text.replace(" ", BLANK)
        return re.findall(f"{BLANK}*[^{BLANK}]+|{BLANK}+", whole)

    def decode(self, ids) -> str:
        """The text of ids; byte pieces join to characters, stray bytes
        become replacement characters, control pieces vanish."""
        out, pending, start = [], bytearray(), True

        def flush():
            nonlocal start
            if pending:
                out.append(replaced(bytes(pending)))
                pending.clear()
                start = False

        for i in ids:
            kind, piece = self.kinds[i], self.pieces[i]
            if kind == BYTE:
                pending.append(int(piece[1:-1], 16))
                continue
            flush()
            if kind == CONTROL:
                continue
            if kind == UNKNOWN:
                out.append(self.unknown_text)
                start = False
                continue
            if start and self.prefix and piece.startswith(BLANK):
                piece = piece[1:]
            start = False
            out.append(piece.replace(BLANK, " "))
        flush()
        return "".join(out)

    def learn_chunks(self, chunks) -> None:
        """Encode the chunks that the memo lacks."""
        new = list(set(chunks).difference(self.memo))
        if not new:
            return
        if len(self.memo) + len(new) > MEMO_CHUNKS:
            self.memo.clear()
            self.other_text.clear()
            new = list(set(chunks))
        import numpy as np

        symbols, counts = self.encode_flat(new)
        ends = np.cumsum(counts)
        strange = np.concatenate([[0], np.cumsum(self.strange[symbols])])
        plain = strange[ends] == strange[ends - counts]
        flat, start = symbols.tolist(), 0
        digits, pieces, memo = self.digits, self.pieces, self.memo
        for chunk, end, fast in zip(new, ends.tolist(), plain.tolist()):
            ids = flat[start:end]
            memo[chunk] = ",".join([digits[i] for i in ids])
            # what the ids decode to, kept where it is not the chunk itself
            text = "".join([pieces[i] for i in ids]) if fast else self.decode_middle(ids)
            if text != chunk:
                self.other_text[chunk] = text
            start = end

    def coded(self, chunks) -> tuple[str, str]:
        """The ids of a text's chunks, joined by commas, and the text that
        they decode to."""
        ids = ",".join([self.memo[c] for c in chunks])
        text = "".join([self.other_text.get(c, c) for c in chunks]).replace(BLANK, " ")
        # the dummy prefix is no part of the text
        return ids, text[1:] if self.prefix and text[:1] == " " else text

    def decode_middle(self, ids) -> str:
        """The text of a chunk's ids that are not the first of a text."""
        text = self.decode([self.unknown, *ids])
        return text[len(self.unknown_text):]


def replaced(data: bytes) -> str:
    """UTF-8 with one replacement character for each stray byte."""
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at:at + size].decode("utf-8"))
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


# -- Spark plans ----------------------------------------------------------

def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           digest: bool = False, extra: list[str] | None = None) -> DataFrame:
    """One row per document: the id, ``extra`` columns, then ``n_tokens`` and
    ``ids`` (array) and ``decoded``; with ``digest`` instead of the last two,
    ``ids_sha256`` and ``decoded_sha256``.  The model file is read on the
    driver and sent to the tasks (a vocabulary, not data that grows)."""
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(read_model(f.read()))
    extra = list(extra or [])
    src = docs.select(col(text_col).cast("string").alias("0"), col(id_col).alias("1"),
                      *[col(c).alias(str(i)) for i, c in enumerate(extra, 2)])

    def run(batches: Iterator) -> Iterator:
        from hashlib import sha256

        import pyarrow as pa

        codec = Codec(model.value)
        for batch in batches:
            for start, stop in slices(batch, 0, SLICE_BYTES):
                part = batch.slice(start, stop - start)
                texts = [codec.chunks_of(t) for t in part.column(0).to_pylist()]
                codec.learn_chunks([c for chunks in texts for c in chunks])
                both = [codec.coded(chunks) for chunks in texts]
                ids, decoded = [x for x, _ in both], [x for _, x in both]
                n = [x.count(",") + 1 if x else 0 for x in ids]
                if digest:
                    a = pa.array([sha256(x.encode()).hexdigest() for x in ids])
                    b = pa.array([sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in decoded])
                else:
                    a = pa.array([[int(i) for i in x.split(",")] if x else [] for x in ids], pa.list_(pa.int32()))
                    b = pa.array(decoded, pa.string())
                arrays = [*part.columns[1:], pa.array(n, pa.int64()), a, b]
                yield pa.RecordBatch.from_arrays(arrays, names=[str(i) for i in range(len(arrays))])
            release()

    kinds = [f.dataType.simpleString() for f in src.schema.fields[1:]]
    kinds += ["bigint", "string", "string"] if digest else ["bigint", "array<int>", "string"]
    out = src.mapInArrow(run, ", ".join(f"`{i}` {k}" for i, k in enumerate(kinds)))
    names = [id_col, *extra, "n_tokens", *(("ids_sha256", "decoded_sha256") if digest else ("ids", "decoded"))]
    return out.toDF(*names)
