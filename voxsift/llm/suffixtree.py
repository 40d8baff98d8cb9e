"""Language-model scoring with a probabilistic suffix tree.

Symbols are the bytes of a text's lower-case words, single blanks between
them and one end mark.  The tree's states are contexts of up to ``DEPTH``
symbols.  A context is retained if its next-symbol distribution diverges from
that of its longest retained suffix by more than ``min_divergence`` nats over
its occurrences; a retained state's distribution is smoothed towards its
suffix's with ``mass`` pseudo-counts.  Each symbol is scored by the longest
retained suffix of what stands before it.  A unigram base score of the words
comes with it.

Everything is counted over all training documents and nothing is broadcast:

* documents are packed into blocks (by a hash of the row), compressed, and
  shuffled by block;
* a block lists its distinct words (as 64-bit hashes) and grams (a context
  and its next symbol), with their training counts, as sorted arrays dealt
  into key buckets: equal keys of a block travel once;
* a bucket adds up the counts of all blocks.  For words it answers each block
  directly.  Grams become rows, from which joins and windows over the levels
  of the tree (a context has at most 256 next symbols, so no group is large)
  compute each gram's probability; the buckets then answer the blocks;
* a block scores its documents by the answers, which come with its keys.

Defined results: null and blank texts are the end mark alone; rows without an
id may be scored and train as the caller says; repeated rows count and are
scored each; without training rows every word is unknown and the tree is its
smoothed root; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, cut, shuffle_partitions, slices

DEPTH = 5
MASS = 4.0
MIN_DIVERGENCE = 4.0
BLOCK_BYTES = 16 << 20
SLICE_BYTES = 2 << 20
END = 10  # the end mark's byte; no word holds it
WORD, GRAM = 0, 1


# -- inside tasks ---------------------------------------------------------

def packed(array) -> bytes:
    import pyarrow as pa

    return pa.compress(array.astype("<u8").tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int, kind: str = "<u8"):
    import numpy as np
    import pyarrow as pa

    return np.frombuffer(pa.decompress(data, n * 8, codec="zstd", asbytes=True), kind) if n else np.zeros(0, kind)


def packed_rows(table) -> bytes:
    import pyarrow as pa

    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table) if isinstance(table, pa.Table) else out.write_batch(table)
    return sink.getvalue().to_pybytes()


def unpacked_rows(data: bytes):
    import pyarrow as pa

    return pa.ipc.open_stream(data).read_all()


def words_of(text) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_keys(words):
    """64-bit hashes of words."""
    import numpy as np
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in words), np.uint64, len(words))


def grams_of(texts_words):
    """(gram codes of all symbols of the texts, symbols of each text)."""
    import numpy as np

    pad = bytes([END]) * DEPTH
    parts, sizes = [], []
    for words in texts_words:
        body = b" ".join(words)
        parts += (pad, body, b"\n")
        sizes.append(len(body) + 1)
    data = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array(sizes, np.int64)
    if not len(sizes):
        return np.zeros(0, np.uint64), sizes
    n = len(data) - DEPTH
    codes = np.zeros(n, np.uint64)
    for k in range(DEPTH + 1):
        codes <<= np.uint64(8)
        codes |= data[k:k + n]
    # windows that end in a text's own symbols
    whole = sizes + DEPTH
    inside = np.ones(n, bool)
    for k in range(DEPTH):  # windows that start in the last places of a text
        ends = np.cumsum(whole)[:-1] - DEPTH + k
        inside[ends] = False
    return codes[inside], sizes


def merged(keys, counts):
    """Distinct sorted keys and their added counts."""
    import numpy as np

    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[len(keys) > 0], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


class Counts:
    """Distinct keys with training counts, merged slice by slice."""

    def __init__(self):
        import numpy as np

        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def add(self, keys, trained: bool):
        import numpy as np

        keys = np.sort(keys)
        starts = np.flatnonzero(np.concatenate([[len(keys) > 0], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(starts, len(keys))).astype(np.uint64)
        if not trained:
            sizes[:] = 0
        self.keys, self.counts = merged(
            np.concatenate([self.keys, keys[starts]]), np.concatenate([self.counts, sizes]))


class Lookup:
    """Places of keys in an array of distinct keys, by hashed slots."""

    def __init__(self, keys):
        import numpy as np

        self.shift = np.uint64(64 - max(1, int(2 * len(keys)).bit_length()))
        slot = self._slot(keys)
        self.order = np.argsort(slot, kind="stable")
        self.keys = keys[self.order]
        ordered = slot[self.order]
        self.first = np.searchsorted(ordered, np.arange((1 << int(64 - int(self.shift))) + 1))

    def _slot(self, keys):
        import numpy as np

        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def places(self, queries):
        """Place of each query (all are among the keys)."""
        import numpy as np

        at = self.first[self._slot(queries)]
        wrong = np.flatnonzero(self.keys[at] != queries)
        while len(wrong):
            at[wrong] += 1
            wrong = wrong[self.keys[at[wrong]] != queries[wrong]]
        return self.order[at]


def block_keys(block_rows):
    """Word and gram counts of a block: iterates its packed rows."""
    import numpy as np
    from collections import Counter

    word_counts: Counter = Counter()
    grams = Counts()
    for data in block_rows:
        rows = unpacked_rows(data)
        texts = list(map(words_of, rows.column("text").to_pylist()))
        held = rows.column("held").to_pylist()
        for trained in (True, False):
            mine = [t for t, h in zip(texts, held) if h != trained]
            if not mine:
                continue
            if trained:
                for words in mine:
                    word_counts.update(words)
                word_counts[b"\n"] += len(mine)
            else:
                for words in mine:
                    word_counts.update(dict.fromkeys(words, 0))
                word_counts[b"\n"] += 0
            codes, _ = grams_of(mine)
            grams.add(codes, trained)
    words = list(word_counts)
    keys, counts = merged(word_keys(words), np.fromiter(word_counts.values(), np.uint64, len(words)))
    return keys, counts, grams.keys, grams.counts


def dealt(keys, n_buckets):
    """Order of the keys by bucket (then key), and the bucket's bounds."""
    import numpy as np

    bucket = (keys % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n_buckets + 1))


# -- Spark plans ----------------------------------------------------------

def packed_blocks(docs: DataFrame, held_out: Column, id_col: str, text_col: str, n_blocks: int) -> DataFrame:
    """(block, rows): the documents (id, held, text), compressed, several to
    a row."""
    src = docs.select(
        col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"),
        col(text_col).cast("string").alias("text"),
        F.pmod(F.xxhash64(col(id_col), col(text_col).cast("string")), F.lit(n_blocks)).alias("block"))

    def pack(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for start, stop in slices(batch, 2, 8 * SLICE_BYTES):
                part = pa.Table.from_batches([batch.slice(start, stop - start)])
                block = np.asarray(part.column("block"))
                rows = part.drop_columns(["block"])
                blocks = np.unique(block)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks), pa.array([packed_rows(rows.filter(pa.array(block == b)))
                                                 for b in blocks.tolist()], pa.binary())], names=["block", "rows"])

    return src.mapInArrow(pack, "block bigint, rows binary")


def key_arrays(blocks: DataFrame, n_buckets: int) -> DataFrame:
    """(kind, bucket, block, n, keys, counts) of each block's distinct keys."""
    def keys_of(table):
        import pyarrow as pa

        block = table.column("block")[0].as_py()
        words, word_counts, grams, gram_counts = block_keys(x.as_py() for x in table.column("rows"))
        out = []
        for kind, keys, counts in ((WORD, words, word_counts), (GRAM, grams, gram_counts)):
            order, bounds = dealt(keys, n_buckets)
            for b in range(n_buckets):
                at = order[bounds[b]:bounds[b + 1]]
                if len(at):
                    out.append({"kind": kind, "bucket": b, "block": block, "n": len(at),
                                "keys": packed(keys[at]), "counts": packed(counts[at])})
        return pa.Table.from_pylist(out, schema=pa.schema([
            ("kind", pa.int32()), ("bucket", pa.int64()), ("block", pa.int64()), ("n", pa.int64()),
            ("keys", pa.binary()), ("counts", pa.binary())]))

    return blocks.groupBy("block").applyInArrow(
        keys_of, "kind int, bucket bigint, block bigint, n bigint, keys binary, counts binary")


def _all_keys(table):
    import numpy as np

    rows = list(zip(*(table.column(c).to_pylist() for c in ("block", "n", "keys", "counts"))))
    keys = np.concatenate([unpacked(k, n) for _, n, k, _ in rows])
    counts = np.concatenate([unpacked(c, n) for _, n, _, c in rows])
    return rows, keys, counts


ANSWER = "block bigint, kind int, n bigint, keys binary, answers binary, tokens bigint, types bigint"


def answer_rows(rows):
    import pyarrow as pa

    return pa.Table.from_pylist(rows, schema=pa.schema([
        ("block", pa.int64()), ("kind", pa.int32()), ("n", pa.int64()), ("keys", pa.binary()),
        ("answers", pa.binary()), ("tokens", pa.int64()), ("types", pa.int64())]))


def word_answers(keys: DataFrame) -> DataFrame:
    """For each block and bucket, its words with their training counts; one
    more row (block -1) for each bucket holds the number of its training
    words, all and distinct."""
    def answer(table):
        import numpy as np

        rows, keys, counts = _all_keys(table)
        distinct, total = merged(keys, counts)
        out = [{"block": -1, "kind": WORD, "n": 0, "keys": b"", "answers": b"",
                "tokens": int(total.sum()), "types": int((total > 0).sum())}]
        found = total[np.searchsorted(distinct, keys)]
        at = 0
        for block, n, own, _ in rows:
            out.append({"block": block, "kind": WORD, "n": n, "keys": own,
                        "answers": packed(found[at:at + n]), "tokens": 0, "types": 0})
            at += n
        return answer_rows(out)

    return keys.where(F.col("kind") == WORD).groupBy("bucket").applyInArrow(answer, ANSWER)


def gram_counts(keys: DataFrame) -> DataFrame:
    """(g, n): every gram of the corpus and its training count."""
    def count(table):
        import pyarrow as pa

        _, keys, counts = _all_keys(table)
        distinct, total = merged(keys, counts)
        return pa.table({"g": distinct.astype("<i8"), "n": total.astype("<i8")})

    return keys.where(F.col("kind") == GRAM).groupBy("bucket").applyInArrow(count, "g bigint, n bigint")


def tree(grams: DataFrame, mass: float = MASS, min_divergence: float = MIN_DIVERGENCE) -> DataFrame:
    """(g, p, state) of every gram: the probability of its last symbol after
    the longest retained suffix of its context, and that suffix's length."""
    def level(k: int) -> DataFrame:
        mask = (1 << (8 * (k + 1))) - 1
        return grams.groupBy(F.col("g").bitwiseAND(F.lit(mask)).alias("g")).agg(F.sum("n").alias("n"))

    root = Window.partitionBy(F.lit(0))
    now = level(0).withColumn("p", (F.col("n") + 0.5) / (F.sum("n").over(root) + 128.0)).select(
        F.col("g").alias("up"), F.col("p").alias("base"), F.lit(0).alias("base_state"))
    for k in range(1, DEPTH + 1):
        up = (1 << (8 * k)) - 1
        rows = level(k).withColumn("up", F.col("g").bitwiseAND(F.lit(up))).join(now, "up")
        context = Window.partitionBy("context")
        rows = rows.withColumn("context", F.shiftright("g", 8))
        rows = rows.withColumn("smooth", (F.col("n") + mass * F.col("base")) / (F.sum("n").over(context) + mass))
        rows = rows.withColumn("divergence", F.sum(F.when(
            F.col("n") > 0, F.col("n") * F.log(F.col("smooth") / F.col("base"))).otherwise(0.0)).over(context))
        kept = F.col("divergence") > min_divergence
        now = rows.select(F.col("g").alias("up"), F.when(kept, F.col("smooth")).otherwise(F.col("base")).alias("base"),
                          F.when(kept, F.lit(k)).otherwise(F.col("base_state")).alias("base_state"))
    return now.toDF("g", "p", "state")


def gram_answers(keys: DataFrame, model: DataFrame, n_buckets: int) -> DataFrame:
    """For each block and bucket, its grams with their log10 probabilities
    (the bits of doubles)."""
    def answer(left, right):
        import numpy as np

        if not left.num_rows:
            return answer_rows([])
        grams = np.asarray(right.column("g")).astype(np.uint64)
        order = np.argsort(grams)
        grams, logs = grams[order], np.log10(np.asarray(right.column("p")))[order]
        out = []
        for block, n, keys in zip(*(left.column(c).to_pylist() for c in ("block", "n", "keys"))):
            found = logs[np.searchsorted(grams, unpacked(keys, n))]
            out.append({"block": block, "kind": GRAM, "n": n, "keys": keys,
                        "answers": packed(found.astype("<f4").astype("<f8").view("<u8")), "tokens": 0, "types": 0})
        return answer_rows(out)

    left = keys.where(F.col("kind") == GRAM).select("bucket", "block", "n", "keys")
    right = model.select(F.pmod("g", F.lit(n_buckets)).alias("bucket"), "g", "p")
    return left.groupBy("bucket").cogroup(right.groupBy("bucket")).applyInArrow(answer, ANSWER)


def scored(blocks: DataFrame, answers: DataFrame, id_kind: str) -> DataFrame:
    """(id, held, n_tokens, n_known, known_log, score) of every document."""
    def of_block(left, right):
        import numpy as np
        import pyarrow as pa

        ids, held, n_tokens, n_known, known_log, score = [], [], [], [], [], []
        if left.num_rows:
            data = [x.as_py() for x in left.column("rows")]
            known = {}
            for kind, dtype in ((WORD, "<u8"), (GRAM, "<f8")):
                mine = right.filter(pa.array(np.asarray(right.column("kind")) == kind))
                rows = list(zip(*(mine.column(c).to_pylist() for c in ("n", "keys", "answers"))))
                keys = np.concatenate([unpacked(k, n) for n, k, _ in rows])
                order = np.argsort(keys)
                known[kind] = keys[order], np.concatenate([unpacked(a, n, dtype) for n, _, a in rows])[order]
            del mine, rows, keys, order
            words, word_counts = known[WORD]
            by_gram, gram_logs, by_word = Lookup(known[GRAM][0]), known[GRAM][1], {}
            for packed_ in data:
                rows = unpacked_rows(packed_)
                texts = list(map(words_of, rows.column("text").to_pylist()))
                new = list(set().union(*texts, (b"\n",)).difference(by_word))
                found = word_counts[np.searchsorted(words, word_keys(new))]
                by_word.update(zip(new, found.tolist()))
                sizes = np.array([len(t) + 1 for t in texts])
                starts = np.cumsum(sizes) - sizes
                counts = np.fromiter((c for t in texts for c in (*map(by_word.__getitem__, t), by_word[b"\n"])),
                                     np.int64, int(sizes.sum()))
                n_tokens.append(sizes)
                n_known.append(np.add.reduceat((counts > 0).astype(np.int64), starts))
                known_log.append(np.add.reduceat(np.log10(counts + 1.0), starts))
                codes, symbols = grams_of(texts)
                logs = gram_logs[by_gram.places(codes)]
                score.append(np.add.reduceat(logs, np.cumsum(symbols) - symbols))
                ids.append(rows.column("id").combine_chunks())
                held.append(rows.column("held").combine_chunks())
        join = lambda x, kind: pa.array(np.concatenate([np.zeros(0, kind), *x]).astype(kind))
        return pa.table({
            "id": pa.concat_arrays(ids) if ids else pa.nulls(0, pa.int64()),
            "held": pa.concat_arrays(held) if held else pa.array([], pa.bool_()),
            "n_tokens": join(n_tokens, np.int64), "n_known": join(n_known, np.int64),
            "known_log": join(known_log, np.float64), "score": join(score, np.float64)})

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        of_block, f"id {id_kind}, held boolean, n_tokens bigint, n_known bigint, known_log double, score double")


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
          mass: float = MASS, min_divergence: float = MIN_DIVERGENCE,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: the id, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score``; the model is learned from
    the rows for which ``held_out`` is not true."""
    size = docs.agg(F.sum(F.octet_length(col(text_col).cast("string")))).first()[0] or 0
    n_blocks = max(1, -(-size // block_bytes))
    n_buckets = 2 * n_blocks + 15
    parts = max(shuffle_partitions(docs.sparkSession), n_blocks)
    blocks = packed_blocks(docs, held_out, id_col, text_col, n_blocks).repartition(parts, "block")
    keys = cut(key_arrays(blocks, n_buckets))
    words = cut(word_answers(keys))
    totals = words.where("block = -1").agg(F.sum("tokens"), F.sum("types")).first()
    n, types = totals[0] or 0, totals[1] or 0
    model = tree(cut(gram_counts(keys)), mass, min_divergence)
    answers = words.where("block >= 0").unionByName(gram_answers(keys, model, n_buckets))
    found = scored(blocks, answers, docs.select(col(id_col)).schema[0].dataType.simpleString())
    return found.select(
        F.col("id").alias(id_col), F.col("held").alias("held_out"), "n_tokens", "n_known",
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("known_log") - F.col("n_tokens") * F.log10(F.lit(float(n + types + 1)))).alias("base_score"), "score")
