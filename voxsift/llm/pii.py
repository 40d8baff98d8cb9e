"""Personal data by rules and a skip-chain conditional random field.

The rules find e-mail, IP, card and phone spans (leftmost, not overlapping,
for each kind); they always stay.  A conditional random field over the
document's entity-like tokens adds spans.  These are the tokens with a digit or
an at sign, and the names: tokens equal to the local part of one of the
document's e-mail spans, if it has at least five characters and an inner mark
(``anna.smith``; a plain word such as ``support`` says nothing on its own).
Other tokens can only be outside.  Its potentials: token features, transitions
between neighbouring tokens, and skip edges between a token and its next
occurrence at any distance, be it the same text, the same digits or the same local
part, which tie their labels.  Tokens of rule spans are clamped to their
kind; loopy sum-product messages then carry it along chains and skip edges,
so that a repeated mention gets the label that the document already gave it.

Weights are learned by pseudo-likelihood (each token given its neighbours'
labels) in numpy, from the rule labels of a bounded sample of documents
(``max_fit_docs``, by a hash); weights that the sample does not determine
stay at their prior, which favours equal labels over skip edges.

Inference runs inside the scan, documents are not shuffled, and skip edges
link consecutive occurrences only, so the work is linear in the text.

Defined results: null and empty texts have no spans; repeated rows give a row
each; overlapping spans of different kinds are all reported, and redacted as
one; empty tables give empty results; ``redact`` keeps all columns whatever
their names, ``find`` reads the id and the text only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, col, slices

MAX_FIT_DOCS = 6_000
SLICE_BYTES = 8 << 20
MIN_MARGINAL = 0.9
ROUNDS = 30
# The kinds in the order of reports, and the rules' patterns.
KINDS = ("email", "ip", "card", "phone")
LABELS = ("outside", *KINDS)
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
TRIGGER = re.compile(r"[0-9@]")
NAME = re.compile(r"[^._%+-][._%+-]+[^._%+-]")
EDGE_MARKS = "\"'()[]{}<>,;:!?*#$%&|=./\\-_~`^"


# -- rules ----------------------------------------------------------------

def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        if i % 2:
            x = 2 * x - 9 * (x > 4)
        total += x
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str):
    """E-mail spans.  A match's local part is the run before its at sign, up
    to the previous match, so each at sign has one candidate."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at and at >= end else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number from 1, start, end) by kind, then start."""
    out = []
    if "@" in text:
        out += [(1, a, b) for a, b in emails(text)]
    if TRIGGER.search(text) is None:
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((2, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = only_digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((3, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(only_digits(m[0])) <= 15:
                out.append((4, m.start(), m.end()))
    return out


# -- the field's graph ----------------------------------------------------

def token_features(core: str, raw: str) -> list[str]:
    """Names of the binary features that a token has (by its first 80
    characters: longer ones are no names or numbers)."""
    core = core[:80]
    digits = only_digits(core)
    shape = re.sub(r"[^0-9A-Za-z]", "-", re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]+", "9", core)))
    out = ["bias", f"digits={min(len(digits), 20)}", f"length={min(len(core), 24) // 3}",
           f"shape={shape[:16]}", f"marks={sum(not c.isalnum() for c in core)}"]
    if "@" in core:
        out.append("at")
        if re.search(r".@.+\..", core):
            out.append("at-domain")
    if raw.startswith("+"):
        out.append("plus")
    if raw.startswith("("):
        out.append("bracket")
    if digits and len(digits) == len(core):
        out.append("all-digits")
    if 13 <= len(digits) <= 19 and re.fullmatch(r"[0-9-]+", core):
        out.append("luhn" if luhn(digits) else "not-luhn")
    parts = core.split(".")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts):
        out.append("quad-ok" if all(len(p) < 4 and int(p) < 256 for p in parts) else "quad-bad")
    if re.search(r"[A-Za-z]", core):
        out.append("letters")
    return out


def name_of(email: str) -> str | None:
    """The local part by which an e-mail span's owner may be mentioned."""
    local = email.split("@")[0].strip(EDGE_MARKS + "+").lower()
    return local if len(local) >= 5 and (TRIGGER.search(local) or NAME.search(local)) else None


def link_keys(core: str, names=()) -> list[str]:
    """Keys under which distant tokens count as the same mention; names:
    those of the e-mail spans in the token."""
    low = core.lower()
    keys = ["t:" + low] if len(low) >= 5 else []
    digits = only_digits(core)
    if len(digits) >= 7:
        keys.append("d:" + digits)
    if "@" in low:
        local = low.split("@")[0]
        if len(local) >= 5 and TRIGGER.search(local):
            keys.append("t:" + local)
    return list(dict.fromkeys(keys + ["t:" + name for name in names]))


class Graph:
    """Entity-like tokens of several documents and the edges among them."""

    def __init__(self):
        self.spans, self.core, self.features, self.labels, self.doc = [], [], [], [], []
        self.chain, self.skip = [], []

    def add(self, doc: int, text: str, rules) -> None:
        """The document's tokens; rules: its rule spans."""
        ordered = sorted((a, b, k) for k, a, b in rules)
        named = {(a, b): name_of(text[a:b]) for k, a, b in rules if k == 1}
        names = set(named.values()) - {None}
        last_seen: dict[str, int] = {}
        previous, rule_at = None, 0
        for number, m in enumerate(TOKEN.finditer(text)):
            if not TRIGGER.search(m[0]) and not (names and m[0].strip(EDGE_MARKS + "+").lower() in names):
                continue
            start, end = m.span()
            while rule_at < len(ordered) and ordered[rule_at][1] <= start:
                rule_at += 1
            inside, mine = [], []
            for a, b, k in islice(ordered, rule_at, None):
                if a >= end:
                    break
                if b > start:
                    inside.append(k)
                    if k == 1 and named[a, b]:
                        mine.append(named[a, b])
            core = m[0].strip(EDGE_MARKS + "+") or m[0]
            offset = m[0].find(core)
            node = len(self.spans)
            self.spans.append((start, end))
            self.core.append((start + offset, start + offset + len(core)))
            self.features.append(token_features(core, m[0]))
            self.labels.append(min(inside) if inside else 0)
            self.doc.append(doc)
            if previous is not None and previous[1] == number - 1:
                self.chain.append((previous[0], node))
            linked = set()
            for key in link_keys(core, mine):
                other = last_seen.get(key)
                if other is not None and other not in linked:
                    self.skip.append((other, node))
                    linked.add(other)
                last_seen[key] = node
            previous = (node, number)

    def edges(self):
        """(tail, head, 0 chain or 1 skip) arrays."""
        import numpy as np

        both = np.array(self.chain + self.skip, np.int64).reshape(-1, 2)
        kind = np.array([0] * len(self.chain) + [1] * len(self.skip), np.int64)
        return both[:, 0], both[:, 1], kind


# -- learning and inference -----------------------------------------------

def prior_potentials():
    """Chain and skip potentials before any evidence (label x label)."""
    import numpy as np

    n = len(LABELS)
    skip = np.full((n, n), -4.0)  # one mention of two kinds
    np.fill_diagonal(skip, 5.0)
    # one mention both inside and outside; two outside say little
    skip[0, 1:] = skip[1:, 0] = -3.0
    skip[0, 0] = 0.5
    return np.stack([np.zeros((n, n)), skip])


def fit(texts, steps=300, rate=0.5, decay=1e-3) -> dict:
    """Weights from the rule labels of the texts, by pseudo-likelihood."""
    import numpy as np

    graph = Graph()
    for i, text in enumerate(texts):
        if text:
            graph.add(i, text, rule_spans(text))
    n_labels = len(LABELS)
    vocabulary: dict[str, int] = {"bias": 0}
    for names in graph.features:
        for name in names:
            vocabulary.setdefault(name, len(vocabulary))
    potentials = prior_potentials()
    weights = np.zeros((len(vocabulary), n_labels))
    weights[0, 0] = 2.0  # without evidence a token is outside
    n = len(graph.spans)
    if n:
        x = np.zeros((n, len(vocabulary)))
        for i, names in enumerate(graph.features):
            x[i, [vocabulary[f] for f in names]] = 1
        y = np.array(graph.labels)
        truth = np.eye(n_labels)[y]
        tail, head, kind = graph.edges()
        prior_w, prior_p = weights.copy(), potentials.copy()
        for step in range(steps):
            scores = x @ weights
            np.add.at(scores, head, potentials[kind, y[tail]])
            np.add.at(scores, tail, potentials[kind, :, y[head]])
            scores -= scores.max(axis=1, keepdims=True)
            p = np.exp(scores)
            p /= p.sum(axis=1, keepdims=True)
            gap = (truth - p) / n
            slope_p = np.zeros_like(potentials)
            np.add.at(slope_p, (kind, y[tail]), gap[head])
            turned = np.zeros_like(potentials)
            np.add.at(turned, (kind, y[head]), gap[tail])
            slope_p += turned.transpose(0, 2, 1)
            pace = rate * 20 / (1 + step / steps)
            weights += pace * (x.T @ gap - decay * (weights - prior_w))
            potentials += pace * (slope_p - decay * (potentials - prior_p))
    return {"vocabulary": vocabulary, "weights": weights, "potentials": potentials}


def marginals(graph: Graph, model: dict, rounds=ROUNDS):
    """Label marginals of every token by damped loopy sum-product messages."""
    import numpy as np

    def log_sum(a, axis):
        top = a.max(axis=axis, keepdims=True)
        return np.log(np.exp(a - top).sum(axis=axis)) + top.squeeze(axis)

    n, n_labels = len(graph.spans), len(LABELS)
    unary = np.zeros((n, n_labels))
    for i, names in enumerate(graph.features):
        known = [model["vocabulary"][f] for f in names if f in model["vocabulary"]]
        unary[i] = model["weights"][known].sum(axis=0)
        if graph.labels[i]:
            unary[i] = -60.0
            unary[i, graph.labels[i]] = 0.0
    tail, head, kind = graph.edges()
    pair = model["potentials"][kind]
    forth = np.zeros((len(tail), n_labels))  # tail to head
    back = np.zeros((len(tail), n_labels))
    belief = unary
    for _ in range(rounds if len(tail) else 0):
        new_forth = log_sum((belief[tail] - back)[:, :, None] + pair, 1)
        new_back = log_sum((belief[head] - forth)[:, None, :] + pair, 2)
        new_forth -= new_forth.max(axis=1, keepdims=True)
        new_back -= new_back.max(axis=1, keepdims=True)
        change = max(np.abs(new_forth - forth).max(), np.abs(new_back - back).max())
        forth, back = 0.3 * forth + 0.7 * new_forth, 0.3 * back + 0.7 * new_back
        belief = unary.copy()
        np.add.at(belief, head, forth)
        np.add.at(belief, tail, back)
        if change < 1e-4:
            break
    p = np.exp(belief - belief.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def find_spans(texts, model, min_marginal=MIN_MARGINAL):
    """For each text: rule spans and added spans, (kind number, start, end)."""
    rules = [rule_spans(t) if t else [] for t in texts]
    graph = Graph()
    for i, text in enumerate(texts):
        if text and TRIGGER.search(text):
            graph.add(i, text, rules[i])
    added: list[list] = [[] for _ in texts]
    if graph.spans:
        p = marginals(graph, model)
        best, sure = p.argmax(axis=1), p.max(axis=1)
        neighbours = set(graph.chain)
        for i in range(len(graph.spans)):
            kind = int(best[i])
            if not kind or graph.labels[i] or sure[i] < min_marginal:
                continue
            start, end = graph.core[i]
            mine = added[graph.doc[i]]
            if mine and mine[-1][0] == kind and (i - 1, i) in neighbours and mine[-1][3] == i - 1:
                mine[-1] = (kind, mine[-1][1], end, i)
            else:
                mine.append((kind, start, end, i))
    return rules, [[(k, a, b) for k, a, b, _ in x] for x in added]


def redacted(text: str, spans) -> str:
    """The text with each group of overlapping spans replaced by its first
    span's kind."""
    out, last, group_end, kind = [], 0, -1, 0
    for start, end, k in sorted((a, b, k) for k, a, b in spans):
        if start >= group_end:
            if group_end >= 0:
                out.append(f"<{KINDS[kind - 1].upper()}>")
            out.append(text[max(last, group_end):start])
            group_end, kind = end, k
        group_end = max(group_end, end)
    if group_end >= 0:
        out.append(f"<{KINDS[kind - 1].upper()}>")
        out.append(text[group_end:])
        return "".join(out)
    return text


# -- Spark plans ----------------------------------------------------------

def learn(docs: DataFrame, text_col: str = "text", max_fit_docs: int = MAX_FIT_DOCS) -> dict:
    """The field's weights from at most ``max_fit_docs`` documents, taken by
    a hash of the text; equal texts train once."""
    src = docs.select(col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    sample = bounded_sample(src, max_fit_docs, F.col("text")).where(F.col("text").rlike("[0-9@]"))
    return fit(sorted({r.text for r in sample.toLocalIterator()}))


def find(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text",
         min_marginal: float = MIN_MARGINAL) -> DataFrame:
    """One row per document: the id, ``base`` and ``added``, arrays of
    struct<kind, start, end> by kind, then start (code points, end exclusive)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        shown = lambda spans: [{"kind": KINDS[k - 1], "start": a, "end": b} for k, a, b in sorted(spans)]
        for batch in batches:
            for start, stop in slices(batch, 1, SLICE_BYTES):
                part = batch.slice(start, stop - start)
                base, added = find_spans(part.column(1).to_pylist(), shared.value, min_marginal)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([shown(x) for x in base], kind),
                     pa.array([shown(x) for x in added], kind)], names=["id", "base", "added"])

    spans = "array<struct<kind:string,start:bigint,end:bigint>>"
    out = src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, base {spans}, added {spans}")
    return out.withColumnRenamed("id", id_col)


def redact(docs: DataFrame, model: dict, text_col: str = "text",
           min_marginal: float = MIN_MARGINAL) -> DataFrame:
    """The documents, all columns, with spans replaced by <KIND> marks."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for start, stop in slices(batch, at, SLICE_BYTES):
                part = batch.slice(start, stop - start)
                texts = part.column(at).to_pylist()
                base, added = find_spans(texts, shared.value, min_marginal)
                changed = [i for i in range(len(texts)) if base[i] or added[i]]
                if changed:
                    for i in changed:
                        texts[i] = redacted(texts[i], base[i] + added[i])
                    columns = list(part.columns)
                    columns[at] = pa.array(texts, columns[at].type)
                    part = pa.RecordBatch.from_arrays(columns, schema=part.schema)
                yield part

    return docs.mapInArrow(run, docs.schema)
