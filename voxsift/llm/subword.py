"""Bags of hashed character n-grams, averaged into a linear softmax.

A unit (a word or a document) is the set of its character n-grams, blanks
standing for word ends; each n-gram hashes into a bucket with an embedding.
The unit's vector is the average of its embeddings, and a linear layer with
softmax reads it.  Embeddings and layer are trained together by stochastic
gradient descent in numpy.  As everything before the softmax is linear, the
trained model is reduced to one score for each bucket and label.
"""

from __future__ import annotations


def ngrams(codes, sizes, bits: int):
    """(place of each n-gram's second character, its bucket) in an array of
    code points; n-grams (at least 3 long) do not cross blanks, but may begin
    and end with one."""
    import numpy as np

    before = np.concatenate([[0], np.cumsum(codes == 32)])  # blanks before each place
    wide = codes.astype(np.uint64)
    places, buckets = [], []
    for n in sizes:
        if len(codes) < n:
            continue
        count = len(codes) - n + 1
        h = np.full(count, np.uint64(n * 0x9E3779B1), np.uint64)
        for k in range(n):
            h ^= wide[k:k + count]
            h *= np.uint64(0x100000001B3)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        inside = np.flatnonzero(before[n - 1:n - 1 + count] == before[1:1 + count])
        places.append(inside + 1)
        buckets.append((h[inside] >> np.uint64(64 - bits)).astype(np.int64))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *places]), np.concatenate([none, *buckets])


def code_points(text: str):
    import numpy as np

    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def train(units, targets, weights, sizes, bits, dim, epochs, rate, batch, seed=7):
    """Train on units (strings of blank-separated words) with soft targets
    (rows of label shares) and weights; returns (bucket scores, bias), the
    scores as a float32 array of labels x buckets."""
    import numpy as np

    rng = np.random.default_rng(seed)
    n_labels = targets.shape[1]
    embeddings = (rng.uniform(-1, 1, (dim, 1 << bits)) / dim).astype(np.float32)
    layer = rng.normal(0, 0.1, (dim, n_labels))
    bias = np.log(np.maximum((targets * weights[:, None]).sum(0), 1e-9))
    bias -= bias.max()
    squares_e = np.full((dim, 1 << bits), 1e-6, np.float32)
    squares_l = np.full((dim, n_labels), 1e-6)
    steps, done = max(1, epochs * -(-len(units) // batch)), 0
    for _ in range(epochs):
        order = rng.permutation(len(units))
        for start in range(0, len(order), batch):
            chosen = order[start:start + batch]
            owner, bucket, size = bag([units[i] for i in chosen], sizes, bits)
            used, bucket = np.unique(bucket, return_inverse=True)
            share = 1.0 / np.maximum(size, 1)
            mine = embeddings[:, used]
            hidden = np.stack([np.bincount(owner, e[bucket], len(chosen)) for e in mine], 1) * share[:, None]
            logits = hidden @ layer + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            gap = (targets[chosen] - p) * (weights[chosen] / weights[chosen].mean())[:, None]
            pace = rate * (1 - done / steps)
            slope_l = hidden.T @ gap / len(chosen)
            back = gap @ layer.T * share[:, None]
            squares_l += slope_l ** 2
            slope = np.stack([np.bincount(bucket, b[owner], len(used)) for b in back.T])
            squares_e[:, used] += slope ** 2
            embeddings[:, used] += pace * slope / np.sqrt(squares_e[:, used])
            layer += pace * slope_l / np.sqrt(squares_l)
            bias = bias + 0.1 * pace * gap.mean(0)
            done += 1
    return (layer.T @ embeddings).astype(np.float32), bias


def bag(units, sizes, bits):
    """(unit number, bucket) of all n-grams of the units, and how many each
    unit has; blanks separate the units."""
    import numpy as np

    place, bucket = ngrams(code_points(" " + " ".join(units) + " "), sizes, bits)
    chars = np.fromiter(map(len, units), np.int64, len(units)) + 1
    owner = np.repeat(np.arange(len(units) + 1), np.append(1, chars)) - 1
    owner = owner[place]
    return owner, bucket, np.bincount(owner, minlength=len(units))


def averages(units, scores, sizes, bits):
    """Average bucket score of each unit and label (units x labels)."""
    import numpy as np

    owner, bucket, size = bag(units, sizes, bits)
    total = np.stack([np.bincount(owner, s[bucket], len(units)) for s in scores], 1)
    return total / np.maximum(size, 1)[:, None]
