"""Quality scores: a factorisation machine over hashed words, structure statistics and metadata.

A text is a set of features: each word occurrence (hashed, weight 1 / sqrt(words)) and one bin for each
of its statistics (shares of upper-case letters, digits, symbols, white space, line breaks and non-ASCII
bytes, mean word length, share of distinct words, share of repeated word pairs, length). Every feature
has a weight and a short vector; pairs of features interact by the dot product of their vectors. The sum
over all pairs is taken in linear time as half of (square of the sum minus the sum of the squares).

The model has a fixed size, 2^16 + bins rows of 1 + rank numbers (about 2.5 MB), and is shipped with the
scoring tasks. It is fitted on a bounded sample of labelled rows (``max_train``) in one task, which the
bound keeps small. ``shards`` above 1 fits on shares and averages the models, which costs accuracy: the
vectors of two models need not point the same way.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import clean_strings, col, fresh, mix, segment_sums, text_slices, utf8_parts, word_hashes
from .toxicity import held_out, score_column, training_rows

WORD_BITS, RANK, BINS = 16, 8, 12
STATS = ["upper", "digit", "symbol", "pipe", "space", "line", "wide", "word_length", "distinct", "pairs", "length"]
#: Upper bin edges of each statistic, as powers of two below its scale.
_EDGES = 2.0 ** -np.arange(BINS - 1)[::-1]
FEATURES = (1 << WORD_BITS) + BINS * len(STATS)


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray  # FEATURES
    vectors: np.ndarray  # FEATURES x RANK


def _class_tables():
    t = np.zeros((7, 256), bool)
    t[0, ord("A"):ord("Z") + 1] = True
    t[1, ord("0"):ord("9") + 1] = True
    for c in "#*$%&<>!~^=+@\\/{}[]_":
        t[2, ord(c)] = True
    t[3, ord("|")] = True
    t[4, [9, 11, 12, 13, 32]] = True
    t[5, 10] = True
    t[6, 128:] = True
    return t


def _distinct(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Distinct values per segment."""
    doc = np.repeat(np.arange(len(off) - 1, dtype=np.uint64), np.diff(off))
    key = np.sort((doc << np.uint64(40)) | (h >> np.uint64(24)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return np.bincount((key[new] >> np.uint64(40)).astype(np.int64), minlength=len(off) - 1)


def text_features(texts: pa.Array):
    """(word features, offsets per text, bins per text): bins is texts x STATS."""
    texts = clean_strings(texts)
    h, off, starts, stops = word_hashes(texts)
    data, cut = utf8_parts(texts)
    size = np.maximum(np.diff(cut), 1).astype(float)
    words = np.diff(off)
    some = np.maximum(words, 1).astype(float)
    tables = _class_tables()
    code = np.zeros(256, np.uint8)
    for k, row in enumerate(tables):
        code[row] = k + 1
    kinds = code[data]
    doc_of = np.repeat(np.arange(len(cut) - 1, dtype=np.int64), np.diff(cut))
    counts = np.bincount(doc_of * 8 + kinds, minlength=8 * (len(cut) - 1)).reshape(-1, 8)
    shares = counts[:, 1:] / size[:, None]
    length = segment_sums((stops - starts).astype(float), off) / some
    pair = mix(h[:-1] * np.uint64(0x51ED270B7F4A7C15) + h[1:]) if len(h) > 1 else np.zeros(0, np.uint64)
    pair_off = np.minimum(off, len(pair))
    distinct = _distinct(h, off) / some
    pairs = _distinct(pair, pair_off) / np.maximum(np.diff(pair_off), 1)
    stats = np.column_stack([shares, length / 16.0, distinct, pairs, np.log2(1.0 + words) / 16.0])
    bins = np.searchsorted(_EDGES, np.nextafter(stats, 0.0))  # bin k: up to edge k
    # Shares near one need finer steps than halves: distinct words and pairs are binned evenly.
    for name in ("distinct", "pairs", "word_length", "length"):
        k = STATS.index(name)
        bins[:, k] = np.minimum((stats[:, k] * BINS).astype(int), BINS - 1)
    bins = np.minimum(bins, BINS - 1) + (1 << WORD_BITS) + BINS * np.arange(len(STATS))
    return (h >> np.uint64(64 - WORD_BITS)).astype(np.int64), off, bins


def _logits(m: Model, squares: np.ndarray, idx: np.ndarray, off: np.ndarray, bins: np.ndarray) -> np.ndarray:
    x = 1.0 / np.sqrt(np.maximum(np.diff(off), 1))
    lin = segment_sums(m.weights[idx], off) * x + m.weights[bins].sum(axis=1)
    total = segment_sums(m.vectors[idx], off) * x[:, None] + m.vectors[bins].sum(axis=1)
    own = segment_sums(squares[idx], off) * x * x + squares[bins].sum(axis=1)
    return m.bias + lin + 0.5 * ((total * total).sum(axis=1) - own)


def start_model(seed: int = 11) -> Model:
    rng = np.random.default_rng(seed)
    return Model(0.0, np.zeros(FEATURES, np.float32), rng.normal(0, 0.02, (FEATURES, RANK)).astype(np.float32))


def fit_fm(examples: list, rate: float = 0.1, l2: float = 1e-4, epochs: int = 3) -> Model:
    """AdaGrad over (words, bins, label) examples in the given order."""
    m = start_model()
    w, v, bias = m.weights.copy(), m.vectors.copy(), 0.0
    gw, gv, gb = np.full(FEATURES, 1e-2, np.float32), np.full((FEATURES, RANK), 1e-2, np.float32), 1e-2
    for _ in range(epochs):
        for idx, bins, y in examples:
            uniq, times = np.unique(idx, return_counts=True)
            f = np.concatenate([uniq, bins])
            x = np.concatenate([times / np.sqrt(max(len(idx), 1)), np.ones(len(bins))]).astype(np.float32)
            # Occurrences of one word are features of their own: their squares add up, not their sum's square.
            x2 = np.concatenate([times / max(len(idx), 1), np.ones(len(bins))]).astype(np.float32)
            vf = v[f]
            total = x @ vf
            logit = bias + w[f] @ x + 0.5 * (total @ total - x2 @ (vf * vf).sum(axis=1))
            g = np.float32(1.0 / (1.0 + np.exp(-np.clip(logit, -35, 35))) - y)
            dw = g * x + l2 * w[f]
            dv = g * (x[:, None] * total - x2[:, None] * vf) + l2 * vf
            gw[f] += dw * dw
            gv[f] += dv * dv
            gb += float(g * g)
            w[f] -= rate * dw / np.sqrt(gw[f])
            v[f] -= rate * dv / np.sqrt(gv[f])
            bias -= rate * float(g) / np.sqrt(gb)
    return Model(float(bias), w, v)


def train(rows: DataFrame, **options) -> Model:
    """Averages the models of the shards of ``training_rows``. No rows: a model that says 0.5."""
    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by([("place", "ascending"), ("text", "ascending")]).combine_chunks()
        y, texts = table["y"].to_numpy(), table["text"].combine_chunks()
        examples = []
        for a, b in text_slices(texts):
            idx, off, bins = text_features(texts.slice(a, b - a))
            examples += [(idx[off[i]:off[i + 1]], bins[i], int(y[a + i])) for i in range(b - a)]
        m = fit_fm(examples, **options)
        return pa.table({"rows": pa.array([len(examples)], pa.int64()), "bias": [m.bias],
                         "weights": pa.array([m.weights.tobytes()], pa.binary()),
                         "vectors": pa.array([m.vectors.tobytes()], pa.binary())})

    # One fixed-size model per shard comes back: shards x 2.5 MB.
    got = rows.groupBy("shard").applyInArrow(learn, "rows long, bias double, weights binary, vectors binary").collect()
    if not got:
        m = start_model()
        return Model(0.0, m.weights, np.zeros_like(m.vectors))
    n = sum(r["rows"] for r in got)
    got.sort(key=lambda r: (r["rows"], r["bias"]))
    return Model(sum(r["bias"] * r["rows"] for r in got) / n,
                 sum(np.frombuffer(r["weights"], np.float32) * np.float32(r["rows"] / n) for r in got),
                 sum(np.frombuffer(r["vectors"], np.float32) * np.float32(r["rows"] / n) for r in got).reshape(FEATURES, RANK))


def score_texts(model: Model):
    squares = (model.vectors * model.vectors).sum(axis=1)

    def score(texts: pa.Array) -> np.ndarray:
        out = np.empty(len(texts))
        for a, b in text_slices(texts, 2 << 20):
            idx, off, bins = text_features(texts.slice(a, b - a))
            out[a:b] = 1.0 / (1.0 + np.exp(-np.clip(_logits(model, squares, idx, off, bins), -35, 35)))
        return out
    return score


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 4,
                remainder: int = 2, max_train: int = 12288, shards: int = 1) -> Model:
    """Fits on at most about ``max_train`` labelled rows whose crc32(id) mod ``modulus`` isn't ``remainder``."""
    return train(training_rows(docs, labels, "quality", id_col, text_col, modulus, remainder, max_train, shards))


def quality_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", modulus: int = 4,
                   remainder: int = 2, threshold: float = 0.7) -> DataFrame:
    """(id, held_out, score, predicted) for every document; predicted is 1 from ``threshold`` on.

    Null and empty texts are scored by their statistics alone; null ids are scored and not held out;
    repeated rows each give a row; an empty table gives none. A model without training rows says 0.5.
    """
    scored = score_column(docs, [id_col], text_col, score_texts(model), fresh([id_col], "score"))
    s = scored.columns[1]
    return scored.select(col(id_col), held_out(col(id_col), modulus, remainder).alias("held_out"), col(s).alias("score"),
                         (col(s) >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The documents that score ``threshold`` or more, columns unchanged."""
    at = docs.columns.index(text_col)
    score = score_texts(model)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(score(batch.column(at)) >= threshold))

    return docs.mapInArrow(run, docs.schema)
