"""Quality classifier: histogram gradient-boosted trees over document statistics.

Each text gives a row of statistics (lengths, character classes, repetition), computed
over whole texts in Arrow batches. Trees are grown level by level on 64-bin histograms
of a bounded sample and kept as flat arrays, so that scoring is a few numpy lookups
per tree for a whole batch.

Results for odd input: NULL and empty texts have all-zero statistics and get a score like
any other; without labels, or with one class only, the score is that class's share (0.5
without labels). Labels with NULL quality are left out; a text labelled twice counts
once per label. Each input row gives one row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.llm import text as tx
from tabml.llm.frames import in_batches, sample_of
from tabml.llm.linear import sigmoid

BINS = 64


@dataclass
class Trees:
    """Complete binary trees: node k has children 2k + 1 and 2k + 2."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray  # trees x inner nodes; larger values go right
    leaf: np.ndarray  # trees x leaves

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1])) if len(self.leaf) else 0
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - (leaf.size - 1)]
        return total


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15) -> Trees:
    """Boosted trees for the logistic loss on binned columns."""
    n, columns = x.shape
    mean = float(np.average(y, weights=weight)) if n else 0.5
    base = float(np.log((mean + 1e-4) / (1 - mean + 1e-4)))
    inner, leaves = 2**depth - 1, 2**depth
    if not n or not 0 < mean < 1:
        return Trees(base, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(columns)]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
    weight = weight / weight.mean()
    margin = np.full(n, base)
    features, values, outputs = [], [], []
    for _ in range(rounds):
        p = sigmoid(margin)
        g, h = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)
        feature, cut = np.zeros(inner, int), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            at = node - first
            best = np.zeros(width)
            for f in range(columns):
                if not len(cuts[f]):
                    continue
                slot = at * BINS + binned[:, f]
                hist_g = np.bincount(slot, g, width * BINS).reshape(width, BINS).cumsum(1)
                hist_h = np.bincount(slot, h, width * BINS).reshape(width, BINS).cumsum(1)
                all_g, all_h = hist_g[:, -1:], hist_h[:, -1:]
                left_g, left_h = hist_g[:, : len(cuts[f])], hist_h[:, : len(cuts[f])]
                right_g, right_h = all_g - left_g, all_h - left_h
                gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - all_g**2 / (all_h + 1)
                gain = np.where((left_h > 0.5) & (right_h > 0.5), gain, 0)
                pick = gain.argmax(1)
                top = gain[np.arange(width), pick]
                better = np.flatnonzero(top > best + 1e-9)
                best[better] = top[better]
                feature[first + better], cut[first + better] = f, cuts[f][pick[better]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
        at = node - inner
        leaf = -rate * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + 1)
        margin = margin + leaf[at]
        features.append(feature)
        values.append(cut)
        outputs.append(leaf)
    return Trees(base, np.array(features), np.array(values), np.array(outputs))


_CLASSES = {
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "digit": bytes(range(48, 58)),
    "stop": b".!?",
    "shout": b"!",
    "symbol": b"#*$%&|<>",
    "mark": b",;:'\"()-",
    "brace": b"{}[]\\/=_^~@+`",
}
FEATURES = ["log_words", "chars_a_word", "words_a_line", "log_lines", "other_bytes", *_CLASSES]
FEATURES += ["same_as_previous", "distinct_words", "duplicate_lines", "repeat_5", "repeat_8", "longest_word", "short_words"]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text of a block."""
    b = tx.Block(data, offsets)
    size, n = np.maximum(np.diff(offsets), 1), np.maximum(b.n_words, 1)
    filled, duplicate = b.duplicate_lines()
    lengths = b.ends - b.starts
    later = tx.repeated(b.hashes, b.text)[1]
    same = np.zeros(len(b.hashes), bool)
    same[1:] = (b.hashes[1:] == b.hashes[:-1]) & (b.text[1:] == b.text[:-1])
    longest = np.zeros(b.n)
    np.maximum.at(longest, b.text, lengths)
    columns = [
        np.log1p(b.n_words),
        b.word_chars / n,
        b.n_words / np.maximum(filled, 1),
        np.log1p(filled),
        tx.counts_between(data >= 128, offsets) / size,
        *[b.count(c) / size for c in _CLASSES.values()],
        b.per_text(same, b.text) / n,
        np.where(b.n_words > 0, 1 - b.per_text(later, b.text) / n, 0),
        duplicate / np.maximum(filled, 1),
        b.repeated_words(5) / n,
        b.repeated_words(8) / n,
        np.log1p(longest),
        b.per_text(lengths <= 2, b.text) / n,
    ]
    return np.stack(columns, 1).astype(float)


def _batch_statistics(column: pa.Array) -> np.ndarray:
    parts = [statistics(data, offsets) for _, _, data, offsets in tx.blocks(*tx.utf8(column))]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = _batch_statistics(batch.column("text"))
        packed = pa.array([r.tobytes() for r in rows], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("key", "label", "weight")] + [packed], names=["key", "label", "weight", "x"]
        )


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 3000, key: str = "doc_id") -> Trees:
    """Learn from ``docs`` (key, text) and ``labels`` (key, label 0 or 1).

    ``per_class`` bounds the sample: about so many texts of each label, weighted back to
    their share.
    """
    rows = labels.select(F.col(key).alias("key"), F.col("label").cast("int").alias("label"))
    rows = rows.filter(F.col("key").isNotNull() & F.col("label").isin(0, 1))
    # The sample is bounded by the parameter, so it may be broadcast.
    picks = F.broadcast(sample_of(rows, "label", per_class))
    texts = docs.select(F.col(key).alias("key"), "text").join(picks, "key")
    texts = texts.select(F.col("key").cast("string").alias("key"), "label", "weight", "text")
    found = in_batches(texts, _profiles, "key string, label int, weight double, x binary").collect()
    found = sorted(found, key=lambda r: (r["key"], r["label"], bytes(r["x"])))
    x = np.array([np.frombuffer(r["x"]) for r in found]).reshape(-1, len(FEATURES))
    y = np.array([r["label"] for r in found], float)
    weight = np.array([r["weight"] for r in found], float)
    return grow(x, y, weight)


def score(docs: DataFrame, model: Trees, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) for each row: the probability of label 1."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = sigmoid(model.margin(_batch_statistics(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(p)], names=["key", "score"])

    schema = T.StructType([rows.schema["key"], T.StructField("score", T.DoubleType())])
    return in_batches(rows, scored, schema).withColumnRenamed("key", key)
