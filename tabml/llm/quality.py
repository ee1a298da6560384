"""Quality rules: exact base counts, and a calibrated n-gram logistic regression.

The regression sees hashed words, word pairs, byte n-grams (case kept) and byte n-grams
of the text's shape (letters, digits and white space by class) as shares of the text. A
word that repeats the one before it makes a pair of its own kind. It learns from a bounded sample of labelled rows, and is calibrated on rows it
did not train on. A text is kept when it passes the base rules and its probability
of label 1 reaches the fixed threshold ``keep_at``. Scoring reads whole texts in Arrow
batches.

Results for odd input: a NULL text counts as empty, has no words and fails the base rules.
Without labels, or with one class only, the base rules alone decide (probability 1).
Each input row gives one row; other columns are ignored.
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
from tabml.llm.linear import calibrated, sigmoid, sparse_logistic

BITS = 15
WIDTHS = (2, 3)
SHAPE_WIDTHS = (2, 4)
_PART = 1 << BITS
PARTS = 2 + len(WIDTHS) + len(SHAPE_WIDTHS)  # words, word pairs, grams by width
SIZE = _PART * PARTS
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[128:], _SHAPE[48:58], _SHAPE[9:14] = 65, 97, 97, 48, 32
SAME = 0  # the pair slot of a word that repeats the one before


@dataclass
class QualityModel:
    weights: np.ndarray  # SIZE numbers
    intercept: float
    slope: float
    shift: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * margin + self.shift)


def _word_slots(b: tx.Block) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the words and of the pairs that begin at each word of the same text."""
    single = (b.hashes >> np.uint64(64 - BITS)).astype(np.int64)
    pair, where = tx.window_hashes(b.hashes, b.bounds, 2)
    slot = np.full(len(b.hashes), -1)
    slot[where] = np.maximum((pair >> np.uint64(64 - BITS)).astype(np.int64), SAME + 1)
    slot[where[b.hashes[where] == b.hashes[where + 1]]] = SAME
    return single, slot


def _grams(b: tx.Block) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    kinds = [(b.data, w) for w in WIDTHS] + [(_SHAPE[b.data], w) for w in SHAPE_WIDTHS]
    return [(tx.gram_slots(data, w, BITS), *tx.gram_bounds(b.offsets, w)) for data, w in kinds]


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slots and shares of each sampled text."""
    for batch in batches:
        slots, shares = [], []
        for _, _, data, offsets in tx.blocks(*tx.utf8(batch.column("text"))):
            b = tx.Block(data, offsets)
            single, pair = _word_slots(b)
            grams = _grams(b)
            for i in range(b.n):
                own = slice(b.bounds[i], b.bounds[i + 1])
                two = pair[own]
                parts = [single[own], two[two >= 0] + _PART]
                parts += [s[a[i] : e[i]].astype(np.int64) + (2 + k) * _PART for k, (s, a, e) in enumerate(grams)]
                found = [tx.slot_counts(p) for p in parts]
                slots.append(np.concatenate([s for s, _ in found]).astype(np.uint32).tobytes())
                shares.append(np.concatenate([c / max(c.sum(), 1) for _, c in found]).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("key", "label", "weight")] + [pa.array(slots, pa.binary()), pa.array(shares, pa.binary())],
            names=["key", "label", "weight", "slots", "shares"],
        )


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1200, key: str = "doc_id") -> QualityModel | None:
    """Learn from ``docs`` (key, text) and ``labels`` (key, label 0 or 1).

    ``per_class`` bounds the sample: about so many texts of each label. Every fourth is
    kept for calibration, weighted back to its share of the labels.
    """
    rows = labels.select(F.col(key).alias("key"), F.col("label").cast("int").alias("label"))
    rows = rows.filter(F.col("key").isNotNull() & F.col("label").isin(0, 1))
    # The sample is bounded by the parameter, so it may be broadcast.
    picks = F.broadcast(sample_of(rows, "label", per_class))
    texts = docs.select(F.col(key).alias("key"), "text").join(picks, "key")
    texts = texts.select(F.col("key").cast("string").alias("key"), "label", "weight", "text")
    found = in_batches(texts, _profiles, "key string, label int, weight double, slots binary, shares binary").collect()
    found = sorted(found, key=lambda r: (r["label"], r["key"], bytes(r["slots"]), bytes(r["shares"])))
    y = np.array([r["label"] for r in found], float)
    if not 0 < y.sum() < len(y):
        return None
    slots = [np.frombuffer(r["slots"], np.uint32) for r in found]
    shares = [np.frombuffer(r["shares"], np.float32) for r in found]
    weight = np.array([r["weight"] for r in found], float)
    place = np.concatenate([np.arange((y == 0).sum()), np.arange((y == 1).sum())])
    held = place % 4 == 3
    if not (y[held] == 1).any() or not (y[held] == 0).any():
        held = np.zeros(len(y), bool)
    train = np.flatnonzero(~held)
    # Both classes weigh the same in training; calibration restores their shares.
    even = np.where(y == 1, 0.5 / y[train].sum(), 0.5 / (1 - y[train]).sum())
    weights, intercept = sparse_logistic([slots[i] for i in train], [shares[i] for i in train], y[train], even[train], _PART, PARTS)
    margin = np.array([(weights[s] * v).sum() + intercept for s, v in zip(slots, shares)])
    use = held if held.any() else np.ones(len(y), bool)
    slope, shift = calibrated(margin[use], y[use], weight[use])
    del found, slots, shares
    tx.release()
    return QualityModel(weights.astype(np.float32), intercept, slope, shift)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measured(column: pa.Array, model: QualityModel | None) -> tuple[np.ndarray, np.ndarray]:
    """COUNTS and probabilities of the texts of one batch."""
    counts, chances = [np.zeros((0, len(COUNTS)), np.int64)], [np.zeros(0)]
    for _, _, data, offsets in tx.blocks(*tx.utf8(column)):
        b = tx.Block(data, offsets)
        rows = [b.n_words, b.word_chars, b.count(b"#*$%&|<>"), b.duplicate_lines()[1], b.repeated_words(8)]
        counts.append(np.stack(rows, 1))
        if model is None:
            chances.append(np.ones(b.n))
            continue
        single, pair = _word_slots(b)
        first, end = b.bounds[:-1], b.bounds[1:]
        n = np.maximum(b.n_words, 1)
        margin = model.intercept + tx.sums_between(model.weights[:_PART][single], first, end) / n
        double = np.where(pair >= 0, model.weights[_PART : 2 * _PART][pair], 0)
        margin += tx.sums_between(double, first, end) / np.maximum(b.n_words - 1, 1)
        for k, (slots, first, end) in enumerate(_grams(b)):
            table = model.weights[(2 + k) * _PART : (3 + k) * _PART]
            margin += tx.sums_between(table[slots], first, end) / np.maximum(end - first, 1)
        chances.append(model.probability(margin))
    return np.concatenate(counts), np.concatenate(chances)


def _verdict(counts: np.ndarray, chance: np.ndarray, keep_at: float, min_words: int, max_repeat_percent: int):
    """Which texts fail the base rules, and which are kept."""
    n, repeat = counts[:, 0], counts[:, 4]
    failed = (n < min_words) | (100 * repeat > max_repeat_percent * n)
    return failed, ~failed & (chance >= keep_at)


def judge(
    docs: DataFrame,
    model: QualityModel | None,
    key: str = "doc_id",
    text: str = "text",
    keep_at: float = 0.5,
    min_words: int = 20,
    max_repeat_percent: int = 30,
) -> DataFrame:
    """(key, counts, probability, base_failed, kept) for each row of ``docs``."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, chance = measured(batch.column("text"), model)
            failed, kept = _verdict(counts, chance, keep_at, min_words, max_repeat_percent)
            columns = [pa.array(np.ascontiguousarray(counts[:, k])) for k in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *columns, pa.array(chance), pa.array(failed), pa.array(kept)],
                names=["key", *COUNTS, "probability", "base_failed", "kept"],
            )

    schema = T.StructType(
        [rows.schema["key"], *[T.StructField(c, T.LongType()) for c in COUNTS]]
        + [T.StructField("probability", T.DoubleType()), T.StructField("base_failed", T.BooleanType())]
        + [T.StructField("kept", T.BooleanType())]
    )
    return in_batches(rows, judged, schema).withColumnRenamed("key", key)


def keep(docs: DataFrame, model: QualityModel | None, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns, in one pass."""
    options = {"keep_at": 0.5, "min_words": 20, "max_repeat_percent": 30} | options

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, chance = measured(batch.column(text), model)
            yield batch.filter(pa.array(_verdict(counts, chance, **options)[1]))

    return in_batches(docs, kept, docs.schema)
