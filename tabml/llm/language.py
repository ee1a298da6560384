"""Language identification by error-correcting output codes.

Each language has a codeword of bits; for each bit a binary classifier over hashed
byte n-grams of the lower-cased text predicts on which side the text lies. Decoding
weighs every bit's logistic loss by the bit's reliability and takes the nearest
codeword; ``ambiguous`` marks texts whose two nearest codewords lie close together.

Fitting uses a bounded sample: about ``per_language`` labelled texts of each language
(the parameter of ``fit``). Two thirds train the bits, one third calibrates
them. Prediction reads whole texts in Arrow batches.

Results for odd input: a NULL text, or one without a letter, is ``und`` with score 0;
without any labelled text everything is ``und``; with one learned language every
other text gets it with score 1. Each input row gives one row, repeated or not; columns
other than the key and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.llm import text as tx
from tabml.llm.frames import in_batches, sample_of
from tabml.llm.linear import calibrated

UNKNOWN = "und"
WIDTHS = (2, 3)  # bytes per gram
BITS = 15  # slots per width, as a power of two


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray  # languages x bits, +1 or -1
    tables: np.ndarray  # bits x widths x slots: log odds of each gram
    slope: np.ndarray
    intercept: np.ndarray
    reliability: np.ndarray


def codewords(n: int) -> np.ndarray:
    """n codewords of +1/-1: every split of the languages up to seven, random splits beyond."""
    if n < 2:
        return np.zeros((n, 0))
    if n <= 7:
        masks = np.arange(1, 2 ** (n - 1))
        bits = (masks[None, :] >> np.arange(n)[:, None]) & 1
        return np.where(bits, 1.0, -1.0)
    rng = np.random.default_rng(11)
    length = int(np.ceil(8 * np.log2(n)))
    best, gap = None, -1
    for _ in range(30):
        code = np.where(rng.random((n, length)) < 0.5, -1.0, 1.0)
        code = code[:, np.abs(code.sum(0)) < n]  # a bit has to have both sides
        nearest = int(((code.shape[1] - code @ code.T) / 2 + 1e9 * np.eye(n)).min())
        if nearest > gap:
            best, gap = code, nearest
    return best


def _lowered(text: Column) -> Column:
    return F.lower(text)


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gram counts of each sampled text as packed arrays."""
    for batch in batches:
        slots, counts = [], []
        for _, _, data, offsets in tx.blocks(*tx.utf8(batch.column("text"))):
            parts = [tx.gram_slots(data, w, BITS) + np.uint32(k << BITS) for k, w in enumerate(WIDTHS)]
            edges = [tx.gram_bounds(offsets, w) for w in WIDTHS]
            for i in range(len(offsets) - 1):
                s, c = tx.slot_counts(np.concatenate([p[a[i] : b[i]] for p, (a, b) in zip(parts, edges)]))
                slots.append(s.astype(np.uint32).tobytes())
                counts.append(c.astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("lang"), pa.array(slots, pa.binary()), pa.array(counts, pa.binary())],
            names=["key", "lang", "slots", "counts"],
        )


def fit(labelled: DataFrame, per_language: int = 400) -> LanguageModel:
    """Learn from rows (key, text, lang); rows without a language are left out.

    ``per_language`` bounds the sample: about so many texts of each language.
    """
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    picks = sample_of(rows.select(F.col("key").cast("string").alias("key"), "lang"), "lang", per_language)
    # The sample is bounded by the parameter, so its keys may be broadcast.
    chosen = F.broadcast(picks.select("key", "lang").distinct())
    texts = rows.select(F.col("key").cast("string").alias("key"), "lang", _lowered(F.col("text")).alias("text"))
    texts = texts.join(chosen, ["key", "lang"], "left_semi").select("key", "lang", "text")
    found = in_batches(texts, _profiles, "key string, lang string, slots binary, counts binary").collect()
    found = sorted(found, key=lambda r: (r["lang"], r["key"], bytes(r["slots"]), bytes(r["counts"])))
    return _learned(
        [r["lang"] for r in found],
        [np.frombuffer(r["slots"], np.uint32) for r in found],
        [np.frombuffer(r["counts"], np.float32).astype(float) for r in found],
    )


def _learned(langs: list[str], slots: list[np.ndarray], counts: list[np.ndarray]) -> LanguageModel:
    languages = sorted(set(langs))
    number = {lang: i for i, lang in enumerate(languages)}
    label = np.array([number[lang] for lang in langs], int)
    code, size = codewords(len(languages)), len(WIDTHS) << BITS
    place = np.zeros(len(label), int)  # the how-many-th text of its language
    for i in range(len(languages)):
        place[label == i] = np.arange((label == i).sum())
    # Every third text calibrates, where a language has three.
    held = (place % 3 == 2) if len(label) else np.zeros(0, bool)
    grams = np.zeros((len(languages), size))
    for lab, s, c, out in zip(label, slots, counts, held):
        if not out and len(c):
            grams[lab, s] += c / c.sum()
    grams = grams.reshape(len(languages), len(WIDTHS), 1 << BITS)
    share = grams / np.maximum(grams.sum(-1, keepdims=True), 1e-12)
    n_bits = code.shape[1]
    tables = np.zeros((n_bits, len(WIDTHS), 1 << BITS), np.float32)
    for b in range(n_bits):
        sides = [share[code[:, b] == side].mean(0) + 1e-6 for side in (1, -1)]
        tables[b] = np.log(sides[0] / sides[1])
    flat = tables.reshape(n_bits, size)
    margins = np.array([[(flat[b, s] * c).sum() / max(c.sum(), 1) for b in range(n_bits)] for s, c in zip(slots, counts)])
    use = held if held.any() else np.ones(len(label), bool)
    slope, intercept, good = np.ones(n_bits), np.zeros(n_bits), np.ones(n_bits)
    for b in range(n_bits):
        y = (code[label[use], b] > 0).astype(int)
        weight = 1 / np.bincount(label[use], minlength=len(languages))[label[use]]
        slope[b], intercept[b] = calibrated(margins[use, b], y, weight)
        right = (margins[use, b] * slope[b] + intercept[b] > 0) == (y == 1)
        good[b] = max(2 * np.average(right, weights=weight) - 1, 0.01)
    return LanguageModel(languages, code, tables, slope, intercept, good)


def decoded(model: LanguageModel, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest codeword, its share of the likelihood, and the gap to the second nearest."""
    n = len(margins)
    if len(model.languages) < 2:
        return np.zeros(n, int), np.ones(n), np.full(n, np.inf)
    m = margins * model.slope + model.intercept
    loss = np.logaddexp(0, -m[:, None, :] * model.code[None, :, :])
    far = (loss * model.reliability).sum(-1)
    order = np.argsort(far, axis=1, kind="stable")
    near = np.take_along_axis(far, order[:, :2], 1)
    like = np.exp(near[:, :1] - far)
    return order[:, 0], 1 / like.sum(1), near[:, 1] - near[:, 0]


def predict(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text", close: float = 1.0) -> DataFrame:
    """(key, lang_pred, score, ambiguous) for each row of ``docs``.

    ``close``: texts whose nearest codewords differ by less are ambiguous.
    """
    rows = docs.select(
        F.col(key).alias("key"),
        _lowered(F.col(text)).alias("text"),
        F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in batches:
            margins = np.zeros((batch.num_rows, model.code.shape[1]))
            for i, j, data, offsets in tx.blocks(*tx.utf8(batch.column("text"))):
                total = np.zeros(j - i)
                for k, width in enumerate(WIDTHS):
                    slots, (first, end) = tx.gram_slots(data, width, BITS), tx.gram_bounds(offsets, width)
                    total += end - first
                    for b in range(margins.shape[1]):
                        margins[i:j, b] += tx.sums_between(model.tables[b, k][slots], first, end)
                margins[i:j] /= np.maximum(total, 1)[:, None]
            best, score, gap = decoded(model, margins)
            known = np.asarray(batch.column("letters").to_pylist(), bool) & bool(model.languages)
            pred = names[np.where(known, best, len(model.languages))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(pred, pa.string()),
                    pa.array(np.where(known, score, 0.0)),
                    pa.array(known & (gap < close)),
                ],
                names=["key", "lang_pred", "score", "ambiguous"],
            )

    schema = T.StructType(
        [rows.schema["key"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
        + [T.StructField("ambiguous", T.BooleanType())]
    )
    return in_batches(rows, scored, schema).withColumnRenamed("key", key)
