"""Toxicity: a word classifier that is held to say the same of every group of people.

A text is its distinct words and word beginnings (letters only, A-Z lower-cased), hashed, each with the
logarithm of its count. A calibrated logistic regression learns from a bounded sample of labelled
texts, over the features that differ most between the classes.

Counterfactuals: each sampled text gets a twin in which its identity terms are swapped for others of
their group; a text that names nobody gets one mention put in. The fit adds ``strength`` times the
mean squared change of the score between a text and its twin to the loss, so a term's own weight
goes towards that of the others of its group, and of no mention at all, even if the labels link it
with toxicity. Scoring reads whole texts in Arrow batches.

Results for odd input: a NULL text counts as empty; an empty text has the score of no evidence. Without
labels, or with one class only, every score is the share of label 1 (0 without labels). Labels other
than 0 and 1 and NULL keys are not learned from; repeated rows are learned and scored each; texts of any
length are read whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.llm import text as tx
from tabml.llm.frames import in_batches, sample_of
from tabml.llm.linear import calibrated, sigmoid

# Terms that name groups of people; a swap stays inside a line.
IDENTITY = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "sikhs"),
    ("black", "white", "asian", "latino", "african", "european", "indigenous"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("woman", "man", "girl", "boy"),
    ("women", "men", "girls", "boys"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("deaf", "blind", "disabled", "autistic"),
    ("muslime", "christen", "juden", "hindus", "buddhisten"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas"),
    ("mujeres", "hombres", "niñas", "niños"),
)
BITS = 17
BEGINNINGS = (4, 5, 6)  # bytes of a word
SIZE = (1 + len(BEGINNINGS)) << BITS
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True


@dataclass
class ToxicityModel:
    weights: np.ndarray  # SIZE numbers, most of them 0
    intercept: float
    slope: float
    shift: float

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * (evidence + self.intercept) + self.shift)


class Swapper:
    """Texts with their identity terms exchanged; which term comes instead follows from the text alone."""

    def __init__(self, groups: tuple[tuple[str, ...], ...]):
        self.groups = groups
        self.others = {term: [t for t in g if t != term] for g in groups for term in g}
        terms = sorted(self.others, key=len, reverse=True)
        self.pattern = re.compile(rf"\b(?:{'|'.join(map(re.escape, terms))})\b", re.IGNORECASE)

    def twin(self, text: str) -> str:
        draw, turn = zlib.crc32(text.encode()), 0

        def other(match: re.Match) -> str:
            nonlocal turn
            turn += 1
            choice = self.others[match.group().lower()]
            return choice[(draw + turn) % len(choice)]

        changed = self.pattern.sub(other, text)
        if turn:
            return changed
        group = self.groups[draw % len(self.groups)]
        term = group[draw // len(self.groups) % len(group)]
        gaps = [0, *(m.end() for m in re.finditer(r"\s+", text))]
        at = gaps[draw % len(gaps)]
        return f"{text[:at]}{term} {text[at:]}"


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slot and text number of every word and word beginning of a block."""
    data = tx.LOWER[data]
    starts, ends = tx.runs(_LETTER[data], offsets)
    text = np.searchsorted(offsets, starts, "right") - 1
    slots = [tx.segment_hashes(data, starts, ends) >> np.uint64(64 - BITS)]
    numbers = [text]
    for k, width in enumerate(BEGINNINGS, 1):
        long = ends - starts >= width
        found = tx.segment_hashes(data, starts[long], starts[long] + width) >> np.uint64(64 - BITS)
        slots.append(found + np.uint64(k << BITS))
        numbers.append(text[long])
    return np.concatenate(slots).astype(np.int64), np.concatenate(numbers)


def _counted(slots: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, slot) with the value of their count."""
    pairs, counts = np.unique(numbers * SIZE + slots, return_counts=True)
    return pairs // SIZE, pairs % SIZE, np.log2(1.0 + counts)


def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slots and values of each text."""
    for _, _, data, offsets in tx.blocks(*tx.utf8(column)):
        numbers, slots, values = _counted(*features(data, offsets))
        cuts = np.searchsorted(numbers, np.arange(len(offsets)))
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield slots[a:b], values[a:b]


def _change(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The entries in which ``b`` differs from ``a``."""
    slots, where = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    change = np.bincount(where, np.concatenate([-a[1], b[1]]), len(slots))
    return slots[change != 0], change[change != 0]


def _chosen(slots: list[np.ndarray], y: np.ndarray, most: int, least_z: float) -> np.ndarray:
    """The features whose log odds ratio between the classes is surest, ``most`` of them."""
    seen = [np.bincount(np.concatenate([s for s, c in zip(slots, y) if c == k] or [np.zeros(0, int)]), minlength=SIZE) for k in (0, 1)]
    n0, n1 = (y == 0).sum(), (y == 1).sum()
    odds = np.log((seen[1] + 0.5) / (n1 - seen[1] + 0.5)) - np.log((seen[0] + 0.5) / (n0 - seen[0] + 0.5))
    z = np.abs(odds) / np.sqrt(1 / (seen[1] + 0.5) + 1 / (seen[0] + 0.5))
    z[seen[0] + seen[1] < 2] = 0
    best = np.argsort(-z, kind="stable")[:most]
    return np.sort(best[z[best] >= least_z])


def _dense(rows: list[tuple[np.ndarray, np.ndarray]], chosen: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), len(chosen)))
    for i, (slots, values) in enumerate(rows if len(chosen) else ()):
        at = np.searchsorted(chosen, slots)
        hit = (at < len(chosen)) & (chosen[np.minimum(at, len(chosen) - 1)] == slots)
        out[i, at[hit]] = values[hit]
    return out


def regularised(x: np.ndarray, y: np.ndarray, weight: np.ndarray, change: np.ndarray, strength: float, ridge: float = 1e-3):
    """Weights and intercept of the logistic regression with the counterfactual penalty (Newton)."""
    n, size = x.shape
    x1 = np.hstack([x, np.ones((n, 1))])
    d1 = np.hstack([change, np.zeros((n, 1))])
    fixed = strength * (d1.T @ d1) / n + ridge * np.diag([1.0] * size + [1e-3])
    weight, w = weight / weight.sum(), np.zeros(size + 1)

    def loss(w: np.ndarray) -> float:
        m = x1 @ w
        return float((weight * (np.logaddexp(0, m) - y * m)).sum() + w @ fixed @ w / 2)

    now = loss(w)
    for _ in range(50):
        p = sigmoid(x1 @ w)
        gradient = x1.T @ (weight * (p - y)) + fixed @ w
        step = np.linalg.solve((x1 * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x1 + fixed, gradient)
        size_of = 1.0
        while (then := loss(w - size_of * step)) > now and size_of > 1e-4:
            size_of /= 2
        w, before, now = w - size_of * step, now, then
        if before - now < 1e-10:
            break
    return w[:-1], float(w[-1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = 1500,
    key: str = "doc_id",
    text: str = "text",
    groups: tuple[tuple[str, ...], ...] = IDENTITY,
    strength: float = 1.0,
    most: int = 600,
    least_z: float = 3.0,
) -> ToxicityModel:
    """Learn from ``docs`` (key, text) and ``labels`` (key, label 0 or 1).

    ``per_class`` bounds the sample: about so many texts of each label. Every fourth is kept
    for calibration, weighted back to its share of the labels. ``most`` bounds the features.
    """
    rows = labels.select(F.col(key).alias("key"), F.col("label").cast("int").alias("label"))
    rows = rows.filter(F.col("key").isNotNull() & F.col("label").isin(0, 1))
    # The sample is bounded by the parameter, so it may be broadcast.
    picks = F.broadcast(sample_of(rows, "label", per_class))
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(picks, "key")
    texts = texts.select(F.col("key").cast("string").alias("key"), "label", "weight", "text")

    def profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        swapper = Swapper(groups)
        for batch in batches:
            plain = batch.column("text")
            twins = pa.array([swapper.twin(t or "") for t in plain.to_pylist()], pa.string())
            own, others = list(_vectors(plain)), list(_vectors(twins))
            changes = [_change(a, b) for a, b in zip(own, others)]
            columns = [
                pa.array([np.ascontiguousarray(p[k], kind).tobytes() for p in pairs], pa.binary())
                for pairs in (own, changes)
                for k, kind in ((0, np.uint32), (1, np.float32))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("key", "label", "weight")] + columns,
                names=["key", "label", "weight", "slots", "values", "other", "change"],
            )

    found = in_batches(
        texts, profiles, "key string, label int, weight double, slots binary, values binary, other binary, change binary"
    ).collect()
    found = sorted(found, key=lambda r: (r["label"], zlib.crc32(r["key"].encode()), r["key"], bytes(r["slots"]), bytes(r["values"])))
    y = np.array([r["label"] for r in found], float)
    weight = np.array([r["weight"] for r in found], float)
    if not 0 < y.sum() < len(y):
        share = float(y.mean()) if len(y) else 0.0
        return ToxicityModel(np.zeros(SIZE, np.float32), 0.0, 1.0, 40.0 if share else -40.0)

    def pairs(slots: str, values: str) -> list[tuple[np.ndarray, np.ndarray]]:
        return [(np.frombuffer(r[slots], np.uint32).astype(np.int64), np.frombuffer(r[values], np.float32)) for r in found]

    own, changes = pairs("slots", "values"), pairs("other", "change")
    place = np.concatenate([np.arange((y == 0).sum()), np.arange((y == 1).sum())])
    held = place % 4 == 3
    if not (y[held] == 1).any() or not (y[held] == 0).any():
        held = np.zeros(len(y), bool)
    train = np.flatnonzero(~held)
    chosen = _chosen([own[i][0] for i in train], y[train], most, least_z)
    x, d = _dense(own, chosen), _dense(changes, chosen)
    even = np.where(y == 1, 0.5 / y[train].sum(), 0.5 / (1 - y[train]).sum())
    w, intercept = regularised(x[train], y[train], even[train], d[train], strength)
    use = held if held.any() else np.ones(len(y), bool)
    slope, shift = calibrated((x @ w + intercept)[use], y[use], weight[use])
    table = np.zeros(SIZE, np.float32)
    table[chosen] = w
    del found, own, changes, x, d
    tx.release()
    return ToxicityModel(table, intercept, slope, shift)


def evidence(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Sum of weight times value over the features of each text."""
    out = [np.zeros(0)]
    for first, end, data, offsets in tx.blocks(*tx.utf8(column)):
        slots, numbers = features(data, offsets)
        told = weights[slots] != 0
        numbers, slots, values = _counted(slots[told], numbers[told])
        out.append(np.bincount(numbers, weights[slots] * values, end - first))
    return np.concatenate(out)


def score(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) for each row of ``docs``."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chance = model.probability(evidence(batch.column("text"), model.weights))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(chance)], names=["key", "score"])

    schema = T.StructType([rows.schema["key"], T.StructField("score", T.DoubleType())])
    return in_batches(rows, scored, schema).withColumnRenamed("key", key)
