"""Quality of documents by multiple-instance learning with gated attention.

A document is a bag of passages of a fixed number of words. Each passage is encoded by a learned layer over surface
features; gated attention, learned from the documents' labels alone, says how much each passage counts; the score is
that of the weighted sum of the encoded passages.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.llm.files import stored
from tonearm.llm.words import text_chunks

PASSAGE_WORDS = 64
#: Labelled documents that a model is fitted on at most.
FIT_DOCUMENTS = 4000
FOLDS = 5
SYMBOLS = b"#*$%&<>"
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123))
DIGITS = bytes(range(48, 58))
HIGH = bytes(range(128, 256))
FEATURES = 15


def count_of(text: bytes, signs: bytes) -> int:
    return len(text) - len(text.translate(None, signs))


def passages(text: bytes) -> list[list[float]]:
    """Features of each passage of a whole text; a text without words has one passage of zeros."""
    words = text.split()
    if not words:
        return [[0.0] * FEATURES]
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeated_lines = 1 - len(set(lines)) / len(lines)
    length = np.log1p(len(words))
    found = []
    for first in range(0, len(words), PASSAGE_WORDS):
        own = words[first : first + PASSAGE_WORDS]
        n, joined = len(own), b" ".join(own)
        size = len(joined)
        letters = max(1, count_of(joined, LETTERS))
        counts = Counter(own)
        pairs = len(set(zip(own, own[1:]))) / (n - 1) if n > 1 else 1.0
        found.append(
            [
                len(counts) / n,
                max(counts.values()) / n,
                1 - pairs,
                joined.count(b"|") / n,
                count_of(joined, SYMBOLS) / n,
                count_of(joined, UPPER) / letters,
                joined.count(b"!") / n,
                count_of(joined, DIGITS) / size,
                size / n / 10,
                joined.count(b".") / n,
                joined.count(b",") / n,
                count_of(joined, HIGH) / size,
                n / PASSAGE_WORDS,
                repeated_lines,
                length,
            ]
        )
    return found


def segments(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First passage of each document, and the document of each passage."""
    return np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class AttentionModel:
    """Parameters: encoder, the two branches of the gate, attention and score."""

    mean: np.ndarray
    scale: np.ndarray
    parts: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, features: np.ndarray, width: int = 16, seed: int = 5) -> AttentionModel:
        random = np.random.default_rng(seed)
        model = cls(features.mean(axis=0), features.std(axis=0) + 1e-6)
        shapes = {"encode": (features.shape[1], width), "shift": (width,), "value": (width, width), "gate": (width, width)}
        shapes |= {"attend": (width,), "score": (width,), "bias": (1,)}
        for name, shape in shapes.items():
            model.parts[name] = random.normal(0, 1 / np.sqrt(shape[0]), shape) if name not in ("shift", "bias") else np.zeros(shape)
        return model

    def forward(self, features: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
        p = self.parts
        firsts, owner = segments(sizes)
        x = (features - self.mean) / self.scale
        h = np.tanh(x @ p["encode"] + p["shift"])
        value, gate = np.tanh(h @ p["value"]), sigmoid(h @ p["gate"])
        weight = (value * gate) @ p["attend"]
        weight = np.exp(weight - np.maximum.reduceat(weight, firsts)[owner])
        weight /= np.add.reduceat(weight, firsts)[owner]
        bag = np.add.reduceat(weight[:, None] * h, firsts)
        score = sigmoid(bag @ p["score"] + p["bias"][0])
        return {"x": x, "h": h, "value": value, "gate": gate, "weight": weight, "bag": bag, "score": score, "owner": owner, "firsts": firsts}

    def gradients(self, features: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss."""
        p, f = self.parts, self.forward(features, sizes)
        x, h, value, gate, weight, owner = (f[k] for k in ("x", "h", "value", "gate", "weight", "owner"))
        error = (f["score"] - labels) / len(labels)
        d_bag = (error[:, None] * p["score"])[owner]
        d_weight = (d_bag * h).sum(axis=1)
        d_logit = weight * (d_weight - np.add.reduceat(weight * d_weight, f["firsts"])[owner])
        d_both = d_logit[:, None] * p["attend"]
        d_value, d_gate = d_both * gate * (1 - value**2), d_both * value * gate * (1 - gate)
        d_h = weight[:, None] * d_bag + d_value @ p["value"].T + d_gate @ p["gate"].T
        d_in = d_h * (1 - h**2)
        return {
            "encode": x.T @ d_in,
            "shift": d_in.sum(axis=0),
            "value": h.T @ d_value,
            "gate": h.T @ d_gate,
            "attend": (value * gate).T @ d_logit,
            "score": f["bag"].T @ error,
            "bias": np.array([error.sum()]),
        }

    def fit(self, features: np.ndarray, sizes: np.ndarray, labels: np.ndarray, steps: int = 400, rate: float = 0.02) -> AttentionModel:
        """Adam on all bags, with a little weight decay."""
        first = {k: np.zeros_like(v) for k, v in self.parts.items()}
        second = {k: np.zeros_like(v) for k, v in self.parts.items()}
        for step in range(1, steps + 1):
            for name, slope in self.gradients(features, sizes, labels).items():
                slope = slope + 1e-4 * self.parts[name]
                first[name] = 0.9 * first[name] + 0.1 * slope
                second[name] = 0.999 * second[name] + 0.001 * slope**2
                ahead = first[name] / (1 - 0.9**step)
                self.parts[name] = self.parts[name] - rate * ahead / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
        return self

    def score(self, features: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return self.forward(features, sizes)["score"]


def in_fold(doc_id: str = "doc_id"):
    """Whether a document is held out of learning."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, limit: int = FIT_DOCUMENTS) -> AttentionModel:
    """A model fitted on at most ``limit`` labelled documents that are not held out, those with the smallest hashes.

    Only these documents' texts are read for it; their passages' features, not their texts, reach the driver. A doc_id
    with several labels counts as what most of them say. Without labels every document scores the same.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~in_fold())
    known = known.groupBy(F.col("doc_id").cast("long").alias("labelled_id")).agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    chosen = stored(known.orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(limit), "fit-labels")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(chosen, F.col("doc_id") == F.col("labelled_id")).select("text", "label", F.xxhash64("text").alias("tie"), "doc_id")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_chunks(batch.column(0)):
                found = [np.asarray(passages(t), np.float32).tobytes() for t in texts]
                rest = [batch.column(k).slice(first, len(texts)) for k in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), *rest], ["features", "label", "tie", "doc_id"])

    found = rows.mapInArrow(encode, "features binary, label double, tie long, doc_id long")
    # repeated rows of a doc_id could exceed the limit
    table = found.orderBy("doc_id", "tie").limit(limit).toArrow()
    if not table.num_rows:
        return AttentionModel.new(np.zeros((1, FEATURES)))
    bags = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in table["features"].to_pylist()]
    features = np.concatenate(bags).astype(np.float64)
    sizes = np.array([len(b) for b in bags])
    return AttentionModel.new(features).fit(features, sizes, table["label"].to_numpy())


def score_documents(docs: DataFrame, model: AttentionModel) -> DataFrame:
    """doc_id, score from 0 to 1, the number of passages and the largest attention, one row per row of ``docs``.

    The score depends on the text alone; a null text counts as empty and has a score too. No documents give no rows.
    """
    names = ["doc_id", "score", "n_passages", "most_attention"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_chunks(batch.column(1)):
                bags = [passages(t) for t in texts]
                sizes = np.array([len(b) for b in bags])
                made = model.forward(np.array([p for b in bags for p in b], np.float64), sizes)
                columns = [
                    batch.column(0).slice(first, len(texts)),
                    pa.array(made["score"]),
                    pa.array(sizes.astype(np.int64)),
                    pa.array(np.maximum.reduceat(made["weight"], made["firsts"])),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id long, score double, n_passages long, most_attention double")
