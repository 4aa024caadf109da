"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct hashes of its words, word pairs and pairs
with one word between (lower case, outer punctuation cut off). Training keeps
per coordinate the sum of adjusted gradients and of squared gradients; the
rate of a coordinate falls with its own gradients, and the L1 term keeps a
weight at zero until the evidence exceeds it, so few weights survive: a small
table that goes to every task. Scoring looks each feature up in it.

The classifier is fitted on about SAMPLE_ROWS labelled rows, chosen by a hash
of the id; scoring covers every whole text.

Edge cases. Null and empty texts have no features and get the bias' score. A
null id is in training's fold but has no label. A document with several
labels counts once for each. Without labels all scores are 0.5. Empty table:
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tally.llm.stage import fold
from tally.llm.textual import LOWER, U, mix, span_hashes, utf8_buffer, word_spans

#: Parameters: training rows, hash space, FTRL rates and penalties, passes.
SAMPLE_ROWS = 20_000
BITS = 22
ALPHA, BETA, L1, L2 = 1.0, 1.0, 6.0, 0.1
PASSES = 3
#: Bytes of text worked on at once.
SLICE_BYTES = 1 << 22
THRESHOLD = 0.3

# lower case, with punctuation as word separators
_PLAIN = LOWER.copy()
_PLAIN[list(b".,;:!?'\"()[]{}*#$%&|<>-_")] = 32


def grams(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, texts, slots, their texts) for slices of whole texts of about SLICE_BYTES;
    a slot comes once per occurrence."""
    raw, offsets = utf8_buffer(col)
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE_BYTES, "right")) - 1)
        plain = _PLAIN[raw[offsets[lo]:offsets[hi]]]
        start, end, first = word_spans(plain, offsets[lo:hi + 1] - offsets[lo])
        words = span_hashes(plain, start, end)
        text_of = np.repeat(np.arange(hi - lo), np.diff(first))
        parts, owners = [words], [text_of]
        for gap, salt in ((1, 0x51ED), (2, 0xA24B)):
            if len(words) > gap:
                same = text_of[gap:] == text_of[:-gap]
                parts.append(mix(words[:-gap][same] * U(3) + words[gap:][same] + U(salt)))
                owners.append(text_of[:-gap][same])
        yield lo, hi - lo, (np.concatenate(parts) >> U(64 - BITS)).astype(np.int64), np.concatenate(owners)
        lo = hi


def distinct(slots: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (text, slot) pairs, by text: (slots, texts)."""
    both = np.unique((owners << BITS) | slots)
    return both & ((1 << BITS) - 1), both >> BITS


class Ftrl:
    """Per-coordinate FTRL-proximal state; coordinate ``1 << BITS`` is the bias."""

    def __init__(self) -> None:
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        l1 = np.where(at == 1 << BITS, 0.0, L1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def fit(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(slots, weights) of the non-zero coordinates, learnt from (text, label, order).

    Features are made where the texts lie; the sample's rows then meet in one task, which learns in order.
    """

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, n, slots, owners in grams(batch.column("text")):
                slots, owners = distinct(slots, owners)
                cuts = pa.array(np.searchsorted(owners, np.arange(n + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(cuts, pa.array(slots.astype(np.int32))),
                                                  batch.column("label").slice(lo, n), batch.column("order").slice(lo, n)], names=["slots", "label", "order"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, np.ndarray, int]] = []
        for batch in batches:
            col = batch.column("slots")
            slots, offsets = col.values.to_numpy(), col.offsets.to_numpy()
            rows += [(o, slots[a:b].copy(), y) for o, y, a, b in zip(batch.column("order").to_pylist(), batch.column("label").to_pylist(), offsets[:-1], offsets[1:])]
        rows.sort(key=lambda r: (r[0], len(r[1]), r[2]))
        model = Ftrl()
        for _ in range(PASSES):
            for _, slots, y in rows:
                model.learn(np.append(slots.astype(np.int64), 1 << BITS), y)
        used = np.flatnonzero(model.n > 0)
        w = model.weights(used)
        keep = w != 0
        yield pa.RecordBatch.from_arrays([pa.array(used[keep]), pa.array(w[keep])], names=["slot", "weight"])

    made = texts.select("text", "label", "order").mapInArrow(features, "slots array<int>, label int, order long")
    got = made.repartition(1).mapInArrow(learn, "slot long, weight double").toPandas()
    got = got.sort_values("slot")
    return got["slot"].to_numpy(np.int64), got["weight"].to_numpy(float)


def training_rows(docs: DataFrame, labels: DataFrame, held_out: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``rows`` labelled training texts, the same on every run: those whose id hash is
    below the share that the count of labelled rows asks for."""
    able = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out).select(
        F.col("doc_id").alias("_label_id"), F.col("toxic").cast("int").alias("label"), F.xxhash64("doc_id", F.lit(7)).alias("order"))
    n = able.count()
    share = min(1.0, rows / n) if n else 1.0
    chosen = able.filter(F.col("order") / 2.0**64 + 0.5 < share)
    # at most about ``rows`` ids: small enough to send to every scan of the texts
    return docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_label_id")).select("text", "label", "order")


def score(docs: DataFrame, slots: np.ndarray, weights: np.ndarray) -> DataFrame:
    """One row per text: doc_id, score in [0, 1], n_weighted (its distinct features with a weight)."""
    model = docs.sparkSession.sparkContext.broadcast((slots, weights))  # 2 ** BITS entries at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, weights = model.value
        dense = np.zeros((1 << BITS) + 1)
        dense[slots] = weights
        known = dense != 0
        for batch in batches:
            total, hits = np.full(batch.num_rows, dense[-1]), np.zeros(batch.num_rows, np.int64)
            for lo, n, slot, owner in grams(batch.column("text")):
                # features without a weight add nothing, so only the others are made distinct
                hit = np.flatnonzero(known[slot])
                slot, owner = distinct(slot[hit], owner[hit])
                total[lo:lo + n] += np.bincount(owner, dense[slot], n)
                hits[lo:lo + n] = np.bincount(owner, minlength=n)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(1 / (1 + np.exp(-np.clip(total, -700, 700)))), pa.array(hits)],
                                             names=["doc_id", "score", "n_weighted"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, n_weighted long")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_weighted."""
    slots, weights = fit(training_rows(docs, labels, fold(F.col("doc_id"), 4)))
    scored = score(docs, slots, weights)
    return scored.select("doc_id", fold(F.col("doc_id"), 4).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_weighted")
