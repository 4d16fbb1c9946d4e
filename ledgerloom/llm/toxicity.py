"""Toxicity scores from a factorization machine over hashed terms.

A document's terms are its words and the first letters of its longer words, hashed to ``SPACE`` slots, each counted
once. Besides a weight per slot the machine learns a short vector per slot; the product of two vectors is the weight
of the two terms occurring together, which a sum of weights alone cannot express.

Labelled rows are sampled by a hash of their id, at most ``per_class`` of each class and one row of each id, so the rows that meet on the
driver for training have a fixed bound; counts of the classes over all labelled rows weigh the sample back. Every slot
that a few documents have gets a weight and a vector, whether or not it depends on the label by itself: terms that are
harmless apart can be toxic together. Slots that do not (by a hypergeometric z-score) are held closer to zero. The model
has ``SPACE`` slots at most and is sent to the tasks that score. Scoring reads each text once and shuffles nothing.

Cases: a null or empty text has no terms and gets the score of the bias alone; a null id is never labelled; labels
that are null are ignored, and of several labels for an id the largest counts; repeated rows are scored again each
time; without labels of both classes nothing is learnt and every score is the share of toxic labels (0 if there are
none); columns other than ``doc_id`` and ``text`` are passed on by ``reject`` and not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

SPACE = 1 << 18
PREFIX = 4
EDGE = ".,;:!?\"'()[]{}<>|/\\*#%&$-_=+~`"
#: Bound of the training sample: labelled documents of each class.
PER_CLASS = 8000
FACTORS = 8
EPOCHS = 25
RATE = 0.1
L2 = 3e-4
#: For slots whose own count among toxic documents is within ``SURE`` standard deviations of chance.
L2_UNSURE = 0.1
SURE = 4.0
#: Documents of the sample that have to have a slot.
SUPPORT = 3
#: Standard deviation of the factors before training.
START = 0.01
THRESHOLD = 0.7
WORDS_KNOWN = 500_000


class Terms:
    """Slots of a text; words seen before are looked up, and the memory of them is bounded."""

    def __init__(self, wanted: dict[int, int] | None = None) -> None:
        self.wanted, self.known = wanted, {}

    def _slots(self, word: str) -> tuple[int, ...]:
        bare = word.strip(EDGE)
        if not bare:
            return ()
        slots = [zlib.crc32(bare.encode()) % SPACE]
        if len(bare) > PREFIX:
            slots.append(zlib.crc32(b"^" + bare[:PREFIX].encode()) % SPACE)
        if self.wanted is not None:
            slots = [self.wanted[s] for s in slots if s in self.wanted]
        return tuple(slots)

    def __call__(self, text: str) -> set[int]:
        if len(self.known) > WORDS_KNOWN:
            self.known.clear()
        known, found = self.known, set()
        for word in set(text.lower().split()):
            slots = known.get(word)
            if slots is None:
                slots = known[word] = self._slots(word)
            if slots:
                found.update(slots)
        return found


@dataclass
class Model:
    slots: np.ndarray
    weights: np.ndarray
    factors: np.ndarray
    bias: float

    def scorer(self):
        terms, weights, factors = Terms({int(s): i for i, s in enumerate(self.slots)}), self.weights, self.factors

        def score(text: str) -> float:
            raw, at = self.bias, sorted(terms(text))
            if at:
                vectors = factors[at]
                total = vectors.sum(0)
                raw += weights[at].sum() + 0.5 * float(total @ total - (vectors * vectors).sum())
            return float(1 / (1 + np.exp(-np.clip(raw, -30, 30))))

        return score


def screen(rows: list[np.ndarray], labels: np.ndarray, least: int = SUPPORT) -> np.ndarray:
    """Slots that ``least`` documents have; the label does not matter, as terms that say nothing apart can tell together."""
    slots, count = np.unique(np.concatenate(rows) if rows else np.zeros(0, np.int64), return_counts=True)
    return slots[count >= least]


def decay(rows: list[np.ndarray], labels: np.ndarray, n: int) -> np.ndarray:
    """L2 of each of ``n`` slots: ``L2`` for those that depend on the label by themselves, ``L2_UNSURE`` for the others."""
    flat, total, n1 = np.concatenate(rows), len(labels), labels.sum()
    count = np.bincount(flat, minlength=n)
    toxic = np.bincount(flat, np.repeat(labels, [len(r) for r in rows]), n)
    expected = count * n1 / total
    variance = expected * (1 - count / total) * (total - n1) / max(total - 1, 1)
    z = (np.abs(toxic - expected) - 0.5) / np.sqrt(np.maximum(variance, 1e-9))
    return np.where((z > SURE) & (count < total), L2, L2_UNSURE)


def train(rows: list[np.ndarray], labels: np.ndarray, class_weights: tuple[float, float], seed: int = 7) -> Model:
    """AdaGrad on the logistic loss. ``class_weights``: what a clean and a toxic row of the sample stand for."""
    slots = screen(rows, labels)
    index = np.full(SPACE, -1, np.int32)
    index[slots] = np.arange(len(slots))
    rows = [(at := index[r])[at >= 0] for r in rows]
    l2 = decay(rows, labels, len(slots))
    weigh = np.where(labels > 0, class_weights[1], class_weights[0])
    share = (weigh * labels).sum() / weigh.sum()
    weigh = weigh / weigh.mean()
    random = np.random.default_rng(seed)
    w, v = np.zeros(len(slots)), random.normal(0, START, (len(slots), FACTORS))
    bias = float(np.log(share / (1 - share)))
    seen_w, seen_v, seen_b = np.full(len(slots), 1e-6), np.full((len(slots), FACTORS), 1e-6), 1e-6
    every = rows
    sure = [r[l2[r] < L2_UNSURE] for r in rows]
    # first what slots tell by themselves, then all slots on what that leaves open
    for rows in [sure] * EPOCHS + [every] * EPOCHS:
        order = random.permutation(len(rows))
        for batch in np.array_split(order, max(1, len(order) // 128)):
            sizes = np.array([len(rows[i]) for i in batch])
            of, flat = np.repeat(np.arange(len(batch)), sizes), np.concatenate([rows[i] for i in batch])
            vectors = v[flat]
            total, filled = np.zeros((len(batch), FACTORS)), np.flatnonzero(sizes)
            if len(filled):
                total[filled] = np.add.reduceat(vectors, (np.cumsum(sizes) - sizes)[filled])
            squares = np.bincount(of, np.einsum("ij,ij->i", vectors, vectors), len(batch))
            raw = bias + np.bincount(of, w[flat], len(batch)) + 0.5 * ((total * total).sum(1) - squares)
            error = weigh[batch] * (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[batch])
            seen_b += error.sum() ** 2
            bias -= RATE * error.sum() / np.sqrt(seen_b)
            if not len(flat):
                continue
            by = np.argsort(flat, kind="stable")
            of, flat, vectors = of[by], flat[by], vectors[by]
            first = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
            used = flat[first]
            step = np.add.reduceat(error[of], first) + l2[used] * len(batch) * w[used]
            seen_w[used] += step * step
            w[used] -= RATE * step / np.sqrt(seen_w[used])
            pull = np.add.reduceat(error[of][:, None] * (total[of] - vectors), first) + (l2[used] * len(batch))[:, None] * v[used]
            seen_v[used] += pull * pull
            v[used] -= 0.3 * RATE * pull / np.sqrt(seen_v[used])
    return Model(slots, w, v, float(bias))


def held_out(doc_id: Column) -> Column:
    """True for the third of all ids that is never learnt from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Learns ``toxic`` from the labelled documents that are not held out."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if counts.get(0, 0) == 0 or counts.get(1, 0) == 0:
        share = counts.get(1, 0) / max(1, sum(counts.values()))
        return Model(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS)), float(np.log(max(share, 1e-12)) - np.log(max(1 - share, 1e-12))))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = known.where("toxic = 1").orderBy(*order).limit(per_class).unionByName(known.where("toxic = 0").orderBy(*order).limit(per_class))
    sample = sample.select(F.col("doc_id").alias("sampled_id"), "toxic")
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("sampled_id")).select("sampled_id", "toxic", F.struct(F.xxhash64("text").alias("version"), "text").alias("row"))
    # one row per id: a repeated id would break the bound and outweigh the others
    texts = texts.groupBy("sampled_id", "toxic").agg(F.min("row").alias("row")).select("toxic", "row.text")

    def slots(batches: Iterator) -> Iterator:
        import pyarrow as pa

        terms = Terms()
        for batch in batches:
            found = [sorted(terms(t or "")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], ["toxic", "slots"])

    rows = texts.mapInArrow(slots, "toxic int, slots array<int>").toArrow()
    toxic = rows.column("toxic").to_numpy().astype(float)
    lists = rows.column("slots").combine_chunks()
    ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy().astype(np.int64)
    features = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
    # a fixed order, whatever the partitioning
    order = sorted(range(len(features)), key=lambda i: (toxic[i], features[i].tobytes()))
    sampled = {c: max(1, int((toxic == c).sum())) for c in (0, 1)}
    if min((toxic == 0).sum(), (toxic == 1).sum()) == 0:
        share = counts[1] / (counts[0] + counts[1])
        return Model(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS)), float(np.log(share) - np.log(1 - share)))
    return train([features[i] for i in order], toxic[order], (counts[0] / sampled[0], counts[1] / sampled[1]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scorer = model.scorer()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([scorer(t or "") for t in batch.column(1).to_pylist()], pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, score double")


def reject(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs``, with all columns, without the rows that score ``threshold`` or more."""
    at = docs.columns.index("text")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scorer = model.scorer()
        for batch in batches:
            yield batch.filter(pa.array([scorer(t or "") < threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
