"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Features of a document: its distinct words, word pairs, and pairs with one word between them, hashed to
2**20 places, each counted once. FTRL-proximal keeps a learning rate for every coordinate and an L1 penalty
sets most weights to zero, so the model is a short list (place, weight) that is broadcast.

The fit takes a bounded sample: of each label the ``sample`` rows that come first in hash order (16,384 rows
in all), shown ``EPOCHS`` times in one task. The intercept is then moved to the label counts of all labelled
rows. Scoring is one pass over whole texts without a shuffle.

Defined cases. NULL or empty text: no feature, the score of the intercept. Several labels for one id: toxic
if any is. Several texts for one id: all are scored, the one that comes first in hash order is learned from. A NULL
label or id is not learned from, and neither is a label without a document. Labels or labelled documents of one kind
only, or none: every score is the labels' smoothed share. Very long texts are scored whole, in a block of their own.
An empty table gives no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.llm.frames import keyed, remainder, returned_memory, stored, text_bytes
from lendspark.llm.words import blocks, mix, word_hashes

BITS = 20
#: Labelled rows of each label that the fit sees at most.
SAMPLE = 8192
EPOCHS = 3
ALPHA, BETA, L1, L2 = 2.0, 1.0, 5.0, 0.1


class Model(NamedTuple):
    places: np.ndarray
    weights: np.ndarray
    intercept: float


def features(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, text) of all words, pairs and skip-pairs, repeats included."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    shift = np.uint64(64 - BITS)
    parts, owners = [words >> shift], [owner]
    for gap in (1, 2):
        if len(words) > gap:
            same = owner[gap:] == owner[:-gap]
            parts.append(mix(words[:-gap][same] + mix(words[gap:][same], gap), 40 + gap) >> shift)
            owners.append(owner[gap:][same])
    return np.concatenate(parts).astype(np.int64), np.concatenate(owners)


def fit_ftrl(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """(weights, intercept) after ``epochs`` passes in a seeded order; features of a row are distinct places."""
    z, n, bias = np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0
    rng = np.random.default_rng(5)
    bias_n = 0.0

    def weights(i):
        zi = z[i]
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(epochs):
        for r in rng.permutation(len(rows)):
            at, label = rows[r]
            w = weights(at)
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, bias + w.sum())))) - label
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
            bias_n += g * g
            bias -= g * ALPHA / (BETA + math.sqrt(bias_n))
    return weights(np.arange(1 << BITS)), bias


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, order = [], []
    for batch in batches:
        labels = batch.column("toxic").to_numpy()
        ids = batch.column("doc_id").to_numpy()
        for start, texts in blocks(text_bytes(batch.column("text"))):
            place, owner = features(*word_hashes(texts))
            by = np.argsort(owner, kind="stable")
            cuts = np.searchsorted(owner[by], np.arange(len(texts) + 1))
            for i in range(len(texts)):
                at = np.unique(place[by[cuts[i] : cuts[i + 1]]]).astype(np.int32)
                rows.append((at, int(labels[start + i])))
                order.append((int(ids[start + i]), len(at)))
    if len({label for _, label in rows}) < 2:
        return
    rows = [rows[i] for i in sorted(range(len(rows)), key=order.__getitem__)]  # the same fit however rows arrive
    w, bias = fit_ftrl(rows)
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_pydict({"place": [*at.tolist(), -1], "weight": [*w[at].tolist(), bias]}, schema=pa.schema([("place", pa.int64()), ("weight", pa.float64())]))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """From the documents (doc_id, text) that have a label (doc_id, toxic)."""
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    marked = stored(marked, "labels")
    counts = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    have = [counts.get(k, 0) for k in (0, 1)]
    share = (have[1] + 0.5) / (sum(have) + 1)
    constant = Model(np.zeros(0, np.int64), np.zeros(0), math.log(share / (1 - share)))
    if not all(have):
        return constant
    picked = [marked.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    chosen = F.broadcast(stored(picked[0].unionByName(picked[1]), "labelled-sample"))
    labelled = keyed(docs, "text").join(chosen, "doc_id")
    first = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first")
    rows = labelled.groupBy("doc_id", "toxic").agg(first).select("doc_id", "first.text", "toxic")
    learned = rows.coalesce(1).mapInArrow(returned_memory(_train), "place long, weight double").collect()
    if not learned:
        return constant
    w = {r["place"]: r["weight"] for r in learned}
    seen = [min(n, sample) for n in have]
    bias = w.pop(-1) + math.log(have[1] / have[0]) - math.log(seen[1] / seen[0])
    places = np.array(sorted(w), dtype=np.int64)
    return Model(places, np.array([w[p] for p in places.tolist()]), bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, weights, bias = shared.value
        table = np.zeros(1 << BITS)
        table[places] = weights
        for batch in batches:
            ids = batch.column("doc_id")
            for start, texts in blocks(text_bytes(batch.column("text"))):
                place, owner = features(*word_hashes(texts))
                hit = np.flatnonzero(table[place])
                once = np.unique(owner[hit] * (1 << BITS) + place[hit])
                total = bias + np.bincount(once >> BITS, weights=table[once & ((1 << BITS) - 1)], minlength=len(texts))
                yield pa.RecordBatch.from_arrays([ids.slice(start, len(texts)), pa.array(1 / (1 + np.exp(-np.clip(total, -500, 500))))], names=["doc_id", "score"])

    return keyed(docs, "text").mapInArrow(returned_memory(run), "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; learned from rows whose crc32(doc_id) mod 5 is not 0."""
    learn = remainder(5) != 0
    scored = score(docs, fit(docs.where(learn), labels.where(learn)))
    return scored.select("doc_id", (~learn).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
