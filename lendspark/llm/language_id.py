"""Language ID by error-correcting output codes.

Every language gets a codeword of bits. One binary classifier for each bit, naive Bayes over hashed byte
2-, 3- and 4-grams, tells languages whose bit is 1 from those whose bit is 0. Counts of n-grams by language
are one aggregation over all training rows (no sample); its size is languages x 24,576. A text's codeword of
margins is decoded by loss weighting: the logistic loss of each bit's margin, weighted by the bit's own
separation on the training counts, is summed for each codeword, the least loss wins. ``ambiguous`` says
that the runner-up is nearly as good.

Defined cases. NULL text, or no letter: ``und`` with score 0, not ambiguous. NULL language: not learned
from. No training row: ``und`` for all. One language: score 1. Equal losses: the first by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.llm.frames import keyed, remainder
from lendspark.llm.words import blocks

DIMS = 8192  # of each n-gram length
LENGTHS = (2, 3, 4)
WIDTH = DIMS * len(LENGTHS)
#: Texts counted at once; a count matrix holds so many rows of WIDTH places.
ROWS = 128
AMBIGUOUS = 0.2

_MAP = np.full(256, 1, dtype=np.uint32)  # every byte that is no letter counts as a space
for _c in range(26):
    _MAP[65 + _c] = _MAP[97 + _c] = 2 + _c
_MAP[128:] = np.arange(28, 156)


class Model(NamedTuple):
    names: list[str]
    codes: np.ndarray  # languages x bits, -1 or 1
    weights: np.ndarray  # WIDTH x bits
    trust: np.ndarray  # bits


def gram_counts(texts: list[bytes]) -> np.ndarray:
    """Counts (texts x WIDTH) of hashed n-grams; grams do not cross texts."""
    raw = _MAP[np.frombuffer(b"  ".join([b"", *texts, b""]), dtype=np.uint8)]
    ends = np.cumsum([2 + len(t) for t in texts])
    owner = np.repeat(np.arange(len(texts)), [2 + len(t) for t in texts])
    m = int(ends[-1])
    out = np.zeros(len(texts) * WIDTH, dtype=np.float32)
    code = raw[:m].copy()
    for k, n in enumerate(LENGTHS):
        for j in range(1 if n == LENGTHS[0] else n - 1, n):
            code = code * np.uint32(0x9E3779B1) + raw[j : j + m] if len(raw) >= j + m else code * np.uint32(0x9E3779B1) + np.pad(raw, (0, j))[j : j + m]
        place = (code * np.uint32(0x85EBCA6B)) >> np.uint32(32 - 13)
        out += np.bincount(owner * WIDTH + (k * DIMS + place), minlength=len(out))
    return out.reshape(len(texts), WIDTH)


def grouped(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes | None]]]:
    """Texts of a batch by ROWS at most and about a megabyte."""
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    for start, part in blocks([t or b"" for t in texts]):
        for i in range(0, len(part), ROWS):
            yield start + i, texts[start + i : start + i + len(part[i : i + ROWS])]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for start, texts in grouped(batch):
            counts = gram_counts([t or b"" for t in texts])
            here = langs[start : start + len(texts)]
            for name in set(here):
                sums.setdefault(name, np.zeros(WIDTH))
                sums[name] += counts[here == name].sum(axis=0)
    yield pa.RecordBatch.from_pydict({"lang": list(sums), "counts": [s.tobytes() for s in sums.values()]}, schema=pa.schema([("lang", pa.string()), ("counts", pa.binary())]))


def _sum(key, frame):
    import pandas as pd

    total = np.zeros(WIDTH)
    for c in frame["counts"]:
        total += np.frombuffer(c)
    return pd.DataFrame({"lang": [key[0]], "counts": [total.tobytes()]})


def codewords(n: int) -> np.ndarray:
    """n codewords of -1 and 1: all splits of up to 4 languages, else the random code of the largest distance of 50 seeded ones."""
    if n <= 4:
        columns = [[1 if n - 1 == i or (c >> i) & 1 else -1 for i in range(n)] for c in range(2 ** (n - 1) - 1)]
        return np.array(columns, dtype=float).T.reshape(n, -1)
    bits = 8 * int(np.ceil(np.log2(n)))
    best, far = None, -1
    for seed in range(50):
        code = np.random.default_rng(seed).choice([-1.0, 1.0], (n, bits))
        code = code[:, np.abs(code.sum(axis=0)) < n]  # a bit needs both values
        gap = code.shape[1] - int((code @ code.T - 2 * bits * np.eye(n)).max())
        if gap > far:
            best, far = code, gap
    return best


def fit(docs: DataFrame) -> Model | None:
    """From all rows of ``docs`` (text, lang) that have both; None without any."""
    rows = keyed(docs, "text", F.col("lang").cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    sums = rows.select("text", "lang").mapInArrow(_count, "lang string, counts binary").groupBy("lang")
    found = sorted((r["lang"], r["counts"]) for r in sums.applyInPandas(_sum, "lang string, counts binary").collect())
    if not found:
        return None
    names = [f[0] for f in found]
    counts = np.array([np.frombuffer(f[1]) for f in found])
    shares = counts + 0.5
    shares /= shares.sum(axis=1, keepdims=True)  # every language weighs the same
    codes = codewords(len(names))
    logs = np.log(shares)
    weights, trust = np.zeros((WIDTH, codes.shape[1])), np.ones(codes.shape[1])
    for b in range(codes.shape[1]):
        one, zero = shares[codes[:, b] > 0].mean(axis=0), shares[codes[:, b] < 0].mean(axis=0)
        weights[:, b] = np.log(one / zero)
        margins = (np.exp(logs) @ weights[:, b]) * codes[:, b]  # what each language's own text gives on average
        trust[b] = max(margins.min(), 0.0)
    trust = trust / trust.mean() if trust.any() else np.ones(len(trust))
    return Model(names, codes, weights.astype(np.float32), trust)


def decode(margins: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the nearest codeword, score, ambiguous) for rows of margins."""
    if len(model.names) == 1:
        return np.zeros(len(margins), int), np.ones(len(margins)), np.zeros(len(margins), bool)
    loss = np.stack([(np.logaddexp(0, -margins * word) * model.trust).sum(axis=1) for word in model.codes], axis=1)
    share = np.exp(loss.min(axis=1, keepdims=True) - loss)
    share /= share.sum(axis=1, keepdims=True)
    ranked = np.sort(share, axis=1)
    return share.argmax(axis=1), ranked[:, -1], ranked[:, -1] - ranked[:, -2] < AMBIGUOUS


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) of every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            ids = batch.column("doc_id")
            for start, texts in grouped(batch):
                names, scores, unsure = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
                letters = [t is not None and any(map(str.isalpha, t.decode("utf-8", "replace"))) for t in texts]
                if model is not None:
                    counts = gram_counts([t or b"" for t in texts])
                    margins = counts @ model.weights
                    margins /= np.sqrt(np.maximum(counts.sum(axis=1, keepdims=True), 1))
                    best, share, doubt = decode(margins.astype(float), model)
                    names = [model.names[b] if ok else "und" for b, ok in zip(best, letters, strict=True)]
                    scores, unsure = np.where(letters, share, 0.0), doubt & np.array(letters)
                yield pa.RecordBatch.from_arrays([ids.slice(start, len(texts)), pa.array(names, pa.string()), pa.array(scores), pa.array(unsure)], names=["doc_id", "lang_pred", "score", "ambiguous"])

    return keyed(docs, "text").mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous; learned from rows whose crc32(doc_id) mod 5 is not 0."""
    held = remainder(5) == 0
    return predict(docs, fit(docs.where(~held))).select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")
