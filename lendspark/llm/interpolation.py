"""Language-model scoring by deleted interpolation of bigram, unigram and uniform estimates.

Nothing is kept by word on the driver: counts stay spread over the cluster and grow with the corpus.

1. Texts are packed into pieces of about 8 MB (compressed, stored once): the unit that asks for counts.
2. Each piece sends its distinct unigrams and bigrams with their counts to shards of the hash space. A shard
   adds them up and answers every piece with the totals of what it asked for, in the same order, so that
   keys are not sent back. A frequent word is one key of each piece: no shard is hot.
3. Training rows are split: 1 in 9 is the deleted part. From its pieces and the counts of the others comes
   a table (bucket of the context's frequency, estimates in steps of 1/8 bit) -> tokens; expectation-
   maximisation on that table gives the mixture weights of each bucket.
4. Every piece scores its documents with the counts of all training rows and these weights.

Defined cases. NULL text counts as empty: one token, the end. The first token's context is the document's
start. A context that was never seen has no bigram weight. Without training rows every count is 0, the
base score is 0, and the model is the uniform distribution over one token. Repeated rows are trained on
and scored one by one. A NULL id counts as the empty id in the split.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.llm.frames import keyed, remainder, stored, text_bytes
from lendspark.llm.words import blocks, mix, word_hashes

PIECE_BYTES = 8 << 20
#: Text bytes for each shard of the counts; so a shard's keys fit a task at any corpus size.
SHARD_BYTES = 16 << 20
TEST, BASE, DELETED = 0, 1, 2
END, START = np.uint64(0x656E64), np.uint64(0x7374617274)
STEPS_PER_BIT = 8
ROUNDS = 100
LEAST = 1e-6  # weight of the uniform estimate, so that every probability is positive


class Model(NamedTuple):
    weights: np.ndarray  # buckets x (bigram, unigram, uniform)
    tokens: int
    words: int


def _press(values: np.ndarray) -> bytes:
    """Bytes of the integers by significance, compressed: sorted hashes share their upper bytes, counts are small."""
    flat = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.compress(flat.tobytes(), 1)


def _open(blob: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).reshape(-1)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, made = TaskContext.get().partitionId(), 0
    held: dict[int, list] = {TEST: [], BASE: [], DELETED: []}
    size = dict.fromkeys(held, 0)

    def piece(role: int) -> pa.RecordBatch:
        nonlocal made
        rows, held[role], size[role] = held[role], [], 0
        made += 1
        blob = zstandard.compress(b"".join(t for _, t in rows), 3)
        ids = [[i or 0 for i, _ in rows]]  # lists without NULL, which would turn into floats; NULL ids are marked beside them
        columns = [[task << 32 | made], [role], ids, [[i is None for i, _ in rows]], [[len(t) for _, t in rows]], [blob]]
        kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["piece", "role", "doc_ids", "no_id", "sizes", "blob"])

    for batch in batches:
        for i, role, text in zip(batch.column("doc_id").to_pylist(), batch.column("role").to_pylist(), text_bytes(batch.column("text")), strict=True):
            if held[role] and size[role] + len(text) > PIECE_BYTES:
                yield piece(role)
            held[role].append((i, text))
            size[role] += len(text) + 64
    for role, rows in held.items():
        if rows:
            yield piece(role)


def tokens_of(sizes: list[int], blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, its context, bounds) of a piece; every document ends with END and begins after START."""
    raw = zstandard.decompress(blob)
    ends = np.cumsum(sizes)
    texts = [raw[e - s : e] for s, e in zip(sizes, ends, strict=True)]
    parts, counts = [], []
    for _, block in blocks(texts):
        words, bounds = word_hashes(block)
        parts.append(np.insert(words, bounds[1:], END))
        counts.append(np.diff(bounds) + 1)
    tokens = np.concatenate(parts)
    bounds = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
    context = np.empty_like(tokens)
    context[1:] = tokens[:-1]
    context[bounds[:-1]] = START
    return tokens, context, bounds


def _pairs(tokens: np.ndarray, context: np.ndarray) -> np.ndarray:
    return mix(context + mix(tokens, 3), 9)


def _ask(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = (np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.zeros(1, np.uint64)
        for batch in batches:
            for row in batch.to_pylist():
                tokens, context, _ = tokens_of(row["sizes"], row["blob"])
                kinds = [np.unique(k, return_counts=True) for k in (tokens, _pairs(tokens, context))]
                cuts = [np.append(np.searchsorted(k, edges), len(k)) for k, _ in kinds]
                out = []
                for s in range(1 << bits):
                    spans = [slice(c[s], c[s + 1]) for c in cuts]
                    if any(x.stop > x.start for x in spans):
                        out.append((s, row["piece"], row["role"], *[_press(v) for (k, n), x in zip(kinds, spans, strict=True) for v in (k[x], n[x].astype(np.uint32))]))
                columns = list(zip(*out, strict=True))
                types = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["shard", "piece", "role", "words", "word_n", "pairs", "pair_n"])

    return run


def _answer(key, frame):
    """Totals for each piece of what it asked of this shard, and one row (piece -1) of the shard's own sums."""
    import pandas as pd

    roles = frame["role"].to_numpy()
    found = []
    for keys, counts in (("words", "word_n"), ("pairs", "pair_n")):
        asked = [_open(b, np.uint64) for b in frame[keys]]
        n = np.concatenate([_open(b, np.uint32) for b in frame[counts]]).astype(np.int64)
        sizes = [len(a) for a in asked]
        of, role = np.concatenate(asked), np.repeat(roles, sizes)
        distinct, place = np.unique(of, return_inverse=True)
        sums = [np.bincount(place[role == r], weights=n[role == r], minlength=len(distinct)).astype(np.uint64) for r in (BASE, DELETED)]
        cuts = np.cumsum([0, *sizes])
        found.append((sums, [[_press(s[place[a:b]]) for s in sums] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]))
    both = found[0][0][0] + found[0][0][1]
    rows = [(int(p), key[0], int(r), *w, *b, 0, 0, 0) for p, r, w, b in zip(frame["piece"], roles, found[0][1], found[1][1], strict=True)]
    rows.append((-1, key[0], -1, b"", b"", b"", b"", int(both.sum()), int(found[0][0][0].sum()), int((both > 0).sum())))
    return pd.DataFrame(rows, columns=["piece", "shard", "role", "w1", "w2", "p1", "p2", "n_tokens", "n_base", "n_words"])


_ANSWER = "piece long, shard int, role int, w1 binary, w2 binary, p1 binary, p2 binary, n_tokens long, n_base long, n_words long"


class Counted(NamedTuple):
    """A piece with the counts it asked for: of each token, its context and the pair."""

    bounds: np.ndarray
    base: list[np.ndarray]  # token, context, pair, from the base part
    all: list[np.ndarray]


def _counted(piece, answers) -> Counted:
    tokens, context, bounds = tokens_of(list(piece["sizes"]), piece["blob"])
    answers = answers.sort_values("shard")
    words, at = np.unique(tokens, return_inverse=True)
    _, pair_at = np.unique(_pairs(tokens, context), return_inverse=True)
    joined = {c: np.concatenate([_open(b, np.uint64) for b in answers[c]]).astype(np.int64) for c in ("w1", "w2", "p1", "p2")}
    end = int(np.searchsorted(words, END))  # as many starts as ends
    out = []
    for w, p in ((joined["w1"], joined["p1"]), (joined["w1"] + joined["w2"], joined["p1"] + joined["p2"])):
        count = w[at]
        before = np.empty_like(count)
        before[1:] = count[:-1]
        before[bounds[:-1]] = w[end]
        out.append([count, before, p[pair_at]])
    return Counted(bounds, *out)


def bucket(context: np.ndarray) -> np.ndarray:
    """0 for a context that was never seen, then one for each doubling of its count."""
    return np.ceil(np.log2(context + 1.0)).astype(np.int64)


def _steps(share: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(share > 0, 1 + np.round(-STEPS_PER_BIT * np.log2(np.where(share > 0, share, 1))), 0).astype(np.int64)


def _cells(n_base: int):
    def run(key, pieces, answers):
        import pandas as pd

        token, context, pair = _counted(pieces.iloc[0], answers).base
        cell = np.stack([bucket(context), _steps(pair / np.maximum(context, 1)), _steps(token / max(n_base, 1))])
        kinds, n = np.unique(cell, axis=1, return_counts=True)
        return pd.DataFrame({"bucket": kinds[0], "pair": kinds[1], "word": kinds[2], "n": n})

    return run


def learn_weights(cells: np.ndarray, n_words: int, rounds: int = ROUNDS) -> np.ndarray:
    """Mixture weights of each bucket by expectation-maximisation; ``cells`` has rows (bucket, pair, word, n)."""
    share = np.where(cells[:, 1:3] > 0, 2.0 ** (-(cells[:, 1:3] - 1) / STEPS_PER_BIT), 0.0)
    estimates = np.column_stack([share, np.full(len(cells), 1 / (n_words + 1))])
    buckets = 66
    weights = np.tile([0.4, 0.5, 0.1], (buckets, 1))
    weights[0] = [0.0, 0.8, 0.2]
    last = None
    for b in range(buckets):
        here = cells[:, 0] == b
        if here.any():
            w, e, n = weights[b], estimates[here], cells[here, 3]
            for _ in range(rounds):
                part = e * w
                total = part.sum(axis=1)
                w = (part / total[:, None] * n[:, None]).sum(axis=0) / n.sum()
                w = np.maximum(w, [0.0 if b == 0 else LEAST, LEAST, LEAST])
                w /= w.sum()
            last = weights[b] = w
        elif last is not None and b > 1:
            weights[b] = last  # no deleted token had such a context: as the next rarer one
            if last[0] == 0:
                weights[b] = weights[b] * 0.5 + np.array([0.4, 0.5, 0.1]) * 0.5
    return weights


def _score(model):
    def run(key, pieces, answers):
        import pandas as pd

        piece = pieces.iloc[0]
        weights, n, v = model.value
        bounds, _, (token, context, pair) = _counted(piece, answers)
        base = np.log10((token + 0.1) / (n + 0.1 * (v + 1)))
        w = weights[bucket(context)]
        p = w[:, 0] * pair / np.maximum(context, 1) + w[:, 1] * token / max(n, 1) + w[:, 2] / (v + 1)
        p = p if n else np.ones(len(p))
        return pd.DataFrame({
            "doc_id": pd.arrays.IntegerArray(np.array(piece["doc_ids"], dtype=np.int64), np.array(piece["no_id"], dtype=bool)),
            "held_out": piece["role"] == TEST,
            "n_tokens": np.diff(bounds),
            "n_known": np.add.reduceat((token > 0).astype(np.int64), bounds[:-1]),
            "train_tokens": n,
            "base_score": np.add.reduceat(base, bounds[:-1]),
            "score": np.add.reduceat(np.log10(p), bounds[:-1]),
        })

    return run


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs`` (doc_id, text).

    Trained on rows whose crc32(doc_id) mod 10 is not 0; of these, remainder 1 is the deleted part for the weights.
    """
    spark = docs.sparkSession
    role = F.when(remainder(10) == 0, TEST).when(remainder(10) == 1, DELETED).otherwise(BASE).cast("int")
    rows = keyed(docs, "text", role.alias("role"))
    pieces = stored(rows.mapInArrow(_pack, "piece long, role int, doc_ids array<long>, no_id array<boolean>, sizes array<long>, blob binary"), "pieces")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")  # pieces are large
    size = pieces.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    bits = max(3, math.ceil(math.log2(max(1, size / SHARD_BYTES))))
    asked = pieces.select("piece", "role", "sizes", "blob").mapInArrow(_ask(bits), "shard int, piece long, role int, words binary, word_n binary, pairs binary, pair_n binary")
    answers = stored(asked.groupBy("shard").applyInPandas(_answer, _ANSWER), "counts")
    sums = answers.where("piece = -1").agg(F.sum("n_tokens"), F.sum("n_base"), F.sum("n_words")).first()
    n, n_base, v = [x or 0 for x in sums]
    by_piece = answers.where("piece >= 0").select("piece", "shard", "role", "w1", "w2", "p1", "p2")
    part = pieces.where(F.col("role") == DELETED).select("piece", "sizes", "blob")
    cells = (
        part.groupBy("piece").cogroup(by_piece.where(F.col("role") == DELETED).groupBy("piece"))
        .applyInPandas(_cells(n_base), "bucket long, pair long, word long, n long")
        .groupBy("bucket", "pair", "word").agg(F.sum("n").alias("n")).collect()
    )
    weights = learn_weights(np.array([tuple(c) for c in cells], dtype=np.int64).reshape(-1, 4), v)
    model = spark.sparkContext.broadcast(Model(weights, n, v))
    return (
        pieces.groupBy("piece").cogroup(by_piece.groupBy("piece"))
        .applyInPandas(_score(model), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    )
