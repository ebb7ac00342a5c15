"""Ranked lexical search: a sharded index of compressed blocks, searched by Block-Max MaxScore.

**Index.** Each task turns its documents into shards of about ``SHARD_TERMS`` terms. A shard has a row for each
block of up to ``BLOCK`` postings of a term (distance to the last document, frequency; variable-length bytes) and a
header with the ids and lengths of its documents. What a posting adds to a score depends on its frequency, on the
length of its document and on two totals of the corpus, so a block keeps those of its (frequency, length) pairs that no
other pair dominates: whatever the totals are later, one of them gives the block's maximum exactly. Shards can
therefore be added without writing the old ones again.

**Search.** Items come in blocks of ``ITEMS``; their terms pick the rows of the index. In a shard, an item's lists are
ordered by their greatest addition. Those that together stay below the tenth score so far are not essential: documents
found in them alone cannot get in. The shard's documents are taken range by range, most promising first. Essential
lists give candidates with partial scores; maxima of the blocks of the other lists at the candidate reject most of
them before any block is decompressed, and again after each list. Shards return their ten best, which are merged.

Terms are held as 64-bit hashes. Everything else is exact integer arithmetic, so ties are ties.

Defined cases. NULL, empty texts and texts without terms are indexed with no terms and are not found. An item with no
term in the corpus has no rows; rows that repeat an ``item_id`` (NULL too) are one item with the terms of all. Rows
of ``docs`` that repeat an id are documents of their own: each can be listed. Equal scores go by ascending id, NULL
ids first. An empty table on either side gives no rows. A very long text makes its shard longer, not less complete.
Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendspark.llm.frames import stored, text_bytes
from lendspark.llm.words import CASED, blocks, word_hashes

SHARD_TERMS = 4_000_000
BLOCK = 128
#: Postings of one batch of rows; only the order of a shard's postings is made for the whole shard at once.
PIECE = 1 << 16
#: Documents of a range.
RANGE = 1024
#: Items of one pass over the index.
ITEMS = 2048

#: Bytes that are no part of a term; A-Z count as a-z. Fixed values of the query.
OUTSIDE = np.zeros(256, dtype=bool)
OUTSIDE[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
FOLDED = CASED.copy()
FOLDED[65:91] = FOLDED[97:123]

INDEX = pa.schema([
    ("shard", pa.string()), ("term", pa.int64()), ("block", pa.int32()), ("n", pa.int32()), ("last", pa.int32()),
    ("best_tf", pa.list_(pa.int32())), ("best_n", pa.list_(pa.int64())), ("postings", pa.binary()),
    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
])
INDEX_COLUMNS = (
    "shard string, term long, block int, n int, last int, best_tf array<int>, best_n array<long>, postings binary, "
    "doc_ids array<long>, lengths array<long>"
)


def term_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(texts, OUTSIDE, FOLDED)


def to_varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bytes of each value): seven bits a byte, the upper bit set on all but the last."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), dtype=np.int64)
    for bits in (7, 14, 21, 28, 35, 42, 49, 56, 63):
        size += values >= np.uint64(1 << bits)
    ends = np.cumsum(size)
    nth = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
    part = (np.repeat(values, size) >> (nth * 7).astype(np.uint64)).astype(np.uint8) & 127
    more = nth < np.repeat(size, size) - 1
    return part | (more.astype(np.uint8) << 7), size


def from_varints(raw: bytes) -> np.ndarray:
    got = np.frombuffer(raw, dtype=np.uint8)
    ends = np.flatnonzero(got < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])
    nth = np.arange(len(got)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((got & 127).astype(np.int64) << (7 * nth), starts) if len(got) else np.zeros(0, np.int64)


def _lists(starts: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)).astype(np.int32)), pa.array(values, kind))


def shard_rows(name: str, ids: pa.Array, counts: np.ndarray, terms: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows of one shard: documents ``ids`` with ``counts`` terms each, ``terms`` in order."""
    empty = pa.nulls(1, pa.int64())
    header = [pa.array([name]), empty, pa.nulls(1, pa.int32()), pa.array([len(ids)], pa.int32()), pa.nulls(1, pa.int32()),
              pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.list_(pa.int64())), pa.nulls(1, pa.binary()),
              pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64()))]
    yield pa.RecordBatch.from_arrays(header, schema=INDEX)
    if not len(terms):
        return
    doc = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    order = np.argsort(terms, kind="stable")
    term, doc = terms[order], doc[order]
    del terms, order
    new = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])]))
    tf = np.diff(np.append(new, len(term))).astype(np.int32)
    term, doc = term[new], doc[new]
    del new
    start = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
    held = np.diff(np.append(start, len(term)))
    # blocks: every BLOCK-th posting of a term starts one
    per_term = -(-held // BLOCK)
    nth = np.arange(per_term.sum()) - np.repeat(np.cumsum(per_term) - per_term, per_term)
    first = np.repeat(start, per_term) + nth * BLOCK
    cuts = np.unique(np.append(np.searchsorted(first, np.arange(0, len(term), PIECE)), len(first)))
    bounds = np.append(first, len(term))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        some = slice(bounds[a], bounds[b])
        yield _block_rows(name, term[first[a:b]], nth[a:b], first[a:b] - bounds[a], doc[some], tf[some], counts)


def _block_rows(name: str, term: np.ndarray, nth: np.ndarray, first: np.ndarray, doc: np.ndarray, tf: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """A row for each block: its ``term`` and place ``nth``; its postings start at ``first`` of ``doc`` and ``tf``."""
    doc, tf = doc.astype(np.int64), tf.astype(np.int64)
    size = np.diff(np.append(first, len(doc)))
    owner = np.repeat(np.arange(len(first)), size)
    last = doc[first + size - 1]
    both = np.empty(2 * len(doc), dtype=np.int64)
    both[0::2], both[1::2] = last[owner] - doc, tf
    raw, width = to_varints(both)
    ends = np.cumsum(width)[2 * (first + size) - 1]
    # pairs that no other of the block dominates: by falling frequency, each shorter than all before it
    length = counts[doc]
    by = np.lexsort((length, -tf, owner))
    low = length[by] + (len(first) - owner[by]) * np.int64(counts.max() + 1)
    best = np.concatenate([[True], low[1:] < np.minimum.accumulate(low)[:-1]])
    kept = by[best]
    front = np.searchsorted(owner[kept], np.arange(len(first)))
    postings = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes())])
    none = pa.nulls(len(first), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays(
        [pa.array([name] * len(first)), pa.array(term.view(np.int64)), pa.array(nth.astype(np.int32)), pa.array(size.astype(np.int32)),
         pa.array(last.astype(np.int32)), _lists(front, tf[kept].astype(np.int32), pa.int32()), _lists(front, length[kept], pa.int64()), postings, none, none],
        schema=INDEX,
    )


def _shards(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        ids, counts, terms, held = [], [], [], 0

        def flush():
            nonlocal made, held
            name = f"{task}-{made}"
            rows = shard_rows(name, pa.concat_arrays(ids), np.concatenate(counts).astype(np.int64), np.concatenate(terms))
            made, held = made + 1, 0
            for x in (ids, counts, terms):
                x.clear()
            return rows

        for batch in batches:
            for start, texts in blocks(text_bytes(batch.column("text"))):
                hashes, bounds = term_hashes(texts)
                ids.append(batch.column("doc_id").slice(start, len(texts)))
                counts.append(np.diff(bounds))
                terms.append(hashes)
                held += len(hashes)
                if held >= most:
                    yield from flush()
        if ids:
            yield from flush()

    return run


def build_index(docs: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """The index of ``docs`` (doc_id, text), stored. Shards are named by task, so a retried task writes the same ones."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(texts.mapInArrow(_shards(shard_terms), INDEX_COLUMNS), "index")


def totals(index: DataFrame) -> tuple[int, int]:
    """(documents with a term, their terms with repeats)."""
    some = "aggregate(lengths, 0L, (s, x) -> s + x)"
    row = index.where("term IS NULL").agg(F.sum(F.expr("size(filter(lengths, x -> x > 0))")), F.sum(F.expr(some))).first()
    return int(row[0] or 0), int(row[1] or 0)


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class Scoring:
    """Additions of a posting without its term's weight: 64-bit integers, division rounds down."""

    def __init__(self, n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms

    def __call__(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 10 + (90 * n.astype(np.int64) * self.n_docs) // self.n_terms
        return (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 8 * m)


class Shard:
    """The rows of one shard that some items of a block need."""

    def __init__(self, table: pa.Table, scoring: Scoring):
        table = table.combine_chunks()
        header = table.filter(pc.is_null(table["term"]))
        rows = table.filter(pc.is_valid(table["term"])).sort_by([("term", "ascending"), ("block", "ascending")]).combine_chunks()
        self.doc_ids = header["doc_ids"].combine_chunks().flatten()
        self.lengths = header["lengths"].combine_chunks().flatten().to_numpy()
        self.scoring = scoring
        self.last = rows["last"].to_numpy().astype(np.int64)
        self.postings = rows["postings"].combine_chunks()
        term = rows["term"].to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
        self.blocks = {int(term[a]): (int(a), int(b)) for a, b in zip(starts, np.append(starts, len(term))[1:], strict=True)}
        if len(term):
            tf, n = rows["best_tf"].combine_chunks(), rows["best_n"].combine_chunks()
            fronts = tf.offsets.to_numpy()[:-1] - tf.offsets.to_numpy()[0]
            self.most = np.maximum.reduceat(scoring(tf.flatten().to_numpy(), n.flatten().to_numpy()), fronts)
        self.ranges = -(-len(self.lengths) // RANGE)
        self.reached: dict[int, np.ndarray] = {}
        self.decoded: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.decompressed = 0

    def read(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, additions without weight); each block is decompressed once for all items."""
        if block not in self.decoded:
            both = from_varints(self.postings[block].as_py())
            doc = self.last[block] - both[0::2]
            self.decoded[block] = doc, self.scoring(both[1::2], self.lengths[doc])
            self.decompressed += 1
        return self.decoded[block]

    def reach(self, a: int, b: int) -> np.ndarray:
        """The greatest maximum of the list's blocks that lie in each range of documents."""
        if a not in self.reached:
            per = np.zeros(self.ranges, dtype=np.int64)
            lo = np.concatenate([[0], (self.last[a : b - 1] + 1) // RANGE])  # a block may begin where the one before it ends
            for most, x, y in zip(self.most[a:b].tolist(), lo.tolist(), (self.last[a:b] // RANGE).tolist(), strict=True):
                np.maximum(per[x : y + 1], most, out=per[x : y + 1])
            self.reached[a] = per
        return self.reached[a]

    def best(self, weights: dict[int, int], k: int) -> list[tuple[int, int | None]]:
        """The k best (score, doc_id) for the terms and their weights."""
        held = [(w, *self.blocks[t]) for t, w in weights.items() if t in self.blocks and w > 0]
        if not held:
            return []
        held.sort(key=lambda x: x[0] * int(self.most[x[1] : x[2]].max()))
        ceiling = np.cumsum([w * int(self.most[a:b].max()) for w, a, b in held])
        bound = sum(w * self.reach(a, b) for w, a, b in held)  # of every document of a range
        top: list[tuple] = []  # (-score, id as a key, document), best first
        least = 1  # a document with a lower score cannot get in
        for r in np.argsort(-bound, kind="stable").tolist():
            if bound[r] < least:
                break
            top = self._range(held, ceiling, r * RANGE, min((r + 1) * RANGE, len(self.lengths)), least, top, k)
            if len(top) == k:
                least = max(1, -top[-1][0])
        return [(-s, self.doc_ids[d].as_py()) for s, _, d in top]

    def _range(self, held, ceiling, lo: int, hi: int, least: int, top: list, k: int) -> list:
        essential = int(np.searchsorted(ceiling, least))  # the lists before it add up to less than ``least``
        score = np.zeros(hi - lo, dtype=np.int64)
        for w, a, b in held[essential:]:
            first = a + int(np.searchsorted(self.last[a:b], lo))
            for block in range(first, b):
                doc, add = self.read(block)
                x, y = np.searchsorted(doc, (lo, hi))
                score[doc[x:y] - lo] += w * add[x:y]
                if self.last[block] >= hi - 1:
                    break
        found = np.flatnonzero(score)
        others = held[:essential]
        if others and len(found):
            at = [a + np.searchsorted(self.last[a:b], found + lo) for _, a, b in others]
            bounds = np.stack([np.where(x < b, w * self.most[np.minimum(x, b - 1)], 0) for x, (w, _, b) in zip(at, others, strict=True)])
            left = np.cumsum(bounds, axis=0)  # what the lists up to each can still add
            alive = score[found] + left[-1] >= least
            for i in reversed(range(len(others))):
                w, _, b = others[i]
                alive &= score[found] + left[i] >= least
                here = np.flatnonzero(alive & (at[i] < b))
                for block in np.unique(at[i][here]).tolist():
                    doc, add = self.read(block)
                    wanted = here[at[i][here] == block]
                    x = np.minimum(np.searchsorted(doc, found[wanted] + lo), len(doc) - 1)
                    hit = doc[x] == found[wanted] + lo
                    score[found[wanted[hit]]] += w * add[x[hit]]
            found = found[alive]
        found = found[score[found] >= least]
        if len(found) > k:  # all that tie with the k-th stay: ids decide below
            found = found[score[found] >= np.partition(score[found], len(found) - k)[len(found) - k]]
        key = lambda d: (self.doc_ids[d].is_valid, self.doc_ids[d].as_py())
        more = [(-int(score[d]), key(int(d) + lo), int(d) + lo) for d in found]
        return sorted(top + more)[:k]


RANKED = pa.schema([("item_id", pa.int64()), ("score", pa.int64()), ("doc_id", pa.int64())])


def _search(items, weights: dict[int, int], scoring: Scoring, k: int):
    def run(table: pa.Table) -> pa.Table:
        shard = Shard(table, scoring)
        out = [(item, s, d) for item, terms in items.value for s, d in shard.best({t: weights[t] for t in terms if t in weights}, k)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*out, strict=True)) or [(), (), ()], RANKED, strict=True)], schema=RANKED)

    return run


def _item_terms(texts: pd.Series) -> pd.Series:
    hashes, bounds = term_hashes([(t or "").encode() for t in texts])
    return pd.Series([np.unique(hashes[a:b]).view(np.int64).tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)])


def ranked(index: DataFrame, items: DataFrame, k: int = 10, at_once: int = ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of the index for each row of ``items`` (item_id, text)."""
    spark = index.sparkSession
    terms_of = F.pandas_udf(_item_terms, "array<long>")
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(terms_of("text")).alias("term")).distinct()
    asked = stored(asked.groupBy("item_id").agg(F.collect_list("term").alias("terms")), "items")
    n_docs, n_terms = totals(index)
    number = asked.count()
    found = spark.createDataFrame([], "item_id long, score long, doc_id long")
    # items are dealt to passes by a hash, so a pass holds about ``at_once`` of them
    passes = max(1, -(-number // at_once)) if n_terms else 0
    for i in range(passes):
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == i).collect()
        wanted = spark.createDataFrame([(t,) for t in {t for r in rows for t in r["terms"]}], "term long")
        postings = index.join(F.broadcast(wanted), "term", "left_semi")
        frequency = {r["term"]: r["df"] for r in postings.groupBy("term").agg(F.sum("n").alias("df")).collect()}
        weights = {t: weight(n_docs, df) for t, df in frequency.items()}
        held = spark.sparkContext.broadcast([(r["item_id"], r["terms"]) for r in rows])
        needed = postings.select(index.columns).unionByName(index.where("term IS NULL"))
        found = found.unionByName(needed.groupBy("shard").applyInArrow(_search(held, weights, Scoring(n_docs, n_terms), k), "item_id long, score long, doc_id long"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc("doc_id"))
    return found.select("item_id", F.row_number().over(order).alias("rank"), "doc_id", "score").where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    return ranked(build_index(docs), items, k)
