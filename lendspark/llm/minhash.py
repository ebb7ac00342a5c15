"""Document fingerprints by MinHash.

Shingles (five words) become 64-bit hashes; PERMUTATIONS universal hashes ``(a x + b) mod 2**64`` with odd a,
of which the upper 32 bits are compared, give one least value each. A fingerprint keeps 16 bits of every
least value. All of it is vectorised numpy inside Arrow batches. ``likeness`` is the share of equal places.

``near_duplicates`` joins bands of signatures in Spark: one row per set of shingles, all pairs of sets that
share a band (their number grows with the square of a band's members), Jaccard verified on whole sets, and
components of the verified links.

``edited_fingerprints`` pairs each document with the next one: one range shuffle by id, sorted; a task sees
the next row as it streams. Only the first and last row of each task are joined afterwards by id.

Defined cases. NULL text counts as empty; without words the one shingle is the empty one, so empty texts are
equal to each other. Fewer than five words: one shingle. Rows with equal ids follow each other in order of
their texts' hashes. NULL ids come last. A table of one row follows itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendspark.llm.components import components
from lendspark.llm.frames import keyed, stored, text_bytes
from lendspark.llm.words import blocks, distinct_by_text, mix, shingle_hashes, word_hashes

PERMUTATIONS = 64
BANDS = 16  # of 4 values: a pair of similarity 0.8 meets in one with probability 0.9998
SHINGLE = 5

_rng = np.random.default_rng(77)
_A = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
_CHUNK = 1 << 15


def signatures(texts: list[bytes], k: int = SHINGLE) -> np.ndarray:
    """(texts x PERMUTATIONS) of 16-bit values."""
    tokens, bounds = shingle_hashes(*word_hashes(texts), k)
    n = np.diff(bounds)
    if not n.all():  # a text without words has the shingle 0
        tokens = np.insert(tokens, bounds[:-1][n == 0], np.uint64(0))
        bounds = np.concatenate([[0], np.cumsum(np.maximum(n, 1))])
    out = np.empty((len(texts), PERMUTATIONS), dtype=np.uint32)
    for p in range(PERMUTATIONS):
        values = ((tokens * _A[p] + _B[p]) >> np.uint64(32)).astype(np.uint32)
        out[:, p] = np.minimum.reduceat(values, bounds[:-1])
    return (out & np.uint32(0xFFFF)).astype(">u2")


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint binary) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for start, texts in blocks(text_bytes(batch.column("text"))):
                marks = [s.tobytes() for s in signatures(texts, k)]
                yield pa.RecordBatch.from_arrays([ids.slice(start, len(texts)), pa.array(marks, pa.binary())], names=["doc_id", "fingerprint"])

    return keyed(docs, "text").mapInArrow(run, "doc_id long, fingerprint binary")


def near_duplicates(docs: DataFrame, percent: int = 80, k: int = SHINGLE) -> DataFrame:
    """(doc_id, component_id, n_links): documents linked by a band and a Jaccard similarity of percent or more.

    ``n_links`` is the number of other documents linked with this one, copies included. An id with several
    texts is one document of a component and has the links of each of its texts.
    """
    rows = stored(keyed(docs, "text").mapInArrow(_marks(k), "doc_id long, n int, s1 long, s2 long, fingerprint binary"), "fingerprints")
    rows = rows.where("n > 0 AND doc_id IS NOT NULL").distinct()
    equal = rows.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.min("fingerprint").alias("fingerprint"))
    equal = stored(equal.withColumn("node", F.struct("id", "s1", "s2")), "equal-sets")
    pairs = stored(_band_pairs(equal, percent), "pairs")
    links = stored(_verified(docs, pairs, percent, k), "near-links")
    of = stored(rows.join(equal.select("n", "s1", "s2", "node", "copies"), ["n", "s1", "s2"]).select("doc_id", "node", "copies"), "nodes")
    texts = of.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z")
    several = of.join(texts, "doc_id").select("a", F.col("node").alias("b")).where("a <> b")
    member = components(links.unionByName(several)).select(F.col("id").alias("node"), F.col("component.id").alias("component"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(equal.select(F.col("node").alias("b"), "copies"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("near"))
    known = of.join(member, "node", "left").join(near, "node", "left").groupBy(F.col("doc_id").alias("id")).agg(
        F.min(F.coalesce("component", "node.id")).alias("component"), F.sum(F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links")
    )
    return keyed(docs).join(known, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", F.coalesce("component", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")
    )


def _band_pairs(equal: DataFrame, percent: int) -> DataFrame:
    """(a, b) of all sets that share a band and whose sizes allow the similarity."""
    size = 2 * PERMUTATIONS // BANDS
    band = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.substring("fingerprint", i * size + 1, F.lit(size))))
    members = stored(equal.select("node", "n", band.alias("band", "value")), "bands")
    left, right = (members.select("band", "value", F.col("node").alias(x), F.col("n").alias(f"n_{x}")) for x in "ab")
    near = f"a < b AND 100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"
    return left.join(right, ["band", "value"]).where(near).select("a", "b").distinct()


def _marks(k: int):
    """Number of shingles, two sums of their hashes and the fingerprint of each row; equal sets are equal in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for start, texts in blocks(text_bytes(batch.column("text"))):
                n, s1, s2, _, _ = _sets(texts, k)
                prints = [s.tobytes() for s in signatures(texts, k)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, len(texts)), *map(pa.array, (n, s1, s2)), pa.array(prints, pa.binary())],
                    names=["doc_id", "n", "s1", "s2", "fingerprint"],
                )

    return run


def _sets(texts: list[bytes], k: int) -> tuple[np.ndarray, ...]:
    sets, bounds = distinct_by_text(*shingle_hashes(*word_hashes(texts), k))
    marks = []
    for salt in (11, 12):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(sets, salt), dtype=np.uint64)])
        marks.append((sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64))
    return np.diff(bounds).astype(np.int32), *marks, sets, bounds


def _verified(docs: DataFrame, pairs: DataFrame, percent: int, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in blocks(text_bytes(batch.column("text"))):
                _, s1, s2, sets, bounds = _sets(texts, k)
                lists = [sets[a:b].view(np.int64) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, len(texts)), pa.array(s1), pa.array(s2), pa.array(lists, pa.list_(pa.int64()))],
                    names=["id", "s1", "s2", "tokens"],
                )

    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = keyed(docs, "text").join(nodes.select(F.col("node.id").alias("id")).distinct(), F.col("doc_id") == F.col("id"), "left_semi")
    found = texts.mapInArrow(run, "id long, s1 long, s2 long, tokens array<long>").select(F.struct("id", "s1", "s2").alias("node"), "tokens")
    sets = stored(found.join(nodes, "node", "left_semi").dropDuplicates(["node"]), "pair-sets")
    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    both = both.select("a", "b", F.expr("size(x) + size(y)").alias("n"), F.expr("size(array_intersect(x, y))").alias("i"))
    return both.where(f"100 * i >= {percent} * (n - i)").select("a", "b")


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many, or all, of the next document."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_OUT = "doc_id long, tie long, edge string, text string, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order: each is paired with the next one. The last row of a task is left open; the first is repeated as a head."""
    carry: tuple | None = None
    first = True
    for batch in batches:
        ids, ties = batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist()
        texts = [t or "" for t in batch.column("text").to_pylist()]
        rows = list(zip(ids, ties, texts, strict=True))
        if first and rows:
            yield _rows([rows[0]], "head")
            first = False
        if carry is not None:
            rows.insert(0, carry)
        for a, b in _bounded(rows):
            yield _paired(rows[a:b], [r[2] for r in rows[a + 1 : b + 1]])
        carry = rows[-1] if rows else carry
    if carry is not None:
        yield _rows([carry], "tail")


def _bounded(rows: list[tuple], most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of all rows but the last, of about ``most`` characters each."""
    start = size = 0
    for i in range(len(rows) - 1):
        size += len(rows[i][2])
        if size > most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(rows) - 1:
        yield start, len(rows) - 1


_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("tie", pa.int64()), ("edge", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
    ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])


def _rows(rows: list[tuple], edge: str) -> pa.RecordBatch:
    none = [None] * len(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip([[r[0] for r in rows], [r[1] for r in rows], [edge] * len(rows), [r[2] for r in rows], *[none] * 6], _SCHEMA, strict=True)],
        schema=_SCHEMA,
    )


def _paired(rows: list[tuple], following: list[str]) -> pa.RecordBatch:
    changed = [edited(r[2], f).encode() for r, f in zip(rows, following, strict=True)]
    own = signatures([r[2].encode() for r in rows])
    other = signatures(changed)
    after = np.vstack([own[1:], signatures([following[-1].encode()])])
    columns = [
        [r[0] for r in rows], [r[1] for r in rows], [None] * len(rows), [None] * len(rows), [len(r[2]) for r in rows],
        [hashlib.sha256(c).hexdigest() for c in changed], *[[s.tobytes() for s in m] for m in (own, other)],
        likeness(own, other), likeness(own, after),
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, t, text, nxt in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "tie", "text", "following")], strict=True):
            yield _paired([(i, t, text)], [nxt])


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row."""
    rows = keyed(docs, "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"))
    order = [F.desc_nulls_last("doc_id"), F.asc("tie")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    done = stored(ranged.mapInArrow(_stream, _OUT), "edited")
    # Two rows for each task: ids alone are ordered in one place, texts follow by join.
    heads = done.where("edge = 'head'").select("doc_id", "tie", "text")
    tails = done.where("edge = 'tail'").select("doc_id", "tie", "text")
    ends = heads.select("doc_id", "tie", F.lit(0).alias("is_tail")).unionByName(tails.select("doc_id", "tie", F.lit(1).alias("is_tail")))
    along = Window.orderBy(F.desc_nulls_last("doc_id"), "tie", "is_tail")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    to = F.struct(F.col("doc_id").alias("i"), F.col("tie").alias("t"))
    linked = ends.withColumn("to", F.coalesce(F.lead(to).over(along), F.first(to).over(whole))).where("is_tail = 1")
    texts = heads.select(F.col("doc_id").alias("head_id"), F.col("tie").alias("head_tie"), F.col("text").alias("following"))
    left = linked.alias("l").join(tails.alias("t"), F.expr("l.doc_id <=> t.doc_id AND l.tie = t.tie")).select("t.*", "to")
    last = left.join(texts, F.expr("to.i <=> head_id AND to.t = head_tie")).select("doc_id", "tie", "text", "following")
    both = done.where("edge IS NULL").unionByName(last.mapInArrow(_edges, _OUT))
    return both.select(
        "doc_id", "n_chars", "edited_sha256",
        F.lower(F.hex("fingerprint")).alias("fingerprint"), F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited", "near_next",
    )
