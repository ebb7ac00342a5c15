"""N-gram Jaccard join with several global token orders.

A document is its set of distinct k-word shingles (64-bit hashes). Two sets with Jaccard similarity of at
least t must share a token among the first ``n - ceil(t n) + 1`` of each, in *any* order of the tokens that
is the same for all documents. Here an order is: class of the token's corpus frequency (rare first), then a
seeded hash; each seed gives another order. The frequency class comes from counters over all documents, about
one for each ``BYTES_A_COUNTER`` bytes of text. Any error in it changes the speed only.

1. Equal sets become one representative (grouped minimum, combined before the shuffle).
2. Order 1: the prefixes of the representatives are exploded, tokens that occur once are left out.
3. Star step: every document meets only the pivot of its tokens. Verified links form components, so groups
   of near copies collapse without their pairs.
4. Remaining pairs are joined only across components, under the length bound and the bound on the overlap
   that the two prefix positions leave.
   ``links`` therefore has enough pairs for the components, not all; ``all_links`` lists all of them.
5. Candidates of 3 and 4 must also share a prefix token under every other order; those left are verified
   on the whole sets with integer arithmetic.

Defined cases. NULL or empty text, or no word: empty set, linked with nothing. Fewer than k words: one
shingle, all words. Rows that repeat an id are one node. A NULL id is linked with nothing and is its own
(NULL) component. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.llm.components import components
from lendspark.llm.frames import keyed, returned_memory, stored, text_bytes
from lendspark.llm.words import blocks, distinct_by_text, mix, shingle_hashes, word_hashes

#: Text bytes for each counter of token frequencies: a few tokens share one, at every size of the corpus ...
BYTES_A_COUNTER = 16
#: ... up to 2**26 counters (a broadcast of 64 MB, reached by 1 GB of text). Beyond it more tokens share a counter.
WIDEST = 26
SLICES = 64
#: Tokens that a task sorts and counts at once.
TOKENS_AT_ONCE = 1 << 20
#: Bits for each shared token in the filter that keeps tokens of one document out of the shuffle, up to 2**29 bits
#: (64 MB). What it lets through is joined exactly.
BITS_A_TOKEN = 32
WIDEST_FILTER = 29
#: Up to so many candidate pairs (16 bytes each) are broadcast to meet their texts; more are joined with a shuffle of the texts.
BROADCAST_PAIRS = 500_000
ORDERS = (101, 202, 303)


def _width(wanted: int, least: int, most: int) -> int:
    """The exponent of the smallest power of two that is at least ``wanted``, between the bounds."""
    return min(max(int(wanted - 1).bit_length(), least), most)


def _cells(tokens: np.ndarray, width: int) -> np.ndarray:
    return (mix(tokens, 7) >> np.uint64(64 - width)).astype(np.uint32)


def _counted(cells: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """The cells in use and their counts (up to 65,535), a row for each slice of the table."""
    used, n = np.unique(cells, return_counts=True)
    n = np.minimum(n, 0xFFFF).astype(np.uint16)
    cuts = np.searchsorted(used, np.arange(SLICES + 1, dtype=np.uint64) << np.uint64(width - SLICES.bit_length() + 1))
    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if a < b:
            steps = np.diff(used[a:b], prepend=np.uint32(0))
            by_place = [np.ascontiguousarray(x.view(np.uint8).reshape(b - a, -1).T).tobytes() for x in (steps, n[a:b])]  # the upper bytes are mostly 0
            yield pa.RecordBatch.from_pydict({"slice": pa.array([i], pa.int32()), "counts": [zstandard.compress(b"".join(by_place), 1)]})


def _count(k: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, texts in blocks(text_bytes(batch.column("text"))):
                tokens, _ = shingle_hashes(*word_hashes(texts), k)
                held.append(_cells(tokens, width))
                size += len(tokens)
                if size >= TOKENS_AT_ONCE:
                    yield from _counted(np.concatenate(held), width)
                    held, size = [], 0
        if size:
            yield from _counted(np.concatenate(held), width)

    return run


def _add(width: int):
    def run(key, frame):
        import pandas as pd

        size = (1 << width) // SLICES
        total = np.zeros(size, dtype=np.uint64)
        for packed in frame["counts"]:
            raw = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(6, -1)
            steps, n = (np.ascontiguousarray(x.T).view(t).reshape(-1) for x, t in ((raw[:4], np.uint32), (raw[4:], np.uint16)))
            total[np.cumsum(steps, dtype=np.int64) - int(key[0]) * size] += n
        classes = np.floor(np.log2(np.maximum(total, 1))).astype(np.uint8)
        return pd.DataFrame({"slice": [key[0]], "classes": [zstandard.compress(classes.tobytes(), 1)]})

    return run


def frequency_classes(docs: DataFrame, k: int):
    """Broadcast table of log2 of the token counts, sized by the text, 64 MB at most."""
    text_size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = _width(text_size // BYTES_A_COUNTER, 16, WIDEST)
    sums = docs.select("text").mapInArrow(returned_memory(_count(k, width)), "slice int, counts binary").groupBy("slice")
    table = np.zeros((SLICES, (1 << width) // SLICES), dtype=np.uint8)
    for r in sums.applyInPandas(_add(width), "slice int, classes binary").collect():
        table[r["slice"]] = np.frombuffer(zstandard.decompress(r["classes"]), dtype=np.uint8)
    return docs.sparkSession.sparkContext.broadcast(table.reshape(-1))


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return np.where(n > 0, n - (n * percent + 99) // 100 + 1, 0)


def _ranked(tokens: np.ndarray, bounds: np.ndarray, classes: np.ndarray, percent: int, seed: int) -> list[np.ndarray]:
    """The prefix of each set in the order of the seed."""
    rank = classes[_cells(tokens, len(classes).bit_length() - 1)].astype(np.uint64)
    order_key = (rank << np.uint64(58)) | (mix(tokens, seed) >> np.uint64(6))
    n = np.diff(bounds)
    owner = np.repeat(np.arange(len(n)), n)
    by = np.lexsort((order_key, owner))
    size = prefix_length(n, percent)
    return [tokens[by[a : a + p]] for a, p in zip(bounds[:-1], size, strict=True)]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _signatures(k: int, percent: int, classes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for start, texts in blocks(text_bytes(batch.column("text"))):
                sets, bounds = distinct_by_text(*shingle_hashes(*word_hashes(texts), k))
                n = np.diff(bounds)
                marks = []
                for salt in (11, 12):
                    sums = np.concatenate([[0], np.cumsum(mix(sets, salt), dtype=np.uint64)]).astype(np.uint64)
                    marks.append((sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, len(texts)), pa.array(n.astype(np.int32)), *map(pa.array, marks),
                     _lists(_ranked(sets, bounds, classes.value, percent, ORDERS[0]))],
                    names=["doc_id", "n", "s1", "s2", "prefix"],
                )

    return run


def _whole_sets(k: int, percent: int, classes):
    """A row for each partner ``a`` of a text: its set, and its prefixes under the other orders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, partners = batch.column("doc_id").to_pylist(), batch.column("partners").to_pylist()
            for start, texts in blocks(text_bytes(batch.column("text"))):
                sets, bounds = distinct_by_text(*shingle_hashes(*word_hashes(texts), k))
                others = [_ranked(sets, bounds, classes.value, percent, seed) for seed in ORDERS[1:]]
                for i in range(len(texts)):
                    a, n = partners[start + i], len(partners[start + i])
                    arrays = [others[0][i], others[1][i], sets[bounds[i] : bounds[i + 1]]]
                    for at in range(0, n, 64):
                        part = a[at : at + 64]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(part, pa.int64()), pa.array([ids[start + i]] * len(part), pa.int64()), *[_lists([x] * len(part)) for x in arrays]],
                            names=["a", "b", "p2", "p3", "tokens"],
                        )

    return run


def _repeated(table):
    """(id, n, pos, token) of the prefix tokens that may be in two documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        for batch in batches:
            lists = batch.column("prefix")
            tokens = lists.flatten().to_numpy().view(np.uint64)
            sizes = np.diff(lists.offsets.to_numpy())
            place = (mix(tokens, 99) >> np.uint64(64 - len(bits).bit_length() - 2)).astype(np.int64)
            hit = np.flatnonzero((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1)
            owner = np.repeat(np.arange(len(sizes)), sizes)[hit]
            pos = hit - (np.cumsum(sizes) - sizes)[owner]
            ids, n = batch.column("doc_id").to_numpy(), batch.column("n").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[owner]), pa.array(n[owner]), pa.array(pos.astype(np.int32)), pa.array(tokens[hit].view(np.int64))], names=["id", "n", "pos", "token"]
            )

    return run


def _bits(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << (width - 3), dtype=np.uint8)
        for batch in batches:
            place = (mix(batch.column("token").to_numpy().view(np.uint64), 99) >> np.uint64(64 - width)).astype(np.int64)
            np.bitwise_or.at(table, place >> 3, (1 << (place & 7)).astype(np.uint8))
        for i, part in enumerate(table.reshape(SLICES, -1)):
            if part.any():
                yield pa.RecordBatch.from_pydict({"slice": pa.array([i], pa.int32()), "counts": [zstandard.compress(part.tobytes(), 1)]})

    return run


def _any(width: int):
    def run(key, frame):
        import pandas as pd

        total = np.zeros((1 << (width - 3)) // SLICES, dtype=np.uint8)
        for part in frame["counts"]:
            total |= np.frombuffer(zstandard.decompress(part), np.uint8)
        return pd.DataFrame({"slice": [key[0]], "classes": [total.tobytes()]})

    return run


class JaccardJoin:
    """Links of ``docs`` (doc_id, text): 100 * intersection >= percent * union of their k-word shingle sets."""

    def __init__(self, docs: DataFrame, k: int = 5, percent: int = 80):
        self.docs, self.k, self.percent = keyed(docs, "text"), k, percent
        self.classes = frequency_classes(self.docs, k)
        self.rows = stored(
            self.docs.mapInArrow(
                returned_memory(_signatures(k, percent, self.classes)), "doc_id long, n int, s1 long, s2 long, prefix array<long>"
            ),
            "shingles",
        )
        equal = self.rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("id"))
        self.equal = stored(equal, "equal-sets")

    def _overlap_left(self, n1: str, p1: str, n2: str, p2: str) -> str:
        """The sizes allow the similarity, and so do the tokens from these prefix positions on."""
        q = self.percent
        return (
            f"100 * least({n1}, {n2}) >= {q} * greatest({n1}, {n2})"
            f" AND {100 + q} * least({n1} - {p1}, {n2} - {p2}) >= {q} * ({n1} + {n2})"
        )

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that share prefix tokens under the other orders and are similar; ``a`` is the side with fewer ids."""
        ends = pairs.select("a", "b").unionByName(pairs.select("a", F.col("a").alias("b")).distinct())
        ends = stored(ends.groupBy("b").agg(F.collect_set("a").alias("partners")), "candidate-ends")
        few = pairs.count() <= BROADCAST_PAIRS
        texts = self.docs.join(F.broadcast(ends) if few else ends, F.col("doc_id") == F.col("b")).select("doc_id", "text", "partners")
        sets = texts.mapInArrow(
            returned_memory(_whole_sets(self.k, self.percent, self.classes)), "a long, b long, p2 array<long>, p3 array<long>, tokens array<long>"
        )
        sets = stored(sets, "candidate-sets")
        pivot = sets.where("a = b").select("a", F.col("p2").alias("a2"), F.col("p3").alias("a3"), F.col("tokens").alias("x"))
        both = sets.where("a <> b").join(pivot, "a").where("arrays_overlap(a2, p2) AND arrays_overlap(a3, p3)")
        both = both.select("a", "b", F.expr("size(x) + size(tokens)").alias("n"), F.expr("size(array_intersect(x, tokens))").alias("i"))
        return stored(both.where(f"100 * i >= {self.percent} * (n - i)").select("a", "b").distinct(), "verified")

    def _shared_prefixes(self) -> DataFrame:
        """(token, id, n, pos, pivot) of the prefix tokens of representatives that at least two of them have."""
        first = self.rows.join(self.equal, F.col("doc_id") == F.col("id"), "left_semi").dropDuplicates(["doc_id", "n", "s1", "s2"])
        first = stored(first.select("doc_id", "n", "prefix"), "prefixes")
        tokens = stored(first.select(F.explode("prefix").alias("token")).groupBy("token").count().where("count > 1").select("token"), "shared-tokens")
        width = _width(tokens.count() * BITS_A_TOKEN, 16, WIDEST_FILTER)
        table = np.zeros((SLICES, (1 << (width - 3)) // SLICES), dtype=np.uint8)
        marks = tokens.mapInArrow(returned_memory(_bits(width)), "slice int, counts binary").groupBy("slice")
        for r in marks.applyInPandas(_any(width), "slice int, classes binary").collect():
            table[r["slice"]] = np.frombuffer(r["classes"], dtype=np.uint8)
        bits = self.docs.sparkSession.sparkContext.broadcast(table.reshape(-1))
        posts = first.mapInArrow(returned_memory(_repeated(bits)), "id long, n int, pos int, token long").join(tokens, "token", "left_semi")
        posts = stored(posts, "shared-prefixes")
        pivots = posts.groupBy("token").agg(F.min(F.struct("id", "n", "pos")).alias("pivot"))
        return posts.join(pivots, "token")

    def links(self) -> DataFrame:
        """(a, b) of representatives of equal sets: enough links for the components of all links."""
        live = self._shared_prefixes()
        star = live.where("id <> pivot.id AND " + self._overlap_left("n", "pos", "pivot.n", "pivot.pos"))
        tried = stored(star.select(F.col("pivot.id").alias("a"), F.col("id").alias("b")).distinct(), "star-pairs")
        near = self._verified(tried)
        member = components(near)
        live = live.select("token", "id", "n", "pos").join(member, "id", "left").withColumn("component", F.coalesce("component", "id"))
        live = stored(live, "by-component")
        mixed = live.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("token")
        open_ = live.join(mixed, "token", "left_semi")
        left = open_.select("token", *[F.col(c).alias(f"{c}1") for c in ("id", "n", "pos", "component")])
        right = open_.select("token", *[F.col(c).alias(f"{c}2") for c in ("id", "n", "pos", "component")])
        rest = left.join(right, "token").where(
            "id1 < id2 AND component1 <> component2 AND " + self._overlap_left("n1", "pos1", "n2", "pos2")
        )
        rest = rest.select(F.col("id1").alias("a"), F.col("id2").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
        return near.unionByName(self._verified(stored(rest, "cross-pairs")))

    def all_links(self) -> DataFrame:
        """(a, b) of all similar pairs of representatives; with ``membership`` the whole result of the join.

        The pairs are listed, so their number grows with the square of a group of near copies.
        """
        live = self._shared_prefixes()
        left, right = (live.select("token", *[F.col(c).alias(f"{c}{i}") for c in ("id", "n", "pos")]) for i in (1, 2))
        pairs = left.join(right, "token").where("id1 < id2 AND " + self._overlap_left("n1", "pos1", "n2", "pos2"))
        return self._verified(stored(pairs.select(F.col("id1").alias("a"), F.col("id2").alias("b")).distinct(), "all-pairs"))

    def membership(self) -> DataFrame:
        """(doc_id, id): the representative of each document's set; documents with the same one are similar too."""
        at = self.rows.where("doc_id IS NOT NULL").join(self.equal, ["n", "s1", "s2"])
        return at.select("doc_id", "id").distinct()

    def classes_of_documents(self) -> DataFrame:
        """(doc_id, n_shingles, component_id) for every row."""
        member = components(self.links())
        of_set = self.equal.join(member, "id", "left").select(
            "n", "s1", "s2", F.coalesce("component", "id").alias("component")
        )
        at = self.rows.select("doc_id", "n", "s1", "s2").join(of_set, ["n", "s1", "s2"], "left")
        return at.select(
            "doc_id",
            F.col("n").cast("long").alias("n_shingles"),
            F.when(F.col("doc_id").isNull() | F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
        )


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    return JaccardJoin(docs, k, percent).classes_of_documents()
