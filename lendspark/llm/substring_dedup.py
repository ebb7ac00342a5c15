"""Substring dedup: suffix automata of reference shards, streamed for matching statistics.

A window is ``window`` consecutive words. Words of windows that start more than once in the corpus go.

1. Each window is named by its anchor, the least hash among its ``ANCHOR_WORDS``-word grams. Neighbouring windows
   with one anchor at one place form a passage: no two windows of it are equal, and equal windows always lie in
   passages with equal anchors. Anchors of one passage in the corpus leave here: their windows cannot repeat.
2. Equal passages become one, with their number. The others are the reference, cut into shards by anchor.
3. A shard's suffix automaton over whole words holds how often each of its sequences starts in the corpus. The
   passages of the shard are streamed through it; where the statistic reaches ``window`` words that occur
   twice, the window is marked. Marked windows run together into maximal spans.
4. An anchor in more than ``MOST`` different passages would make its shard grow with the corpus. Its windows
   go one by one, named by their own hash and combined before the shuffle, into automata of their own.

An automaton is built where the passages that it can answer are, instead of being sent to every task: all
documents through all shards would be quadratic. Passages of other shards cannot match in it. Hashes only
route and combine; windows are compared word by word in the automata.

Defined cases. NULL, empty and blank texts have no words; texts of fewer words than a window lose nothing.
Windows are judged on the input, so every copy of a repeated passage goes, the first one too. Rows that
repeat an id are documents of their own (equal rows repeat each other), and so are rows with a NULL id. A
very long text is one task's work for as long as it takes to split it. An empty table gives no rows.
Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.llm.frames import stored, text_bytes
from lendspark.llm.words import CASED, blocks, mix, powers, word_hashes

ANCHOR_WORDS = 6
#: Words of a shard, on average.
SHARD_WORDS = 150_000
#: Most different passages that one anchor brings to a shard.
MOST = 1024
SPACE = re.compile(rb"[\x20\x09-\x0D]+")
_GRAM = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)


def split_words(text: bytes) -> list[bytes]:
    return [w for w in SPACE.split(text) if w]


def _gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    n = len(words) - k + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for j in range(k if n > 0 else 0):
        out += words[j : j + n] * _GRAM[j]
    return mix(out)


def _least_places(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The least of each run of ``width`` values, and where it first is."""

    def step(values, places, by, n):
        later = values[by : by + n] < values[:n]
        return np.where(later, values[by : by + n], values[:n]), np.where(later, places[by : by + n], places[:n])

    places, reach = np.arange(len(values)), 1
    while 2 * reach <= width:
        values, places = step(values, places, reach, len(values) - reach)
        reach *= 2
    return step(values, places, width - reach, len(values) - (width - reach))


def passages_of(words: np.ndarray, bounds: np.ndarray, window: int, k: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, anchor, hash of the words) of each passage, in order."""
    none = tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int32, np.int32, np.uint64, np.uint64))
    size = np.diff(bounds)
    count = np.maximum(size - window + 1, 0)
    total = int(count.sum())
    if not total:
        return none
    owner = np.repeat(np.arange(len(size)), count)
    at = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + bounds[owner]
    anchor, place = (x[at] for x in _least_places(_gram_hashes(words, k), window - k + 1))
    new = np.ones(total, dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, total))
    base, back = powers(len(words) + 1)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(words * base[: len(words)], dtype=np.uint64)])
    lo, hi = at[first], at[first] + length + window - 1
    text_hash = mix((sums[hi] - sums[lo]) * back[lo] + length.astype(np.uint64), 3)
    return owner[first], (lo - bounds[owner[first]]).astype(np.int32), length.astype(np.int32), anchor[first], text_hash


def _passages(window: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column("doc_id"), batch.column("mark")
            for start, texts in blocks(text_bytes(batch.column("text"))):
                row, first, count, anchor, seg = passages_of(*word_hashes(texts, values=CASED), window, k)
                rows = pa.array(row + start)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(rows), marks.take(rows), pa.array(anchor.view(np.int64)), pa.array(seg.view(np.int64)), pa.array(first), pa.array(count)],
                    names=["doc_id", "mark", "anchor", "seg", "start", "n"],
                )

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(1).compress
    for batch in batches:
        packed = pa.array([pack(t) for t in text_bytes(batch.column("text"))], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), packed], names=["doc_id", "mark", "packed"])


def _words(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple]:
    """(anchor, seg, copies, words) of each passage wanted from a document."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for i in range(batch.num_rows):
            words = split_words(unpack(batch.column("packed")[i].as_py()))
            for w in batch.column("wanted")[i].as_py():
                yield w["anchor"], w["seg"], w["copies"], words[w["start"] : w["start"] + w["n"] + window - 1]


def _batched(rows: Iterator[tuple], schema: pa.Schema, most: int = 4096) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


PASSAGE = pa.schema([("anchor", pa.int64()), ("seg", pa.int64()), ("copies", pa.int64()), ("words", pa.binary())])
MARKED = pa.schema([("anchor", pa.int64()), ("seg", pa.int64()), ("runs", pa.list_(pa.int32()))])
SINGLE = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("anchor", pa.int64()), ("seg", pa.int64()), ("at", pa.int32()), ("copies", pa.int64()), ("words", pa.binary())])


def _fetch(window: int):
    def run(batches):
        return _batched(((a, s, c, b" ".join(w)) for a, s, c, w in _words(batches, window)), PASSAGE)

    return run


def _single_windows(window: int):
    """Every window of the passages by itself, named by a digest of its words."""

    def rows(batches):
        for anchor, seg, copies, words in _words(batches, window):
            for i in range(len(words) - window + 1):
                text = b" ".join(words[i : i + window])
                h1, h2 = np.frombuffer(hashlib.blake2b(text, digest_size=16).digest(), np.int64).tolist()
                yield h1, h2, anchor, seg, i, copies, text

    return lambda batches: _batched(rows(batches), SINGLE, 1024)


class SuffixAutomaton:
    """All word sequences of a list of passages, and how often each occurs; a passage may stand for several copies."""

    def __init__(self):
        self.next, self.link, self.length, self.count = [{}], [-1], [0], [0]

    def _state(self, length: int, edges: dict, link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.next) - 1

    def _split(self, p: int, word, q: int) -> int:
        """A state for the sequences of ``q`` that are no longer than those of ``p`` and the word."""
        clone = self._state(self.length[p] + 1, self.next[q].copy(), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list, copies: int = 1) -> None:
        edges, link, length = self.next, self.link, self.length
        last = 0
        for word in words:
            q = edges[last].get(word)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, word, q)
            else:
                p, cur = last, self._state(length[last] + 1, {}, 0)
                while p >= 0 and word not in edges[p]:
                    edges[p][word] = cur
                    p = link[p]
                if p >= 0:
                    q = edges[p][word]
                    link[cur] = q if length[q] == length[p] + 1 else self._split(p, word, q)
                last = cur
            self.count[last] += copies

    def counted(self) -> SuffixAutomaton:
        """Occurrences of a state are added to its suffixes', longest first. Call once, after all passages."""
        for v in np.argsort(self.length, kind="stable")[:0:-1].tolist():
            if self.link[v] > 0:
                self.count[self.link[v]] += self.count[v]
        return self

    def repeated(self, words: list, window: int) -> Iterator[int]:
        """The places of the windows that occur twice or more: the matching statistic, cut at ``window`` words."""
        edges, link, length, count = self.next, self.link, self.length, self.count
        state = matched = 0
        for end, word in enumerate(words, 1):
            while state and word not in edges[state]:
                state = link[state]
                matched = length[state]
            if word not in edges[state]:
                continue
            state = edges[state][word]
            matched = min(matched + 1, window)
            while length[link[state]] >= matched:  # the state of the last ``matched`` words alone
                state = link[state]
            if matched == window and count[state] >= 2:
                yield end - window


def _shard(window: int):
    def run(table: pa.Table) -> pa.Table:
        held = {}
        for anchor, seg, copies, words in zip(*(table.column(c).to_pylist() for c in ("anchor", "seg", "copies", "words")), strict=True):
            held[anchor, seg] = (copies, words.split(b" "))
        automaton = SuffixAutomaton()
        for copies, words in held.values():
            automaton.add(words, copies)
        automaton.counted()
        out = []
        for (anchor, seg), (_, words) in held.items():
            runs: list[int] = []  # first window and number of windows, in turn
            for at in automaton.repeated(words, window):
                if runs and runs[-2] + runs[-1] == at:
                    runs[-1] += 1
                else:
                    runs += [at, 1]
            if runs:
                out.append((anchor, seg, runs))
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, MARKED, strict=True)], schema=MARKED)

    return run


def _in_shards(passages: DataFrame, shards: int, window: int) -> DataFrame:
    dealt = passages.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(_shard(window), "anchor long, seg long, runs array<int>")


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, text): ``mark`` tells texts of one id apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _with_text(docs: DataFrame, wanted: DataFrame, how: str) -> DataFrame:
    """(doc_id, packed, wanted): every document, or those with something wanted, and their text."""
    packed = _rows(docs).mapInArrow(_packed, "doc_id long, mark long, packed binary").alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.mark") == F.col("w.mark"))
    return packed.join(wanted.alias("w"), same, how).select("d.doc_id", "packed", "wanted")


class SubstringDedup:
    """Windows of ``docs`` (doc_id, text) that repeat."""

    def __init__(self, docs: DataFrame, window: int = 35, anchor_words: int = ANCHOR_WORDS, most: int = MOST, shard_words: int = SHARD_WORDS):
        self.docs, self.window, self.most, self.shard_words = docs, window, most, shard_words
        self.anchor_words = min(anchor_words, window)

    def _asked(self, passages: DataFrame) -> DataFrame:
        wanted = F.collect_list(F.struct("anchor", "seg", "copies", "start", "n")).alias("wanted")
        return _with_text(self.docs, passages.groupBy("doc_id", "mark").agg(wanted), "inner")

    def _shards(self, words: int | None) -> int:
        return max(1, -(-(words or 0) // self.shard_words))

    def marked(self) -> DataFrame:
        """(doc_id, mark, runs): runs of repeated windows (first, number, in turn) of each passage that has one."""
        shape = "doc_id long, mark long, anchor long, seg long, start int, n int"
        all_ = stored(_rows(self.docs).mapInArrow(_passages(self.window, self.anchor_words), shape), "passages")
        # stored, so that the join has a shuffle of its own and an anchor with very many passages can be split
        often = stored(all_.groupBy("anchor").count().where("count > 1").select("anchor"), "often")
        places = stored(all_.join(often, "anchor"), "repeated-anchors")
        one = [F.first(c).alias(c) for c in ("doc_id", "mark", "start", "n")]
        reference = stored(places.groupBy("anchor", "seg").agg(F.count(F.lit(1)).alias("copies"), *one), "reference")
        heavy = stored(reference.groupBy("anchor").count().where(F.col("count") > self.most).select("anchor"), "heavy-anchors")
        light = reference.join(heavy, "anchor", "left_anti")
        words = reference.agg(F.sum(F.col("n") + self.window - 1)).first()[0]
        passages = self._asked(light).mapInArrow(_fetch(self.window), "anchor long, seg long, copies long, words binary")
        runs = _in_shards(passages, self._shards(words), self.window)
        if not heavy.isEmpty():
            runs = runs.unionByName(self._marked_alone(reference.join(heavy, "anchor", "left_semi")))
        return places.join(stored(runs, "repeated-windows"), ["anchor", "seg"]).select("doc_id", "mark", "start", "runs")

    def _marked_alone(self, passages: DataFrame) -> DataFrame:
        """As ``marked`` for passages of anchors that too many have: each window by itself."""
        shape = "h1 long, h2 long, anchor long, seg long, at int, copies long, words binary"
        windows = stored(self._asked(passages).mapInArrow(_single_windows(self.window), shape), "single-windows")
        several = windows.groupBy("h1", "h2").agg(F.sum("copies").alias("copies"), F.first("words").alias("words")).where("copies > 1")
        several = stored(several.select(F.col("h1").alias("anchor"), F.col("h2").alias("seg"), "copies", "words"), "several-windows")
        found = _in_shards(several, self._shards(several.count() * self.window), self.window)
        found = found.select(F.col("anchor").alias("h1"), F.col("seg").alias("h2"))
        return windows.join(found, ["h1", "h2"]).select("anchor", "seg", F.array(F.col("at"), F.lit(1)).alias("runs"))

    def _spans(self) -> DataFrame:
        spans = self.marked().groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "runs")).alias("wanted"))
        return _with_text(self.docs, spans, "left")

    def kept(self) -> DataFrame:
        """(doc_id, n_words, n_removed, spans, kept_text) of every row; spans are (first word, words) in turn, maximal."""
        shape = "doc_id long, n_words long, n_removed long, spans array<int>, kept_text binary"
        out = self._spans().mapInArrow(_cut(self.window, digest=False), shape)
        return out.withColumn("kept_text", F.col("kept_text").cast("string"))

    def digests(self) -> DataFrame:
        """As ``kept`` with the SHA-256 of the kept words in place of the text."""
        return self._spans().mapInArrow(_cut(self.window, digest=True), "doc_id long, n_words long, n_removed long, spans array<int>, kept_sha256 string")


def _cut(window: int, digest: bool):
    last = ("kept_sha256", pa.string()) if digest else ("kept_text", pa.binary())
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.int32())), last])

    def row(doc_id, text: bytes, wanted):
        words = split_words(text)
        steps = np.zeros(len(words) + 1, dtype=np.int64)
        for w in wanted or ():
            for first, number in zip(w["runs"][0::2], w["runs"][1::2], strict=True):
                steps[w["start"] + first] += 1
                steps[w["start"] + first + number + window - 1] -= 1
        gone = np.cumsum(steps)[:-1] > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
        spans = np.stack([edges[0::2], edges[1::2] - edges[0::2]], 1).reshape(-1).astype(np.int32)
        kept = words if not len(spans) else [words[i] for i in np.flatnonzero(~gone)]
        text = b" ".join(kept)
        return doc_id, len(words), len(words) - len(kept), spans, hashlib.sha256(text).hexdigest() if digest else text

    def rows(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for i in range(batch.num_rows):
                yield row(batch.column("doc_id")[i].as_py(), unpack(batch.column("packed")[i].as_py()), batch.column("wanted")[i].as_py())

    return lambda batches: _batched(rows(batches), schema, 256)
