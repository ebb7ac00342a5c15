"""Token-id output: frequency-ranked ids in a byte-aligned code with separate control bytes.

1. Texts are encoded where they lie; compressed ids go to the shared folder (ids only, no text after this).
2. Ids are counted over the corpus; the code book gives the most frequent id rank 0.
3. Rows are range-partitioned by ``doc_id`` and sorted; each task packs its documents into blocks. A rank
   takes one to four bytes, low byte first; a control byte holds the lengths of four ranks (two bits each).
   Control bytes and data bytes are separate columns of a Parquet file, with the ids and lengths of the
   block's documents and the place of the block; the code book lies beside it.
4. Reading looks the four lengths of each control byte up in a table and gathers the bytes with numpy.
   A block's first position is the sum of all blocks before it.

Defined cases. NULL text counts as empty: only the end id. Rows with equal ids follow each other in order of
their ids' checksums. NULL ids come first, as in ascending order. An empty table gives files without rows.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendspark.llm.frames import keyed, stored
from lendspark.llm.vocabulary import LATIN, Remembered, byte_letters, latin_class, tokenizer, visible
from lendspark.session import scratch_path

#: ids in a block, but a longer document is a block of its own.
BLOCK_IDS = 1 << 18
SPACE = byte_letters()[32]
#: Anything else than the characters whose classes the pattern knows.
_ODD = re.compile(f"[^\x00-\x1b\x20-{chr(LATIN - 1)}]")


class ByteTokenizer:
    """Ids of whole texts; a distinct piece is encoded by the library once and remembered."""

    def __init__(self, path: str):
        self.library = tokenizer(path)
        self.tokenize = self.library.model.tokenize  # each ``.model`` makes a new object
        with open(path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f)["added_tokens"]]
        letters, digits, space = latin_class("L"), latin_class("N"), r"\t-\r \x85\xa0"
        self.pattern = re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{digits}]+| ?[^{space}{letters}{digits}]+|[{space}]+(?![^{space}])|[{space}]+"
        )
        self.pieces = Remembered(self._piece)

    def _piece(self, piece: str) -> bytes:
        plain = piece.isascii() and piece.isprintable()  # then the space is the only character shown by another
        shown = piece.replace(" ", SPACE) if plain else visible(piece)
        return array("I", [t.id for t in self.tokenize(shown)]).tobytes()

    def _visible_piece(self, piece: str) -> bytes:
        return array("I", [t.id for t in self.tokenize(piece)]).tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not text:
            return b""
        if any(s in text for s in self.special):
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        if not _ODD.search(text):
            return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))
        return b"".join([self._visible_piece(p) for p, _ in self.library.pre_tokenizer.pre_tokenize_str(text)])


@functools.cache
def byte_tokenizer(path: str) -> ByteTokenizer:
    return ByteTokenizer(path)


def stored_kind(path: str, end_id: int) -> str:
    """Two bytes for an id where every id of the vocabulary and the end id fit."""
    most = max(end_id, *tokenizer(path).get_vocab(with_added_tokens=True).values())
    return "<u2" if most < 1 << 16 else "<u4"


def encoded(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(doc_id, crc, n, packed): ids with the end id, zstd-compressed in two or four bytes each, of every row."""
    kind = stored_kind(path, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, press = byte_tokenizer(path), zstandard.ZstdCompressor(level=3)
        tail = array("I", [end_id]).tobytes()
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                ids = [tok.encode(t or "") + tail for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([zlib.crc32(i) for i in ids], pa.int64()), pa.array([len(i) // 4 for i in ids], pa.int64()),
                     pa.array([press.compress(np.frombuffer(i, "<u4").astype(kind).tobytes()) for i in ids], pa.binary())],
                    names=["doc_id", "crc", "n", "packed"],
                )

    return keyed(docs, "text").mapInArrow(run, "doc_id long, crc long, n long, packed binary")


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    raw = zstandard.decompress(packed)
    return np.frombuffer(raw, dtype="<u4" if len(raw) == 4 * n else "<u2")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, held, size = np.zeros(0, dtype=np.int64), [], 0

    def add() -> None:
        nonlocal total, held, size
        c = np.bincount(np.concatenate(held))
        if len(c) > len(total):
            total = np.concatenate([total, np.zeros(len(c) - len(total), np.int64)])
        total[: len(c)] += c
        held, size = [], 0

    for batch in batches:
        for packed, n in zip(batch.column("packed").to_pylist(), batch.column("n").to_pylist(), strict=True):
            held.append(_unpacked(packed, n))
            size += len(held[-1])
            if size > BLOCK_IDS:
                add()
    if held:
        add()
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])


def code_book(ids: DataFrame) -> DataFrame:
    """(rank, id, n): ids by falling count, then by id. As many rows as the vocabulary has used ids, at most."""
    counts = ids.select("packed", "n").mapInArrow(_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return counts.select((F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1).alias("rank"), "id", "n")


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes): two bits of length and one to four bytes for each rank."""
    most = int(ranks.max(initial=0))
    more = np.zeros(-len(ranks) % 4 + len(ranks), dtype=np.uint8)  # bytes after the first
    for limit in (0xFF, 0xFFFF, 0xFFFFFF):
        if most > limit:
            more[: len(ranks)] += ranks > limit
    control = more[0::4] | more[1::4] << 2 | more[2::4] << 4 | more[3::4] << 6
    if most <= 0xFF:
        return control.tobytes(), ranks.astype(np.uint8).tobytes()
    width = 2 if most <= 0xFFFF else 4
    places = np.arange(width, dtype=np.uint8) <= more[: len(ranks), None]
    return control.tobytes(), ranks.astype(f"<u{width}").view(np.uint8)[places.reshape(-1)].tobytes()


_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1).astype(np.uint8)  # of the four ranks of a control byte


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    starts = np.cumsum(lengths, dtype=np.int64)
    starts -= lengths
    raw = np.frombuffer(data, np.uint8)
    out = raw[starts].astype(np.uint32)
    for j in range(1, int(lengths.max(initial=1))):
        more = np.flatnonzero(lengths > j)
        out[more] |= raw[starts[more] + j].astype(np.uint32) << np.uint32(8 * j)
    return out


_BLOCK = "block int, doc_ids array<long>, lengths array<long>, n long, control binary, data binary"


def write_files(docs: DataFrame, folder: str, path: str, end_id: int) -> None:
    """Blocks in ascending ``doc_id`` order under ``folder``/blocks, the code book under ``folder``/codes."""
    spark = docs.sparkSession
    ids = stored(encoded(docs, path, end_id), "ids")
    code_book(ids).coalesce(1).write.parquet(f"{folder}/codes")
    rank_of = np.zeros(1, dtype=np.uint32)
    for r in spark.read.parquet(f"{folder}/codes").select("id", "rank").collect():
        if r["id"] >= len(rank_of):
            rank_of = np.concatenate([rank_of, np.zeros(r["id"] + 1, np.uint32)])
        rank_of[r["id"]] = r["rank"]
    shared = spark.sparkContext.broadcast(rank_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = 0, [], 0
        for batch in batches:
            for doc_id, packed, n in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "packed", "n")), strict=True):
                values = _unpacked(packed, n)
                if held and size + len(values) > BLOCK_IDS:
                    yield _block(block, held, shared.value)
                    block, held, size = block + 1, [], 0
                held.append((doc_id, values))
                size += len(values)
        if held:
            yield _block(block, held, shared.value)

    order = [F.asc_nulls_first("doc_id"), F.asc("crc")]
    ranged = ids.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "packed", "n")
    blocks = ranged.mapInArrow(run, _BLOCK).withColumn("file", F.spark_partition_id())
    blocks.write.option("compression", "uncompressed").parquet(f"{folder}/blocks")


def _block(block: int, held: list[tuple], rank_of: np.ndarray) -> pa.RecordBatch:
    ids = np.concatenate([v for _, v in held])
    control, data = pack(rank_of[ids])
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int32()), pa.array([[d for d, _ in held]], pa.list_(pa.int64())), pa.array([[len(v) for _, v in held]], pa.list_(pa.int64())),
         pa.array([len(ids)], pa.int64()), pa.array([control], pa.binary()), pa.array([data], pa.binary())],
        names=["block", "doc_ids", "lengths", "n", "control", "data"],
    )


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    codes = spark.read.parquet(f"{folder}/codes").orderBy("rank").select("id").collect()
    shared = spark.sparkContext.broadcast(np.array([r["id"] for r in codes], dtype="<u4"))
    # One row for each file, then a running sum inside a file: no single place sees all blocks.
    files = blocks.groupBy("file").agg(F.sum("n").alias("n")).select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before"))
    inside = Window.partitionBy("file").orderBy("block")
    starts = blocks.select("file", "block", (F.sum("n").over(inside) - F.col("n")).alias("within")).join(F.broadcast(files), "file")
    starts = starts.select("file", "block", (F.col("before") + F.col("within")).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_of = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                ids = id_of[unpack(row["control"], row["data"], row["n"])]
                ends = np.cumsum(row["lengths"])
                begins = ends - np.array(row["lengths"])
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(begins, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["file"]] * len(crcs), pa.int32()), pa.array([row["block"]] * len(crcs), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                     pa.array(begins), pa.array(row["lengths"], pa.int64()), pa.array(crcs, pa.int64())],
                    names=["file", "block", "doc_id", "begin", "n_tokens", "ids_crc32"],
                )

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    docs = blocks.mapInArrow(run, "file int, block int, doc_id long, begin long, n_tokens long, ids_crc32 long")
    return docs.join(starts, ["file", "block"]).select("doc_id", (F.col("at") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def written_and_read(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-files")
    write_files(docs, folder, path, end_id)
    return read_files(spark, folder)
