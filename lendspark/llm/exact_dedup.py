"""Exact dedup by heavy-hitter split.

Texts become SHA-256 digests in one pass. A Misra-Gries summary of each partition names the digests
that may be frequent; summaries add up, so a digest in more than 2/k of all rows is always named and
fewer than k are named. The named ones are counted exactly (partial sums before the shuffle) and these
verified winners, at most k rows, are broadcast: their documents are decided where they lie. All other
digests are shuffled in the ordinary way; none of them has more than 2/k of the rows.

Defined cases. A NULL text counts as empty. The largest ``doc_id`` of equal texts stays; rows that repeat
one id with one text count one by one in ``group_size`` and share their fate. NULL ids lose to all others;
if a group has no other id, all its rows stay. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendspark.llm.frames import keyed, stored

#: Counters of a summary, and the most digests that are broadcast.
COUNTERS = 4096


def misra_gries(keys: dict[bytes, int], more: dict[bytes, int], k: int) -> dict[bytes, int]:
    """Merge two summaries into one of at most k counters: all lose the (k+1)-th largest count."""
    for key, n in more.items():
        keys[key] = keys.get(key, 0) + n
    if len(keys) <= k:
        return keys
    counts = np.fromiter(keys.values(), dtype=np.int64, count=len(keys))
    cut = int(np.partition(counts, len(counts) - k - 1)[len(counts) - k - 1])
    return {key: n - cut for key, n in keys.items() if n > cut}


def summarise(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, int] = {}
        rows = 0
        for batch in batches:
            counted = batch.column("digest").value_counts()
            kept = misra_gries(
                kept, dict(zip(counted.field(0).to_pylist(), counted.field(1).to_pylist(), strict=True)), k
            )
            rows += batch.num_rows
        yield pa.RecordBatch.from_pydict(
            {"digest": [*kept, b""], "n": [*kept.values(), rows]},
            schema=pa.schema([("digest", pa.binary()), ("n", pa.int64())]),
        )

    return run


def winners(digests: DataFrame, k: int = COUNTERS) -> DataFrame:
    """Exact (digest, keep_id, group_size) of the digests that may hold more than 1/k of the rows; fewer than k rows."""
    summary = stored(
        digests.select("digest").mapInArrow(summarise(k), "digest binary, n long").groupBy("digest").agg(F.sum("n").alias("n")),
        "frequent-digests",
    )
    rows = summary.where(F.length("digest") == 0).agg(F.sum("n")).first()[0] or 0
    named = summary.where((F.length("digest") > 0) & (F.col("n") > max(1, rows // k))).select("digest")
    return (
        digests.join(F.broadcast(named), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )


def exact_groups(docs: DataFrame, k: int = COUNTERS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs`` (doc_id, text)."""
    digests = stored(
        keyed(docs, F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("digest")), "digests"
    )
    heavy = stored(winners(digests, k), "winners")
    marked = digests.join(F.broadcast(heavy), "digest", "left")
    same = Window.partitionBy("digest")
    rest = digests.join(F.broadcast(heavy.select("digest")), "digest", "left_anti").select(
        "digest", "doc_id", F.max("doc_id").over(same).alias("keep_id"), F.count(F.lit(1)).over(same).alias("group_size")
    )
    both = marked.where("group_size IS NOT NULL").select(rest.columns).unionByName(rest)
    return both.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
