"""Line dedup with DataFrame functions only: per-document keep bitmaps instead of texts.

Every line becomes (128-bit hash of its key, document, position). Hashes that hold more than 1/4096 of
all lines (fewer than 4,096 of them, found by a count that combines before the shuffle) are decided by a
broadcast of their last document. The others are range-partitioned by hash and sorted by document, latest
first, and position; one streaming pass sees the first occurrence and marks the rest. The answer is a
run-length compressed bitmap for each document, ``keep_runs``: (start, length) of the runs of lines that
stay. Texts meet the bitmaps once, by ``doc_id`` and a hash of the text.

Defined cases. NULL or empty text: one empty line, which stays (it is shorter than any key). A line of
the last document stays however often it repeats there. Rows that repeat an id are one document where
documents are counted, and each of its texts has positions and a bitmap of its own. A NULL id: all lines
stay, and the row is not counted. A very long text is many rows before the shuffle and one bitmap after it. An
empty table gives no rows. Other columns, whatever their names, are carried through by ``apply_bitmaps``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendspark.llm.frames import keyed, stored

#: Hashes with more than one line in HOT_SHARE of all are decided by broadcast; so fewer than HOT_SHARE are.
HOT_SHARE = 4096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def text_mark(text: Column) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc_id, mark, pos) of every line whose key has at least ``min_chars`` code points."""
    texts = keyed(docs, "text").where("doc_id IS NOT NULL").select("doc_id", text_mark(F.col("text")).alias("mark"), lines_of(F.col("text")).alias("lines"))
    lines = texts.select("doc_id", "mark", F.posexplode("lines").alias("pos", "line"))
    keys = lines.where(F.length("line") >= min_chars).select("doc_id", "mark", "pos", line_key(F.col("line")).alias("key"))
    return keys.where(F.length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"), "doc_id", "mark", "pos"
    )


def dropped_lines(lines: DataFrame, min_docs: int, hot_share: int = HOT_SHARE) -> DataFrame:
    """(doc_id, mark, pos) of the lines to drop."""
    total = lines.count()
    key = ["h1", "h2"]
    named = lines.groupBy(*key).count().where(F.col("count") > max(total // hot_share, 1)).select(*key)
    hot = stored(
        lines.join(F.broadcast(named), key, "left_semi").groupBy(*key, "doc_id").agg(F.lit(1).alias("one"))
        .groupBy(*key).agg(F.count("one").alias("n_docs"), F.max("doc_id").alias("last")),
        "hot-lines",
    )
    from_hot = lines.join(F.broadcast(hot), key).where((F.col("n_docs") >= min_docs) & (F.col("doc_id") < F.col("last")))
    cold = lines.join(F.broadcast(hot.select(*key)), key, "left_anti").repartitionByRange("h1")
    stream = Window.partitionBy(*key).orderBy(F.desc("doc_id"), "pos")
    first = F.coalesce((F.lag("doc_id").over(stream) != F.col("doc_id")).cast("int"), F.lit(1))  # of the hash in its document
    seen = cold.select("doc_id", "mark", "pos", *key, first.alias("first"))
    so_far = stream.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = seen.select("doc_id", "mark", "pos", *key, F.sum("first").over(so_far).alias("nth"))
    marked = seen.select("doc_id", "mark", "pos", "nth", F.max("nth").over(Window.partitionBy(*key)).alias("n_docs"))
    from_cold = marked.where((F.col("nth") > 1) & (F.col("n_docs") >= min_docs))
    return from_hot.select("doc_id", "mark", "pos").unionByName(from_cold.select("doc_id", "mark", "pos"))


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, hot_share: int = HOT_SHARE) -> DataFrame:
    """(doc_id, mark, keep_runs, rest, n_dropped) of the texts that lose a line.

    ``keep_runs`` holds the kept runs before each run of dropped lines; after the last dropped line, ``rest`` on, all stay.
    """
    lines = stored(occurrences(docs, min_chars), "lines")
    drops = dropped_lines(lines, min_docs, hot_share).groupBy("doc_id", "mark").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    # a kept run lies between one dropped position and the next
    runs = F.expr("filter(transform(at, (p, i) -> struct(if(i = 0, 0, at[i - 1] + 1) AS start, p - if(i = 0, 0, at[i - 1] + 1) AS length)), r -> r.length > 0)")
    return drops.select("doc_id", "mark", runs.alias("keep_runs"), (F.element_at("at", -1) + 1).alias("rest"), F.size("at").cast("long").alias("n_dropped"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(row, dedup) for every row of ``docs``: the row as it was, and kept_text, n_lines, n_dropped."""
    whole, doc_id, text = F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text")
    rows = docs.select(whole, doc_id, text_mark(text).alias("mark"), lines_of(text).alias("lines"))
    kept = F.expr(
        """array_join(concat(flatten(transform(keep_runs, r -> slice(lines, r.start + 1, r.length))),
                             slice(lines, rest + 1, greatest(size(lines) - rest, 0))), '\n')"""
    )
    return rows.join(bitmaps, ["doc_id", "mark"], "left").select(
        "row",
        F.struct(
            F.when(F.col("rest").isNull(), F.array_join("lines", "\n")).otherwise(kept).alias("kept_text"),
            F.size("lines").cast("long").alias("n_lines"),
            F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        ).alias("dedup"),
    )
