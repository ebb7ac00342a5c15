"""Seeded stratified splits, folds, time splits and their checks."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.operators.running import order_statistics
from lendspark.schemas import SEED, TARGET

MAX_CLASSES = 1_000
PREFIX_DIGITS = 4  # 65,536 slices of the hash space


def seeded_hash(key: str, seed: int = SEED) -> Column:
    """md5 of ``seed:key`` in hex: a repeatable shuffle order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def stratified_cuts(
    df: DataFrame,
    key: str,
    label: str,
    percents: Sequence[int],
    seed: int = SEED,
) -> dict:
    """Hash values that cut every class at exact row counts.

    For class size ``n`` and percent ``q`` the cut is the hash at rank
    ``q * n div 100``. Rows are counted per slice of the hash space, the slice
    that holds a rank is found on those counts, and only that slice (about one
    row in 65,536) is ordered. Copies of a key share a hash and so stay together.
    The result, a few strings per class, is the split: it needs no data to apply.
    """
    rows = df.select(F.col(label).alias("label"), seeded_hash(key, seed).alias("h"))
    rows = rows.withColumn("slice", F.expr(f"substr(h, 1, {PREFIX_DIGITS})"))
    through = "sum(n) OVER (PARTITION BY label ORDER BY slice ROWS UNBOUNDED PRECEDING)"
    cuts_wanted = ", ".join(str(q) for q in percents)
    slices = (
        rows.groupBy("label", "slice")
        .agg(F.expr("count(1) AS n"))
        .selectExpr(
            "*", f"{through} AS through", "sum(n) OVER (PARTITION BY label) AS size"
        )
        .selectExpr("*", f"explode(array({cuts_wanted})) AS q")
        .selectExpr("label", "slice", "q", "(size * q) div 100 AS rank", "through", "through - n AS before")
        .where("before < rank AND rank <= through")
        .selectExpr("label", "slice", "q", "rank - before AS k")
        .limit(MAX_CLASSES * len(percents) + 1)
        .collect()
    )
    if len(slices) > MAX_CLASSES * len(percents):
        raise ValueError(f"column {label} has more than {MAX_CLASSES} classes")
    if not slices:
        return {}
    # The few slices that hold a rank, as a literal relation: (label, slice, q, k).
    kind = rows.schema["label"].dataType.simpleString()
    wanted = df.sparkSession.createDataFrame(slices, f"label {kind}, slice string, q int, k bigint")
    in_slice = "sum(n) OVER (PARTITION BY label, slice ORDER BY h ROWS UNBOUNDED PRECEDING)"
    picked = (
        rows.where(F.col("slice").isin(sorted({r["slice"] for r in slices})))
        .groupBy("label", "slice", "h")
        .agg(F.expr("count(1) AS n"))
        .selectExpr("label", "slice", "h", f"{in_slice} AS through", "n")
    )
    same = picked["label"].eqNullSafe(wanted["label"]) & (picked["slice"] == wanted["slice"])
    hit = (F.col("through") - F.col("n") < F.col("k")) & (F.col("through") >= F.col("k"))
    found = picked.join(wanted, same & hit).select(wanted["label"], "q", "h").collect()
    marks: dict = {}
    for r in found:  # one hash per class and percent
        marks.setdefault(r["label"], {})[r["q"]] = r["h"]
    return marks


#: Name of the hash while a part is looked up. It is a column, so a row is hashed once and not once a cut.
_HASH = "_hash of the key"


def _with_part(df: DataFrame, name: str, cuts: dict, key: str, label: str, seed: int, percents: Sequence[int]) -> DataFrame:
    """Add the number of cuts that lie below the row's hash (plain projections).

    A class too small for a cut has none there: its rows lie above that cut.
    """
    if not cuts:
        return df.withColumn(name, F.lit(len(percents)))
    classes = " ".join(
        f"WHEN {label} <=> {_literal(value)} THEN "
        + " + ".join(f"CAST(`{_HASH}` > '{at[q]}' AS INT)" if q in at else "1" for q in percents)
        for value, at in cuts.items()
    )
    part = F.expr(f"CASE {classes} ELSE {len(percents)} END")
    return df.withColumn(_HASH, seeded_hash(key, seed)).withColumn(name, part).drop(_HASH)


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, float):
        return f"CAST('{value}' AS DOUBLE)"  # NaN and infinity have no other literal
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP_NTZ '{value}'" if value.tzinfo is None else f"TIMESTAMP '{value}'"
    return f"DATE '{value}'" if isinstance(value, datetime.date) else str(value)


PARTS = ("train", "validation", "test")
SPLIT_PERCENTS = (70, 85)


def _fold_percents(folds: int) -> list[int]:
    if folds < 2 or 100 % folds:
        raise ValueError("folds must divide 100")
    return [100 // folds * i for i in range(1, folds)]


def stratified_split(
    df: DataFrame, key: str, label: str = TARGET, seed: int = SEED, percents: Sequence[int] = SPLIT_PERCENTS
) -> DataFrame:
    """Add ``split``: train / validation / test in exact class-wise proportions."""
    cuts = stratified_cuts(df, key, label, percents, seed)
    names = F.expr("array(" + ", ".join(f"'{n}'" for n in PARTS) + ")")
    return _with_part(df, "split", cuts, key, label, seed, percents).withColumn("split", F.get(names, F.col("split")))


def stratified_folds(
    df: DataFrame, key: str, label: str = TARGET, folds: int = 5, seed: int = SEED
) -> DataFrame:
    """Add ``fold`` (0 .. folds-1): shuffled, equal in size within every class."""
    percents = _fold_percents(folds)
    cuts = stratified_cuts(df, key, label, percents, seed)
    return _with_part(df, "fold", cuts, key, label, seed, percents)


def split_and_folds(
    df: DataFrame, key: str, label: str = TARGET, folds: int = 5, seed: int = SEED
) -> DataFrame:
    """Add ``split``, and ``fold`` for the training part (NULL elsewhere), from one search for cuts."""
    train, _ = SPLIT_PERCENTS
    if folds < 2 or train % folds:
        raise ValueError(f"folds must divide {train}")
    percents = [train // folds * i for i in range(1, folds)] + list(SPLIT_PERCENTS)
    cuts = stratified_cuts(df, key, label, percents, seed)
    return _with_part(df, "_k", cuts, key, label, seed, percents).selectExpr(
        *df.columns,
        f"CASE WHEN _k < {folds} THEN 'train' WHEN _k = {folds} THEN 'validation' ELSE 'test' END AS split",
        f"CASE WHEN _k < {folds} THEN _k END AS fold",
    )


def micros(ts: str | Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def time_split(df: DataFrame, ts: str, percents: Sequence[int] = (70, 85)) -> DataFrame:
    """Add ``split`` by time: everything up to the 70 % moment trains, the latest tests.

    Rows of one moment are never divided.
    """
    cuts = order_statistics(
        df.select(micros(F.col(ts)).alias("t")), {"t": [q / 100 for q in percents]}, kind="rank"
    )["t"]
    marks = [cuts[q / 100] for q in percents]
    if None in marks:
        return df.withColumn("split", F.lit(None).cast("string"))
    at = micros(F.col(ts))
    return df.withColumn(
        "split",
        F.when(at <= int(marks[0]), "train").when(at <= int(marks[1]), "validation").otherwise("test"),
    )


def split_overlap(parts: dict[str, DataFrame], key: str) -> DataFrame:
    """Keys that occur in more than one part, with the parts (none is the aim)."""
    tagged = None
    for name, part in parts.items():
        one = part.select(key, F.lit(name).alias("part"))
        tagged = one if tagged is None else tagged.unionByName(one)
    return (
        tagged.groupBy(key)
        .agg(F.array_sort(F.collect_set("part")).alias("parts"))  # at most one entry per part
        .where(F.size("parts") > 1)
    )


def split_lost(whole: DataFrame, parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of the whole that no part holds, duplicates counted."""
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return whole.exceptAll(union)


def oversample(df: DataFrame, label: str = TARGET, positive: int = 1) -> DataFrame:
    """Repeat the minority class ``majority div minority`` times (training rows only)."""
    counts = df.agg(
        F.count(F.when(F.col(label) == positive, 1)).alias("pos"),
        F.count(F.when(F.col(label) != positive, 1)).alias("neg"),
    ).first()
    pos, neg = counts["pos"], counts["neg"]
    times = max(neg, pos) // max(min(pos, neg), 1)
    minority = (F.col(label) == positive) if pos <= neg else (F.col(label) != positive)
    copies = F.when(minority, F.sequence(F.lit(1), F.lit(max(times, 1)))).otherwise(F.array(F.lit(1)))
    return df.withColumn("copy", F.explode(copies))
