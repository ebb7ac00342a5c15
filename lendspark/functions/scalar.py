"""Column functions: guarded arithmetic, risk score and level, keys, encodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendspark.schemas import LOW_MAX, MEDIUM_MAX


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(x: float) -> str:
    """A double as SQL, infinities included."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def ratio(numerator: str, denominator: str) -> str:
    """SQL for ``numerator / denominator`` as double, NULL where the denominator is not positive."""
    return (
        f"CASE WHEN {denominator} > 0 THEN "
        f"CAST({numerator} AS DOUBLE) / CAST({denominator} AS DOUBLE) END"
    )


def at_least_one(c: str) -> str:
    """SQL for ``max(c, 1)``. ``greatest`` skips NULLs, so a NULL is kept NULL explicitly."""
    return f"CASE WHEN {c} IS NOT NULL THEN greatest(CAST({c} AS DOUBLE), 1D) END"


def risk_score(p: str) -> Column:
    """0-100 score; NULL for NULL, NaN and anything outside [0, 1].

    ``rint`` rounds halves to even, which ``round`` does not.
    """
    return F.expr(f"CASE WHEN {p} BETWEEN 0 AND 1 THEN CAST(rint({p} * 100D) AS INT) END")


def risk_level(score: str) -> Column:
    """LOW / MEDIUM / HIGH, decided on the rounded score."""
    return F.expr(
        f"CASE WHEN {score} <= {LOW_MAX} THEN 'LOW' WHEN {score} <= {MEDIUM_MAX} THEN 'MEDIUM' "
        f"WHEN {score} > {MEDIUM_MAX} THEN 'HIGH' END"
    )


def logistic(z: str) -> str:
    """SQL for the logistic function."""
    return f"(1D / (1D + exp(-({z}))))"


def direction(impact: str | Column) -> Column:
    """Sign of an impact in words; zero counts as positive (own choice)."""
    return F.when(col(impact) >= 0, "positive").when(col(impact) < 0, "negative")


def yes_no_to_int(flag: str | Column) -> Column:
    """Y / N to 1 / 0; anything else becomes NULL and so breaks its rule later."""
    return F.when(col(flag) == "Y", 1).when(col(flag) == "N", 0)


def stable_id(*keys: str | Column) -> Column:
    """Key derived from the row's own values: the same on every retry, unlike ``uuid()``.

    Parts are joined by ``|``; ``|`` and ``\\`` inside a part are escaped and NULL is ``\\N``, so that
    different keys never give the same text.
    """
    return F.sha2(F.concat_ws("|", *[_part(col(k).cast("string")) for k in keys]), 256)


def _part(text: Column) -> Column:
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
    return F.coalesce(escaped, F.lit("\\N"))


def as_uuid(hex_text: str | Column) -> Column:
    """First 32 hex digits in 8-4-4-4-12 groups."""
    return F.regexp_replace(
        F.substring(col(hex_text), 1, 32),
        "^(.{8})(.{4})(.{4})(.{4})(.{12})$",
        "$1-$2-$3-$4-$5",
    )


def model_identity(name: str | Column, version: str | Column) -> Column:
    return F.format_string("%s:v%s", col(name), col(version))


def metric(metrics: str | Column, key: str) -> Column:
    """Value of a metrics map, NULL (never 0) when the key is absent."""
    return F.try_element_at(col(metrics), F.lit(key))


def iso_encode(ts: str | Column) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def iso_decode(text: str | Column) -> Column:
    return F.to_timestamp_ntz(col(text), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
