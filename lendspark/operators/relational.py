"""Renames, normalisation into tables, lookups, key joins and delete rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendspark.errors import EntityNotFoundError, RegistryStateError
from lendspark.functions.scalar import stable_id, yes_no_to_int
from lendspark.schemas import (
    API_TO_TABLE,
    APPLICATION,
    COMMON_SHAPE,
    FEATURES,
    FORBIDDEN_FEATURES,
    SOURCE_TO_API,
)


# ------------------------------------------------------------------ projections
def source_to_api(df: DataFrame) -> DataFrame:
    """Raw file names to application names; the Y / N default flag becomes 1 / 0."""
    renamed = {v: F.col(k) for k, v in SOURCE_TO_API.items()}
    renamed["previous_defaults"] = yes_no_to_int("cb_person_default_on_file")
    kept = [c for c in df.columns if c not in SOURCE_TO_API]
    return df.select(*kept, *[e.alias(n) for n, e in renamed.items()])


def api_to_table(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in API_TO_TABLE.items() if k in df.columns})


def feature_frame(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The request fields in their declared order and type, NULLs kept, outcome excluded."""
    types = {f.name: f.dataType for f in APPLICATION.fields}
    return df.select(*extra, *[F.col(c).cast(types[c]).alias(c) for c in FEATURES])


def drop_forbidden(df: DataFrame) -> DataFrame:
    return df.drop(*FORBIDDEN_FEATURES)


#: Names under which a table may hold a column of the shape.
_OTHER_NAMES = {"previous_default": "previous_defaults"}


def to_shape(df: DataFrame, shape: T.StructType = COMMON_SHAPE) -> DataFrame:
    """Bring any compatible table to ``shape``; what it lacks becomes typed NULL."""

    def found(name: str) -> Column:
        held = next((n for n in (name, _OTHER_NAMES.get(name)) if n in df.columns), None)
        return F.lit(None) if held is None else F.col(held)

    return df.select(*[found(f.name).cast(f.dataType).alias(f.name) for f in shape.fields])


def _lenient(f: T.StructField) -> Column:
    """A whole number may be written with a zero fraction (34.0); any other fraction does not convert."""
    if not isinstance(f.dataType, (T.IntegerType, T.LongType)):
        return F.col(f.name).try_cast(f.dataType)
    exact = F.col(f.name).try_cast("decimal(38,10)")
    return F.when(exact == F.floor(exact), exact.try_cast(f.dataType))


def lenient_cast(df: DataFrame, shape: T.StructType = APPLICATION) -> DataFrame:
    """Text columns to their declared types; text that does not convert becomes NULL
    and is listed in ``unconverted``."""
    fields = [f for f in shape.fields if f.name in df.columns]
    failed = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(f.name).isNotNull() & _lenient(f).isNull(),
                    F.lit(f.name),
                )
                for f in fields
            ]
        )
    )
    keep = [c for c in df.columns if c not in {f.name for f in fields}]
    return df.select(
        *keep,
        *[_lenient(f).alias(f.name) for f in fields],
        failed.alias("unconverted"),
    )


# ---------------------------------------------------------------- normalisation
# A value that its decimal type cannot hold becomes NULL; ``validate.decimal_rule`` finds such rows beforehand.
def _latest(df: DataFrame, key: str, columns: Sequence[str], ts: str, tie: str) -> DataFrame:
    """The newest row per key: combined before the shuffle (sorted by key on both sides of it), so a hot key stays cheap."""
    newest = F.max_by(F.struct(*columns), F.struct(ts, tie))
    return df.groupBy(key).agg(newest.alias("_r")).select(key, "_r.*")


def normalise_customers(apps: DataFrame) -> DataFrame:
    """One row per customer, from the latest application."""
    rows = _latest(
        apps,
        "customer_id",
        ("age", "income", "home_ownership", "employment_years"),
        "application_ts",
        "application_id",
    )
    return rows.select(
        F.col("customer_id").alias("id"),
        "age",
        F.col("income").try_cast("decimal(14,2)").alias("income"),
        "home_ownership",
        F.col("employment_years").try_cast("decimal(5,2)").alias("employment_years"),
    )


def normalise_loans(apps: DataFrame) -> DataFrame:
    share = F.try_divide("amount", F.when(F.col("income") > 0, F.col("income")))
    return api_to_table(apps).select(
        F.col("application_id").alias("id"),
        "customer_id",
        F.col("amount").try_cast("decimal(14,2)").alias("amount"),
        F.col("interest_rate").try_cast("decimal(5,2)").alias("interest_rate"),
        "term_months",
        "purpose",
        "grade",
        "loan_status",
        F.round(share, 4).try_cast("decimal(5,4)").alias("loan_percent_income"),
    )


def normalise_credit_histories(apps: DataFrame) -> DataFrame:
    """One row per customer, as the latest application reports it."""
    rows = _latest(
        apps,
        "customer_id",
        (
            "credit_history_years",
            "previous_defaults",
            "late_payments",
            "credit_utilization",
            "active_credit_lines",
        ),
        "application_ts",
        "application_id",
    )
    return rows.select(
        stable_id(F.lit("history"), "customer_id").alias("id"),
        "customer_id",
        F.col("credit_history_years").cast("int").alias("credit_history_years"),
        "previous_defaults",
        "late_payments",
        F.col("credit_utilization").try_cast("decimal(5,4)").alias("credit_utilization"),
        "active_credit_lines",
    )


def customer_read(customers: DataFrame) -> DataFrame:
    """Decimals as double, for readers outside the tables."""
    return customers.select(
        "id",
        "age",
        F.col("income").cast("double").alias("income"),
        F.col("employment_years").cast("double").alias("employment_years"),
        "home_ownership",
    )


# ---------------------------------------------------------------------- lookups
def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """Rows with this key; the filter reaches the scan."""
    return df.where(F.col(key) == F.lit(value))


def lookup_one(df: DataFrame, key: str, value):
    rows = lookup(df, key, value).take(1)
    if not rows:
        raise EntityNotFoundError(f"no row with {key} = {value!r}")
    return rows[0]


def lookup_many(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows whose key occurs in the single column of ``ids``."""
    return df.join(ids.select(F.col(ids.columns[0]).alias(key)), key, "left_semi")


# ------------------------------------------------------------------------ joins
def join_parent(
    child: DataFrame, parent: DataFrame, fk: str, pk: str = "id", how: str = "inner"
) -> DataFrame:
    """Child rows with their parent's columns, prefixed ``parent_``.

    No broadcast hint: the size of the parent is unknown here, so the choice is
    left to the statistics and to run-time re-planning, which also splits hot keys.
    """
    renamed = parent.select(*[F.col(c).alias(f"parent_{c}") for c in parent.columns])
    return child.join(renamed, child[fk] == renamed[f"parent_{pk}"], how)


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose (non-NULL) key has no parent."""
    known = child.where(F.col(fk).isNotNull())
    return known.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def delete_cascade(child: DataFrame, deleted: DataFrame, fk: str, pk: str) -> DataFrame:
    """What is left of the child table after its parents were deleted."""
    return child.join(deleted.select(F.col(pk).alias(fk)), fk, "left_anti")


def delete_set_null(child: DataFrame, deleted: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows kept, their key emptied where the parent was deleted."""
    gone = deleted.select(F.col(pk).alias("_gone")).distinct()
    cleared = F.when(F.col("_gone").isNull(), F.col(fk)).alias(fk)
    return child.join(gone, F.col(fk) == F.col("_gone"), "left").select(
        *[cleared if c == fk else F.col(c) for c in child.columns]
    )


def delete_blocked(parents: DataFrame, child: DataFrame, pk: str, fk: str) -> DataFrame:
    """Of the parents asked to be deleted, those that child rows still use."""
    return parents.join(child.select(F.col(fk).alias(pk)), pk, "left_semi")


def delete_restrict(parents: DataFrame, child: DataFrame, pk: str, fk: str) -> DataFrame:
    used = delete_blocked(parents, child, pk, fk).select(pk).take(1)
    if used:
        raise RegistryStateError(f"{pk} {used[0][0]!r} is still in use")
    return parents
