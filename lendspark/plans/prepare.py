"""Preparation that decides per column on the training rows, as a saved Spark ML stage.

A numeric column without any value is dropped; one with missing values gets a flag and the exact median; all are
scaled. A category gets a 0 / 1 slot per value seen (and one for a missing value, if there was one). What was decided
is a JSON text inside the fitted stage, so the same text scores, explains and checks a table.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendspark.errors import DataValidationError, InvalidFeatureSchemaError
from lendspark.operators.running import order_statistics

#: A category with more values than this is refused: it is an id or free text.
MOST_VALUES = 1000


class _Prepared(Params):
    outputCol = Param(Params._dummy(), "outputCol", "name of the feature vector", TypeConverters.toString)


class PrepareColumns(Estimator, _Prepared, DefaultParamsReadable, DefaultParamsWritable):
    """Fit ``PreparedColumns``. Listed columns that the table does not have are left out and remembered as absent."""

    numeric = Param(Params._dummy(), "numeric", "numeric columns", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "category columns", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, numeric: Sequence[str] = (), categorical: Sequence[str] = (), outputCol: str = "features"):
        super().__init__()
        self._set(numeric=list(numeric), categorical=list(categorical), outputCol=outputCol)

    def _fit(self, dataset: DataFrame) -> PreparedColumns:
        wanted, groups = self.getOrDefault("numeric"), self.getOrDefault("categorical")
        absent = [c for c in [*wanted, *groups] if c not in dataset.columns]
        numeric = [c for c in wanted if c not in absent]
        groups = [c for c in groups if c not in absent]
        values = dataset.select(*[_number(c).alias(c) for c in numeric], *[F.col(c).cast("string").alias(c) for c in groups])
        counts = values.agg(F.count(F.lit(1)).alias("n rows"), *[F.count(c).alias(c) for c in values.columns]).first()
        n = counts["n rows"]
        if not n:
            raise DataValidationError("no training rows")
        dropped = [c for c in [*numeric, *groups] if not counts[c]]
        numeric = [c for c in numeric if c not in dropped]
        groups = [c for c in groups if c not in dropped]
        if not numeric and not groups:
            raise DataValidationError("no column holds a value")
        medians = order_statistics(values.select(*numeric), {c: (0.5,) for c in numeric}) if numeric else {}
        filled = {c: F.coalesce(F.col(c), F.lit(medians[c][0.5])) for c in numeric}
        moments = [f(x).alias(f"{k} {c}") for c, x in filled.items() for k, f in (("mean", F.avg), ("scale", F.stddev_samp))]
        row = values.agg(*moments).first() if moments else {}
        plan = {
            "rows": n,
            "absent": absent,
            "dropped": dropped,
            "numeric": [
                {"name": c, "median": medians[c][0.5], "missing": n - counts[c], "mean": row[f"mean {c}"], "scale": row[f"scale {c}"] or 1.0}
                for c in numeric
            ],
            "categorical": [
                {"name": c, "missing": n - counts[c], "values": seen} for c, seen in _seen(values, groups).items()
            ],
            "types": {c: dataset.schema[c].dataType.simpleString() for c in [*numeric, *groups]},
        }
        return PreparedColumns(plan=json.dumps(plan), outputCol=self.getOrDefault("outputCol"))


class PreparedColumns(Model, _Prepared, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the feature vector; all of it is one projection of built-in functions."""

    plan = Param(Params._dummy(), "plan", "what the fit decided, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, plan: str = "{}", outputCol: str = "features"):
        super().__init__()
        self._set(plan=plan, outputCol=outputCol)

    @property
    def decided(self) -> dict:
        return json.loads(self.getOrDefault("plan"))

    def slots(self) -> list[tuple[str, Column]]:
        """(source column, value) of each place of the vector, in order."""
        out, plan = [], self.decided
        for d in plan["numeric"]:
            x = _number(d["name"])
            out.append((d["name"], (F.coalesce(x, F.lit(d["median"])) - F.lit(d["mean"])) / F.lit(d["scale"])))
            if d["missing"]:
                out.append((d["name"], x.isNull().cast("double")))
        for d in plan["categorical"]:
            c = F.col(d["name"]).cast("string")
            out += [(d["name"], c.eqNullSafe(v).cast("double")) for v in d["values"]]
            if d["missing"]:
                out.append((d["name"], c.isNull().cast("double")))
        return out

    def decisions(self) -> list[tuple]:
        """(column, decision, missing, median, values) of every column the fit was asked for."""
        plan = self.decided
        rows = [(c, "absent", None, None, None) for c in plan["absent"]]
        rows += [(c, "dropped", plan["rows"], None, None) for c in plan["dropped"]]
        rows += [(d["name"], "filled and flagged" if d["missing"] else "number", d["missing"], d["median"], None) for d in plan["numeric"]]
        rows += [(d["name"], "category", d["missing"], None, len(d["values"])) for d in plan["categorical"]]
        return rows

    def _transform(self, dataset: DataFrame) -> DataFrame:
        problems = schema_problems(self.decided["types"], dataset.schema)
        if problems:
            raise InvalidFeatureSchemaError("; ".join(problems))
        return dataset.withColumn(self.getOrDefault("outputCol"), array_to_vector(F.array(*[c for _, c in self.slots()])))


def _number(name: str) -> Column:
    """As a double; NaN is a missing value."""
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def _seen(values: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """The distinct values of each category, ascending, found in one pass; at most one value too many of each is collected."""
    if not columns:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in columns])).alias("x")
    found = values.select(pairs).select("x.*").where("value IS NOT NULL").distinct()
    place = F.row_number().over(Window.partitionBy("name").orderBy("value"))
    out: dict[str, list[str]] = {c: [] for c in columns}
    for r in found.withColumn("place", place).where(F.col("place") <= MOST_VALUES + 1).collect():
        out[r["name"]].append(r["value"])
    many = [c for c, v in out.items() if len(v) > MOST_VALUES]
    if many:
        raise DataValidationError(f"more than {MOST_VALUES} values, not a category: {', '.join(sorted(many))}")
    return {c: sorted(v) for c, v in out.items()}


_WIDTH = {"tinyint": 1, "smallint": 2, "int": 3, "bigint": 4, "float": 5, "double": 6}


def schema_problems(expected: dict[str, str], found: T.StructType, extra: Sequence[str] | None = None) -> list[str]:
    """What keeps a table from being scored by a model trained on ``expected`` (column -> type), in order.

    A number may be narrower than in training, not wider. With ``extra`` (the columns that may be there beside the
    expected ones), any other column is a problem too.
    """
    types = {f.name: f.dataType.simpleString() for f in found.fields}
    out = [f"missing column {c}" for c in expected if c not in types]
    for c, t in expected.items():
        if c in types and types[c] != t and not _WIDTH.get(types[c], 9) < _WIDTH.get(t, 0):
            out.append(f"column {c} is {types[c]}, not {t}")
    if extra is not None:
        out += [f"unexpected column {c}" for c in types if c not in expected and c not in extra]
    return out
