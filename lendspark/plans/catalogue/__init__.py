"""Named queries over the test tables, with SQL for side-by-side checks."""

from lendspark.plans.catalogue import (  # noqa: F401
    evaluation,
    jobs,
    joins,
    models,
    monitoring,
    preparation,
    quality,
    risk,
    tables,
    validation,
)
from lendspark.plans.catalogue.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
