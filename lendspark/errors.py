"""Exceptions raised by lendspark."""


class LendSparkError(Exception):
    """Base class of every error this package raises on purpose."""


class EntityNotFoundError(LendSparkError):
    """A lookup by key matched no row."""


class ModelNotFoundError(LendSparkError):
    """No saved model (or no metadata beside it) exists at a path."""


class ModelLoadError(LendSparkError):
    """A saved model exists but cannot be read back."""


class InvalidFeatureSchemaError(LendSparkError):
    """A table does not have the columns and types a model was fitted on."""


class DataValidationError(LendSparkError):
    """A table broke its rules and the caller asked to stop on that."""


class ExplanationError(LendSparkError):
    """Contributions cannot be computed for a model or table."""


class BatchSizeExceededError(LendSparkError):
    """A request batch holds more items than allowed."""


class RegistryStateError(LendSparkError):
    """The model registry breaks an invariant (active model, delete restrict)."""
