"""Exceptions raised on the driver before or after a Spark job."""


class NearspanError(Exception):
    """Base class of all errors of this package."""


class ConfigError(NearspanError, ValueError):
    """An option has a wrong value or does not belong to the chosen index kind."""


class DimensionError(NearspanError, ValueError):
    """Vectors, models or tables do not have the same width."""


class InvalidVectorError(NearspanError, ValueError):
    """A table holds null, empty, short or non-finite vectors."""


class NotTrainedError(NearspanError, RuntimeError):
    """A model is needed before the call."""


class EmptyTableError(NearspanError, RuntimeError):
    """A strict search was asked of an empty table."""
