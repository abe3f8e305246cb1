"""Typed errors raised by tablekit; Spark's own error classes pass through untouched."""


class TablekitError(Exception):
    """Base class of all tablekit errors."""


class UnsupportedFormat(TablekitError):
    """The file suffix, format name or URL scheme has no reader or writer."""


class NoData(TablekitError):
    """A load was asked to insert nothing."""


class InvalidVariables(TablekitError):
    """Check variables are not a JSON object, or a variable is missing."""


class TableNotFound(TablekitError):
    """The named table is not in the catalog."""


class SchemaConflict(TablekitError):
    """A batch column has another type than the target column."""


class InvalidSpec(TablekitError):
    """A check, load or model was declared with contradictory arguments."""
