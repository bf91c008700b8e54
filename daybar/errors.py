"""Typed errors raised by the job."""


class WrongFormatError(ValueError):
    """A sink was asked for a file format other than csv or parquet."""


class LedgerSchemaError(ValueError):
    """The ledger does not have exactly the expected columns."""


class RunIntentError(RuntimeError):
    """Another run of the same ledger is open, or died before it recorded its days."""


class LedgerLayoutError(ValueError):
    """The ledger path is a single file (the old layout) where a folder is expected."""
