"""Errors raised by a load. All are ``ValueError`` so one ``except`` covers them."""


class SpecError(ValueError):
    """The load is described wrongly: a bad field, date request or target."""


class SourceError(ValueError):
    """The source query could not be analysed or executed."""


class DataQualityError(ValueError):
    """The source rows must not be published; the target was left as it was."""


class VerificationError(ValueError):
    """What the target holds after the write differs from what was checked."""


class ConflictError(ValueError):
    """Another load has published, or is publishing, the same partitions; this one has changed nothing."""
