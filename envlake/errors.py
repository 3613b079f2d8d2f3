"""Errors raised by the gates between pipeline stages."""


class InputError(ValueError):
    """The input of a stage cannot be read or breaks its contract."""


class ConflictError(ValueError):
    """Two sources disagree about the same identity."""


class QueryArgumentError(ValueError):
    """A query argument lies outside its domain."""


def is_missing_path(error: Exception) -> bool:
    """Whether reading failed because nothing is there; any other failure must not pass for it."""
    return getattr(error, "getCondition", lambda: None)() == "PATH_NOT_FOUND"
