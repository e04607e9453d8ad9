"""Errors that users of the engine see."""


class SqlError(Exception):
    """A statement that can't be parsed, planned or run."""
