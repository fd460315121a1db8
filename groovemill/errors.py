"""Errors of the engine."""


class EngineError(Exception):
    """Base of all errors that callers may want to catch."""


class InvalidArgument(EngineError, ValueError):
    """An argument or a value in the data has no meaning."""


class MissingArgument(InvalidArgument):
    """A required argument is absent."""


class DumpNotFound(EngineError, LookupError):
    """The catalog has no dump that was asked for."""


class FileProblem(EngineError, OSError):
    """A file can't be fetched, verified or removed."""


class ImportRefused(EngineError):
    """Admission refuses a run: locked, downgrade, stale dependency or unfinished coverage."""


class RelationConflict(EngineError):
    """One relation identity has several payloads."""


class Fenced(EngineError):
    """Another run has taken over the store."""
