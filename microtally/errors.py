"""Errors that stop a run."""


class SourceError(Exception):
    """A source file or list is missing, ambiguous, empty or unusable."""


class DuplicateShareError(Exception):
    """More duplicates than allowed: usually a wrong key or a corrupt file."""


class JoinContractError(Exception):
    """A join side breaks the uniqueness or completeness its caller declared."""


class DataQualityError(Exception):
    """At least one check of severity ``error`` failed."""

    def __init__(self, message, results=()):
        super().__init__(message)
        self.results = list(results)
