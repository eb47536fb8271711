"""Weighted survey microdata on Spark: staging, quality gates, curated tables and estimates."""

from microtally.errors import (
    DataQualityError,
    DuplicateShareError,
    JoinContractError,
    SourceError,
)
from microtally.session import build_session, tune

__all__ = [
    "DataQualityError",
    "DuplicateShareError",
    "JoinContractError",
    "SourceError",
    "build_session",
    "tune",
]
