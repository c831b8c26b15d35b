"""Registered queries by section of the operator inventory."""

from tidemark.plans import (  # noqa: F401
    aggregates,
    calendars,
    columns,
    filters,
    governance,
    history,
    joins,
    loaders,
    quality,
    ranking,
    streams,
    texts,
    windows,
)
from tidemark.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
