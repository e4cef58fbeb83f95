"""Queries over the supplied tables, one or more per operator, with their SQL counterparts."""

from checks.registry import REGISTRY
from checks import cleaning, comparing, features, joining, metrics, modelling, profiling, sampling, selecting, sources  # noqa: F401

__all__ = ["REGISTRY"]
