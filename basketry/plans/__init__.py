"""Registered queries over the bench tables."""

from . import baskets, catalogue, documents, evaluation, examples, metrics, texts  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
