"""Operators for training data; nothing outside imports this package."""

from .queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
