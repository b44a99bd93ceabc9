"""Registered queries with their check SQL."""

from . import cleaning, encoders, evaluation, features, learning, reports  # noqa: F401
from .base import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
