"""Errors that a load raises because of its data."""

from __future__ import annotations


class SchemaMismatch(RuntimeError):
    """Raised when a batch has columns or types that the target cannot take."""
