"""Connected components of links: those of the core."""

from __future__ import annotations

from ..operators.graph import components

__all__ = ["components"]
