"""Intermediate tables: those of the core, and Arrow's view of the shared folder."""

from __future__ import annotations

from ..tables import BROADCAST_ROWS, delete, discard, drop_matches, file_system, new_path, on_workers, settle, shared_dir, small

__all__ = ["BROADCAST_ROWS", "delete", "discard", "drop_matches", "file_system", "new_path", "on_workers", "settle", "shared_dir", "small"]
