"""Intermediate tables of the operators: the library's shared scratch folder."""

from __future__ import annotations

from ..sources.scratch import new_path, shared_folder, staged

__all__ = ["new_path", "shared_folder", "staged"]
