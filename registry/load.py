"""Importing this module registers every query."""

from registry import enrich, learning, marts, reports, semantic, sources, state  # noqa: F401
