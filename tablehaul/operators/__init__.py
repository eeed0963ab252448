"""Shaping, structure, writing, validation, consolidation and run history."""
