"""Small text expressions used by loads and by run history."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The longest error message kept, and the label of a run without path and description.
MESSAGE_LENGTH = 1000
NO_LABEL = "(unknown)"


def normalize_name(name: str) -> str:
    """Element name to column name."""
    return name.lower().replace("-", "_")


def clip_message(message: Column) -> Column:
    return F.left(message, F.lit(MESSAGE_LENGTH))


def label(path: Column, description: Column) -> Column:
    """What a run is called: its path, else its description."""
    return F.coalesce(path, description, F.lit(NO_LABEL))


def field_rank(value: Column, *choices: str) -> Column:
    """1-based place of ``value`` among ``choices``; 0 when it is none of them or null."""
    return F.coalesce(F.array_position(F.array(*[F.lit(c) for c in choices]), value), F.lit(0)).cast("int")


def parse_flag(text: Column) -> Column:
    """Text or number to boolean; unreadable or missing is false."""
    return F.coalesce(text.try_cast("boolean"), text.try_cast("double") != 0, F.lit(False))


def starts_with_text(column: Column, prefix: str, *, ignore_case: bool = False) -> Column:
    """``LIKE 'prefix%'``. Exact case reaches the file scan; ignoring case does as the usual source databases do."""
    return F.lower(column).like(f"{prefix.lower()}%") if ignore_case else column.like(f"{prefix}%")


def contains_text(column: Column, part: str, *, ignore_case: bool = False) -> Column:
    """``LIKE '%part%'``."""
    return F.lower(column).like(f"%{part.lower()}%") if ignore_case else column.like(f"%{part}%")
