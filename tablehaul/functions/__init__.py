"""Column expressions."""

from tablehaul.functions.dates import duration_seconds, format_duration, ntz, parse_http_date, same_zone_literal
from tablehaul.functions.text import (clip_message, contains_text, field_rank, label, normalize_name, parse_flag,
                                      starts_with_text)

__all__ = ["clip_message", "contains_text", "duration_seconds", "field_rank", "format_duration", "label",
           "normalize_name", "ntz", "parse_flag", "parse_http_date", "same_zone_literal", "starts_with_text"]
