"""Text functions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# The list-text clean-up chain, applied in this order.
LIST_TEXT_RULES = (
    ("List", ""),
    (r"\(", "["),
    (r"\)", "]"),
)


def replace_all(text: Column, rules: Iterable[tuple[str, str]] = LIST_TEXT_RULES) -> Column:
    """Apply each (pattern, replacement) to every match, one rule after the other."""
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def nested_json(value: Column) -> Column:
    """A nested value as JSON text, with NULL fields kept."""
    return F.to_json(value, {"ignoreNullFields": "false"})
