"""Text to number."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Blanks and control characters around a number are ignored, as in Spark's own casts.
NUMBER = r"^[\x00-\x20\x7F]*[+-]?[0-9]+(\.[0-9]*)?[\x00-\x20\x7F]*$"
FRACTION_ONLY = r"^[\x00-\x20\x7F]*[+-]?\.[0-9]*[\x00-\x20\x7F]*$"


def lenient_bigint(text: Column) -> Column:
    """Text as bigint, cutting a decimal part and giving NULL for text that is no number.

    The same under ANSI and non-ANSI sessions. A `try_cast` that fails is slow, so text meets a
    pattern first and only a number too large for bigint can fail.
    """
    return F.when(text.rlike(NUMBER), F.substring_index(text, ".", 1).try_cast("bigint")).when(
        text.rlike(FRACTION_ONLY), F.lit(0).cast("bigint")
    )
