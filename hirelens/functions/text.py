"""Text cleaning as one JVM-side Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cleaning patterns.
TAG_PATTERN = r"<[^>]+>"
SPACE_PATTERN = r"\s+"
# Pictographic ranges removed by the optional emoji step.
EMOJI_PATTERN = "[\\x{1F000}-\\x{1FAFF}\\x{2600}-\\x{27BF}\\x{FE0F}]"


def clean_text_col(c: Column | str, strip_emoji: bool = False) -> Column:
    """Remove tags (no space left behind), collapse whitespace, trim, lower.

    NULL stays NULL; HTML entities are left as they are.
    """
    c = F.col(c) if isinstance(c, str) else c
    out = F.regexp_replace(c, F.lit(TAG_PATTERN), F.lit(""))
    if strip_emoji:
        out = F.regexp_replace(out, F.lit(EMOJI_PATTERN), F.lit(""))
    out = F.regexp_replace(out, F.lit(SPACE_PATTERN), F.lit(" "))
    return F.lower(F.trim(out))


def clean_text(df, *columns: str, strip_emoji: bool = False):
    """Clean the named columns in place (one projection)."""
    return df.withColumns({c: clean_text_col(c, strip_emoji) for c in columns})
