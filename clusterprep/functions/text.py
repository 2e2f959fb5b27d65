"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that separate words. These are the ones Python's
# str.split() uses: Unicode white space and the four information separators.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"


def words(text: Column) -> Column:
    """Array of the white-space separated words of a text.

    White space at either end of the text leaves an empty word there.
    """
    return F.split(text, WHITESPACE)
