"""Column expressions over the words of a text: runs of anything but ASCII white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words in their order; none for NULL."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def hex_number(text: Column, digits: int) -> Column:
    """The first hexadecimal digits (15 at most) of a text's MD5 as a long."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")
