"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and the letters they fold to, position by position.
ACCENTED = "áàãâäéèêëíìîïóòõôöúùûüçñÁÀÃÂÄÉÈÊËÍÌÎÏÓÒÕÔÖÚÙÛÜÇÑ"
UNACCENTED = "aaaaaeeeeiiiiooooouuuucnAAAAAEEEEIIIIOOOOOUUUUCN"


def normalize_string(text: Column) -> Column:
    """Fold the listed accented letters to ASCII, then upper-case.

    Text that is ASCII already, as keys and codes are, skips the letter-wise pass.
    """
    is_ascii = F.octet_length(text) == F.char_length(text)
    return F.upper(F.when(is_ascii, text).otherwise(F.translate(text, ACCENTED, UNACCENTED)))


def after_last(text: Column, marker: str) -> Column:
    """The part after the last ``marker``; the whole text if there is none."""
    return F.split_part(text, F.lit(marker), F.lit(-1))


def leading_day(text: Column, marker: str) -> Column:
    """The yyyyMMdd number in the 8 characters after the last ``marker``; null if they are no number."""
    return F.substring(after_last(text, marker), 1, 8).try_cast("int")
