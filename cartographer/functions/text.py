"""Text expressions (unicode-aware, as Python's ``re``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def strip_markup(t: Column) -> Column:
    """Remove the literal tokens of the review cleanup, in order."""
    for tok in C.REVIEW_STRIP_TOKENS:
        t = F.replace(t, F.lit(tok), F.lit(""))
    return t


def strip_tags(t: Column) -> Column:
    """Remove markup tags, with their attributes."""
    return F.regexp_replace(t, r"</?[A-Za-z][^<>]*>", "")


def normalize(t: Column) -> Column:
    """lower-case, then drop every char that is neither a word char nor space."""
    return F.regexp_replace(F.lower(t), r"(?U)[^\w\s]", "")


def tokens(t: Column) -> Column:
    """Tokens of the normalised text: runs of two or more word characters."""
    return F.regexp_extract_all(normalize(F.coalesce(t, F.lit(""))), F.lit(r"(?U)(\w\w+)"), 1)
