"""Text normalisation as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.constants import (
    ASCII_DIGITS,
    NO_ANSWER,
    NO_ANSWER_VARIANT,
    PERSIAN_DIGITS,
    PUNCTUATION,
    WHITESPACE,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every Unicode whitespace character at both ends (`trim` only knows spaces)."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def is_blank(c: Column | str) -> Column:
    return strip(c) == F.lit("")


def canonical_no_answer(
    c: Column | str, phrase: str = NO_ANSWER_VARIANT, canonical: str = NO_ANSWER
) -> Column:
    """Replace one no-answer wording by the canonical one, anywhere in the text."""
    return F.replace(_col(c), F.lit(phrase), F.lit(canonical))


def fold_digits(c: Column | str) -> Column:
    """Extended Arabic-Indic digits to ASCII."""
    return F.translate(_col(c), PERSIAN_DIGITS, ASCII_DIGITS)


def strip_punct(c: Column | str) -> Column:
    """Delete ASCII punctuation and the three Persian marks."""
    return F.translate(_col(c), PUNCTUATION, "")


def normalize_text(
    c: Column | str, phrase: str = NO_ANSWER_VARIANT, canonical: str = NO_ANSWER
) -> Column:
    """No-answer wording first, then digits and punctuation in one pass over the text."""
    return F.translate(canonical_no_answer(c, phrase, canonical), PERSIAN_DIGITS + PUNCTUATION, ASCII_DIGITS)


def missing_to_null(c: Column | str, na_values) -> Column:
    """Null where the text is one of `na_values`."""
    c = _col(c)
    return F.when(~c.isin(*na_values), c) if na_values else c
