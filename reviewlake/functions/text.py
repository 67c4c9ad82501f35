"""Text cleaning of review columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and the letters that replace them.
ACCENTED = "ÁÀÃÂÄÉÈÊËÍÌÎÏÓÒÕÔÖÚÙÛÜÇáàãâäéèêëíìîïóòõôöúùûüç"
UNACCENTED = "AAAAAEEEEIIIIOOOOOUUUUCaaaaaeeeeiiiiooooouuuuc"
# Fixed value: replacement list with one "i" too many, so letters from "ó" on shift by one place.
UNACCENTED_LEGACY = "AAAAAEEEEIIIIOOOOOUUUUCaaaaaeeeeiiiiiooooouuuuc"
# What is deleted from texts, and from identifiers.
SYMBOLS = r"[^\p{L}\p{N}\s\p{P}]"
IDENTIFIER_NOISE = r"[./\-\s]"


def fold_accents(text: Column, legacy_map: bool = False) -> Column:
    """Replace accented letters; ``legacy_map`` repeats the shifted table of older results.

    Text of one byte per letter is plain ASCII and passes unread.
    """
    folded = F.translate(text, ACCENTED, UNACCENTED_LEGACY if legacy_map else UNACCENTED)
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(folded)


def strip_symbols(text: Column) -> Column:
    """Delete emoji and symbols: all but letters, digits, whitespace and punctuation."""
    return F.regexp_replace(text, SYMBOLS, "")


def tidy(text: Column) -> Column:
    """Cut outer spaces and write in capitals."""
    return F.upper(F.trim(text))


def clean_text(text: Column, legacy_map: bool = False) -> Column:
    return tidy(strip_symbols(fold_accents(text, legacy_map)))


def clean_identifier(text: Column) -> Column:
    """Delete dots, slashes, hyphens and whitespace."""
    return tidy(F.regexp_replace(text, IDENTIFIER_NOISE, ""))


def clean_category(text: Column) -> Column:
    """Join words with ``_``. Outer whitespace is joined too: it is replaced before trimming."""
    return tidy(F.regexp_replace(text, r"\s+", "_"))


def anonymize(identifier: Column, salt: str = "") -> Column:
    """One-way digest of an identifier."""
    return F.sha2(F.concat(F.lit(salt), identifier) if salt else identifier, 256)
