"""Column functions: text cleaning, typed casts and predicates. All run inside the JVM."""

from reviewlake.functions.predicates import is_blank, lossy_cast, any_of
from reviewlake.functions.text import (
    anonymize,
    clean_category,
    clean_identifier,
    clean_text,
    fold_accents,
    strip_symbols,
    tidy,
)

__all__ = [
    "anonymize", "any_of", "clean_category", "clean_identifier", "clean_text",
    "fold_accents", "is_blank", "lossy_cast", "strip_symbols", "tidy",
]
