"""Column -> Column building blocks."""

from reviewloom.functions.gates import (
    is_not_blank,
    is_not_placeholder,
    is_present,
    passes_quality,
)
from reviewloom.functions.labels import sentiment
from reviewloom.functions.text import (
    ascii_fold,
    clean_review,
    clean_review_native,
    clean_review_once,
    register_functions,
)

__all__ = [
    "ascii_fold",
    "clean_review",
    "clean_review_native",
    "clean_review_once",
    "is_not_blank",
    "is_not_placeholder",
    "is_present",
    "passes_quality",
    "register_functions",
    "sentiment",
]
