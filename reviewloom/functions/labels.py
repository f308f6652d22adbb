"""Rating -> sentiment label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sentiment(
    rating: Column | str,
    negative_from: float = 1.0,
    neutral_from: float = 3.0,
    positive_from: float = 4.0,
) -> Column:
    """Half-open rating bands; no upper bound on the last one.

    A missing rating is ``unknown``. A rating below the first band gets no
    label (NULL). NaN sorts above every number, hence ``positive``.
    """
    r = F.col(rating) if isinstance(rating, str) else rating
    return (
        F.when(r.isNull(), "unknown")
        .when(r >= positive_from, "positive")
        .when(r >= neutral_from, "neutral")
        .when(r >= negative_from, "negative")
    )
