"""Rating cleaning: range predicate and NULL / NaN removal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Valid rating range (inclusive).
DEFAULT_RATING_RANGE = (0.5, 5.0)
RATING_COLUMNS = ["user_id", "item_id", "rating", "timestamp"]


def clean_ratings(
    df: DataFrame,
    rating_range: tuple[float, float] | None = DEFAULT_RATING_RANGE,
    subset: list[str] | None = None,
    rating_col: str = "rating",
) -> DataFrame:
    """Keep ratings inside the inclusive range and rows with no NULL / NaN.

    ``subset=None`` checks every column; both predicates are plain filters
    that Catalyst combines and pushes towards the scan.
    """
    out = df
    if rating_range is not None:
        lo, hi = rating_range
        out = out.filter(F.col(rating_col).between(lo, hi))
    return out.dropna(how="any", subset=subset)
