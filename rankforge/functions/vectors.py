"""Column functions on ``array<float>`` vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm(v: Column) -> Column:
    squares = F.aggregate(
        v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )
    return F.sqrt(squares)


def l2_normalise(v: Column) -> Column:
    """Scale to unit length, so that cosine is a dot product; zero stays zero."""
    n = norm(v)
    return F.transform(v, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0)))
