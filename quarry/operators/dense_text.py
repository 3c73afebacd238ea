"""Dense vectors of sparse concept vectors by a signed hash projection.

Concept i is added, with its sign, to one of ``width`` places; both come from the md5 of the
concept's id, so any engine makes the same vectors.  Inner products are kept in expectation.  The work
is one aggregate over (text, place) rows; a text has ``width`` places at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 1024


def _digits(feature: Column, first: int, n: int) -> Column:
    return F.conv(F.substring(F.md5(feature.cast("string").cast("binary")), first, n), 16, 10).cast("int")


def dense_places(vectors: DataFrame, width: int = WIDTH, id_col: str = "id", feature_col: str = "feature_id",
                 value_col: str = "value") -> DataFrame:
    """(id, place, value): the places of every vector that hold a concept; place is 0 to ``width`` - 1.

    NULL ids, features and values are left out.
    """
    if not 1 <= width <= 1 << 24:
        raise ValueError("width must be in 1..2^24")
    feature = F.col(feature_col)
    sign = F.when(_digits(feature, 9, 1) % 2 == 0, 1.0).otherwise(-1.0)
    kept = vectors.filter(F.col(id_col).isNotNull() & feature.isNotNull() & F.col(value_col).isNotNull())
    return kept.groupBy(F.col(id_col).alias("id"), (_digits(feature, 1, 6) % width).alias("place")).agg(
        F.sum(sign * F.col(value_col)).alias("value"))


def dense_vectors(places: DataFrame, width: int = WIDTH) -> DataFrame:
    """(id, vector): arrays of ``width`` doubles from :func:`dense_places`."""
    held = places.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("place", "value"))).alias("held"))
    return held.select("id", F.transform(F.sequence(F.lit(0), F.lit(width - 1)),
                                         lambda i: F.coalesce(F.element_at("held", i), F.lit(0.0))).alias("vector"))
