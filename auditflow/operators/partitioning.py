"""Using all cores when the input arrives in few pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, pieces: int | None) -> DataFrame:
    """Deal the rows out over so many partitions; as they are without a number.

    For an input that comes in fewer pieces than there are cores, such as one unsplittable file or a
    topic of a handful of partitions: parsing JSON costs far more than moving it. It is a shuffle of
    the whole input, so it is only done on request.
    """
    return df.repartition(pieces) if pieces else df
