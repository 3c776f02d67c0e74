"""Keeping costly expressions from being evaluated more than once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """``withColumn`` for a costly expression that later filters refer to.

    A filter on a plain projected column is pushed below the projection with the expression copied
    into it, so JSON or time text would be parsed again for the filter. Filters are not pushed
    through a generator, so a one-element ``explode_outer`` keeps a single evaluation.
    """
    return df.select("*", F.explode_outer(F.array(expr)).alias(name))
