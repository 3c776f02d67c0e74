"""Comma lists and tab-separated lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_codes(codes: Column) -> Column:
    """Split a comma list: no trimming, inner empty codes kept, trailing empty codes dropped.

    Text made only of commas holds no code at all; the empty text holds one empty code.
    """
    kept = F.split(F.regexp_replace(codes, ",+$", ""), ",")
    return F.when(codes.rlike("^,+$"), F.array().cast("array<string>")).otherwise(kept)


def tab_line(*cols: Column) -> Column:
    """Tab-joined text in which a null prints as ``null``."""
    return F.concat_ws("\t", *(F.coalesce(c.cast("string"), F.lit("null")) for c in cols))
