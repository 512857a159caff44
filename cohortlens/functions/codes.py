"""Code normalisation helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def icd9_rollup(col) -> Column:
    """ICD-9 roll-up: keep 4 characters for E-codes, 3 for everything else.

    Null stays null; codes shorter than the cut are kept whole.
    """
    c = F.col(col) if isinstance(col, str) else col
    c = F.trim(c)
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(
        F.substring(c, F.lit(1), F.when(c.startswith("E"), F.lit(4)).otherwise(F.lit(3)))
    )
