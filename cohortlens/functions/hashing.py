"""Deterministic pseudo-random numbers from ids.

The reference draws seeded random numbers (Pig RANDOM, Python random, numpy).  Those
streams cannot be reproduced on a distributed engine, and a seeded ``rand()`` changes
with partitioning.  We use a hash of the id instead: the same row always gets the same
number, whatever the partitioning or the executor that recomputes it.

``hash_unit(id, salt)`` = first 32 bits of md5(salt || id) / 2**32, in [0, 1).
DuckDB equivalent: ``('0x'||substr(md5(salt||id::varchar),1,8))::ubigint/4294967296.0``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_unit(col, salt: str | Column = "") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    text = c.cast("string")
    if isinstance(salt, Column):
        text = F.concat(salt.cast("string"), text)
    elif salt:
        text = F.concat(F.lit(salt), text)
    top = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return top / F.lit(4294967296.0)


def hash_unit_sql(expr: str, salt: str = "") -> str:
    """The DuckDB form of :func:`hash_unit` (used by the oracle SQL)."""
    inner = f"{expr}::varchar" if not salt else f"'{salt}' || {expr}::varchar"
    return f"(('0x' || substr(md5({inner}), 1, 8))::ubigint / 4294967296.0)"
