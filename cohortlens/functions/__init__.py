"""Column-level helpers (all built-in expressions, JVM side)."""

from .hashing import hash_unit
from .codes import icd9_rollup
from .sparse import format_pairs, sigmoid, jaccard_expr

__all__ = ["hash_unit", "icd9_rollup", "format_pairs", "sigmoid", "jaccard_expr"]
