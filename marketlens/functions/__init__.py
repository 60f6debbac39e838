"""Column-expression helpers (built-in Spark functions only)."""

from marketlens.functions import bands, semantics

__all__ = ["bands", "semantics"]
