"""Operators over relational tables and document collections (DataFrame in,
DataFrame out)."""

from docrel.operators import division, documents, grouping, integrity, membership, sampling

__all__ = ["division", "documents", "grouping", "integrity", "membership", "sampling"]
