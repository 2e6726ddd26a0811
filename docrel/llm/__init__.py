"""Operators for preparing text corpora: fingerprints, deduplication, mixing,
packing, classification and scrubbing.

Nothing else in the library imports this subpackage; ``__spark_entry__.py`` adds
its queries when it can be imported.
"""
