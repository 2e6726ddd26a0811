"""docrel — relational tables and nested document collections on Spark.

Every public function takes and returns DataFrames; Catalyst plans the work.
Sub-packages:

* ``sources``    — reading collections/tables and writing them back (SRC-*, SNK-*)
* ``functions``  — column-level helpers (arrays, hashing, formatting)
* ``operators``  — membership, grouping, division, documents, integrity, sampling
* ``plans``      — layout/tuning helpers, the six end-to-end queries, the test mapping
* ``streaming``  — micro-batch form of the idempotent append
"""

from docrel.session import ensure_checkpoint_dir, get_session, scratch_path

__all__ = ["ensure_checkpoint_dir", "get_session", "scratch_path"]
