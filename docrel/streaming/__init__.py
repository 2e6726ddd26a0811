"""Streaming: the reference has no streams; its incremental insert-if-absent
(SNK-2) is offered here as a micro-batch sink."""

from docrel.streaming.append import append_absent_batch, stream_append_if_absent

__all__ = ["append_absent_batch", "stream_append_if_absent"]
