"""SNK-2 on a stream: insert-if-absent applied to each micro-batch.

The reference inserts rows one by one after checking that the natural key is
absent.  On a stream the same contract is a ``foreachBatch`` sink: every
micro-batch is reduced to one row per key (deterministically), anti-joined
against the keys already in the target, and appended.  A batch replayed after
a failure finds its keys present and appends nothing, so the target holds each
key once whatever the retries.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docrel.session import scratch_path
from docrel.sources.partial import among
from docrel.sources.sinks import absent_rows


def _table(spark, path: str, fmt: str) -> DataFrame | None:
    """The target, or None if there is none yet; any other failure is raised."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def append_absent_batch(target_path: str, keys: Sequence[str], *, order: Sequence[str] | None = None,
                        fmt: str = "parquet", partition_by: str | None = None
                        ) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function appending the rows of each micro-batch whose
    key is not yet in the table at ``target_path``.

    ``partition_by`` names one of the keys (a date, a hash bucket) that the target
    is partitioned by: a micro-batch then reads only the partitions it touches.
    """
    keys = list(keys)
    if partition_by is not None and partition_by not in keys:
        raise ValueError("partition_by must be one of the keys")

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        present = _table(spark, target_path, fmt)
        if present is None:
            present = spark.createDataFrame([], batch.schema)
        elif partition_by is not None:  # a value for each partition of the batch
            touched = [r[0] for r in batch.select(partition_by).distinct().collect()]
            present = present.filter(among(partition_by, touched) if touched else F.lit(False))
        fresh = absent_rows(present, batch, keys, order=order)
        w = fresh.write.mode("append").format(fmt)
        (w.partitionBy(partition_by) if partition_by else w).save(target_path)

    return run


def stream_append_if_absent(source: DataFrame, target_path: str, keys: Sequence[str], *,
                            checkpoint: str | None = None, order: Sequence[str] | None = None,
                            available_now: bool = True, fmt: str = "parquet",
                            partition_by: str | None = None) -> StreamingQuery:
    """Start a streaming query that feeds ``source`` (a streaming DataFrame)
    into ``target_path`` with insert-if-absent semantics.  The checkpoint goes
    to the shared checkpoint folder unless given."""
    ckpt = checkpoint or scratch_path(source.sparkSession, "stream-ckpt")
    sink = append_absent_batch(target_path, keys, order=order, fmt=fmt, partition_by=partition_by)
    w = source.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
