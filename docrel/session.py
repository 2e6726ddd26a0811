"""Session helpers.

The library never assumes a local disk: lineage cuts and scratch output go to the
folder the cluster names in ``spark.checkpoint.dir``.  Only a ``local`` master without
that setting (tests, a laptop) gets a private temporary folder; a cluster without
it is an error, as its executors could not read each other's files there.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "docrel", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _conf_dir(spark: SparkSession) -> str | None:
    try:
        v = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # pragma: no cover - conf access can fail on some builds
        v = None
    return v or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where none is set.

    On a Spark Connect session (no SparkContext on the client) the server's
    ``spark.checkpoint.dir`` is used as is; it must be configured there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: checkpointing is configured server-side
        base = _conf_dir(spark)
        if base is None:
            raise RuntimeError("set spark.checkpoint.dir on the Spark Connect server")
        return base
    current = sc.getCheckpointDir()
    if current:
        return _conf_dir(spark) or current
    base = _conf_dir(spark)
    if base is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="docrel-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for intermediate tables;
    it is dropped when the session's JVM ends (or by :func:`drop_scratch`)."""
    base = ensure_checkpoint_dir(spark)
    folder = os.path.join(base, "docrel-scratch", uuid.uuid4().hex)
    fs, path = _hadoop(spark, folder)
    if fs is not None:
        fs.deleteOnExit(path)
    return os.path.join(folder, name)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Drop the folder of a :func:`scratch_path` that is no longer read."""
    fs, folder = _hadoop(spark, os.path.dirname(path))
    if fs is not None:
        fs.delete(folder, True)


def _hadoop(spark: SparkSession, path: str):
    """File system and path object, or (None, None) on a Spark Connect session."""
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    except Exception:
        return None, None
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p
