"""Session helpers.

The library never creates folders on the machine it runs on: lineage cuts go
to ``spark.checkpoint.dir`` (a shared folder named by the cluster), and it is
an error if none is configured.  Callers on one machine (tests, benches) name
one themselves.  :func:`scratch_scope` removes what was written there;
:func:`freed_shuffles` keeps shuffle files from piling up between steps.
"""

from __future__ import annotations

import contextlib
import os
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings that matter at any scale: AQE re-plans joins and coalesces
# partitions from runtime statistics; skew join splits hot partitions.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benches (a cluster passes its own)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = SparkSession.builder.master(master or f"local[{cpus}]").appName(app_name)
    conf = dict(_DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf["tessera.minTextPartitions"] = str(cpus)
    conf["spark.driver.memory"] = os.environ.get("TESSERA_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session: ``spark.checkpoint.dir``, or what
    ``setCheckpointDir`` named.  Raises if there is none."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a table written inside go when it is written.
    Otherwise they stay until the driver happens to collect its garbage, and
    the steps of a long job have theirs on disk all at once."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


_SCOPES: list[list[str]] = []


def own_scratch(path: str) -> str:
    """Leave ``path`` to the innermost :func:`scratch_scope`, if any."""
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables written inside are removed at its end, so results must
    have been written or collected by then.  Without a scope they stay."""
    _SCOPES.append([])
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _SCOPES.pop():
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(hadoop).delete(p, True)
