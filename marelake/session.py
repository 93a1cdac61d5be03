"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# What the library relies on.  AQE re-plans joins from real sizes, splits skewed
# join partitions and merges small shuffle partitions, so the initial partition
# number can stay generous on a cluster.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # call-site capture costs a third of the time it takes to build a wide plan
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# folders handed out by ``shared_dir``
_WRITTEN: list[str] = []


def build_session(app: str = "marelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediate tables.

    It lies in the folder the cluster names in ``spark.checkpoint.dir``.  Only a
    local master may fall back to the machine's temporary folder, because there
    every task runs on that machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.gettempdir()
    _WRITTEN.append(os.path.join(base, "marelake", f"{name}-{uuid.uuid4().hex}"))
    return _WRITTEN[-1]


def clear_shared(spark: SparkSession) -> None:
    """Removes the intermediate tables of this session; results that still read them must have been written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    while _WRITTEN:
        p = path(_WRITTEN.pop())
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
