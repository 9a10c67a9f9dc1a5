"""Spark session settings for the warehouse jobs.

The cluster owns ``spark.checkpoint.dir``; jobs read it from the session and
only fall back to a scratch folder when it is unset (local tests).
"""

from __future__ import annotations

import os
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: adaptive re-planning (partition coalescing,
# skew-join splitting, runtime broadcast), UTC so date casts never shift, and
# no web UI.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "ledgerloom", extra: dict | None = None) -> SparkSession:
    """A session with the job settings above (used by tests, the benchmark and the CLI)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(JOB_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Folders of a partitioned write that a task keeps open side by side. Beyond them it sorts the rest.
OPEN_WRITERS = 16
WRITERS_CONF = "spark.sql.maxConcurrentOutputFileWriters"


def keep_writers_open(spark: SparkSession) -> None:
    """Partitioned writes of few folders need no sort of whole rows; a session's own setting is kept."""
    if int(spark.conf.get(WRITERS_CONF, "0")) == 0:
        spark.conf.set(WRITERS_CONF, str(OPEN_WRITERS))


# Input that one partition of a shuffle is made for. In a fixed number of partitions a task's rows,
# and from some size on what it spills, grow with the input.
BYTES_A_PARTITION = 4 << 20
INITIAL_CONF = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_SIZED = "ledgerloom.shuffles.sized"


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions that a shuffle begins with, before adaptive execution joins small ones."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get(_SIZED, "0")))


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Let shuffles begin with enough partitions for the input; a session's own initial number is kept."""
    own = spark.conf.get(INITIAL_CONF, None)
    if own is not None and own != spark.conf.get(_SIZED, None):
        return
    needed = -(-input_bytes // BYTES_A_PARTITION)
    if needed > shuffle_partitions(spark):
        spark.conf.set(_SIZED, str(needed))
        spark.conf.set(INITIAL_CONF, str(needed))


# Spark plans a broadcast by the size of a scan's files. Ids in order and repeated texts take a byte or two
# a row there and over a hundred in the table that the driver builds and sends, so millions of rows would pass.
UNPACKED = 100
UNPACKED_CONF = "spark.sql.sources.fileCompressionFactor"


def size_broadcasts(spark: SparkSession) -> None:
    """Let plans count files by what their rows take in memory; a session's own factor is kept.

    A side that this leaves to a shuffle is still broadcast by adaptive execution if its rows, then
    measured, are small.
    """
    if float(spark.conf.get(UNPACKED_CONF, "1.0")) == 1.0:
        spark.conf.set(UNPACKED_CONF, str(float(UNPACKED)))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
            spark.sparkContext.setCheckpointDir(current)
        return current
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        path = jdir.get()
    elif not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    else:
        # Local runs only (a cluster names its shared folder): one stable
        # folder, so later sessions reuse the snapshots keyed by input + code.
        path = os.path.join(tempfile.gettempdir(), "ledgerloom-checkpoints")
        os.makedirs(path, exist_ok=True)
        spark.sparkContext.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


SCRATCH = "ledgerloom-scratch"


def scratch_folder(spark: SparkSession, kind: str) -> str:
    """A fresh folder name under the checkpoint folder, for files of one call."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{SCRATCH}/{kind}-{uuid.uuid4().hex}"


# Folders under the checkpoint folder that hold files of single calls.
CALL_FOLDERS = (SCRATCH, "ledgerloom-llm", "ledgerloom-keys")


def remove_scratch(spark: SparkSession, older_than_hours: float = 48.0) -> int:
    """Delete the calls' own folders that are older than a limit; returns how many."""
    limit, gone = (time.time() - older_than_hours * 3600) * 1000, 0
    for name in CALL_FOLDERS:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            continue
        for s in fs.listStatus(path):
            if s.getModificationTime() < limit:
                gone += fs.delete(s.getPath(), True)
    return gone
