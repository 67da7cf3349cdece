"""Session construction and the shared scratch location.

Library code never creates a session on its own; callers (tests, bench,
notebooks) use :func:`build_session`.  Jobs that must write intermediate
files use :func:`shared_dir`, which always lives under the cluster's
``spark.checkpoint.dir`` so that it survives the loss of an executor.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale.  AQE re-plans joins at run time (broadcast
# when a materialised side turns out small, splits skewed partitions of
# semi/anti/inner joins) and coalesces small shuffle partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "reachset",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings above.

    Started by a submit command, the session takes its master, partition
    count, memory and warehouse from there (a value set in code would win
    over the command's); only what the caller passes, and SQL settings that
    the command leaves open, are set.  Else it is a local session.
    """
    submitted = "PYSPARK_GATEWAY_PORT" in os.environ or "PYSPARK_SUBMIT_ARGS" in os.environ
    conf: dict[str, str] = {}
    if not submitted:
        master = master or "local[*]"
        conf = SCALE_CONF | {"spark.driver.memory": "8g"}
        if master.startswith("local"):
            # keep catalog files out of the working directory
            conf["spark.sql.warehouse.dir"] = tempfile.mkdtemp(prefix="reachset-warehouse-")
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in (conf | (extra or {})).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if submitted:
        given = spark.sparkContext.getConf()
        for k, v in SCALE_CONF.items():
            if k.startswith("spark.sql.") and not given.contains(k):
                spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, S3,
    ...) and is used as is; without it this raises, as a folder of one
    machine would lose intermediate data.  Only local runs (one machine) make
    and register a private directory.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect client has no SparkContext
        sc = None
    current = (sc.getCheckpointDir() if sc else None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if current:
        if sc and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    master = sc.master if sc else spark.conf.get("spark.master", "")
    if not re.match(r"local(\[[^,]*(,[^,]*)?\])?$", master):
        raise ValueError(
            "spark.checkpoint.dir is not set: on a cluster it must name a folder that "
            "the driver and all executors share"
        )
    local = tempfile.mkdtemp(prefix="reachset-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    if sc:
        sc.setCheckpointDir(local)
        return sc.getCheckpointDir().rstrip("/")
    return local


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:") and "://" not in base:
        base = base[len("file:"):]
    return f"{base}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and return a frame
    that reads it back (reliable ``checkpoint``, never a local one).

    For a sub-result that several branches of a long plan reuse: lost
    executors then cost a re-read, not a recomputation of the whole
    lineage.  Runs one job.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
