"""Intermediate tables in the folder the cluster shares.

A job that needs an intermediate result more than once writes it out and reads
it back: that cuts the lineage, survives lost executors and gives the optimizer
real sizes. The folder is `spark.checkpoint.dir` of the session. Only a local
session, as in the tests, may do without and gets a temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_roots: dict[str, str] = {}


def workspace_root(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    master = spark.sparkContext.master
    one_machine = master == "local" or master.startswith(("local[", "local-cluster["))
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and app in _local_roots:
        return _local_roots[app]
    shared = shared or spark.sparkContext.getCheckpointDir()
    if shared:
        if not one_machine and shared.startswith("file:"):
            raise RuntimeError(f"{shared} is on one machine: set spark.checkpoint.dir to a folder all executors can reach")
        own = shared.rstrip("/")
        return own if own.endswith(f"/{app}") else f"{own}/{app}"
    if master.startswith("local-cluster") or not one_machine:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    _local_roots[app] = tempfile.mkdtemp(prefix="tastegraph-")
    return _local_roots[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{workspace_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_workspace(spark: SparkSession) -> None:
    """Delete what the jobs of this application have written, once their results
    are stored elsewhere."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(workspace_root(spark))
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def write(df: DataFrame, path: str) -> None:
    """Write `df`, after which the shuffle files behind it may go."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the workspace and return the table read back. The shuffle
    files behind it may go as soon as it is written."""
    path = new_path(df.sparkSession, name)
    write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
