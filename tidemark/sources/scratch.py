"""Shared scratch space for checkpoints and staged tables.

On a cluster the folder comes from ``spark.checkpoint.dir``, which all
executors can reach.  Only a session on a local master may leave it unset: it
has one machine, and gets a temporary folder that is removed with it.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting that an execution's shuffle files are removed when it ends.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folders: dict[str, str] = {}


def _shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    already_set = context.getCheckpointDir()
    app = context.applicationId
    if not already_set and not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if app not in _local_folders:
        if not already_set:
            already_set = tempfile.mkdtemp(prefix="tidemark-")
            atexit.register(shutil.rmtree, already_set, ignore_errors=True)
        _local_folders[app] = already_set
    return _local_folders[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{_shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame, free: bool = False) -> DataFrame:
    """Materialise ``df`` on the shared folder and cut its lineage there.

    With ``free``, shuffle files that made it go at once; else they go when the
    driver has collected its garbage, which may be after many more checkpoints.
    """
    context, conf = df.sparkSession.sparkContext, df.sparkSession.conf
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_shared_folder(df.sparkSession))
    if not free:
        return df.checkpoint(eager=True)
    before = conf.get(_FREE_SHUFFLES, "false")
    conf.set(_FREE_SHUFFLES, "true")
    try:  # a frame keeps the setting that it was made under
        once = df.select("*")
    finally:
        conf.set(_FREE_SHUFFLES, before)
    return once.checkpoint(eager=True)
