"""Session factory and the shared working folder."""

from __future__ import annotations

import os
import tempfile
from datetime import datetime

from pyspark.sql import SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def get_session(app: str = "riskloom", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """Session with UTC time, adaptive execution and skew-join splitting.

    Nothing here is sized for one machine: ``spark.sql.shuffle.partitions``
    and memory are left to the cluster unless passed in ``conf``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session (tests) without that setting gets a folder of
    its own under the system temporary directory.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the whole cluster")
        app = context.applicationId
        if app not in _LOCAL_DIRS:
            _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="riskloom-")
        base = _LOCAL_DIRS[app]
    return os.path.join(base, *parts) if parts else base


def cut_lineage(df):
    """Reliable ``checkpoint()`` into the shared folder; survives executor loss."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def as_datetime(ts) -> datetime:
    """Run times may be given as ISO text."""
    return datetime.fromisoformat(ts) if isinstance(ts, str) else ts
