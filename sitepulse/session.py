"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "sitepulse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the zone pinned to UTC (readings carry naive clock times) and AQE on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Without call-site capture, building a plan takes about half the time.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_folder() -> str:
    """One temporary folder for this process, removed at its end."""
    folder = tempfile.mkdtemp(prefix="sitepulse-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table, below the folder the cluster shares.

    ``spark.checkpoint.dir`` names that folder. Only a local master, where one machine runs
    everything, may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = _local_folder()
    return os.path.join(shared, f"{name}-{uuid.uuid4().hex}")


def spread(table: DataFrame, *keys: str) -> DataFrame:
    """``table`` dealt by the keys into a stated number of partitions, for groups that are few bytes but much work.

    Spark would merge small partitions by their bytes into one task.
    """
    spark = table.sparkSession
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return table.repartition(count, *keys)
