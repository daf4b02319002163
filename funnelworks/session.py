"""Session defaults and the shared work folder."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")


def build_session(cores: str | int = "*", app: str = "funnelworks", **conf: str) -> SparkSession:
    """A local session with the settings the plans are written for; on a cluster use the cluster's own session."""
    n = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
    )
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings the plans rely on: adaptive execution, and skewed joins split even before an aggregation."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def sifting(spark: SparkSession) -> SparkSession:
    """A session beside this one, on the same cluster, in which Spark drops rows that a join would drop before they are shuffled:
    its runtime filter, a Bloom filter of at most 8 MB. By default it is kept for scans of 10 GB."""
    beside = tune(spark.newSession())
    bloom = "spark.sql.optimizer.runtime.bloomFilter"
    beside.conf.set(f"{bloom}.enabled", "true")
    beside.conf.set(f"{bloom}.applicationSideScanSizeThreshold", "0")
    beside.conf.set(f"{bloom}.creationSideThreshold", "1t")
    beside.conf.set(f"{bloom}.expectedNumItems", "4000000")
    beside.conf.set(f"{bloom}.numBits", str(2**26))
    return beside


def together(jobs: list[Callable[[], T]], workers: int = 4) -> list[T]:
    """Run independent Spark jobs side by side, so that the small ones fill the slots the large ones leave idle."""
    with ThreadPoolExecutor(workers) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def local_table(spark: SparkSession, **columns: list | pa.Array) -> DataFrame:
    """A small table from lists. Its size is known to the planner, which lets it decide on a broadcast."""
    return spark.createDataFrame(pa.table(columns))


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder path below the shared folder of the cluster (spark.checkpoint.dir).

    Only a local session may fall back to a temporary folder: on a cluster, executors do not share one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = _local_folder(spark.sparkContext.applicationId)
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


@lru_cache(maxsize=None)
def _local_folder(application: str) -> str:
    """One temporary folder per local session, removed with the process; core settings can't be written while Spark runs."""
    folder = tempfile.mkdtemp(prefix="funnelworks-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
