"""Session construction and shared-storage helpers.

Cluster jobs read ``spark.checkpoint.dir`` from the session: it names a folder
every executor can reach. Only when it is unset (local tests) do we create one.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def get_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "strandline") -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, configuring the context with it.

    The cluster names the folder in ``spark.checkpoint.dir``. A private folder
    is created only in local mode when nothing is configured (tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="strandline-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint location; Spark's writers make the folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder (survives executor loss), computed once; later plans know its size."""
    path = scratch_dir(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_together(plans: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """The tables that independent plans make, each as ``cut_lineage`` does; their jobs run side by side, so that one
    plan's last tasks do not leave the executors idle."""
    if not plans:
        return {}
    spark = SparkSession.getActiveSession()
    run = inheritable_thread_target(spark)(lambda make: cut_lineage(make()))
    with ThreadPoolExecutor(max_workers=min(4, len(plans))) as pool:
        return dict(zip(plans, pool.map(run, plans.values())))
