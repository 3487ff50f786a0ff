"""Session construction and the shared checkpoint folder."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "allelespark", cores: str | int = "*") -> SparkSession:
    """A session for tests and benchmarks; on a cluster the submitted conf is used as is."""
    cpus = os.cpu_count() or 4 if cores == "*" else int(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder the cluster names in ``spark.checkpoint.dir``.

    A private folder is set only where the session has none (tests, local runs).
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return df.checkpoint(eager=True)
