"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "lakekit", cores: str | int = "*", shuffle: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the session spark-submit gives you."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a ``local`` master, where driver and executors are one process, gets a folder of its own when
    the setting is absent; on a cluster the missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="lakekit-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def workdir(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below the shared root."""
    return os.path.join(shared_root(spark), f"{label}-{uuid.uuid4().hex[:12]}")


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage by a reliable checkpoint: survives the loss of executors."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def load(spark: SparkSession, sf_dir: str, *names: str):
    """Read one or several test tables; the engine works in UTC throughout."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    got = [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]
    return got[0] if len(got) == 1 else got
