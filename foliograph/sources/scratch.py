"""Tables written in the shared folder that cut a loop's lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a session of one machine that has none gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="foliograph-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """df by checkpoint(), in the folder that executors share."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
