"""Where lineage is cut: checkpoint() in a folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoints(spark: SparkSession) -> None:
    """Use the folder that spark.checkpoint.dir names; make one only where it is unset, on a local master."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if not named and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="corpusweft-"))


def cut(df: DataFrame) -> DataFrame:
    ensure_checkpoints(df.sparkSession)
    return df.checkpoint()


def spread(scan: DataFrame) -> DataFrame:
    """A scan with fewer splits than the cluster has cores is dealt out over them; a larger one stays as it is.

    For scans alone: counting the partitions of a plan with a shuffle would run it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
