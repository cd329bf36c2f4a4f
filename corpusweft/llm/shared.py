"""Shared storage for the operators: where intermediate tables are written.

A lost executor must never lose an intermediate result, so lineage is cut only by
tables written to the folder that the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a local one is made only for a local master."""
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="corpusweft-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def job_dir(spark: SparkSession) -> str:
    """This application's folder in the shared one; it goes when the application ends."""
    path = f"{shared_dir(spark)}/corpusweft-{spark.sparkContext.applicationId}"
    fs, p = _fs(spark, path)
    if fs.mkdirs(p):
        fs.deleteOnExit(p)
    return path


def new_path(spark: SparkSession, name: str) -> str:
    return f"{job_dir(spark)}/{name}-{uuid.uuid4().hex}"


def free_name(taken: list[str], name: str) -> str:
    """A column name that no given column has, case aside."""
    have = {c.lower() for c in taken}
    while name.lower() in have:
        name += "_"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and return it as read again."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def forget(df: DataFrame) -> None:
    """Delete the files of a table that ``written`` returned."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()[:1]}:
        delete(df.sparkSession, folder)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def create_once(spark: SparkSession, path: str, content: str) -> bool:
    """Create a small file; False if it was there already."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    try:
        out = fs.create(p, False)
    except Exception as e:  # noqa: BLE001 - py4j wraps FileAlreadyExistsException
        if "FileAlreadyExists" in str(e) or "already exists" in str(e):
            return False
        raise
    out.write(bytearray(content.encode()))
    out.close()
    return True


def listing(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished plans, which it does once their objects are collected."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()
