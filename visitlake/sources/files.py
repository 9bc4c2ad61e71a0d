"""Paths on whatever file system Spark is configured for."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories right below `path`; none when it does not exist."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a glob pattern names, by one call to the file system."""
    fs, p = _path(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or [])


def move(spark: SparkSession, source: str, target: str) -> None:
    """Gives a directory another place on the same file system, replacing what is there."""
    fs, old = _path(spark, source)
    _, new = _path(spark, target)
    fs.delete(new, True)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def claim(spark: SparkSession, source: str, target: str) -> bool:
    """Gives a file or directory its place only if nothing is there yet: of several writers of a place one succeeds."""
    jvm = spark._jvm
    old, new = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs, _ = _path(spark, target)
    fs.mkdirs(new.getParent())
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    no_overwriting = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    try:
        files.rename(old, new, no_overwriting)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _path(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _path(spark, path)
    source = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a directory."""
    fs, p = _path(spark, path)
    return fs.getContentSummary(p).getLength()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory name in the shared folder the cluster names for checkpoints.

    Only local sessions, as in tests, may do without that setting and use a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        root = tempfile.mkdtemp(prefix="visitlake-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """`df` stored in the shared scratch folder, for results that are read several times, and its path."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def spread(lines: DataFrame) -> DataFrame:
    """Lines of few input splits, such as a handful of compressed files, dealt out to all cores.

    Parsing a line costs several times as much as moving it, so this pays while less than half of the cores
    would have work. Inputs with more splits stay where they are.
    """
    cores = lines.sparkSession.sparkContext.defaultParallelism
    return lines.repartition(cores) if 2 * lines.rdd.getNumPartitions() <= cores else lines


def delete(spark: SparkSession, path: str) -> None:
    """Removes a directory this library wrote itself, such as a finished job's staging table."""
    fs, p = _path(spark, path)
    fs.delete(p, True)
