"""The cluster's shared folder and what lives in it."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_local_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared working folder, ``spark.checkpoint.dir``.

    Where it is unset a temporary folder serves local sessions only.
    """
    global _local_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="clickweir-")
    return _local_dir


def new_dir(spark: SparkSession, label: str) -> str:
    """An unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def list_dir(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(p)]


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, whole or not at all; FileExistsError if the path is taken."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs, target = _fs(spark, path)
    staged = hadoop.Path(target.getParent(), f"_staged-{uuid.uuid4().hex}")
    stream = fs.create(staged)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    rename = getattr(hadoop, "Options$Rename")
    modes = spark.sparkContext._gateway.new_array(rename, 1)
    modes[0] = rename.NONE
    try:
        # Unlike FileSystem.rename this never replaces an existing file.
        hadoop.FileContext.getFileContext(
            fs.getUri(), spark._jsc.hadoopConfiguration()
        ).rename(staged, target, modes)
    except Py4JJavaError as error:
        fs.delete(staged, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            raise FileExistsError(path) from error
        raise


def materialized(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    It is computed once however often it is read, and a lost executor does not
    bring its lineage back.
    """
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
