"""Small files and folders through Hadoop's file system, so that any storage that Spark writes to will do."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, none if it does not exist."""
    system, target = _at(spark, folder)
    return sorted(x.getPath().getName() for x in system.listStatus(target)) if system.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    system, target = _at(spark, path)
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a whole new file, or gives False if there is one of that name: of several writers one succeeds."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    system, target = _at(spark, path)
    _, own = _at(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = system.create(own, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(own, target, none)
        return True
    except Exception as e:  # Java's exceptions have one Python type
        system.delete(own, False)
        if "FileAlreadyExists" in str(e):
            return False
        raise


def delete(spark: SparkSession, path: str) -> None:
    system, target = _at(spark, path)
    system.delete(target, True)
