"""Files and folders of any file system that Spark knows."""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """A path's file system, and the path in it."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), location


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table or a partition's folder; one that does not exist is left so."""
    files, location = located(spark, path)
    if files.exists(location) and not files.delete(location, True):
        raise OSError(f"{path} could not be deleted")


def exists(spark: SparkSession, path: str) -> bool:
    files, location = located(spark, path)
    return files.exists(location)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Give a file or folder another path, which must be free."""
    files, location = located(spark, path)
    target = located(spark, to)[1]
    files.mkdirs(target.getParent())
    if files.exists(target) or not files.rename(location, target):
        raise OSError(f"{path} could not be moved to {to}")
