"""Folders of any file system Spark knows, from the driver."""

from pyspark.sql import SparkSession


def _of(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _of(spark, path)
    return system.exists(place)


def file_names(spark: SparkSession, folder: str) -> set[str]:
    """Names of the files in one folder; none if it does not exist."""
    system, place = _of(spark, folder)
    if not system.exists(place):
        return set()
    return {status.getPath().getName() for status in system.listStatus(place) if status.isFile()}


def folder_names(spark: SparkSession, folder: str) -> set[str]:
    """Names of the folders in one folder; none if it does not exist."""
    system, place = _of(spark, folder)
    if not system.exists(place):
        return set()
    return {status.getPath().getName() for status in system.listStatus(place) if status.isDirectory()}


def make_folder(spark: SparkSession, path: str) -> None:
    system, place = _of(spark, path)
    system.mkdirs(place)


def delete(spark: SparkSession, path: str) -> None:
    system, place = _of(spark, path)
    system.delete(place, True)


def move(spark: SparkSession, path: str, target: str) -> bool:
    """Whether there was something to move."""
    system, place = _of(spark, path)
    if not system.exists(place):
        return False
    if not system.rename(place, _of(spark, target)[1]):
        raise OSError(f"{path} could not be moved to {target}")
    return True
