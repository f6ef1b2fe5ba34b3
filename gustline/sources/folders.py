"""What kind of place a path is, asked of the file system Spark itself uses for it."""

from __future__ import annotations

from pyspark.sql import SparkSession


def is_directory(spark: SparkSession, path: str) -> bool:
    """Whether the path, taken literally, is an existing folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return system.exists(place) and system.getFileStatus(place).isDirectory()
