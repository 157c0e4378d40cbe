"""What lies in a folder, through the file system that Spark itself uses for its path."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Fixed value: the marker Spark leaves in a folder once a write is through.
SUCCESS = "_SUCCESS"


def _opened(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _opened(spark, path)
    return system.exists(place)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True if a write to the folder came to its end."""
    return exists(spark, f"{path}/{SUCCESS}")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if it is absent."""
    system, place = _opened(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def numbered(spark: SparkSession, path: str, key: str) -> list[int]:
    """The numbers ``n`` of the folders ``key=n`` that were written to the end, ascending."""
    mark = f"{key}="
    found = (name.removeprefix(mark) for name in names(spark, path) if name.startswith(mark))
    return sorted(int(n) for n in found if n.isdigit() and is_complete(spark, f"{path}/{mark}{n}"))


def remove(spark: SparkSession, path: str) -> None:
    system, place = _opened(spark, path)
    system.delete(place, True)
