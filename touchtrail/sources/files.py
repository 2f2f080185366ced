"""Small files and folders on whatever file system a table is on."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place)


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with all of ``text``; False if there is one of that name already."""
    files, place = _at(spark, path)
    try:
        out = files.create(place, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return _filled(out, text)


def write_over(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file, or replace it."""
    files, place = _at(spark, path)
    return _filled(files.create(place, True), text)


def _filled(out, text: str) -> bool:
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """What a small file holds, None if it isn't there."""
    files, place = _at(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies directly in a folder, in order; none if it isn't there."""
    files, place = _at(spark, folder)
    if not files.exists(place):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(place))


def any_match(spark: SparkSession, pattern: str) -> bool:
    """Whether anything has a path of this pattern."""
    files, place = _at(spark, pattern)
    return bool(files.globStatus(place))


def written_at(spark: SparkSession, path: str) -> int:
    """Time of the last change in milliseconds."""
    files, place = _at(spark, path)
    return files.getFileStatus(place).getModificationTime()


def make_folder(spark: SparkSession, path: str) -> None:
    files, place = _at(spark, path)
    files.mkdirs(place)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all it holds."""
    files, place = _at(spark, path)
    files.delete(place, True)


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Remove an existing folder when the driver ends."""
    files, place = _at(spark, path)
    files.deleteOnExit(place)
