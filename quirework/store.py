"""Files of a shared folder through the Hadoop file system: any scheme, no machine-local calls."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, sorted; none if there is no such folder."""
    fs, p = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder; nothing happens if it is gone already."""
    fs, p = _at(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all: written beside, then renamed."""
    fs, p = _at(spark, path)
    fs.mkdirs(p.getParent())
    beside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.tmp")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(p, False)
    if not fs.rename(beside, p):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    source = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
    finally:
        source.close()
