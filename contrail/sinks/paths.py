"""Names, small files and renames on any Hadoop-compatible store."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, directory: str) -> list[str]:
    """Names in a directory; none if it is not there."""
    fs, p = _path(spark, directory)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, whole."""
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename to a name that is free; ``False`` if the target is there already."""
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    a, b = (fs.makeQualified(p) for fs, p in (_path(spark, source), _path(spark, target)))
    files = hadoop.FileContext.getFileContext(b.toUri(), sc._jsc.hadoopConfiguration())
    rename = getattr(hadoop, "Options$Rename")
    options = sc._gateway.new_array(rename, 1)
    options[0] = rename.NONE  # an existing target is an error
    try:
        files.rename(a, b, options)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """A small file that appears whole or not at all; ``False`` if the name is taken."""
    fs, p = _path(spark, path)
    fs.mkdirs(p.getParent())
    aside = f"{p.getParent().toString()}/_{uuid.uuid4().hex}"
    out = fs.create(_path(spark, aside)[1], False)
    out.write(bytearray(text.encode()))
    out.close()
    if rename_new(spark, aside, path):
        return True
    remove(spark, aside)
    return False
