"""Complete versions of a folder, and a small pointer to the one that counts.

A version is written into a folder of its own below ``base``.  Only when it is
complete does the file ``CURRENT``, which holds its name, take its place in one
rename.  A reader between any two steps sees one whole version, and a job that
dies on the way leaves the old one in force.  The version before stays for
readers that have started on it; older ones go.

One job at a time may publish below a ``base``; readers need not wait.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

POINTER = "CURRENT"


def _hadoop(spark: SparkSession):
    return spark.sparkContext._jvm.org.apache.hadoop.fs


def _folder(spark: SparkSession, base: str):
    """The path of ``base`` and its file system."""
    path = _hadoop(spark).Path(base)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, base: str) -> str | None:
    """The folder of the version in force, None before the first one."""
    path, files = _folder(spark, base)
    pointer = _hadoop(spark).Path(path, POINTER)
    if not files.exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        name = stream.readLine()
    finally:
        stream.close()
    return f"{base.rstrip('/')}/{name}"


def publish(spark: SparkSession, base: str, write: Callable[[str], object], keep: int = 2) -> str:
    """Let ``write`` fill a new folder, put the pointer on it, remove all but the last ``keep``; the new folder."""
    before = current_version(spark, base)
    number = _number(before.rpartition("/")[2]) + 1 if before else 1
    name = f"v-{number:08d}-{uuid.uuid4().hex}"
    write(f"{base.rstrip('/')}/{name}")
    _point(spark, base, name)
    _remove_until(spark, base, number - keep)
    return f"{base.rstrip('/')}/{name}"


def _number(name: str) -> int:
    return int(name.split("-")[1])


def _point(spark: SparkSession, base: str, name: str) -> None:
    path, files = _folder(spark, base)
    fs = _hadoop(spark)
    fresh = fs.Path(path, f"{POINTER}-{uuid.uuid4().hex}")
    stream = files.create(fresh, True)
    stream.writeBytes(name + "\n")
    stream.close()
    options = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    options[0] = fs.Options.Rename.OVERWRITE
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    qualified = files.makeQualified(path)
    context = fs.FileContext.getFileContext(qualified.toUri(), configuration)
    context.rename(files.makeQualified(fresh), fs.Path(qualified, POINTER), options)


def _remove_until(spark: SparkSession, base: str, last: int) -> None:
    """Versions up to a number, and what failed attempts of those numbers have left."""
    path, files = _folder(spark, base)
    for status in files.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("v-") and _number(name) <= last:
            files.delete(status.getPath(), True)
