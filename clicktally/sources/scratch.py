"""Where a job may keep tables between two steps, and when they go."""

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, the folder all executors share.

    Only a local session without that setting falls back to a temporary
    folder, which goes when the process ends; on a cluster the other machines
    could not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="clicktally-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for scope in _scopes:
        scope.append(path)
    return path


#: The paths handed out inside each scope that is open.
_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end of the block, the folders of all paths that were handed out in it.

    Whatever reads them has to be written elsewhere by then, to a path from outside the block.
    """
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        for path in paths:
            remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is; none is no error."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def replace_folder(spark: SparkSession, fresh: str, path: str) -> None:
    """Put the complete folder ``fresh`` in the place of ``path``, on whatever file system they are.

    The old folder is moved aside first and goes once the new one is in place, so
    that a failure on the way loses neither.  Readers that must not find the
    moment in between use :mod:`clicktally.sinks.versions`.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    aside = hadoop.Path(f"{path.rstrip('/')}-old-{uuid.uuid4().hex}")
    fresh, path = hadoop.Path(fresh), hadoop.Path(path)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    replaced = files.exists(path)
    if replaced and not files.rename(path, aside):
        raise OSError(f"{path} could not be renamed to {aside}")
    if not files.rename(fresh, path):
        if replaced:
            files.rename(aside, path)
        raise OSError(f"{fresh} could not be renamed to {path}")
    if replaced:
        files.delete(aside, True)
