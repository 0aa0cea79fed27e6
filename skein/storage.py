"""Shared scratch space: the folder named by spark.checkpoint.dir, never a machine-local one on a cluster."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
_QUALIFIED: dict[str, str] = {}
_MADE: list[tuple[object, str]] = []


def shared_root(spark: SparkSession) -> str:
    """URI of the shared folder: spark.checkpoint.dir, or what setCheckpointDir was given.

    Where both are unset, a session on the local machine gets a temporary folder, and any other is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        key = spark.sparkContext.applicationId
        if key not in _OWN:
            _OWN[key] = tempfile.mkdtemp(prefix="skein-")
            atexit.register(shutil.rmtree, _OWN[key], ignore_errors=True)
            spark.sparkContext.setCheckpointDir(f"file://{_OWN[key]}")
        root = f"file://{_OWN[key]}"
    if root not in _QUALIFIED:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(root)
        _QUALIFIED[root] = str(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString())
    return _QUALIFIED[root].rstrip("/")


def keep_until_exit(spark: SparkSession, uri: str) -> None:
    """Have a folder deleted with the scratch folders."""
    _MADE.append((spark.sparkContext, uri))


def delete(spark: SparkSession, uri: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete the scratch folders made in this session, from the since-th on; tables still to be read must not lie in them."""
    for s, uri in _MADE[since:]:
        if s is spark.sparkContext:
            delete(spark, uri)
    _MADE[since:] = [(s, uri) for s, uri in _MADE[since:] if s is not spark.sparkContext]


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Scratch folders made inside are deleted at its end; what is to stay is written elsewhere before."""
    since = len(_MADE)
    try:
        yield
    finally:
        release(spark, since)


def _sweep() -> None:
    for s, uri in _MADE:
        try:
            path = s._jvm.org.apache.hadoop.fs.Path(uri)
            path.getFileSystem(s._jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
        except Exception:  # the session is gone, and its folder is the cluster's to clear
            return


atexit.register(_sweep)


def make_dir(spark: SparkSession, uri: str) -> str:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    return uri


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder; the folder is deleted by release, scope, or at the driver's exit."""
    uri = f"{shared_root(spark)}/skein-{name}-{uuid.uuid4().hex}"
    _MADE.append((spark.sparkContext, uri))
    return uri


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI, for tasks; local paths and file: URIs need no Hadoop client."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)
