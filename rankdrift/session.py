"""Session settings and the scratch space that jobs may write to."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Spark gives up whole-stage code generation beyond a number of columns, 100 by
# default. Signatures of more than 97 hash functions have more.
MAX_FIELDS = 512


def tune(spark: SparkSession) -> SparkSession:
    """Let aggregations of long signatures run as generated code (about twice as fast)."""
    if int(spark.conf.get("spark.sql.codegen.maxFields")) < MAX_FIELDS:
        spark.conf.set("spark.sql.codegen.maxFields", MAX_FIELDS)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder that all executors can reach.

    It lies below ``spark.checkpoint.dir``. Without that setting a local
    session gets a temporary folder, and a cluster session an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="rankdrift-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _located(spark: SparkSession, path: str):
    """The file system of ``path`` and the path on it, as Spark itself would open them."""
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    return located.getFileSystem(spark._jsc.hadoopConfiguration()), located


def exists(spark: SparkSession, path: str) -> bool:
    files, located = _located(spark, path)
    return files.exists(located)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies directly in the folder; none if it doesn't exist."""
    files, located = _located(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(located)) if files.exists(located) else []


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library has made."""
    files, located = _located(spark, path)
    files.delete(located, True)
