"""Shared-storage helpers: scratch tables, table existence, small metadata files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, asked of the file system Spark itself uses for it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_parquet_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None when there is none yet."""
    if not path_exists(spark, path):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without data files
            return None
        raise


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, outside every table.

    The folder the cluster names in ``spark.checkpoint.dir``; without one, a folder in the
    warehouse, which every executor reaches too. Its name starts with ``_``, so that nobody takes
    it for a table.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    root = configured or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/_tarnflow"


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders right below ``path``, without a look into them; none if it is not there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not file_system.exists(hadoop_path):
        return []
    found = [s.getPath() for s in file_system.listStatus(hadoop_path) if s.isDirectory()]
    return sorted(f"{path.rstrip('/')}/{p.getName()}" for p in found)


def rename_path(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; the target must not be there."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    file_system = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    file_system.mkdirs(hadoop.Path(to).getParent())
    if not file_system.rename(hadoop.Path(path), hadoop.Path(to)):
        raise OSError(f"cannot rename {path} to {to}")


@contextmanager
def staged(spark: SparkSession, df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written once to a scratch table and read back.

    This cuts the lineage on shared storage, so a lost executor costs a re-read and not a re-run
    of the shuffles behind ``df``; it gives later steps column pruning and a true size, on which
    the choice of a broadcast join rests. The table is deleted on the way out.
    """
    path = f"{scratch_root(spark)}/{uuid.uuid4().hex}"
    try:
        df.write.mode("errorifexists").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder through the file system Spark itself uses for it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return file_system.delete(hadoop_path, True)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file that is not there yet, whole or not at all; False if it is there.

    The text is complete before the name is taken, and taking a name that exists fails.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    configuration = spark._jsc.hadoopConfiguration()
    target, draft = hadoop.Path(path), hadoop.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    file_system = target.getFileSystem(configuration)
    if file_system.exists(target):
        return False
    stream = file_system.create(draft, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    no_overwrite = spark._jvm.java.lang.reflect.Array.newInstance(
        hadoop.Options.Rename.OVERWRITE.getClass(), 0
    )
    try:
        hadoop.FileContext.getFileContext(target.toUri(), configuration).rename(draft, target, no_overwrite)
    except Py4JJavaError as error:
        file_system.delete(draft, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small text file in one step: written beside it, then renamed over it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    configuration = spark._jsc.hadoopConfiguration()
    target = hadoop.Path(path)
    draft = hadoop.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    file_system = target.getFileSystem(configuration)
    stream = file_system.create(draft, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    overwrite = spark._jvm.java.lang.reflect.Array.newInstance(
        hadoop.Options.Rename.OVERWRITE.getClass(), 1
    )
    overwrite[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(target.toUri(), configuration).rename(draft, target, overwrite)
