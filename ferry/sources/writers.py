"""Sinks: row id, staged write, verify, publish (K1, K2, K4, K8, K9).

The reference inserts batches, commits per table and cannot undo DDL. Here the copy is written
to a staging folder (or staging JDBC table) first; checks read the staged copy, and only a
passing copy is published, by pointing at it as the newest version. A failed task is retried by Spark and the commit
protocol keeps exactly one attempt's files, so a lost executor never leaves half a table.
"""

from __future__ import annotations

import time
import uuid
import warnings

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ROW_ID = "U_ID"
# Layout of a published table: data folders, pointer files, and Spark's marker of a finished write.
DATA, VERSIONS, MARKER = "_data-", "_versions", "_SUCCESS"


def add_row_id(df: DataFrame) -> DataFrame:
    """K4: a 32-hex-digit GUID per row in front of the data columns."""
    return df.select(F.upper(F.replace(F.uuid(), F.lit("-"), F.lit(""))).alias(ROW_ID), "*")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_staged(df: DataFrame, staging_path: str, fmt: str = "parquet",
                 partition_by: list[str] | None = None, options: dict | None = None) -> int:
    """K2 for files: write the frame once and return the number of rows written.

    The count comes from an ``Observation`` on the write itself, so verifying needs no re-scan
    of the source.
    """
    obs = Observation("ferry_write")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode("overwrite").format(fmt).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(staging_path)
    return int(obs.get["rows"])


def version_dir(target_path: str) -> str:
    """A new folder inside the target for one version. A copy staged here is published without a rename;
    nobody reads it before ``publish`` has pointed at it."""
    return f"{target_path}/{DATA}{uuid.uuid4().hex[:12]}"


def _names(spark: SparkSession, folder: str) -> list[str]:
    p, fs = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def versions(spark: SparkSession, target_path: str) -> list[str]:
    """Pointers of the target, oldest first: empty files named ``<number>-<id of the data folder>``."""
    return _names(spark, f"{target_path}/{VERSIONS}")


def _data_path(target_path: str, pointer: str) -> str:
    return f"{target_path}/{DATA}{pointer.split('-', 1)[1]}"


def is_committed(spark: SparkSession, path: str) -> bool:
    """True for a folder that holds the commit marker of a finished Spark write."""
    marker, fs = _fs(spark, f"{path}/{MARKER}")
    return fs.exists(marker)


def current_path(spark: SparkSession, target_path: str) -> str | None:
    """Folder of the last good version: the highest pointer whose folder holds a commit marker. A target
    written without versions is its own folder; None if nothing finished is there."""
    for pointer in reversed(versions(spark, target_path)):
        if is_committed(spark, _data_path(target_path, pointer)):
            return _data_path(target_path, pointer)
    return target_path if is_committed(spark, target_path) else None


def read_published(spark: SparkSession, target_path: str, fmt: str = "parquet") -> DataFrame:
    """The last good version of a published table."""
    path = current_path(spark, target_path)
    if path is None:
        raise FileNotFoundError(f"{target_path} holds no published table")
    return spark.read.format(fmt).load(path)


def publish(spark: SparkSession, staging_path: str, target_path: str, drop_existing: bool = True,
            keep: int = 2) -> str:
    """K1 + K9: make the staged copy the target's newest version; returns its folder.

    A version is a folder of the target, and the one atomic step is the creation of an empty pointer file
    whose name says it all, so a stop at any point leaves either the old or the new table whole (on object
    stores too, where a rename is a copy: stage under ``version_dir``). Two publishers at once may take the
    same number; the higher id counts then. The newest ``keep`` versions stay for running readers.
    """
    src, fs = _fs(spark, staging_path)
    if not is_committed(spark, staging_path):
        raise FileNotFoundError(f"{staging_path} holds no finished write")
    if not drop_existing and current_path(spark, target_path) is not None:
        raise FileExistsError(target_path)
    folder = staging_path
    inside = fs.makeQualified(src.getParent()).toString() == fs.makeQualified(_fs(spark, target_path)[0]).toString()
    if not (inside and src.getName().startswith(DATA)):
        folder = version_dir(target_path)
        dst, _ = _fs(spark, folder)
        fs.mkdirs(dst.getParent())
        if not fs.rename(src, dst):
            raise OSError(f"could not move {staging_path} to {folder}")
    last = versions(spark, target_path)
    number = int(last[-1].split("-")[0]) + 1 if last else 1
    pointer, _ = _fs(spark, f"{target_path}/{VERSIONS}/{number:010d}-{folder.rsplit(DATA, 1)[1]}")
    fs.create(pointer, False).close()
    if not drop_existing and versions(spark, target_path)[0] != pointer.getName():
        fs.delete(pointer, False)
        raise FileExistsError(target_path)
    try:
        _drop_old(spark, target_path, keep)
    except Exception as exc:    # the new version stands; the next publish cleans up
        warnings.warn(f"old versions of {target_path} left behind: {exc}")
    return folder


def _drop_old(spark: SparkSession, target_path: str, keep: int) -> None:
    """Delete all but the newest versions. The marker goes first and the pointer last, so a half-deleted
    version is neither read nor forgotten."""
    for pointer in versions(spark, target_path)[:-max(1, keep)]:
        data, fs = _fs(spark, _data_path(target_path, pointer))
        fs.delete(_fs(spark, f"{_data_path(target_path, pointer)}/{MARKER}")[0], False)
        fs.delete(data, True)
        fs.delete(_fs(spark, f"{target_path}/{VERSIONS}/{pointer}")[0], False)
    for name in _names(spark, target_path):     # files of a table written before it had versions
        if name == MARKER or name[0] not in "_.":
            old, fs = _fs(spark, f"{target_path}/{name}")
            fs.delete(old, True)


def recover(spark: SparkSession, target_path: str, grace_seconds: float = 7 * 86400) -> str | None:
    """After a stopped run: delete data folders no pointer names that are older than ``grace_seconds`` (a
    younger one may belong to a running job); returns the folder of the last good version."""
    named = {_data_path(target_path, v).rsplit("/", 1)[1] for v in versions(spark, target_path)}
    for name in _names(spark, target_path):
        if name.startswith(DATA) and name not in named:
            p, fs = _fs(spark, f"{target_path}/{name}")
            if time.time() - fs.getFileStatus(p).getModificationTime() / 1000 >= grace_seconds:
                fs.delete(p, True)
    return current_path(spark, target_path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a staging folder that will not be published; a published version stays."""
    p, fs = _fs(spark, path)
    parent = path.rsplit("/", 1)[0]
    if p.getName().startswith(DATA) and any(_data_path(parent, v) == path for v in versions(spark, parent)):
        return
    if fs.exists(p):
        fs.delete(p, True)


def jdbc_write_options(url: str, table: str, properties: dict | None = None, batch_size: int = 1000,
                       column_types: str | None = None) -> dict:
    """Options of the JDBC writer; ``column_types`` becomes ``createTableColumnTypes``."""
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size), **(properties or {})}
    return opts | ({"createTableColumnTypes": column_types} if column_types else {})


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               batch_size: int = 1000, drop_existing: bool = True,
               column_types: str | None = None) -> None:
    """K1 + K2 for a database target: every partition inserts in batches of ``batch_size``."""
    df.write.format("jdbc").mode("overwrite" if drop_existing else "errorifexists") \
        .options(**jdbc_write_options(url, table, properties, batch_size, column_types)).save()


def verify_counts(expected_rows: int, written: DataFrame) -> DataFrame:
    """K8: the row count of what was written against the rows read; one row."""
    return written.agg(F.count(F.lit(1)).cast("bigint").alias("actual_rows")) \
        .select(F.lit(expected_rows).cast("bigint").alias("expected_rows"), "actual_rows",
                (F.col("actual_rows") == F.lit(expected_rows)).alias("verified"))
