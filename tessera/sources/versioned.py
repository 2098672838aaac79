"""Versioned Parquet tables: atomic rewrites and safe concurrent commits without a table format.

DataFrames are immutable and Parquet files cannot be updated in place, so a rewrite
(K1-K4) writes the whole new table to a folder of its own and then commits it: the
file ``<base>/_commits/<n>``, which holds the folder's name, is created exclusively,
so of two writers that both read version n - 1 only one gets version n. The other
sees the conflict, reads the new version and does its rewrite again (``update``), or
gives up (``write_version`` with ``expect``). Readers take the folder of the highest
commit: the old or the new table, never a half-written one. Paths go through Hadoop's
FileSystem; exclusive creation is a rename that fails where the target exists, which
HDFS and local disks do atomically.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_COMMITS = "_commits"


class CommitConflict(RuntimeError):
    """Another writer committed the version that this one was going to."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def versions(spark: SparkSession, base: str) -> list[int]:
    """Committed versions of the table at ``base``, oldest first."""
    fs, p, _ = _fs(spark, f"{base.rstrip('/')}/{_COMMITS}")
    if not fs.exists(p):
        return []
    return sorted(int(n) for n in (st.getPath().getName() for st in fs.listStatus(p)) if n.isdigit())


def folder_of(spark: SparkSession, base: str, version: int) -> str:
    """The folder that holds the rows of a version."""
    fs, p, jvm = _fs(spark, f"{base.rstrip('/')}/{_COMMITS}/{version:012d}")
    stream = fs.open(p)
    try:
        return f"{base.rstrip('/')}/{jvm.org.apache.commons.io.IOUtils.toString(stream, 'UTF-8')}"
    finally:
        stream.close()


def read_current(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The latest committed version (or a given one: time travel by version)."""
    found = versions(spark, base)
    if not found:
        raise FileNotFoundError(f"no finished version under {base}")
    v = found[-1] if version is None else version
    if v not in found:
        raise FileNotFoundError(f"version {v} not finished under {base}")
    return spark.read.parquet(folder_of(spark, base, v))


def _commit(spark: SparkSession, base: str, version: int, folder: str) -> None:
    """Make ``folder`` the rows of ``version``, unless that version is there already."""
    target = f"{base.rstrip('/')}/{_COMMITS}/{version:012d}"
    fs, p, jvm = _fs(spark, target)
    tmp = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{_COMMITS}/_{uuid.uuid4().hex}")
    fs.mkdirs(p.getParent())
    out = fs.create(tmp, False)
    try:
        out.write(bytearray(folder.encode()))
    finally:
        out.close()
    try:
        if fs.getScheme() == "file":  # a hard link is the local call that never replaces its target
            os.link(tmp.toUri().getPath(), p.toUri().getPath())
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
            none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            context.rename(tmp, p, none)
    except FileExistsError:
        raise CommitConflict(f"version {version} of {base} was committed by another writer") from None
    except Py4JJavaError as failed:
        if "FileAlreadyExists" not in str(failed.java_exception):
            raise
        raise CommitConflict(f"version {version} of {base} was committed by another writer") from None
    finally:
        fs.delete(tmp, False)


def write_version(df: DataFrame, base: str, expect: int | None = None) -> int:
    """Write ``df`` as the next version and return its number.

    ``expect`` is the version that ``df`` was made from (0: none yet); if another
    version was committed meanwhile, nothing is committed and ``CommitConflict``
    is raised. Without it the next free version is taken. A writer that dies, or
    loses, leaves a folder that no commit names, which readers never see.
    """
    spark = df.sparkSession
    folder = f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{base.rstrip('/')}/{folder}")
    while True:
        found = versions(spark, base)
        now = found[-1] if found else 0
        if expect is not None and now != expect:
            raise CommitConflict(f"{base} is at version {now}, not {expect}")
        try:
            _commit(spark, base, now + 1, folder)
            return now + 1
        except CommitConflict:
            if expect is not None:
                raise


def update(spark: SparkSession, base: str, rewrite: Callable[[DataFrame], DataFrame], attempts: int = 10) -> int:
    """Commit ``rewrite(current table)`` as the next version and return its number.

    If another writer commits first, its version is read and the rewrite is done
    again on it, so checks inside the rewrite (such as the row versions of
    ``edits.save_changes``) see what the other writer stored. After ``attempts``
    lost races the last conflict is raised.
    """
    for left in reversed(range(attempts)):
        now = versions(spark, base)
        if not now:
            raise FileNotFoundError(f"no finished version under {base}")
        try:
            return write_version(rewrite(read_current(spark, base, now[-1])), base, expect=now[-1])
        except CommitConflict:
            if not left:
                raise


def vacuum(spark: SparkSession, base: str, keep: int = 10) -> int:
    """Remove all versions but the last ``keep`` and the folders that no commit names; returns how many folders went.

    Not to be run while a writer is at work, whose folder is not yet named.
    """
    fs, p, jvm = _fs(spark, base.rstrip("/"))
    found = versions(spark, base)
    named = {folder_of(spark, base, v).rsplit("/", 1)[1] for v in found[-keep:]}
    gone = [st.getPath() for st in fs.listStatus(p) if st.getPath().getName().startswith("v-") and st.getPath().getName() not in named]
    for v in found[:-keep]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{_COMMITS}/{v:012d}"), False)
    for g in gone:
        fs.delete(g, True)
    return len(gone)
