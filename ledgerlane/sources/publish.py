"""Sinks: versioned publish of report tables, partition replacement, and cutting lineage through the shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.operators.replace import replace_into


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local-mode session that names none gets a temporary folder; a cluster must name a shared one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="ledgerlane-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Scratch folders of the scopes that are open, the innermost last.
_scopes: list[list[str]] = []


def _hadoop(spark: SparkSession, path: str):
    """A path and its file system as the session sees them, also where only Spark can reach it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder under the shared one, removed at the end of the open ``scratch_scope``, else with the session's JVM."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    hadoop, files = _hadoop(spark, path)
    files.mkdirs(hadoop)
    files.deleteOnExit(hadoop)
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Owns the copies stored inside it: they go when it ends, so results that read them must be written by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            hadoop, files = _hadoop(spark, path)
            files.delete(hadoop, True)


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to a scratch folder and read it back, so a lost executor never recomputes it differently."""
    spark = df.sparkSession
    path = f"{scratch(spark, label)}/rows"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class StaleVersion(Exception):
    """Another writer committed a version after the one this result was computed from."""


def current_version(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """Number of the last commit and the folder name of the version it made current; (0, None) before the first.

    Commits are files named by their number that hold the version's name; an empty one was never finished.
    """
    folder, files = _hadoop(spark, f"{root}/commits")
    found = sorted((int(s.getPath().getName()), s.getLen()) for s in files.listStatus(folder)) if files.exists(folder) else []
    whole = [number for number, size in found if size]
    version = spark.read.text(f"{root}/commits/{whole[-1]:012d}").first()[0] if whole else None
    return (found[-1][0] if found else 0), version


def _commit(spark: SparkSession, root: str, number: int, version: str) -> None:
    """Make a version current under the given number, which can be used once.

    File systems that create a file only if it is not there decide between two writers. Object stores without that test may let both through; the
    marker is therefore read again, and the writer whose version it does not hold has lost.
    """
    marker, files = _hadoop(spark, f"{root}/commits/{number:012d}")
    try:
        out = files.create(marker, False)
    except Py4JJavaError as error:
        raise StaleVersion(f"{root} has a commit {number} already") from error
    out.write(bytearray(version.encode()))
    out.close()
    if spark.read.text(f"{root}/commits/{number:012d}").first()[0] != version:
        raise StaleVersion(f"{root} has a commit {number} of another writer")


def publish(df: DataFrame, root: str, partition_by: Sequence[str] = (), expected: int | None = None) -> str:
    """Write a new version of a table under ``root`` and then commit it; readers never see a half-written version.

    ``expected`` is the number of the version the result was computed from: if another was committed since, this one
    is refused. Without it the result follows whatever was committed last.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root}/data/{version}")
    number = current_version(spark, root)[0] if expected is None else expected
    _commit(spark, root, number + 1, version)
    return version


def read_current(spark: SparkSession, root: str, name: str | None = None) -> DataFrame:
    """The latest committed version of a published table, or of the table ``name`` of a set published together."""
    number, version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"{root} has no committed version")
    return spark.read.parquet(f"{root}/data/{version}/{name}" if name else f"{root}/data/{version}")


def upsert_published_set(sources: Mapping[str, DataFrame], root: str, keys: Mapping[str, Sequence[str]]) -> str:
    """Replace-by-key into several tables that become current together: all are written under one version, and one commit names it.

    A reader sees all tables as they were or all as they are. A version committed meanwhile by another writer raises ``StaleVersion``.
    """
    spark = next(iter(sources.values())).sparkSession
    number, old = current_version(spark, root)
    version = uuid.uuid4().hex
    for name, source in sources.items():
        merged = source if old is None else replace_into(spark.read.parquet(f"{root}/data/{old}/{name}"), source, keys[name])
        merged.write.mode("errorifexists").parquet(f"{root}/data/{version}/{name}")
    _commit(spark, root, number + 1, version)
    return version


def upsert_published(
    source: DataFrame, root: str, keys: Sequence[str], partition_by: Sequence[str] = ()
) -> str:
    """Replace-by-key into a published table: the old version is read, a new version is written and committed.

    Before the first version the table is empty. A version committed meanwhile by another writer raises ``StaleVersion``.
    """
    spark = source.sparkSession
    number, version = current_version(spark, root)
    if version is not None:
        source = replace_into(spark.read.parquet(f"{root}/data/{version}"), source, keys)
    return publish(source, root, partition_by, expected=number)


class UnfinishedRewrite(Exception):
    """An overwrite of partitions failed part way. The whole new rows are in ``copy``; :func:`finish_rewrite` writes them again."""

    def __init__(self, path: str, copy: str, partition_by: Sequence[str]) -> None:
        super().__init__(f"partitions of {path} were not all overwritten; their new rows are kept in {copy}, write them with finish_rewrite")
        self.path, self.copy, self.partition_by = path, copy, tuple(partition_by)


def _overwrite(rows: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite the partitions that ``rows`` have."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def finish_rewrite(spark: SparkSession, path: str, copy: str, partition_by: Sequence[str]) -> None:
    """Overwrite the partitions of a table with the rows kept in ``copy``, as often as needed; the copy goes once they are written."""
    try:
        _overwrite(spark.read.parquet(copy), path, partition_by)
    except Exception as error:
        raise UnfinishedRewrite(path, copy, partition_by) from error
    folder, files = _hadoop(spark, copy)
    files.delete(folder, True)


def _rewrite(rows: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Store ``rows`` and overwrite their partitions from the copy, which outlives a failure and the session."""
    spark = rows.sparkSession
    copy = f"{shared_folder(spark)}/rewrite-{uuid.uuid4().hex}"
    rows.write.parquet(copy)
    finish_rewrite(spark, path, copy, partition_by)


def upsert_partitions(source: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str]) -> None:
    """Replace-by-key that rewrites only the partitions the source touches.

    ``partition_by`` must be part of ``keys``, so a key never moves between partitions. The touched part of the target
    is stored first: the folder being overwritten is no longer an input of the final write, and a failed write raises
    :class:`UnfinishedRewrite` and can be repeated from the stored rows.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be part of the key")
    spark = source.sparkSession
    touched = source.select(*partition_by).distinct()
    target = spark.read.parquet(path).join(touched, list(partition_by), "left_semi")
    _rewrite(replace_into(target, source, keys), path, partition_by)


def rewrite_partitions(
    spark: SparkSession,
    path: str,
    touched: Callable[[DataFrame], DataFrame],
    change: Callable[[DataFrame], DataFrame],
    partition_by: Sequence[str],
) -> int:
    """Apply ``change`` to the partitions of a table in which ``touched`` leaves a row, and rewrite only those.

    The partitions are found first, one entry each, and become a literal filter, so that all other files are neither read nor
    written. The changed rows are stored before the folder they come from is overwritten; if that fails part way they stay, and
    :class:`UnfinishedRewrite` names them. Returns how many partitions were rewritten.
    """
    table = spark.read.parquet(path)
    hit = [tuple(row) for row in touched(table).select(*partition_by).distinct().collect()]
    if not hit:
        return 0
    if not partition_by:
        raise ValueError(f"{path} has no partitions to rewrite")
    tests = [reduce(Column.__and__, [F.col(name).eqNullSafe(F.lit(value)) for name, value in zip(partition_by, row)]) for row in hit]
    _rewrite(change(table.where(reduce(Column.__or__, tests))).select(*table.columns), path, partition_by)
    return len(hit)
