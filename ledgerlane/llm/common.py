"""Shared pieces of the operators: input columns, scratch folders, file access inside tasks, tokens."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.sources.publish import store


#: Fixed value of the contracts: a word is a run of anything but ASCII white space. ``bytes.split()`` cuts the same.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of ids that may be broadcast (16 bytes each).
BROADCAST_ROWS = 500_000

#: Texts handled at once inside a task, whatever the size of an Arrow batch.
CHUNK_TEXTS = 256


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would, once per context; the driver hands out the file."""
    context = spark.sparkContext
    if getattr(context, "_ledgerlane_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    folder = Path(tempfile.mkdtemp(prefix="ledgerlane-code-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(folder / "ledgerlane.zip", "w") as packed:
        for source in sorted(package.rglob("*.py")):
            packed.write(source, source.relative_to(package.parent))
    context.addPyFile(str(folder / "ledgerlane.zip"))
    context._ledgerlane_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filesystem(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a folder and the path in it; a path without a scheme is local."""
    return pa.fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


@contextmanager
def replacing(files: pa.fs.FileSystem, path: str) -> Iterator[pa.NativeFile]:
    """A file that appears under its name only when whole, so a repeated or lost task leaves no half of one."""
    unfinished = f"{path}.{uuid.uuid4().hex}"
    with files.open_output_stream(unfinished, compression=None) as out:
        yield out
    files.move(unfinished, path)


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def chunks(values: list, size: int = CHUNK_TEXTS) -> Iterator[list]:
    for start in range(0, len(values), size):
        yield values[start : start + size]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores added until no column of ``df`` has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; NULL counts as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix (the finalizer of a public generator), element by element."""
    values = values.astype(np.uint64)
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` as a broadcast side if its rows, which must be a few numbers each, are few; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.count() <= most else df


def drop_rows(docs: DataFrame, named: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``named`` (doc_id, text_hash) names; a NULL id is an id like any other here."""
    own = fresh(docs, "_text_hash")
    marked = docs.withColumn(own, F.xxhash64(F.col("text").cast("string")))
    named = store(named.select(F.col("doc_id").alias("_named_id"), F.col("text_hash").alias("_named_hash")).distinct(), "dropped")
    named = small(named)
    same = marked["doc_id"].cast("long").eqNullSafe(named["_named_id"]) & (marked[own] == named["_named_hash"])
    return marked.join(named, same, "left_anti").drop(own)
