"""What the operators of this folder share: staged tables, arrow batches, 64-bit mixing."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesloom.session import materialize, remove_folder

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder, in a session that is ready for Python workers."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later jobs start from files
    that outlive executors, and rows keep one identity however often they are read."""
    return materialize(df, f"llm-{name}")


def unstage(table: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        remove_folder(table.sparkSession, folder)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a NULL id counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def in_chunks(
    batches: Iterable[pa.RecordBatch], text: str, most_bytes: int, most_rows: int = 1 << 30
) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds at most ``most_bytes`` of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(
            zero_copy_only=False
        )
        total, first = 0, 0
        for i, n in enumerate(size.tolist()):
            if i > first and (total + n > most_bytes or i - first >= most_rows):
                yield batch.slice(first, i - first)
                total, first = 0, i
            total += n
        yield batch.slice(first)


def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task; afterwards its freed memory is released."""
    yield from batches
    release()


def release() -> None:
    """Give freed memory back to the machine: a worker outlives its tasks, and shares the
    executor's memory with what runs next."""
    for cache in Remembered.all:
        cache.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def binaries(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; NULL is empty."""
    return column.cast(pa.binary()).fill_null(b"").to_pylist()


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Remembered(dict):
    """A function's results by argument; emptied when ``most`` are held, and after a task."""

    all: list[Remembered] = []

    def __init__(self, function: Callable, most: int = 1 << 20):
        super().__init__()
        self.all.append(self)
        self.function, self.most = function, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.function(key)
        return value


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, and bound their batches by bytes, as texts
    differ in length by orders of magnitude.

    Nothing is sent if the package's folder is on PYTHONPATH, as on a cluster where it is
    installed; else a zip of it goes to the workers the way Spark sends any dependency.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    root = Path(__file__).resolve().parents[2]
    known = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    application = spark.sparkContext.applicationId
    if root in known or application in _SHIPPED:
        return
    folder = tempfile.mkdtemp(prefix="salesloom-code-")
    target = f"{folder}/salesloom.zip"
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted((root / "salesloom").rglob("*.py")):
            out.write(source, source.relative_to(root))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(application)
