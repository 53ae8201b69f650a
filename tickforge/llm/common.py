"""Helpers that the text operators share."""

from __future__ import annotations

import atexit
import ctypes
import gc
import re
import tempfile
import uuid
import zlib
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that parts words, and ASCII case folding.
SPACES = "\t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A word, in str and in UTF-8 bytes.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")
FOLD_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())
FOLD = str.maketrans(UPPER, LOWER)


def values(column, rows: int = 512):
    """The Python values of an Arrow column, some rows at a time, so that no batch of texts stands in memory twice."""
    for at in range(0, len(column), rows):
        yield from column.slice(at, rows).to_pylist()


def slices(column, rows: int = 256, size: int = 4 << 20):
    """Places (from, to) that cut an Arrow column of texts in pieces of so many rows and bytes at most, or of one row."""
    ends = np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right"))
        to = min(max(to, at + 1), at + rows, len(column))
        yield at, to
        at = to


def tidied(batches_to_batches):
    """The function for ``mapInArrow``, after which a worker gives back what it no longer uses: it may serve another operator next."""

    def run(batches):
        yield from batches_to_batches(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)

    return run


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold_case(c: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def bucket(doc_id) -> int:
    """crc32 of the decimal id, mod 5; a missing id counts as the text 'None'."""
    return zlib.crc32(str(doc_id).encode()) % 5


def bucket_col(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("None"))) % 5


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, set here only if it is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="tickforge-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


@contextmanager
def scratches_closed():
    """Deletes the scratch tables that are begun within, at the end: what needs them must be written by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for s in _SCOPES.pop():
            s.close()


_SCOPES: list[list[Scratch]] = []


class Scratch:
    """Tables written to the shared folder, so that a lost executor never costs more than the stage at hand."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/tickforge-{name}-{uuid.uuid4().hex}"
        if _SCOPES:
            _SCOPES[-1].append(self)
        atexit.register(self.close)

    def table(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", codec).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.spark.sparkContext._jvm.System.gc()  # shuffle files go with the driver's objects that name them, so that disk doesn't wait for its next collection
        return out

    def drop(self, name: str) -> None:
        self._delete(f"{self.root}/{name}")

    def keep(self, *names: str) -> None:
        """Drop the tables that what is still to run doesn't read: all but those of these names and their numbered rounds."""
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        for f in root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root):
            name = f.getPath().getName()
            if name.rsplit("-", 1)[0] not in names and name not in names:
                self.drop(name)

    def close(self) -> None:
        atexit.unregister(self.close)
        try:
            self._delete(self.root)
        except Exception:  # noqa: BLE001  the session may be gone at exit
            pass

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
