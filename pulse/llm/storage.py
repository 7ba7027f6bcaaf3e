"""Shared-storage helpers: intermediate tables, side files, checked broadcasts.

Intermediate results that are read more than once are written as Parquet below
the shared checkpoint folder, so a lost executor costs only the re-run of the
tasks that read them. Files in formats of our own are written by tasks through
``pyarrow.fs`` under a name of the attempt; the manifest that Spark commits
lists the files of successful attempts only, so leftovers of lost or
speculative attempts are never read.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.session import scratch_path

#: proven bound of what is broadcast: bytes of the Parquet files of the table
BROADCAST_BYTES = 8 << 20
#: rows of an Arrow batch that goes to a Python worker
ROWS_PER_BATCH = 2000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder, read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def written_small(df: DataFrame, name: str) -> DataFrame:
    """``written`` for a small table behind a shuffle of its own: at most one file
    a core, so that no width of shuffle turns it into hundreds of tiny files."""
    return written(df.coalesce(max(1, df.sparkSession.sparkContext.defaultParallelism)), name)


def table_bytes(df: DataFrame) -> int:
    """Bytes of the files behind a table that ``written`` returned."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsc.hadoopConfiguration()
    total = 0
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(f)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return total


def small_or_shuffled(df: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a written table for broadcast if its files are below the bound.

    Beyond the bound the table is left as it is and the join shuffles.
    """
    return F.broadcast(df) if table_bytes(df) <= most_bytes else df


def texts_of(column: pa.Array, ranges) -> Iterator[tuple[int, int, list]]:
    """``lo, hi, texts`` for the ``ranges`` of the sizes of a column's texts (none null):
    a worker holds the texts of one range as Python objects, not those of a batch."""
    for lo, hi in ranges(pc.binary_length(column).to_pylist()):
        yield lo, hi, column.slice(lo, hi - lo).to_pylist()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (once per context), and have
    them given ``ROWS_PER_BATCH`` rows at a time: whole texts lie in a batch twice,
    in the executor and in its worker."""
    if int(spark.conf.get(_ROWS)) > ROWS_PER_BATCH or int(spark.conf.get(_ROWS)) <= 0:
        spark.conf.set(_ROWS, str(ROWS_PER_BATCH))
    sc = spark.sparkContext
    if getattr(sc, "_pulse_shipped", False):
        return
    import pulse
    top = os.path.dirname(os.path.abspath(pulse.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="pulse-pkg-"), "pulse_pkg.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._pulse_shipped = True


def open_store(path: str):
    """``pyarrow`` file system of a path or URI, and the path within it."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path)


class AttemptFile:
    """A side file written by one task attempt; ``close`` publishes it.

    The name carries a random suffix per attempt, so attempts never meet, and
    readers go by the committed manifest.
    """

    def __init__(self, folder: str, stem: str, suffix: str):
        self.uri = f"{folder.rstrip('/')}/{stem}-{uuid.uuid4().hex[:12]}{suffix}"
        self._fs, self._path = open_store(self.uri)
        self._fs.create_dir(self._path.rsplit("/", 1)[0], recursive=True)
        self._out = self._fs.open_output_stream(self._path, compression=None)
        self.size = 0

    def write(self, data) -> int:
        """Append; returns the offset at which ``data`` begins."""
        at = self.size
        self._out.write(data)
        self.size += len(data)
        return at

    def close(self) -> None:
        self._out.close()


def read_range(uri: str, offset: int, length: int) -> bytes:
    """``length`` bytes of a side file from ``offset``."""
    store, path = open_store(uri)
    with store.open_input_file(path) as f:
        return f.read_at(length, offset)
