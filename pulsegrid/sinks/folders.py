"""JSON-Lines files in Hive folders of a time, many folders to one job.

Without its native library Hadoop's local file system starts a ``chmod`` process
for each folder, file and checksum file that it creates. With a folder for each
minute that is nearly all of the time of a write, so there the tasks create the
same folders and files themselves. Any other file system gets Spark's writer.
"""

from __future__ import annotations

import errno
import functools
import itertools
import operator
import os
import shutil
import uuid
import zlib
from collections.abc import Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.sources.files import file_system, touch_path

# --- fixed values: Spark's folder name of a missing value; bytes to a checksum of Hadoop's local files
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
SUM_BYTES = 512


def append_json(df: DataFrame, path: str, by: list[str]) -> None:
    """Append rows as JSON-Lines under ``path`` in a folder for each value of the
    ``by`` columns (digits, or null): the folders, lines, checksums and access
    modes of ``df.write.mode("append").partitionBy(*by).json(path)``.

    Tasks write aside; what the attempts that succeeded wrote is moved in after
    all of them ended, so a write that fails adds no row."""
    spark = df.sparkSession
    fs, target = file_system(spark, path)
    if fs.getUri().getScheme() != "file":
        df.write.mode("append").partitionBy(*by).json(path)
        return
    fs.mkdirs(target)
    root = fs.makeQualified(target).toUri().getPath()
    aside = f"{root}/_temporary/{uuid.uuid4().hex}"
    umask = spark.sparkContext._jvm.org.apache.hadoop.fs.permission.FsPermission.getUMask(fs.getConf()).toShort()
    folder = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c), F.lit(NO_VALUE))) for c in by])
    line = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in by])).cast("binary")
    lines = df.select(folder.alias("folder"), line.alias("line")).sortWithinPartitions("folder")
    try:
        written = lines.mapInArrow(functools.partial(_write_lines, aside=aside, umask=umask), "folder string").collect()
        for r in written:
            _move_in(r["folder"], root)
    finally:
        shutil.rmtree(aside, ignore_errors=True)
        with suppress(OSError):  # another write's folder may be there
            os.rmdir(os.path.dirname(aside))
    touch_path(spark, f"{path}/_SUCCESS")


def _write_lines(batches: Iterator[pa.RecordBatch], aside: str, umask: int) -> Iterator[pa.RecordBatch]:
    """Lines, sorted by folder, as one file in each folder below a folder of
    this attempt, whose path is the result (no row if there is no line)."""
    attempt = uuid.uuid4().hex
    name = f"part-{TaskContext.get().partitionId():05d}-{attempt}.c000.json"
    before, at, out = os.umask(umask), None, None
    try:
        for batch in batches:
            rows = zip(batch.column("folder").to_pylist(), batch.column("line").to_pylist())
            for folder, some in itertools.groupby(rows, operator.itemgetter(0)):
                if folder != at:
                    if out:
                        out.close()
                    at, out = folder, _SummedFile(f"{aside}/{attempt}/{folder}", name)
                out.write(b"".join(line + b"\n" for _, line in some))
    finally:
        if out:
            out.close()
        os.umask(before)
    if out:
        yield pa.RecordBatch.from_pydict({"folder": [f"{aside}/{attempt}"]})


class _SummedFile:
    """A file and the checksum file that Hadoop's local file system keeps beside it."""

    def __init__(self, folder: str, name: str):
        os.makedirs(folder, exist_ok=True)
        self.file, self.sums, self.rest = open(f"{folder}/{name}", "xb"), open(f"{folder}/.{name}.crc", "xb"), b""
        self.sums.write(b"crc\0" + SUM_BYTES.to_bytes(4, "big"))

    def write(self, data: bytes) -> None:
        self.file.write(data)
        data = self.rest + data
        end = len(data) - len(data) % SUM_BYTES
        self._sum(data[:end])
        self.rest = data[end:]

    def _sum(self, data: bytes) -> None:
        self.sums.write(b"".join(zlib.crc32(data[i:i + SUM_BYTES]).to_bytes(4, "big") for i in range(0, len(data), SUM_BYTES)))

    def close(self) -> None:
        self._sum(self.rest)
        self.file.close()
        self.sums.close()


def _move_in(source: str, target: str) -> None:
    """Move what a folder holds into another: a folder that is not there yet as
    a whole, one that is by what it holds."""
    for name in os.listdir(source):
        try:
            os.rename(f"{source}/{name}", f"{target}/{name}")
        except OSError as e:
            if e.errno not in (errno.ENOTEMPTY, errno.EEXIST):
                raise
            _move_in(f"{source}/{name}", f"{target}/{name}")
