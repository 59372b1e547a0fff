"""Helpers shared by the training-data operators.

Rows are identified by ``row_key``: a 128-bit hash of (doc_id, text) as two
longs, never null, the same in every job that reads the input again. Rows with
equal id and text share a key and are treated alike.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulsegrid.session import scratch_path

BLOCK_BYTES = 4 << 20  # text handled by one numpy pass
ARROW_BYTES = 8 << 20  # text that Spark hands to a Python worker at once
KEY = ("_rk1", "_rk2")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded(df: DataFrame) -> DataFrame:
    """Lower the session's Arrow batches to ARROW_BYTES if they are larger, so
    that a worker's memory does not follow the text size; returns df."""
    key, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    now = conf.get(key).rstrip("bB")
    if not now.isdigit() or int(now) > ARROW_BYTES:
        conf.set(key, str(ARROW_BYTES))
    return df


class Scratch:
    """Intermediate tables of one operator call in the shared folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, scratch_path(spark, name), 0

    def save(self, df: DataFrame, **options) -> DataFrame:
        """Write df as a table and read it back: short lineage, and a lost
        executor loses nothing. ``options`` go to the writer."""
        self.n += 1
        path = f"{self.root}/t{self.n}"
        df.write.options(compression="zstd", **options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        fs.delete(p, True)


@contextlib.contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[Scratch]:
    """A Scratch whose tables are deleted on leaving the block: what leaves it
    must be checkpointed (or collected) inside."""
    s = Scratch(spark, name)
    try:
        yield s
    finally:
        s.remove()


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Two key columns of a row (see the module docstring)."""
    return [F.xxhash64(F.lit(1), F.col(doc_id).cast("string"), F.col(text)).alias(KEY[0]),
            F.xxhash64(F.lit(2), F.col(text), F.col(doc_id).cast("string")).alias(KEY[1])]


def same_key(a: DataFrame, b: DataFrame) -> Column:
    return (a[KEY[0]] == b[KEY[0]]) & (a[KEY[1]] == b[KEY[1]])


def split_join(left: DataFrame, right: DataFrame, a: str, b: str, how: str = "inner") -> DataFrame:
    """Equi-join a = b that Spark can split where a key is hot. A side that was
    just grouped by its key would be joined in the stage that groups it, which
    skew handling leaves alone; keys as structs make both sides shuffle for the
    join itself (again for the grouped side, which is the small one)."""
    return left.join(right, F.struct(left[a].alias("k")) == F.struct(right[b].alias("k")), how)


def packed_row(df: DataFrame) -> Column:
    """All columns as one struct, ``_row``: whatever their names, they clash
    with none that an operator adds."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("_row")


def unpacked(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like`` from ``_row``."""
    return df.select(*[F.col("_row").getField(c).alias(c) for c in like.columns])


def text_column(text: str = "text") -> Column:
    """The text with null as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def crc_mod(doc_id: str, m: int) -> Column:
    """crc32 of the id as text, modulo m (null id: the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % m


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and its n+1 offsets into them (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer text is a block of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def batch_blocks(batches, text: str = "text", size: int = BLOCK_BYTES):
    """Slices of Arrow batches of about ``size`` text bytes, with their bytes
    and offsets."""
    for b in batches:
        data, off = utf8(b.column(b.schema.get_field_index(text)))
        for i, j in blocks(off, size):
            yield b.slice(i, j - i), data[off[i]:off[j]], off[i:j + 1] - off[i]


def int_lists(flat: np.ndarray, counts: np.ndarray, kind=pa.int32()) -> pa.Array:
    """A list column from flat values and the length of each list."""
    off = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat, kind))


def kept(df: DataFrame) -> DataFrame:
    """A small result (ids, numbers, spans), checkpointed to the shared folder."""
    from pulsegrid.session import shared_dir
    shared_dir(df.sparkSession)
    return df.checkpoint()
