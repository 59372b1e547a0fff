"""Exact deduplication on a cuckoo-filter index.

Documents are equal when their normalised texts are identical (by default the
text itself; null counts as empty). Digests are SHA-256 of the UTF-8 bytes; the
texts of each digest are compared too, and where they differ (a collision) the
digest is extended by the text's number. The persistent index has digests only.
Every task keeps a :class:`CuckooIndex` of live digests: a filter of 16-bit
fingerprints whose hits are verified against the full stored digest and byte
length. Hash buckets of digests are the unit of the global index, so no task
holds more than its buckets, and a digest carried by a third of all rows
reaches its bucket as one row per map task.

Defined cases: null text = empty text; empty table = empty result; rows with
equal id and text count as two members of their group; a null doc_id loses to
any other id and stays only if its whole group has null ids; of rows sharing
the kept id too, all are marked kept; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsegrid.llm.common import kept, packed_row, scratch, split_join, text_column, unpacked

N_BUCKETS = 65536  # global index buckets; each is the work of one step in a task
LOCAL_LIVE = 200_000  # live digests a map-side index holds before it is flushed
SLOTS = 4
MAX_KICKS = 200


class CuckooIndex:
    """Cuckoo filter over live digests with the digests stored beside it.

    ``find`` probes two buckets of four fingerprints and verifies each hit
    against the stored key; ``insert`` relocates fingerprints and doubles the
    table from the stored keys when relocation fails; ``delete`` frees the slot.
    Values are mutable lists owned by the caller.
    """

    def __init__(self, n_buckets: int = 8):
        self.keys: list[bytes | None] = []
        self.values: list = []
        self.free: list[int] = []
        self._build(n_buckets)

    def _build(self, n_buckets: int) -> None:
        self.n = n_buckets
        self.fp = [0] * (n_buckets * SLOTS)  # 0: empty slot
        self.ref = [-1] * (n_buckets * SLOTS)

    def __len__(self) -> int:
        return len(self.keys) - len(self.free)

    def _place(self, key: bytes) -> tuple[int, int, int]:
        f = int.from_bytes(key[:2], "little") or 1
        i = int.from_bytes(key[2:10], "little") & (self.n - 1)
        return f, i, self._other(i, f)

    def _other(self, i: int, f: int) -> int:
        return (i ^ (f * 0x5BD1E995)) & (self.n - 1)

    def _slot(self, key: bytes) -> int:
        f, i, j = self._place(key)
        for b in (i, j) if i != j else (i,):
            for s in range(b * SLOTS, b * SLOTS + SLOTS):
                if self.fp[s] == f and self.keys[self.ref[s]] == key:
                    return s
        return -1

    def find(self, key: bytes):
        """The value of a live key, else None."""
        s = self._slot(key)
        return None if s < 0 else self.values[self.ref[s]]

    def _seat(self, key: bytes, ref: int) -> bool:
        f, i, j = self._place(key)
        for b in (i, j):
            for s in range(b * SLOTS, b * SLOTS + SLOTS):
                if not self.fp[s]:
                    self.fp[s], self.ref[s] = f, ref
                    return True
        b = j
        for kick in range(MAX_KICKS):
            s = b * SLOTS + (f + kick) % SLOTS
            f, self.fp[s] = self.fp[s], f
            ref, self.ref[s] = self.ref[s], ref
            b = self._other(b, f)
            for s in range(b * SLOTS, b * SLOTS + SLOTS):
                if not self.fp[s]:
                    self.fp[s], self.ref[s] = f, ref
                    return True
        return False

    def insert(self, key: bytes, value) -> None:
        """Add a key that is not live."""
        if self.free:
            ref = self.free.pop()
            self.keys[ref], self.values[ref] = key, value
        else:
            ref = len(self.keys)
            self.keys.append(key)
            self.values.append(value)
        if not self._seat(key, ref):
            self._resize()

    def _resize(self) -> None:
        """Double the table until every stored key has a seat."""
        n = self.n * 2
        while True:
            self._build(n)
            if all(self._seat(k, r) for r, k in enumerate(self.keys) if k is not None):
                return
            n *= 2

    def delete(self, key: bytes) -> bool:
        s = self._slot(key)
        if s < 0:
            return False
        ref = self.ref[s]
        self.fp[s], self.ref[s] = 0, -1
        self.keys[ref] = self.values[ref] = None
        self.free.append(ref)
        return True

    def items(self) -> Iterator[tuple[bytes, object]]:
        return ((k, v) for k, v in zip(self.keys, self.values, strict=True) if k is not None)


def _merge(index: CuckooIndex, key: bytes, doc, n: int) -> None:
    v = index.find(key)
    if v is None:
        index.insert(key, [doc, n])
    else:
        v[1] += n
        if doc is not None and (v[0] is None or doc > v[0]):
            v[0] = doc


_GROUP = pa.schema([("bucket", pa.int32()), ("digest", pa.binary()), ("keep_id", pa.int64()),
                    ("group_size", pa.int64())])


def _groups(bucket, index: CuckooIndex) -> pa.RecordBatch:
    items = list(index.items())
    b = [int.from_bytes(k[30:32], "big") if bucket is None else bucket for k, _ in items]
    return pa.record_batch([pa.array(b, pa.int32()), pa.array([k for k, _ in items], pa.binary()),
                            pa.array([v[0] for _, v in items], pa.int64()),
                            pa.array([v[1] for _, v in items], pa.int64())], schema=_GROUP)


def _local(batches):
    """Map side: one row per distinct digest seen by the task."""
    index = CuckooIndex()
    for b in batches:
        for key, doc in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            _merge(index, key, doc, 1)
            if len(index) >= LOCAL_LIVE:
                yield _groups(None, index)
                index = CuckooIndex()
    if len(index):
        yield _groups(None, index)


def _global(batches):
    """Reduce side: rows sorted by bucket, one index per bucket at a time."""
    at, index, done = None, CuckooIndex(), []
    for b in batches:
        for bucket, key, doc, n in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            if bucket != at:
                if at is not None:
                    done.append(_groups(at, index))
                    if len(done) >= 512:
                        yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
                        done = []
                at, index = bucket, CuckooIndex(4)
            _merge(index, key, doc, n)
    if at is not None:
        done.append(_groups(at, index))
        yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]


GROUP_DDL = "bucket int, digest binary, keep_id bigint, group_size bigint"


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
            normalise: Column | None = None, *more: Column) -> DataFrame:
    """(digest, doc_id, more): SHA-256 and byte length (8 bytes) of the normalised text."""
    t = normalised(text, normalise)
    size = F.unhex(F.lpad(F.hex(F.octet_length(t).cast("bigint")), 16, "0"))
    return docs.select(F.concat(F.unhex(F.sha2(t.cast("binary"), 256)), size).alias("digest"),
                       F.col(doc_id).cast("bigint").alias("doc_id"), *more)


def normalised(text: str, normalise: Column | None = None) -> Column:
    return text_column(text) if normalise is None else F.coalesce(normalise, F.lit(""))


def verified(docs: DataFrame, text: str, doc_id: str, normalise: Column | None, tmp) -> DataFrame:
    """(digest, doc_id) of all rows, equal exactly where the texts are: the texts
    of each digest are counted, and a digest of several gets their number added."""
    rows = tmp.save(digests(docs, text, doc_id, normalise))
    full = digests(docs, text, doc_id, normalise, normalised(text, normalise).alias("_text"))
    texts = full.select("digest", "_text").distinct()
    clash = tmp.save(texts.groupBy("digest").count().where("count > 1").select(F.col("digest").alias("_c")))
    if clash.isEmpty():
        return rows
    number = F.row_number().over(Window.partitionBy("digest").orderBy("_text")).cast("bigint")
    texts = texts.join(clash, F.col("digest") == F.col("_c")).select(
        F.col("digest").alias("_c"), F.col("_text").alias("_t"), F.unhex(F.lpad(F.hex(number), 16, "0")).alias("_n"))
    same = (F.col("digest") == F.col("_c")) & (F.col("_text") == F.col("_t"))
    return tmp.save(full.join(texts, same, "left").select(
        F.concat("digest", F.coalesce("_n", F.lit(b""))).alias("digest"), "doc_id"))


def groups(rows: DataFrame) -> DataFrame:
    """One row per distinct digest of (digest, doc_id) rows: the largest doc_id
    and the number of rows."""
    local = rows.select("digest", "doc_id").mapInArrow(_local, GROUP_DDL)
    return (local.repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(_global, GROUP_DDL))


def exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                     normalise: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    with scratch(docs.sparkSession, "cuckoo") as tmp:
        rows = verified(docs, text, doc_id, normalise, tmp)
        g = groups(rows).select(F.col("digest").alias("_d"), "keep_id", "group_size")
        return kept(rows.join(g, rows["digest"] == g["_d"]).select(
            "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.lower(F.hex(F.substring("digest", 1, 32))).alias("text_sha256")))


def drop_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The input rows that stay, all columns unchanged: of equal texts the one
    with the largest doc_id (rows repeating that id and text all stay)."""
    d = exact_duplicates(docs, text, doc_id).where("kept")
    d = d.select(F.col("doc_id").alias("_k_id"), F.col("text_sha256").alias("_k_sha")).distinct()
    keyed = docs.select(packed_row(docs), F.col(doc_id).cast("bigint").alias("_id"), F.sha2(text_column(text).cast("binary"), 256).alias("_sha"))
    return unpacked(keyed.join(d, F.col("_id").eqNullSafe(F.col("_k_id")) & (F.col("_sha") == F.col("_k_sha")), "left_semi"), docs)


# --- the persistent index: insertion and deletion of live digests ------------

INDEX_DDL = "bucket int, live int, capacity int, filter binary, keys binary, doc_ids array<bigint>, members array<bigint>"


def _state(bucket: int, index: CuckooIndex) -> dict:
    items = list(index.items())
    return {"bucket": bucket, "live": len(items), "capacity": index.n * SLOTS,
            "filter": np.array(index.fp, np.uint16).tobytes(), "keys": b"".join(k for k, _ in items),
            "doc_ids": [v[0] for _, v in items], "members": [v[1] for _, v in items]}


def _load(state: pa.Table) -> tuple[int | None, CuckooIndex]:
    bucket, index = None, CuckooIndex(4)
    for s in state.to_pylist():
        bucket, index = s["bucket"], CuckooIndex(s["capacity"] // SLOTS)
        for i, (d, m) in enumerate(zip(s["doc_ids"], s["members"], strict=True)):
            index.insert(s["keys"][i * 40:i * 40 + 40], [d, m])
    return bucket, index


def _apply(state: pa.Table, changes: pa.Table) -> pa.Table:
    """One bucket: load the stored keys, then apply the changes, a row per digest."""
    bucket, index = _load(state)
    for c in changes.to_pylist():
        bucket = c["bucket"]
        if c["inserts"]:
            _merge(index, c["digest"], c["doc_id"], c["inserts"])
        v = index.find(c["digest"])
        if v is not None:
            v[1] -= c["deletes"]
            if v[1] <= 0:
                index.delete(c["digest"])
    out = [_state(bucket, index)] if bucket is not None else []
    schema = pa.schema([("bucket", pa.int32()), ("live", pa.int32()), ("capacity", pa.int32()),
                        ("filter", pa.binary()), ("keys", pa.binary()),
                        ("doc_ids", pa.list_(pa.int64())), ("members", pa.list_(pa.int64()))])
    return pa.Table.from_pylist(out, schema=schema)


def _look(state: pa.Table, probes: pa.Table) -> pa.Table:
    """One bucket: which of its distinct digests are live."""
    index = _load(state)[1]
    hit = [index.find(k) is not None for k in probes.column("digest").to_pylist()]
    return pa.table({"digest": probes.column("digest"), "live": pa.array(hit, pa.bool_())})


def update_index(index: DataFrame | None, inserts: DataFrame | None = None,
                 deletes: DataFrame | None = None, spark=None) -> DataFrame:
    """Index table after inserting and deleting documents (insertions first).

    A digest stays live while it has members; its doc_id is the largest ever
    inserted for it. Deleting an unknown digest does nothing. Changes are counted
    per digest before they meet their bucket.
    """
    spark = spark or (index if index is not None else inserts if inserts is not None else deletes).sparkSession
    bucket = F.conv(F.hex(F.substring("digest", 31, 2)), 16, 10).cast("int").alias("bucket")
    changes = spark.createDataFrame([], "digest binary, doc_id bigint, insert int")
    for d, i in ((inserts, 1), (deletes, 0)):
        if d is not None:
            changes = changes.unionByName(digests(d).withColumn("insert", F.lit(i)))
    changes = changes.groupBy("digest").agg(
        F.max(F.when(F.col("insert") == 1, F.col("doc_id"))).alias("doc_id"), F.sum("insert").alias("inserts"),
        F.sum(1 - F.col("insert")).alias("deletes")).select(bucket, "digest", "doc_id", "inserts", "deletes")
    empty = spark.createDataFrame([], INDEX_DDL)
    return ((index if index is not None else empty).groupBy("bucket")
            .cogroup(changes.groupBy("bucket")).applyInArrow(_apply, INDEX_DDL))


def probe_index(index: DataFrame, docs: DataFrame) -> DataFrame:
    """Per document whether its text is live in the index (verified by key)."""
    with scratch(docs.sparkSession, "probe") as tmp:
        rows = tmp.save(digests(docs))
        bucket = F.conv(F.hex(F.substring("digest", 31, 2)), 16, 10).cast("int").alias("bucket")
        probes = rows.select("digest").distinct().select(bucket, "digest")
        found = (index.groupBy("bucket").cogroup(probes.groupBy("bucket"))
                 .applyInArrow(_look, "digest binary, live boolean").withColumnRenamed("digest", "_d"))
        return kept(split_join(rows, found, "digest", "_d").select("doc_id", "live"))
