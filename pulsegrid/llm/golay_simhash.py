"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint has 64 bits: bit i is set if it is set in over half of the hashes
(XXH64, seed 42) of the text's ``shingle``-word shingles. Fingerprints that
differ in at most ``max_bits`` (4 or fewer) bits are linked.

Candidates: the fingerprint is cut into segments of 23, 23 and 18 bits (the
last padded with zeros). Of any 4 errors, two of the three segments hold at
most 2 together (pigeonhole). The perfect binary Golay code [23, 12] maps
every segment to its one codeword within 3 bits; a text's keys for a pair of
segments are the codeword pairs reached after flipping at most one bit of the
two. Fingerprints within 2 bits over the pair meet in the point between them,
so they share a key. A fingerprint gets at most 11 keys for each pair.

Only distinct fingerprints are keyed (copies cost nothing more). A bucket emits
links that span its groups of fingerprints instead of all pairs: a search from
each fingerprint removes what it reaches, after verifying the bit distance.
Buckets of over ``CHUNK`` fingerprints are split into chunks, and every pair of
chunks is a task's work of its own, so no bucket is gathered whole.

Defined cases: null, empty and blank texts have fingerprint zero, linked like
any other; fewer words than a shingle make one shingle; null doc_ids keep their
row and never name a component unless all its ids are null; repeated rows stay;
an empty table gives an empty result; other columns are ignored, whatever their
names; doc_ids are whole numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pulsegrid.llm.common import (KEY, batch_blocks, blocks, bounded, kept, packed_row, row_key, scratch, split_join, text_column,
                                  unpacked)
from pulsegrid.llm.components import components

SEED = 42
CHUNK = 4096
GENERATOR = 0b101011100011  # fixed value: generator polynomial of the [23, 12] Golay code
SEGMENTS = ((0, 23), (23, 23), (46, 18))  # shift and width
PAIRS = ((0, 1), (0, 2), (1, 2))


def _syndromes(x: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words modulo the generator polynomial."""
    x = x.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        x ^= np.where((x >> bit) & 1, GENERATOR << (bit - 11), 0)
    return x


def _correction() -> np.ndarray:
    """Error pattern (at most 3 bits) of each of the 2048 syndromes."""
    one = [1 << i for i in range(23)]
    e = [0, *one, *[a | b for i, a in enumerate(one) for b in one[i + 1:]],
         *[a | b | c for i, a in enumerate(one) for j, b in enumerate(one[i + 1:], i + 1) for c in one[j + 1:]]]
    e = np.array(e, np.int64)
    out = np.zeros(2048, np.int64)
    out[_syndromes(e)] = e
    return out


class Golay:
    """Decoder of 23-bit words to the index (12 bits) of the nearest codeword."""

    def __init__(self):
        self.fix = _correction()

    def decode(self, x: np.ndarray) -> np.ndarray:
        return (x ^ self.fix[_syndromes(x)]) >> 11

    def near(self, x: np.ndarray, width: int) -> np.ndarray:
        """Per word: its own codeword index, then those after flipping each of
        the lowest ``width`` bits, shape (n, width + 1)."""
        flips = np.concatenate([[0], 1 << np.arange(width, dtype=np.int64)])
        return self.decode(x[:, None] ^ flips[None, :])


def keys(fp: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(index into fp, key) for the distinct keys of each fingerprint."""
    u = fp.view(np.uint64)
    near = [golay.near(((u >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64), w) for s, w in SEGMENTS]
    rows, out = [], []
    who = np.arange(len(fp))
    for p, (i, j) in enumerate(PAIRS):
        a, b = near[i], near[j]
        k = np.concatenate([(a << 12) | b[:, :1], (a[:, :1] << 12) | b[:, 1:]], axis=1) | (p << 24)
        k.sort(axis=1)
        new = np.ones(k.shape, bool)
        new[:, 1:] = k[:, 1:] != k[:, :-1]
        r, c = np.nonzero(new)
        rows.append(who[r])
        out.append(k[r, c])
    return np.concatenate(rows), np.concatenate(out)


def _bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Majority bits of each text's hashes."""
    fp = np.zeros(len(counts), np.uint64)
    at = np.flatnonzero(counts)
    first = (np.cumsum(counts) - counts)[at]
    for lo, hi in blocks(np.concatenate([first, [len(hashes)]]), 1 << 18):
        a = first[lo]
        b = first[hi] if hi < len(first) else len(hashes)
        bit = np.unpackbits(hashes[a:b].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total = np.add.reduceat(bit, first[lo:hi] - a, axis=0, dtype=np.int32)
        set_ = total * 2 > counts[at[lo:hi], None]
        fp[at[lo:hi]] = np.packbits(set_, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return fp


def fingerprint(text: bytes, shingle: int) -> list[int]:
    """XXH64 of each shingle of a text."""
    w = text.lower().split()
    if not w:
        return []
    if len(w) <= shingle:
        return [xxhash.xxh64_intdigest(b" ".join(w), SEED)]
    joined = b" ".join(w)
    end, at = [], -1
    for x in w:
        at += len(x) + 1
        end.append(at)
    h = xxhash.xxh64_intdigest
    start = [0, *[e + 1 for e in end[:len(w) - shingle]]]
    return [h(joined[a:b], SEED) for a, b in zip(start, end[shingle - 1:], strict=True)]


def _fingerprints(shingle: int):
    def run(batches):
        for rows, data, off in batch_blocks(batches, "_text"):
            raw, bound = data.tobytes(), off.tolist()
            each = [fingerprint(raw[bound[i]:bound[i + 1]], shingle) for i in range(len(bound) - 1)]
            counts = np.array([len(x) for x in each], np.int64)
            flat = np.fromiter((h for x in each for h in x), np.uint64, int(counts.sum()))
            yield pa.record_batch({**{c: rows.column(rows.schema.get_field_index(c)) for c in ("doc_id", *KEY)},
                                   "fp": pa.array(_bits(flat, counts).view(np.int64))})
    return run


def fingerprints(docs: DataFrame, shingle: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, row key, fp) of every row; fp is the fingerprint as a signed long."""
    return bounded(docs).select(F.col(doc_id).cast("bigint").alias("doc_id"), *row_key(doc_id, text), text_column(text).alias("_text")).mapInArrow(
        _fingerprints(shingle), f"doc_id bigint, {KEY[0]} bigint, {KEY[1]} bigint, fp bigint")


def _keyed(batches):
    golay = Golay()
    for b in batches:
        fp = np.ascontiguousarray(np.asarray(b.column(0)).astype(np.int64))
        for i in range(0, len(fp), 20_000):
            part = fp[i:i + 20_000]
            r, k = keys(part, golay)
            yield pa.record_batch({"key": pa.array(k, pa.int32()), "fp": pa.array(part[r])})


def _distance(a, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _span(x: np.ndarray, y: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect all of x and y that true links (between x and y, or
    within x where both are the same array) connect."""
    same = y is x
    left = np.concatenate([x, y]) if not same else x
    side = np.concatenate([np.zeros(len(x), bool), np.ones(len(y), bool)]) if not same else None
    out, todo = [], np.arange(len(left))
    while len(todo):
        front, todo = [todo[0]], todo[1:]
        while front and len(todo):
            i = front.pop()
            hit = _distance(left[todo], left[i]) <= max_bits
            if not same:
                hit &= side[todo] != side[i]
            got = todo[hit]
            if len(got):
                out.append((np.full(len(got), left[i]), left[got]))
                front.extend(got.tolist())
                todo = todo[~hit]
    return out


def _verify(max_bits: int):
    """Rows sorted by (key, c1, c2): spanning links of each bucket part."""
    def emit(found):
        a = np.concatenate([f[0] for f in found]).view(np.int64)
        b = np.concatenate([f[1] for f in found]).view(np.int64)
        return pa.record_batch({"a": pa.array(a), "b": pa.array(b)})

    def part(fp, chunk, c1, c2):
        u = fp.view(np.uint64)
        if c1 == c2:
            return _span(u, u, max_bits)
        return _span(u[chunk == c1], u[chunk == c2], max_bits)

    def run(batches):
        held = None
        for b in batches:
            cols = [np.asarray(b.column(n)).astype(np.int64) for n in ("key", "c1", "c2", "chunk", "fp")]
            if held is not None:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols, strict=True)]
            key, c1, c2, chunk, fp = cols
            new = np.flatnonzero((key[1:] != key[:-1]) | (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])) + 1
            last = new[-1] if len(new) else 0
            held = [c[last:] for c in cols]
            found = list(_parts(part, key[:last], c1, c2, chunk, fp, np.concatenate([[0], new]) if len(new) else new, max_bits))
            if found:
                yield emit(found)
        if held is not None and len(held[0]) > 1:
            found = part(held[4], held[3], held[1][0], held[2][0])
            if found:
                yield emit(found)
    return run


def _parts(part, key, c1, c2, chunk, fp, bound, max_bits):
    """Links of the complete parts of a batch; parts of two rows all at once."""
    if not len(key):
        return
    size = np.diff(bound)
    start = bound[:-1]
    two = start[size == 2]
    a, b = fp[two].view(np.uint64), fp[two + 1].view(np.uint64)
    ok = _distance(a, b) <= max_bits
    if ok.any():
        yield a[ok], b[ok]
    for s, n in zip(start[size > 2].tolist(), size[size > 2].tolist(), strict=True):
        yield from part(fp[s:s + n], chunk[s:s + n], c1[s], c2[s])


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints of a frame with ``fp``."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the segment keys hold for at most 4 differing bits")
    k = fps.select("fp").mapInArrow(_keyed, "key int, fp bigint")
    hot = (k.groupBy("key").count().where(F.col("count") > CHUNK)
           .select(F.col("key").alias("_hk"), F.ceil(F.col("count") / CHUNK).cast("int").alias("_n")))
    j = split_join(k, hot, "key", "_hk", "left")
    chunk = F.when(F.col("_n").isNull(), 0).otherwise(F.pmod(F.xxhash64("fp"), F.col("_n"))).cast("int")
    j = j.select("key", "fp", F.coalesce("_n", F.lit(1)).alias("n"), chunk.alias("chunk"))
    # a chunk meets every chunk of its bucket, itself included
    meet = F.explode(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda o: F.struct(
        F.least(o, F.col("chunk")).alias("c1"), F.greatest(o, F.col("chunk")).alias("c2"))))
    one = j.where("n = 1").select("key", F.lit(0).alias("c1"), F.lit(0).alias("c2"), "chunk", "fp")
    many = j.where("n > 1").select("key", "chunk", "fp", meet.alias("m")).select("key", "m.c1", "m.c2", "chunk", "fp")
    dealt = one.unionByName(many).repartition("key", "c1", "c2").sortWithinPartitions("key", "c1", "c2")
    return dealt.mapInArrow(_verify(max_bits), "a bigint, b bigint").distinct()


def _named(docs: DataFrame, tmp, shingle: int, max_bits: int, text: str, doc_id: str) -> DataFrame:
    """(doc_id, row key, fp, component_id) of every row."""
    rows = tmp.save(fingerprints(docs, shingle, text, doc_id))
    distinct = tmp.save(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    cc = components(links(distinct, max_bits))
    name = tmp.save(distinct.join(cc, distinct["fp"] == cc["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")))
    named = name.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "_root")
    ids = tmp.save(split_join(name, named, "root", "_root").select(F.col("fp").alias("_fp"), "component_id"))
    return rows.join(ids, rows["fp"] == ids["_fp"]).drop("_fp")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, text: str = "text",
                    doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id
    (the smallest doc_id reachable over links, its own included)."""
    with scratch(docs.sparkSession, "simhash") as tmp:
        return kept(_named(docs, tmp, shingle, max_bits, text, doc_id).select(
            "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one_each(docs: DataFrame, shingle: int = 4, max_bits: int = 4, text: str = "text",
                  doc_id: str = "doc_id") -> DataFrame:
    """The input rows of the smallest doc_id of each component, all columns
    unchanged (rows with a null id stay if their component has no other id;
    rows that repeat the kept id stay if they are of its component)."""
    with scratch(docs.sparkSession, "simhash") as tmp:
        d = _named(docs, tmp, shingle, max_bits, text, doc_id).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        d = kept(d.select(*[F.col(k).alias("_k" + k) for k in KEY]).distinct())
    keyed = docs.select(packed_row(docs), *row_key(doc_id, text))
    return unpacked(keyed.join(d, (keyed[KEY[0]] == d["_k" + KEY[0]]) & (keyed[KEY[1]] == d["_k" + KEY[1]]), "left_semi"), docs)
