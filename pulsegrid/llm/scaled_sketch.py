"""Document fingerprints by threshold-scaled sketches.

A text's fingerprint keeps every hash of its five-word shingles that lies below
a fixed fraction of the hash range (``FRACTION``), so its size follows the
text's and a hash is kept in all texts or in none. The share of one text's kept
hashes that another text keeps too estimates how much of the one is contained
in the other, however unequal their lengths; fingerprints of parts merge into
the fingerprint of the whole by union (``merged``).

A text of few shingles would keep nothing, so the ``AT_LEAST`` smallest hashes
are kept as well. A fingerprint is therefore whole below its limit: the range's
end if it has fewer than ``AT_LEAST`` hashes (then it has all), else the larger
of the fixed threshold and its largest hash. Two fingerprints are compared below
the smaller limit, where both are whole; below the fixed threshold all are.

Words are maximal ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; fewer words than a
shingle make one shingle. A fingerprint's text is its hashes, ascending, 16
hexadecimal digits each.

``neighbours`` compares each document with the next one in descending doc_id and
with its own text edited with that one's beginning. Only ids and row hashes are
sorted first, to cut the order into ranges of about as many rows; then each text
is sent once to its range, sorted there and read as a stream, one block of texts
at a time. The first row of a range also goes to the range before it (that of
the whole order to the last one), so every row meets its successor.

Defined cases: a null text is empty; a text without words has the fingerprint '',
which is as near as can be (1) to '' and not near (0) to any other; null doc_ids
come last in the order, equal doc_ids go by a hash of id and text; rows that
repeat id and text are one document in the order (each gets its row); the only
document follows itself; an empty table gives an empty result; other columns are
ignored, whatever their names. If the document keeps no hash below the common
limit, nothing of it is known to be shared: 0.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pulsegrid.llm.common import KEY, batch_blocks, bounded, kept, row_key, text_column, utf8
from pulsegrid.llm.words import LOWER, NOT_BLANK, hashes, mix, spans

SHINGLE = 5
FRACTION = 1 / 8
AT_LEAST = 32
END = np.uint64(2**64 - 1)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def threshold(fraction: float = FRACTION) -> np.uint64:
    if not 0 < fraction <= 1:
        raise ValueError("the fraction lies in (0, 1]")
    return np.uint64(min(int(fraction * 2**64), 2**64 - 1))


def shingles(data: np.ndarray, off: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every shingle of a block of texts."""
    data = LOWER[data]
    start, end, doc = spans(data, off, NOT_BLANK)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = hashes(data, start, end)
    count = np.bincount(doc, minlength=len(off) - 1)
    width = np.minimum(count, shingle)[doc]  # words of the shingle that starts here
    left = (np.cumsum(count)[doc]) - np.arange(len(doc))  # words from here to the text's end
    at = np.flatnonzero(left >= width)
    h = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(shingle):
            more = width[at] > k
            h[more] = mix(h[more] * _STEP + word[at[more] + k])
    return doc[at], h


def sketches(data: np.ndarray, off: np.ndarray, shingle: int = SHINGLE, fraction: float = FRACTION,
             at_least: int = AT_LEAST) -> list[np.ndarray]:
    """Fingerprint of each text of a block: its kept hashes, ascending."""
    doc, h = shingles(data, off, shingle)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    doc, h = doc[new], h[new]
    count = np.bincount(doc, minlength=len(off) - 1)
    rank = np.arange(len(h)) - (np.cumsum(count) - count)[doc]
    keep = (h < threshold(fraction)) | (rank < at_least)
    cut = np.cumsum(np.bincount(doc[keep], minlength=len(off) - 1))[:-1]
    return np.split(h[keep], cut)


def limit(sketch: np.ndarray, fraction: float = FRACTION, at_least: int = AT_LEAST) -> np.uint64:
    """The largest hash up to which a fingerprint is known to be whole."""
    if len(sketch) < at_least:
        return END
    return max(threshold(fraction) - np.uint64(1), sketch[-1])


def containment(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION, at_least: int = AT_LEAST) -> float:
    """Estimated share of a's shingles that b has too."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    top = min(limit(a, fraction, at_least), limit(b, fraction, at_least))
    a = a[:np.searchsorted(a, top, side="right")]
    if not len(a):
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum()) / len(a)


def as_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u8").astype(np.uint64)


# --- fingerprints as tables ----------------------------------------------------

def _fingerprint_rows(shingle: int, fraction: float, at_least: int):
    def run(batches):
        for rows, data, off in batch_blocks(batches, "_text"):
            found = sketches(data, off, shingle, fraction, at_least)
            yield pa.record_batch({"doc_id": rows.column("doc_id"), "fingerprint": pa.array([as_text(s) for s in found], pa.string())})
    return run


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE,
                 fraction: float = FRACTION, at_least: int = AT_LEAST) -> DataFrame:
    """(doc_id, fingerprint) of every row."""
    return bounded(docs).select(F.col(doc_id).cast("bigint").alias("doc_id"), text_column(text).alias("_text")).mapInArrow(
        _fingerprint_rows(shingle, fraction, at_least), "doc_id bigint, fingerprint string")


def kept_hashes(prints: DataFrame, key: str = "doc_id", fraction: float = FRACTION) -> DataFrame:
    """(key, hash) for the hashes below the fixed threshold, as 16 digits."""
    digits = F.explode(F.regexp_extract_all("fingerprint", F.lit("([0-9a-f]{16})"), F.lit(1)))
    below = f"{int(threshold(fraction)) - 1:016x}"
    return prints.select(F.col(key), digits.alias("hash")).where(F.col("hash") <= below)


def merged(prints: DataFrame, by: str, fraction: float = FRACTION) -> DataFrame:
    """(by, hash): the fingerprint of all texts of each group together, as rows,
    so a group of any size is never gathered."""
    return kept_hashes(prints, by, fraction).distinct()


def covered_by(prints: DataFrame, whole: DataFrame, key: str = "doc_id", fraction: float = FRACTION) -> DataFrame:
    """(key, n_hashes, containment): the estimated share of each text's shingles
    that a merged fingerprint (column ``hash``) holds; null where a text keeps no
    hash below the threshold. Keys must be distinct."""
    mine = kept_hashes(prints, key, fraction)
    there = whole.select(F.col("hash").alias("_whole")).distinct()
    hit = mine.join(there, mine["hash"] == there["_whole"], "left")
    share = hit.groupBy(F.col(key).alias("_key")).agg(F.count("hash").alias("n_hashes"), F.count("_whole").alias("_hit"))
    all_keys = prints.select(key).distinct()
    return all_keys.join(share, all_keys[key].eqNullSafe(share["_key"]), "left").select(
        key, F.coalesce("n_hashes", F.lit(0)).alias("n_hashes"), (F.col("_hit") / F.col("n_hashes")).alias("containment"))


# --- neighbours ------------------------------------------------------------------

ORDER = ("_known", "_id", *KEY)  # descending: the order of the documents


def _ranges(rows: DataFrame, n: int) -> list[tuple]:
    """At most n rows of the order, ascending, that begin its ranges; the
    largest of all is the last of them."""
    order = F.struct(*ORDER)
    spread = rows.select(*ORDER).repartitionByRange(n, *ORDER)
    tops = spread.groupBy(F.spark_partition_id().alias("p")).agg(F.max(order).alias("top"))
    return sorted(tuple(r["top"]) for r in tops.collect())


def _deal(starts: list[tuple]):
    """Rows of a batch with their range, equal rows once with their number, and
    a second time, marked ``_ahead``, what begins a range for the one before."""
    def run(batches):
        for b in batches:
            pair = np.stack([np.asarray(b.column(b.schema.get_field_index(c))) for c in KEY], axis=1)
            _, at, n = np.unique(pair, axis=0, return_index=True, return_counts=True)
            b = b.take(pa.array(at))
            order = list(zip(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in ORDER], strict=True))
            home = [min(bisect_left(starts, t), len(starts) - 1) for t in order]
            first = [i for i, (h, t) in enumerate(zip(home, order, strict=True)) if starts[h] == t]
            take = pa.array([*range(len(order)), *first])
            ahead = np.repeat([False, True], [len(order), len(first)])
            ranges = [*home, *[(home[i] + 1) % len(starts) for i in first]]
            out = b.take(take)
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(ranges, pa.int32()), pa.array(ahead), pa.array([*n, *n[first]], pa.int64())],
                names=[*out.schema.names, "_range", "_ahead", "_n"])
    return run


def edited(text: str, following: str) -> str:
    """The text whose last half is replaced by the beginning of another."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _compare(shingle: int, fraction: float, at_least: int):
    def of(texts: list[str]) -> list[np.ndarray]:
        data, off = utf8(pa.array(texts, pa.large_string()))
        return sketches(data, off, shingle, fraction, at_least)

    def rows_of(known: list, new: list) -> pa.RecordBatch:
        """known: documents (key, id, text, fingerprint, number), new: the
        document that follows each."""
        changed = [edited(a[2], b[2]) for a, b in zip(known, new, strict=True)]
        prints = of(changed)
        times = np.repeat(np.arange(len(known)), [a[4] for a in known])
        like = (fraction, at_least)
        out = pa.record_batch({
            "doc_id": pa.array([a[1] for a in known], pa.int64()),
            "n_chars": pa.array([len(a[2]) for a in known], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
            "fingerprint": pa.array([as_text(a[3]) for a in known]),
            "edited_fingerprint": pa.array([as_text(p) for p in prints]),
            "near_edited": pa.array([containment(a[3], p, *like) for a, p in zip(known, prints, strict=True)], pa.float64()),
            "near_next": pa.array([containment(a[3], b[3], *like) for a, b in zip(known, new, strict=True)], pa.float64())})
        return out.take(pa.array(times)) if len(times) != len(known) else out

    def run(batches):
        last, ended = None, False
        for rows, data, off in batch_blocks(batches, "_text"):
            if ended:
                continue  # further copies of the row that begins the next range
            found = sketches(data, off, shingle, fraction, at_least)
            raw, bound = data.tobytes(), off.tolist()
            cols = [rows.column(rows.schema.get_field_index(c)).to_pylist() for c in (*KEY, "_known", "_id", "_n", "_ahead")]
            docs = [last] if last else []
            for i, (k1, k2, known, doc_id, n, ahead) in enumerate(zip(*cols, strict=True)):
                key = (k1, k2, ahead)
                if docs and docs[-1][0] == key:
                    docs[-1] = (*docs[-1][:4], docs[-1][4] + n)
                    continue
                docs.append((key, doc_id if known else None, raw[bound[i]:bound[i + 1]].decode(), found[i], n))
                if ahead:
                    ended = True
                    break
            last = docs[-1]
            if len(docs) > 1:
                yield rows_of(docs[:-1], docs[1:])
    return run


RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def neighbours(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE,
               fraction: float = FRACTION, at_least: int = AT_LEAST, ranges: int | None = None) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and the containment
    of the document in its edited text and in the next document. ``ranges``
    defaults to the session's number of shuffle partitions."""
    spark = docs.sparkSession
    rows = bounded(docs).select(F.col(doc_id).cast("bigint").alias("_doc"), text_column(text).alias("_text")).select(
        F.col("_doc").isNotNull().alias("_known"), F.coalesce("_doc", F.lit(0)).alias("_id"), *row_key("_doc", "_text"), "_text")
    starts = _ranges(rows, ranges or int(spark.conf.get("spark.sql.shuffle.partitions")))
    if not starts:
        return spark.createDataFrame([], RESULT)
    kinds = "_known boolean, _id bigint, _rk1 bigint, _rk2 bigint, _text string, _range int, _ahead boolean, _n bigint"
    dealt = rows.mapInArrow(_deal(starts), kinds).repartitionById(len(starts), "_range")
    in_order = dealt.sortWithinPartitions("_ahead", *[F.desc(c) for c in ORDER])
    return in_order.mapInArrow(_compare(shingle, fraction, at_least), RESULT)
