"""Line or paragraph deduplication by unit digests.

A unit is a line (cut at ``\\n``) or a paragraph (cut at blank lines). Units are
normalised (A-Z lower-cased, ASCII white space collapsed and trimmed) and
hashed to 128 bits. Digests are grouped over all documents; the occurrence with
the smallest rank (doc_id, unit number) stays and the rest are removed. Units
of fewer than ``min_words`` words are never removed: such short lines meet by
chance. Offsets are bytes of the original UTF-8 text; a removed unit takes its
separator along.

The grouping is pre-aggregated per task, so a unit that a third of all rows
carry is one row per task; only digests that occur twice are joined back, by a
join whose skewed partitions Spark can split.

Defined cases: null and empty texts have no units; an empty table gives an
empty result; a null doc_id ranks first; rows with equal id and text are one
document for the ranking (their units stay or go alike, a unit repeated inside
them goes); other columns are ignored or passed on unchanged.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from pulsegrid.llm.common import KEY, batch_blocks, bounded, kept, row_key, scratch, split_join, text_column

MIN_WORDS = 5
UNIT_DDL = f"{KEY[0]} bigint, {KEY[1]} bigint, _id bigint, unit int, start int, end int, digest binary"


def cut(text: bytes, unit: str) -> list[tuple[int, int, int]]:
    """(start, end, end with separator) of each non-empty unit."""
    sep = b"\n" if unit == "line" else b"\n\n"
    out, at = [], 0
    while at < len(text):
        e = text.find(sep, at)
        e = len(text) if e < 0 else e
        nxt = min(e + len(sep), len(text))
        if unit != "line":
            while nxt < len(text) and text[nxt] == 10:
                nxt += 1
        if e > at:
            out.append((at, e, nxt))
        at = nxt
    return out


def _units(unit: str, min_words: int):
    def run(batches):
        for rows, data, off in batch_blocks(batches, "_text"):
            doc, no, start, end, digest = [], [], [], [], []
            for d in range(len(off) - 1):
                t = data[off[d]:off[d + 1]].tobytes()
                for k, (a, b, c) in enumerate(cut(t, unit)):
                    w = t[a:b].lower().split()
                    if len(w) >= max(min_words, 1):
                        doc.append(d)
                        no.append(k)
                        start.append(a)
                        end.append(c)
                        digest.append(hashlib.blake2b(b" ".join(w), digest_size=16).digest())
            at = pa.array(doc, pa.int32())
            yield pa.record_batch({
                KEY[0]: rows.column(KEY[0]).take(at), KEY[1]: rows.column(KEY[1]).take(at),
                "_id": rows.column("_id").take(at), "unit": pa.array(no, pa.int32()),
                "start": pa.array(start, pa.int32()), "end": pa.array(end, pa.int32()),
                "digest": pa.array(digest, pa.binary())})
    return run


def repeated_units(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", unit: str = "line",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document that loses units: its row key and the removed
    (start, end, unit) spans in order."""
    with scratch(bounded(docs).sparkSession, "lines") as tmp:
        units = tmp.save(docs.select(*row_key(doc_id, text), F.col(doc_id).cast("bigint").alias("_id"),
                                     text_column(text).alias("_text")).mapInArrow(_units(unit, min_words), UNIT_DDL))
        rank = F.struct("_id", *KEY, "unit")
        first = (units.groupBy("digest").agg(F.min(rank).alias("_first"), F.max(rank).alias("_last"))
                 .where(~F.col("_first").eqNullSafe(F.col("_last"))).select(F.col("digest").alias("_d"), "_first"))
        late = split_join(units, first, "digest", "_d").where(~rank.eqNullSafe(F.col("_first")))
        return kept(late.groupBy(*KEY).agg(
            F.sort_array(F.collect_set(F.struct("start", "end", "unit"))).alias("removed")))


def _cut_spans(with_text: bool):
    def run(batches):
        for b in batches:
            pos = b.schema.get_field_index("_text")
            texts, removed = b.column(pos).to_pylist(), b.column("_removed").to_pylist()
            out = []
            for t, spans in zip(texts, removed, strict=True):
                if spans:
                    raw, at, parts = t.encode(), 0, []
                    for s in spans:
                        parts.append(raw[at:s["start"]])
                        at = max(at, s["end"])
                    t = b"".join([*parts, raw[at:]]).decode()
                out.append(t)
            yield pa.record_batch([b.column("_row"), pa.array(out, pa.string())], names=["_row", "_kept"])
    return run


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", unit: str = "line",
                min_words: int = MIN_WORDS) -> DataFrame:
    """The input's rows and columns plus ``removed_spans`` (start, end, unit in
    the original text) and ``kept_text`` (null stays null); input columns of
    these two names give way to them."""
    marks = repeated_units(docs, text, doc_id, unit, min_words).select(
        *[F.col(k).alias("_m" + k) for k in KEY], F.col("removed").alias("_removed"))
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row")
    keyed = docs.select(row, F.col(text).cast("string").alias("_text"), *row_key(doc_id, text))
    joined = keyed.join(marks, (F.col(KEY[0]) == F.col("_m" + KEY[0])) & (F.col(KEY[1]) == F.col("_m" + KEY[1])), "left")
    cols = joined.select(F.struct("_row", "_removed").alias("_row"), "_text", "_removed")
    schema = T.StructType([cols.schema["_row"], T.StructField("_kept", T.StringType())])
    out = cols.mapInArrow(_cut_spans(True), schema)
    return out.select(*[F.col("_row._row").getField(c).alias(c) for c in docs.columns if c not in ("removed_spans", "kept_text")],
                      F.coalesce(F.col("_row._removed"), F.array().cast(joined.schema["_removed"].dataType)).alias("removed_spans"),
                      F.col("_kept").alias("kept_text"))
