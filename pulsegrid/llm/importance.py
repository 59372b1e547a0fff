"""Quality classification by importance resampling.

Two generative models over hashed n-grams are counted on the whole corpus: the
target model on documents labelled good, the raw model on all documents. An
n-gram is a word, a pair of words, a word shape or a pair of shapes (runs of
capitals, letters, digits and punctuation, and whether the word repeats the one
before). A document's log importance weight is the sum over its n-grams of
log(p_target / p_raw) minus a margin per n-gram; the margin is fitted on the
labelled documents. Labels enter as a broadcast sample of at most ``MAX_LABELS``
ids; every other count covers all documents. The documents kept are drawn by Gumbel top-k: the k largest of log weight + Gumbel
noise, where k is the number of documents of weight 1 or more (or a parameter).

Noise is a hash of the row key and a seed, so every re-run draws the same
documents. The k-th largest key is found exactly, by counting 16 bits of the
key at a time.

Defined cases: null and empty texts have no n-grams and weight 1 (log 0); a
null label is no label; without good labels every document has weight 1; keys
that tie with the k-th are all kept (repeated rows share a key); an empty table
gives an empty result; other columns are passed on unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from pulsegrid.llm.common import KEY, batch_blocks, bounded, kept, row_key, scratch, text_column

BINS = 1 << 15
BLOCK = 1 << 20  # text bytes of one numpy pass
MAX_LABELS = 200_000  # labelled documents used, those with the smallest id hashes
MAX_FALSE_REJECT = 0.002  # share of good labels that the margin may put below weight 1
_MUL = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _classes() -> np.ndarray:
    c = np.arange(256, dtype=np.uint64)
    c[[9, 10, 11, 12, 13, 32]] = 0
    c[ord("0"):ord("9") + 1] = 1
    c[ord("A"):ord("Z") + 1] = 2
    c[ord("a"):ord("z") + 1] = 3
    c[128:] = 3
    return c


_CLASS = _classes()
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
# high-order capitals with a lead byte of 0xC3 (accented Latin capitals) count as capitals
_CAP_TAIL = np.zeros(256, bool)
_CAP_TAIL[0x80:0x9F] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        p = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), _MUL)]).astype(np.uint64))
        q = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), _INV)]).astype(np.uint64))
    return p, q


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


_POW: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _span_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of values[start:end] for each span, independent of its place."""
    n = len(values)
    if len(_POW[0]) < n + 1:
        _POW[0], _POW[1] = _powers(max(n + 1, 1 << 20))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((values + np.uint64(7)) * _POW[0][:n], out=total[1:])
    return _mix((total[end] - total[start]) * _POW[1][start])


def ngrams(data: np.ndarray, off: np.ndarray, bins: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """(bin of each n-gram, number of n-grams of each text) of a block of texts."""
    n_docs = len(off) - 1
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(n_docs, np.int64)
    cls = _CLASS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    cap = lead[_CAP_TAIL[data[lead + 1]]]
    cls[cap] = cls[cap + 1] = 2
    word = cls != 0
    edge = np.zeros(len(data) + 1, bool)  # a word starts (or ends) here
    edge[0], edge[-1] = word[0], word[-1]
    edge[1:-1] = word[1:] != word[:-1]
    cut = off[1:-1]
    inner = np.unique(cut[(cut > 0) & (cut < len(data))])
    both = inner[word[inner] & word[inner - 1]]  # texts that touch
    bounds = np.sort(np.concatenate([np.flatnonzero(edge), both, both]))
    start, end = bounds[::2], bounds[1::2]
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(n_docs, np.int64)
    with np.errstate(over="ignore"):
        wh = _span_hash(_LOWER[data], start, end)
        new = np.ones(len(data), bool)  # runs of one class count once
        new[1:] = cls[1:] != cls[:-1]
        new[start] = True
        place = np.concatenate([[0], np.cumsum(new)])
        sh = _span_hash(cls[new], place[start], place[end])
        doc = np.searchsorted(off, start, side="right") - 1
        same = np.zeros(len(doc), bool)
        same[1:] = doc[1:] == doc[:-1]
        rep = np.zeros(len(doc), np.uint64)
        rep[1:] = same[1:] & (wh[1:] == wh[:-1])
        sh = _mix(sh + rep * np.uint64(0x94D049BB133111EB))
        prev_w, prev_s = np.roll(wh, 1), np.roll(sh, 1)
        prev_w[~same] = prev_s[~same] = np.uint64(0)
        pair = _mix(prev_w * np.uint64(0xD6E8FEB86659FD93) + wh)
        pair[rep == 1] = np.uint64(0x5851F42D4C957F2D)  # any word said twice
        kinds = np.stack([wh, pair ^ np.uint64(0x11), _mix(sh) ^ np.uint64(0x22),
                          _mix(prev_s * np.uint64(0xA0761D6478BD642F) + sh) ^ np.uint64(0x33)], axis=1)
    b = (_mix(kinds) >> np.uint64(40)).astype(np.int64) % bins
    return b.reshape(-1), np.bincount(doc, minlength=n_docs).astype(np.int64) * 4


def _label_flags(doc_ids: pa.Array, labels) -> tuple[np.ndarray, np.ndarray]:
    """(labelled, labelled good) of each row, from the sorted label sample."""
    ids, good = labels
    d = np.asarray(doc_ids.fill_null(-1))
    at = np.minimum(np.searchsorted(ids, d), max(len(ids) - 1, 0))
    known = (ids[at] == d) & ~np.asarray(doc_ids.is_null()) if len(ids) else np.zeros(len(d), bool)
    return known, known & good[at] if len(ids) else known


def _counts(labels, bins: int):
    """Per task the n-gram counts of good and of all documents (bounded: bins)."""
    def run(batches):
        good, every = np.zeros(bins, np.int64), np.zeros(bins, np.int64)
        for rows, data, off in batch_blocks(batches, "_text", BLOCK):
            b, n = ngrams(data, off, bins)
            every += np.bincount(b, minlength=bins)
            _, g = _label_flags(rows.column("_id"), labels.value)
            good += np.bincount(b[np.repeat(g, n)], minlength=bins)
        at = np.flatnonzero(every)
        yield pa.record_batch({"bin": pa.array(at, pa.int32()), "good": pa.array(good[at]), "every": pa.array(every[at])})
    return run


def fit_ratios(base: DataFrame, labels, bins: int = BINS) -> np.ndarray:
    """log(p_target / p_raw) of each bin; the raw model counts all documents.
    What is collected has one row per bin."""
    c = (base.mapInArrow(_counts(labels, bins), "bin int, good bigint, every bigint")
         .groupBy("bin").agg(F.sum("good").alias("good"), F.sum("every").alias("every")).collect())
    t, r = np.zeros(bins), np.zeros(bins)
    for x in c:
        t[x["bin"]], r[x["bin"]] = x["good"], x["every"]
    if not t.sum():
        return np.zeros(bins)
    raw = (r + 0.5) / (r.sum() + 0.5 * bins)
    strength = 0.0005 * t.sum()  # smoothing of the target model towards the raw one
    return np.log((t + strength * raw) / (t.sum() + strength)) - np.log(raw)


def _weigh(rows, data, off, ratio: np.ndarray, bins: int, seed: int):
    """n-grams, log ratio and Gumbel noise of each text; the same in any block."""
    b, n = ngrams(data, off, bins)
    s, at = np.zeros(len(n)), np.flatnonzero(n)
    if len(at):
        s[at] = np.add.reduceat(ratio[b], (np.cumsum(n) - n)[at])
    u = np.asarray(rows.column(KEY[0])).astype(np.int64).view(np.uint64)
    with np.errstate(over="ignore"):
        u = _mix(_mix(u + np.uint64(seed) * _MUL))
    u = ((u >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
    return n, s, -np.log(-np.log(u))


def _sortable(x: np.ndarray) -> np.ndarray:
    """Doubles as unsigned longs of the same order."""
    x = np.ascontiguousarray(x, np.float64).view(np.uint64)
    return np.where((x >> np.uint64(63)) == 1, ~x, x | np.uint64(1 << 63))


def _scores(ratio, labels, bins: int, seed: int):
    def run(batches):
        for rows, data, off in batch_blocks(batches, "_text", BLOCK):
            n, s, g = _weigh(rows, data, off, ratio.value, bins, seed)
            known, good = _label_flags(rows.column("_id"), labels.value)
            yield pa.record_batch({"doc_id": rows.column("_id"), "n_grams": pa.array(n), "log_ratio": pa.array(s),
                                   "gumbel": pa.array(g), "good": pa.array(good, pa.bool_(), mask=~known)})
    return run


def _with_bits(margin: float):
    def run(batches):
        for b in batches:
            w = np.asarray(b.column("log_ratio")) - margin * np.asarray(b.column("n_grams"))
            key = w + np.asarray(b.column("gumbel"))
            yield pa.record_batch([*b.columns[:3], pa.array(w), pa.array(key), pa.array(_sortable(key).view(np.int64))],
                                  names=["doc_id", "n_grams", "log_ratio", "log_weight", "gumbel_key", "bits"])
    return run


def _kth_largest(df: DataFrame, k: int) -> int | None:
    """The k-th largest unsigned value of ``bits``, by four counts of 16 bits."""
    if k <= 0:
        return None
    prefix = 0
    for level in range(4):
        shift = 48 - 16 * level
        at = df.where(F.shiftrightunsigned("bits", shift + 16) == prefix) if level else df
        digit = F.shiftrightunsigned("bits", shift).bitwiseAND(F.lit(0xFFFF).cast("bigint"))
        for d, n in sorted(((r["d"], r["n"]) for r in at.groupBy(digit.alias("d")).agg(
                F.count("*").alias("n")).collect()), reverse=True):
            if n >= k:
                prefix = (prefix << 16) | d
                break
            k -= n
        else:
            return 0
    return prefix


def _margin(scored: DataFrame) -> float:
    """Margin per n-gram, from exact histograms of the labelled documents' mean
    log ratios: the highest that leaves at most MAX_FALSE_REJECT of the good
    labels below it, then half-way down to the nearest bad label below."""
    mean = F.col("log_ratio") / F.greatest(F.col("n_grams"), F.lit(1))
    h = (scored.where("n_grams > 0 and good is not null")
         .groupBy("good", F.floor(mean * 1000).cast("int").alias("b")).count().collect())
    good = sorted((r["b"], r["count"]) for r in h if r["good"])
    if not good:
        return 0.0
    allowed, seen, low = MAX_FALSE_REJECT * sum(n for _, n in good), 0, good[0][0]
    for low, n in good:
        seen += n
        if seen > allowed:
            break
    below = [r["b"] for r in h if not r["good"] and r["b"] < low]
    return (low - (low - max(below)) / 2 if below else low) / 1000.0


def _prepare(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, bins: int, seed: int):
    spark = bounded(docs).sparkSession
    sample = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
              .groupBy(F.col("doc_id").cast("bigint").alias("i")).agg((F.min(label) > 0).alias("g"))
              .orderBy(F.xxhash64("i"), "i").limit(MAX_LABELS).toArrow())
    ids = sample.column("i").to_numpy()
    order = np.argsort(ids, kind="stable")
    sent = spark.sparkContext.broadcast((ids[order], sample.column("g").to_numpy()[order]))
    base = docs.select(*row_key(doc_id, text), F.col(doc_id).cast("bigint").alias("_id"), text_column(text).alias("_text"))
    ratio = spark.sparkContext.broadcast(fit_ratios(base, sent, bins))
    ddl = "doc_id bigint, n_grams bigint, log_ratio double, gumbel double, good boolean"
    return ratio, base.mapInArrow(_scores(ratio, sent, bins, seed), ddl)


def _draw(tmp, scored: DataFrame, k: int | None) -> tuple[float, DataFrame, int | None]:
    """(margin, scored rows with their keys, smallest key drawn as bits)."""
    s = tmp.save(scored)
    margin = _margin(s)
    w = tmp.save(s.mapInArrow(_with_bits(margin), "doc_id bigint, n_grams bigint, log_ratio double, "
                                                  "log_weight double, gumbel_key double, bits bigint"))
    return margin, w, _kth_largest(w, k if k is not None else w.where("log_weight >= 0").count())


def importance(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
               label: str = "quality", k: int | None = None, bins: int = BINS, seed: int = 17) -> DataFrame:
    """One row per input row: doc_id, n_grams, log_ratio (sum over n-grams),
    log_weight (less the margin), gumbel_key, selected."""
    with scratch(docs.sparkSession, "dsir") as tmp:
        _, w, cut = _draw(tmp, _prepare(docs, labels, text, doc_id, label, bins, seed)[1], k)
        flip = F.lit(-2**63).cast("bigint")  # unsigned comparison
        picked = F.lit(False) if cut is None else F.col("bits").bitwiseXOR(flip) >= F.lit(cut - (1 << 63)).cast("bigint")
        return kept(w.select("doc_id", "n_grams", "log_ratio", "log_weight", "gumbel_key", picked.alias("selected")))


def select_quality(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
                   label: str = "quality", k: int | None = None, bins: int = BINS, seed: int = 17) -> DataFrame:
    """The input rows that are drawn, all columns unchanged. The keys are worked
    out again beside the texts, so that no text is shuffled."""
    ratio, scored = _prepare(docs, labels, text, doc_id, label, bins, seed)
    with scratch(docs.sparkSession, "dsir") as tmp:
        margin, _, cut = _draw(tmp, scored, k)

    def run(batches):
        for rows, data, off in batch_blocks(batches, "_text", BLOCK):
            n, s, g = _weigh(rows, data, off, ratio.value, bins, seed)
            keep = _sortable(s - margin * n + g) >= np.uint64(cut) if cut is not None else np.zeros(len(n), bool)
            row = rows.column("_row")
            cols = [row.field(i) for i in range(row.type.num_fields)]
            yield pa.record_batch(cols, names=[str(i) for i in range(len(cols))]).filter(pa.array(keep))

    out = T.StructType([T.StructField(str(i), f.dataType, True) for i, f in enumerate(docs.schema.fields)])
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row")
    return docs.select(row, row_key(doc_id, text)[0], text_column(text).alias("_text")).mapInArrow(run, out).toDF(*docs.columns)
