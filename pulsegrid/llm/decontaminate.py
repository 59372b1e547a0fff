"""Benchmark decontamination with a generalised suffix automaton.

The words of the test items become one automaton over word ids. Training texts
are streamed through it: the automaton's state gives the longest match that
ends at each word. A window is ``window`` consecutive words of an item (a
shorter item is one window); every word inside an occurrence of a window is
hit. Spans of hit words are removed; a text in which the hit share exceeds
``max_coverage`` is contaminated as a whole.

Items are cut into pieces of at most ``BLOCK_WORDS`` words that share
``window - 1`` words, so that every window is whole in one. Pieces that make one
block in all are broadcast, and each task builds their automaton and streams the
texts that it reads. More pieces are numbered into blocks of that size by tasks.
The documents are then read once: a bitmap of the hashes of all item grams (of
as many words as the shortest item, ``window`` at most; its size is fixed) keeps
the runs of words that could hold a window. These runs meet each block's pieces
in tasks that hold one block's automaton at a time, and the hits come back by
row key.

Defined cases: a null or empty text has no words; an item without words, or
with a null id, is ignored; items sharing an id count once; an empty benchmark
hits nothing; words never cross documents; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from pulsegrid.llm.common import BLOCK_BYTES, KEY, batch_blocks, bounded, kept, row_key, scratch, text_column
from pulsegrid.llm.words import ALPHANUMERIC, LOWER, hashes, mix, spans

WINDOW = 10
BLOCK_WORDS = 100_000
BITS = 22
FILTER_BITS = 26  # of the bitmap of item grams: 8 MB
SCAN_WORDS = 2_000_000  # words that one task streams through one block's automaton

# Word bytes are 0-9, a-z (A-Z lower-cased) and all above 0x7F.
_TABLE = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Automaton:
    """Generalised suffix automaton of word-id sequences.

    ``full[v]``: the items that hold the window of ``window`` words which is a
    suffix of state v's longest string; ``short[v]``: items of fewer words that
    are suffixes of it, with their lengths.
    """

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.shortest = window
        bigrams = set()
        for _, words in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
            bigrams.update(zip(ids, ids[1:], strict=False))
            last = 0
            for c in ids:
                last = self._extend(last, c)
            self.shortest = min(self.shortest, len(ids))
        self.seen = np.zeros(1 << BITS, bool)
        if bigrams:
            a = np.array(sorted(bigrams), np.int64)
            self.seen[_mix(a[:, 0], a[:, 1])] = True
        self._label(items)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        k = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = k
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = k
            p = link[p]
        return k

    def _label(self, items) -> None:
        """Item sets of the window states, by running each item through."""
        self.full: dict[int, set] = defaultdict(set)
        own: dict[int, set] = defaultdict(set)
        for item, words in items:
            v = 0
            for i, w in enumerate(words):
                v = self.next[v][self.vocab[w]]
                if i + 1 >= self.window:
                    u = self.at(v, self.window)
                    self.full[u].add(item)
            if 0 < len(words) < self.window:
                own[v].add((len(words), item))
        self.short: dict[int, tuple] = {}
        for v in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            got = own.get(v, set()) | set(self.short.get(self.link[v], ()))
            if got:
                self.short[v] = tuple(got)

    def at(self, v: int, n: int) -> int:
        """The state that holds the suffix of n words of v's strings."""
        while self.length[self.link[v]] >= n:
            v = self.link[v]
        return v

    def scan(self, ids, base: int, mark: np.ndarray, found: set) -> None:
        """Stream word ids; mark hit words (positions from base), collect items."""
        nxt, link, length, w = self.next, self.link, self.length, self.window
        v = n = 0
        for i, c in enumerate(ids):
            while v and c not in nxt[v]:
                v = link[v]
                n = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                n += 1
            else:
                v = n = 0
                continue
            if n >= w:
                mark[base + i - w + 1:base + i + 1] = True
                found.update(self.full[self.at(v, w)])
            for m, item in self.short.get(v, ()):
                if m <= n:
                    mark[base + i - m + 1:base + i + 1] = True
                    found.add(item)

    def match(self, words: list[bytes]) -> tuple[np.ndarray, set]:
        """(hit flag of each word, items with occurring windows)."""
        n, least = len(words), self.shortest
        mark, found = np.zeros(n, bool), set()
        if n < least or not self.vocab:
            return mark, found
        get = self.vocab.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, n)
        if least == 1:
            self.scan(ids.tolist(), 0, mark, found)
            return mark, found
        pair = (ids[:-1] >= 0) & (ids[1:] >= 0)
        pair[pair] = self.seen[_mix(ids[:-1][pair], ids[1:][pair])]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], pair, [False]]).astype(np.int8)))
        for a, b in edge.reshape(-1, 2).tolist():  # pairs a..b-1 hold: words a..b
            if b - a + 1 >= least:
                self.scan(ids[a:b + 1].tolist(), a, mark, found)
        return mark, found


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def cut(words: list[bytes], size: int, window: int) -> list[list[bytes]]:
    """An item's pieces of at most ``size`` words; neighbours share window - 1."""
    return [words[a:a + size] for a in range(0, max(len(words) - window, 0) + 1, size - window + 1)]


def item_pieces(benchmark: DataFrame, item_id: str, text: str, window: int, size: int) -> DataFrame:
    """item, words (joined by blanks) and their number n, of each piece."""
    def run(batches):
        for b in batches:
            out = [(i, p) for i, t in zip(b.column("i").to_pylist(), b.column("t").to_pylist(), strict=True)
                   for p in cut(words_of(t.encode()), size, window) if p]
            yield pa.record_batch({"item": pa.array([i for i, _ in out], pa.string()),
                                   "words": pa.array([b" ".join(p) for _, p in out], pa.binary()),
                                   "n": pa.array([len(p) for _, p in out], pa.int64())})

    return benchmark.where(F.col(item_id).isNotNull()).select(
        F.col(item_id).cast("string").alias("i"), text_column(text).alias("t")).mapInArrow(
            run, "item string, words binary, n bigint")


def numbered(pieces: DataFrame, total: int, size: int) -> DataFrame:
    """(block, item, words): blocks of at most ``size`` words, cut by the tasks
    over which the pieces are spread."""
    def run(batches):
        block, held = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            at = []
            for n in b.column("n").to_pylist():
                if held and held + n > size:
                    block, held = block + 1, 0
                held += n
                at.append(block)
            yield pa.record_batch([pa.array(at, pa.int64()), b.column("item"), b.column("words")], names=["block", "item", "words"])

    return pieces.repartition(math.ceil(total / size)).mapInArrow(run, "block bigint, item string, words binary")


def gram_slots(data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, place in the bitmap) of each run of ``gram`` words of a row."""
    h = hashes(data, start, end)
    n = max(len(h) - gram + 1, 0)
    x = h[:n]
    with np.errstate(over="ignore"):
        for j in range(1, gram):
            x = mix(x) + h[j:n + j]
    first = np.flatnonzero(row[:n] == row[len(row) - n:])
    return first, (mix(x)[first] >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def gram_filter(pieces: DataFrame, gram: int) -> np.ndarray:
    """Bitmap (64-bit words) of the places of all grams of the pieces; tasks and
    then one aggregate merge it, so at most 2**FILTER_BITS / 64 rows come back."""
    def run(batches):
        for _, data, off in batch_blocks(batches, "words"):
            _, at = gram_slots(data, *spans(data, off, ALPHANUMERIC), gram)
            at = np.unique(at)
            slot, first = np.unique(at >> 6, return_index=True)
            mask = np.uint64(1) << (at & 63).astype(np.uint64)
            yield pa.record_batch({"slot": pa.array(slot, pa.int64()),
                                   "mask": pa.array((np.bitwise_or.reduceat(mask, first) if len(at) else mask).view(np.int64))})

    got = pieces.select("words").mapInArrow(run, "slot bigint, mask bigint").groupBy("slot").agg(
        F.bit_or("mask").alias("mask")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    bits[got.column("slot").to_numpy()] = got.column("mask").to_numpy().view(np.uint64)
    return bits


def possible_runs(keyed: DataFrame, bits: np.ndarray, gram: int) -> DataFrame:
    """(row key, number of the first word, words, n) of each maximal run of words
    that lie in grams of the bitmap: every occurrence of a window is inside one."""
    sent = keyed.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for rows, data, off in batch_blocks(batches, "_text"):
            low = LOWER[data]
            start, end, row = spans(low, off, ALPHANUMERIC)
            first, at = gram_slots(low, start, end, row, gram)
            first = first[(sent.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1]
            depth = np.zeros(len(start) + 1, np.int64)
            depth[first] += 1
            depth[first + gram] -= 1
            held = np.cumsum(depth)[:-1] > 0
            new = np.ones(len(held) + 1, bool)
            new[1:-1] = row[1:] != row[:-1]  # runs end with their row
            a = np.flatnonzero(held & (new[:-1] | ~np.concatenate([[False], held[:-1]])))
            b = np.flatnonzero(held & (new[1:] | ~np.concatenate([held[1:], [False]])))
            pick = pa.array(row[a], pa.int64())
            yield pa.record_batch([
                rows.column(KEY[0]).take(pick), rows.column(KEY[1]).take(pick),
                pa.array(a - np.searchsorted(row, row[a]), pa.int32()),
                pa.array([low[i:j].tobytes() for i, j in zip(start[a].tolist(), end[b].tolist(), strict=True)], pa.binary()),
                pa.array(b + 1 - a, pa.int64())], names=[*KEY, "first", "words", "n"])

    return keyed.mapInArrow(run, f"{KEY[0]} bigint, {KEY[1]} bigint, first int, words binary, n bigint")


def block_hits(blocks: DataFrame, found: DataFrame, window: int) -> DataFrame:
    """Hits of the runs ``found`` in each block: (row key, hit word ranges,
    items). A block's pieces come before its runs in the task that has both;
    the runs of a block are spread over tasks of about SCAN_WORDS words."""
    ids = sorted(r[0] for r in blocks.select("block").distinct().collect())
    salts = max(1, math.ceil((found.agg(F.sum("n")).first()[0] or 0) / SCAN_WORDS))
    pieces = blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("kind"),
                           "item", "words", *[F.lit(None).cast("bigint").alias(k) for k in KEY], F.lit(None).cast("int").alias("first"))
    runs_ = found.select(F.explode(F.lit(ids).cast("array<bigint>")).alias("block"),
                         F.pmod(F.xxhash64(*KEY, "first"), F.lit(salts)).cast("int").alias("salt"), F.lit(1).alias("kind"),
                         F.lit(None).cast("string").alias("item"), "words", *KEY, "first")

    def run(batches):
        group, held, automaton = None, [], None
        for b in batches:
            out = []
            for block, salt, kind, item, words, k1, k2, first in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if (block, salt) != group:
                    group, held, automaton = (block, salt), [], None
                if kind == 0:
                    held.append((item, words.split()))
                    continue
                if automaton is None:
                    automaton, held = Automaton(held, window), []
                mark, items = automaton.match(words_of(words))
                if mark.any():
                    out.append((k1, k2, [{"a": first + i, "b": first + j} for i, j in runs(mark).tolist()], sorted(items)))
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _HITS, strict=True)],
                                      names=[*KEY, "hits", "found"])

    return pieces.unionByName(runs_).repartition(len(ids) * salts, "block", "salt").sortWithinPartitions(
        "block", "salt", "kind").mapInArrow(run, f"{KEY[0]} bigint, {KEY[1]} bigint, hits array<struct<a: int, b: int>>, "
                                                 "found array<string>")


_HITS = [pa.int64(), pa.int64(), pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])), pa.list_(pa.string())]


def word_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of each word."""
    b = np.frombuffer(text.translate(_TABLE), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[False], b, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def runs(mark: np.ndarray) -> np.ndarray:
    """(first, last+1) of each run of True."""
    return np.flatnonzero(np.diff(np.concatenate([[False], mark, [False]]).astype(np.int8))).reshape(-1, 2)


def _match_all(automaton: Automaton):
    """(hit flags, items) of each text of a row batch, by streaming."""
    def match(rows, texts):
        return [automaton.match(words_of(t)) for t in texts]
    return match


def _match_known(rows, texts):
    """(hit flags, items) of each text from hits found before (``_hits``, ``_found``)."""
    out = []
    for t, hits, found in zip(texts, rows.column("_hits").to_pylist(), rows.column("_found").to_pylist(), strict=True):
        mark = np.zeros(len(words_of(t)), bool)
        for h in hits or ():
            mark[h["a"]:h["b"]] = True
        out.append((mark, set(found or ())))
    return out


def _matcher(pieces, window, out_rows):
    """mapInArrow body: out_rows(row batch, texts, [(marks, items)])."""
    def run(batches):
        match = _match_known if pieces is None else _match_all(Automaton([(i, w.split()) for i, w in pieces.value], window))
        for rows, data, off in batch_blocks(batches, "_text"):
            texts = [data[off[i]:off[i + 1]].tobytes() for i in range(len(off) - 1)]
            yield out_rows(rows, texts, match(rows, texts))
    return run


def _with_matches(docs: DataFrame, columns: list, text: str, doc_id: str, benchmark: DataFrame, item_id: str,
                  item_text: str, window: int):
    """(rows with ``columns``, _text and what the matcher needs; the pieces that
    the matcher streams, broadcast, or none where the hits are known)."""
    spark = bounded(docs).sparkSession
    size = max(BLOCK_WORDS, window)
    plain = docs.select(*columns, text_column(text).alias("_text"))
    with scratch(spark, "decontaminate") as tmp:
        pieces = tmp.save(item_pieces(benchmark, item_id, item_text, window, size))
        total, least, held = pieces.agg(F.sum("n"), F.min("n"), F.sum(F.octet_length("words"))).first()
        if not total or total <= size and held <= BLOCK_BYTES:
            return plain, spark.sparkContext.broadcast([(r["item"], bytes(r["words"])) for r in pieces.collect()])
        gram = min(window, least)
        blocks = tmp.save(numbered(pieces, total, size))
        keyed = docs.select(*row_key(doc_id, text), text_column(text).alias("_text"))
        # rows of equal id and text share their key: their runs count once
        found = tmp.save(possible_runs(keyed, gram_filter(pieces, gram), gram).dropDuplicates([*KEY, "first"]))
        hits = kept(block_hits(blocks, found, window).groupBy(*[F.col(k).alias("_h" + k) for k in KEY]).agg(
            F.flatten(F.collect_list("hits")).alias("_hits"), F.array_distinct(F.flatten(F.collect_list("found"))).alias("_found")))
    named = docs.select(*columns, text_column(text).alias("_text"), *row_key(doc_id, text))
    return named.join(hits, (F.col(KEY[0]) == F.col("_h" + KEY[0])) & (F.col(KEY[1]) == F.col("_h" + KEY[1])), "left"), None


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, item_ids (sorted as strings) and
    spans (start and end byte of each maximal run of hit words)."""
    def rows_out(rows, texts, result):
        spans = []
        for t, (mark, _) in zip(texts, result, strict=True):
            if mark.any():
                s, e = word_bounds(t)
                spans.append([{"start": int(s[a]), "end": int(e[b - 1])} for a, b in runs(mark).tolist()])
            else:
                spans.append([])
        return pa.record_batch({
            "doc_id": rows.column("doc_id"), "n_words": pa.array([len(m) for m, _ in result], pa.int64()),
            "n_hit": pa.array([int(m.sum()) for m, _ in result], pa.int64()),
            "item_ids": pa.array([sorted(f) for _, f in result], pa.list_(pa.string())),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))})

    rows, pieces = _with_matches(docs, [F.col(doc_id).cast("bigint").alias("doc_id")], text, doc_id, benchmark, item_id,
                                 item_text, window)
    return rows.mapInArrow(
        _matcher(pieces, window, rows_out), "doc_id bigint, n_words bigint, n_hit bigint, item_ids array<string>, "
                                  "spans array<struct<start: bigint, end: bigint>>")


def remove_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id",
                         item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, max_coverage: float = 0.8) -> DataFrame:
    """The input's rows and columns with hit spans cut out of ``text``; rows
    whose share of hit words exceeds ``max_coverage`` are dropped. A text
    without a hit is unchanged, null included."""
    schema = docs.schema
    at = docs.columns.index(text)
    packed = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row")

    def rows_out(rows, texts, result):
        row = rows.column("_row")
        keep = pa.array([not m.any() or m.mean() <= max_coverage for m, _ in result], pa.bool_())
        cut = row.field(at).to_pylist()
        for i, (t, (mark, _)) in enumerate(zip(texts, result, strict=True)):
            if mark.any():
                s, e = word_bounds(t)
                left, parts = 0, []
                for a, b in runs(mark).tolist():
                    parts.append(t[left:s[a]])
                    left = e[b - 1]
                cut[i] = b"".join([*parts, t[left:]]).decode("utf-8")
        cols = [pa.array(cut, row.field(i).type) if i == at else row.field(i) for i in range(row.type.num_fields)]
        return pa.record_batch(cols, names=[str(i) for i in range(len(cols))]).filter(keep)

    rows, pieces = _with_matches(docs, [packed], text, doc_id, benchmark, item_id, item_text, window)
    out = T.StructType([T.StructField(str(i), f.dataType, True) for i, f in enumerate(schema.fields)])
    return rows.mapInArrow(_matcher(pieces, window, rows_out), out).toDF(*docs.columns)


def items_digest(ids: str = "item_ids"):
    """SHA-256 of the comma-joined sorted item ids."""
    return F.sha2(F.array_join(F.array_sort(F.col(ids)), ",").cast("binary"), 256)


def digest_of(ids: list) -> str:
    return hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
