"""Ranked lexical search by range-maximum queries on posting lists.

``build_index`` tokenises every document once. A shard (one row of the index)
holds a few MB of text: its documents by ascending doc_id, and for each of
their terms the documents that hold it with their counts. Terms are told apart
by 64-bit hashes.

``search`` takes the items in blocks. Per block one pass over the index counts
the documents of the block's terms, and one scores. There, in each shard, the
posting lists of the block's terms get a sparse table that answers where the
largest gain within any range of a list lies. An item starts with the interval
of all documents of the shard. An interval's bound is the sum, over the item's
terms, of the largest gain inside it. Intervals are taken best bound first: the
document of the largest single gain is scored and splits its interval in two,
whose bounds are answered from the table; terms without a document inside are
dropped. Intervals of ``LEAF`` or fewer documents are scored whole. An interval
whose bound cannot enter the item's best k (carried from shard to shard of a
task) is dropped: as documents stand by doc_id, equal scores are decided by the
interval's first one. All items of a block advance together, the ``WIDTH`` best
intervals of each in one numpy step. Nothing is approximate: every document is
scored or excluded by a bound.

Score of a document: the sum over the item's distinct terms of
w * ((10**9 * tf) div (1000 * tf + 8 * m)), with w = floor(1000 * ln((2N + 2) /
(2df + 1))) and m = 10 + (90 * n * N) div L; N documents with a term, L terms in
all, n in the document.

Defined cases: null and empty texts hold no term; null doc_ids rank last among
equal scores; rows that repeat a doc_id are documents of their own; rows of one
item_id are one item (their terms together), null item_ids are none; an item
without a matching document has no rows; empty tables give an empty result;
ids are whole numbers; other columns are ignored, whatever their names.

Bounds: a shard is about ``SHARD_BYTES`` of text (a longer text is one shard); a
block is about ``BLOCK_PAIRS`` pairs of item and term, the only thing that passes
through the driver and is sent to every task (a larger item is a block of its
own, as it is one row of its table).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from pulsegrid.llm.common import batch_blocks, bounded, kept, scratch, text_column
from pulsegrid.llm.words import ALPHANUMERIC, LOWER, hashes, spans

SHARD_BYTES = 4 << 20
BLOCK_PAIRS = 200_000
LEAF = 16
WIDTH = 16
EXACT = 2**53  # doubles add whole numbers below this exactly
LAST = np.iinfo(np.int64).max
INDEX = "doc_id binary, n_terms binary, term binary, df binary, doc binary, tf binary, n_docs bigint, n_all bigint"


# --- index -------------------------------------------------------------------

def _packed(x: np.ndarray) -> bytes:
    """Whole numbers in the narrowest width."""
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0)).tobytes()


def _unpacked(b: bytes, n: int) -> np.ndarray:
    return np.frombuffer(b, f"<u{len(b) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def shard(doc_id: np.ndarray, data: np.ndarray, off: np.ndarray) -> dict | None:
    """Index row of a block of texts (null ids: LAST)."""
    data = LOWER[data]
    start, end, doc = spans(data, off, ALPHANUMERIC)
    if not len(start):
        return None
    n = np.bincount(doc, minlength=len(off) - 1)
    order = np.lexsort((np.arange(len(n)), doc_id))
    order = order[n[order] > 0]
    place = np.zeros(len(n), np.int64)
    place[order] = np.arange(len(order))
    term, number = np.unique(hashes(data, start, end), return_inverse=True)
    posting, tf = np.unique(number * len(order) + place[doc], return_counts=True)
    return {"doc_id": doc_id[order].astype("<i8").tobytes(), "n_terms": n[order].astype("<i8").tobytes(),
            "term": term.astype("<u8").tobytes(), "df": _packed(np.bincount(posting // len(order), minlength=len(term))),
            "doc": _packed(posting % len(order)), "tf": _packed(tf), "n_docs": len(order), "n_all": int(n.sum())}


def _shards(batches):
    schema = pa.schema([(c, pa.binary()) for c in ("doc_id", "n_terms", "term", "df", "doc", "tf")] + [("n_docs", pa.int64()), ("n_all", pa.int64())])
    for rows, data, off in batch_blocks(batches, "_text", SHARD_BYTES):
        ids = np.asarray(rows.column(rows.schema.get_field_index("_id")).fill_null(LAST))
        row = shard(ids, data, off)
        if row is not None:
            yield pa.RecordBatch.from_pylist([row], schema)


def build_index(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The index of all documents: one row per shard."""
    return bounded(docs).select(F.col(doc_id).cast("bigint").alias("_id"), text_column(text).alias("_text")).mapInArrow(_shards, INDEX)


# --- one block of items in one shard -------------------------------------------

def _ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (count[0] numbers), then those of start[1]."""
    first = np.cumsum(count) - count
    return np.arange(int(count.sum())) + np.repeat(start - first, count)


def _sums(x: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of x (counts above zero)."""
    return np.add.reduceat(x, np.cumsum(count) - count) if len(count) else np.zeros(0, np.int64)


class Lists:
    """Posting lists with gains, one after the other, and their sparse table."""

    def __init__(self, doc: np.ndarray, gain: np.ndarray, count: np.ndarray, n_docs: int):
        self.doc, self.gain, self.n_docs = doc, gain, n_docs
        self.end = np.cumsum(count)
        self.first = self.end - count
        self.list = np.repeat(np.arange(len(count)), count)
        self.key = self.list * n_docs + doc  # ascending
        levels = [np.arange(len(doc), dtype=np.int32)]
        widest = int(count.max()) if len(count) else 0
        while 2 << (len(levels) - 1) <= widest:
            half, below = 1 << (len(levels) - 1), levels[-1]
            a, b = below[:-half], below[half:]
            levels.append(np.concatenate([np.where(gain[b] > gain[a], b, a), below[-half:]]))
        self.table = np.stack(levels)

    def argmax(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Position of the largest gain in each range [a, b) of a list, b > a."""
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        x, y = self.table[level, a], self.table[level, b - (1 << level)]
        return np.where(self.gain[y] > self.gain[x], y, x)

    def place(self, lists: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Position in its list of a document or of the next one after it."""
        return np.searchsorted(self.key, lists * self.n_docs + doc)


class Best:
    """The k best (score, id) of each item so far."""

    def __init__(self, n_items: int, k: int):
        self.k, self.item, self.score, self.id = k, *[np.zeros(0, np.int64) for _ in range(3)]
        self.floor = np.zeros(n_items, np.int64)  # to beat: score, and id where equal
        self.floor_id = np.full(n_items, -1 << 63, np.int64)

    def open(self, item: np.ndarray, score: np.ndarray, doc_id: np.ndarray) -> np.ndarray:
        """Which of these could still enter."""
        low = self.floor[item]
        return (score > low) | ((score == low) & (doc_id < self.floor_id[item]) & (score > 0))

    def add(self, item: np.ndarray, score: np.ndarray, doc_id: np.ndarray) -> None:
        new = self.open(item, score, doc_id)
        if not new.any():
            return
        item, score, doc_id = (np.concatenate([x, y[new]]) for x, y in ((self.item, item), (self.score, score), (self.id, doc_id)))
        order = np.lexsort((doc_id, -score, item))
        item, score, doc_id = item[order], score[order], doc_id[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        stay = rank < self.k
        self.item, self.score, self.id = item[stay], score[stay], doc_id[stay]
        worst = np.flatnonzero(rank[stay] == self.k - 1)
        self.floor[self.item[worst]], self.floor_id[self.item[worst]] = self.score[worst], self.id[worst]


class Intervals:
    """Intervals [lo, hi) of documents of items, with the ranges [a, b) that
    the item's lists have inside (count: how many, one after the other)."""

    def __init__(self, lists: Lists, item, lo, hi, count, a, b, top=None):
        self.lists, self.item, self.lo, self.hi, self.count, self.a, self.b = lists, item, lo, hi, count, a, b
        self.top = lists.argmax(a, b) if top is None else top
        self.bound = _sums(lists.gain[self.top], count)

    def take(self, mask: np.ndarray) -> "Intervals":
        flat = np.repeat(mask, self.count)
        return Intervals(self.lists, self.item[mask], self.lo[mask], self.hi[mask], self.count[mask], self.a[flat], self.b[flat], self.top[flat])

    def __add__(self, other: "Intervals") -> "Intervals":
        both = [np.concatenate([getattr(self, c), getattr(other, c)]) for c in ("item", "lo", "hi", "count", "a", "b", "top")]
        return Intervals(self.lists, *both)

    def foremost(self, width: int) -> np.ndarray:
        """Mask of the ``width`` intervals of best bound of each item."""
        order = np.lexsort((-self.bound, self.item))
        item = self.item[order]
        mask = np.zeros(len(item), bool)
        mask[order[np.arange(len(item)) - np.searchsorted(item, item) < width]] = True
        return mask

    def scores(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, document, score) of all documents inside that hold a term."""
        size = self.hi - self.lo
        base = np.cumsum(size) - size
        whose = np.repeat(np.arange(len(size)), self.count)
        n = self.b - self.a
        at = _ragged(self.a, n)
        cell = self.lists.doc[at] + np.repeat((base - self.lo)[whose], n)
        gain, cells = self.lists.gain[at], int(size.sum())
        if int(self.bound.max(initial=0)) < EXACT:
            total = np.bincount(cell, gain, cells).astype(np.int64)
        else:
            total = np.zeros(cells, np.int64)
            np.add.at(total, cell, gain)
        hit = total > 0
        return np.repeat(self.item, size)[hit], _ragged(self.lo, size)[hit], total[hit]

    def split(self) -> tuple["Intervals", np.ndarray, np.ndarray, np.ndarray]:
        """The parts before and after each interval's document of the largest
        gain, and (item, document, score) of these documents."""
        x = self.lists
        gain, first = x.gain[self.top], np.cumsum(self.count) - self.count
        whose = np.repeat(np.arange(len(self.item)), self.count)
        is_best = np.flatnonzero(gain == np.maximum.reduceat(gain, first)[whose])
        pick = is_best[np.searchsorted(whose[is_best], np.arange(len(self.item)))]
        doc = x.doc[self.top[pick]]
        at = x.place(x.list[self.a], doc[whose])
        hit = (at < self.b) & (x.doc[np.minimum(at, len(x.doc) - 1)] == doc[whose])
        score = _sums(np.where(hit, x.gain[np.minimum(at, len(x.doc) - 1)], 0), self.count)
        parts = []
        for a, b, lo, hi in ((self.a, at, self.lo, doc), (at + hit, self.b, doc + 1, self.hi)):
            some = b > a
            count = np.bincount(whose[some], minlength=len(self.item))
            live = count > 0
            parts.append(Intervals(x, self.item[live], lo[live], hi[live], count[live], a[some], b[some]))
        return parts[0] + parts[1], self.item, doc, score


class Block:
    """Items of a block: their terms (positions in the sorted block terms)."""

    def __init__(self, pairs: list[tuple[int, int]]):
        item_id, term = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64).view(np.uint64)
        self.item_id, item = np.unique(item_id, return_inverse=True)
        self.term, number = np.unique(term, return_inverse=True)
        pair = np.unique(item * len(self.term) + number)
        self.item, self.number = pair // max(len(self.term), 1), pair % max(len(self.term), 1)
        self.weight = np.zeros(len(self.term), np.int64)
        self.n_docs = self.n_all = 0

    def weigh(self, df: np.ndarray, n_docs: int, n_all: int) -> None:
        self.n_docs, self.n_all = n_docs, n_all
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)

    def found(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(block terms that a shard has, their places among the shard's terms)."""
        at = np.minimum(np.searchsorted(terms, self.term), len(terms) - 1)
        mine = np.flatnonzero(terms[at] == self.term)
        return mine, at[mine]

    def search(self, row: dict, best: Best) -> None:
        """Put the documents of a shard among the best of each item."""
        doc_id, n = np.frombuffer(row["doc_id"], "<i8"), np.frombuffer(row["n_terms"], "<i8")
        terms = np.frombuffer(row["term"], "<u8")
        mine, at = self.found(terms)
        useful = self.weight[mine] > 0
        mine, at = mine[useful], at[useful]
        if not len(mine):
            return
        df = _unpacked(row["df"], len(terms))
        start, count, total = (np.cumsum(df) - df)[at], df[at], int(df.sum())
        places = _ragged(start, count)
        doc, tf = _unpacked(row["doc"], total)[places], _unpacked(row["tf"], total)[places]
        m = np.array([10 + 90 * int(x) * self.n_docs // self.n_all for x in n], np.int64)
        gain = np.repeat(self.weight[mine], count) * (10**9 * tf // (1000 * tf + 8 * m[doc]))
        lists = Lists(doc, gain, count, len(n))
        list_of = np.full(len(self.term), -1, np.int64)
        list_of[mine] = np.arange(len(mine))
        have = list_of[self.number] >= 0
        item, which = self.item[have], list_of[self.number[have]]
        if not len(item):
            return
        items, each = np.unique(item, return_counts=True)
        zero = np.zeros(len(items), np.int64)
        todo = Intervals(lists, items, zero, zero + len(n), each, lists.first[which], lists.end[which])
        while True:
            todo = todo.take(best.open(todo.item, todo.bound, doc_id[todo.lo]))
            if not len(todo.item):
                return
            front = todo.foremost(WIDTH)
            small = todo.hi - todo.lo <= LEAF
            item, doc, score = todo.take(front & small).scores()
            best.add(item, score, doc_id[doc])
            large = front & ~small
            rest = todo.take(~front)
            if large.any():
                parts, item, doc, score = todo.take(large).split()
                best.add(item, score, doc_id[doc])
                rest = rest + parts
            todo = rest


# --- jobs ------------------------------------------------------------------------

def _block_df(block: Block):
    """(block term, documents of it) per shard, and the totals as -1 and -2."""
    def run(batches):
        df = np.zeros(len(block.term), np.int64)
        docs = words = 0
        for b in batches:
            for row in b.to_pylist():
                docs, words = docs + row["n_docs"], words + row["n_all"]
                terms = np.frombuffer(row["term"], "<u8")
                mine, at = block.found(terms)
                df[mine] += _unpacked(row["df"], len(terms))[at]
        some = np.flatnonzero(df)
        yield pa.record_batch({"number": pa.array([-1, -2, *some], pa.int64()), "n": pa.array([docs, words, *df[some]], pa.int64())})
    return run


def _block_best(block: Block, k: int):
    def run(batches):
        best = Best(len(block.item_id), k)
        for b in batches:
            for row in b.to_pylist():
                block.search(row, best)
        known = best.id != LAST
        yield pa.record_batch({"item_id": pa.array(block.item_id[best.item]), "doc_id": pa.array(best.id, mask=~known),
                               "score": pa.array(best.score)})
    return run


def item_terms(items: DataFrame, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Distinct (item, term) pairs; terms as hashes."""
    def run(batches):
        for rows, data, off in batch_blocks(batches, "_text"):
            low = LOWER[data]
            start, end, who = spans(low, off, ALPHANUMERIC)
            yield pa.record_batch({"item": rows.column(rows.schema.get_field_index("_id")).take(pa.array(who)),
                                   "term": pa.array(hashes(low, start, end).view(np.int64))})
    x = bounded(items).select(F.col(item_id).cast("bigint").alias("_id"), text_column(text).alias("_text")).where("_id is not null")
    return x.mapInArrow(run, "item bigint, term bigint").distinct()


def search(index: DataFrame, items: DataFrame, k: int = 10, text: str = "text", item_id: str = "item_id",
           block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents by score,
    then doc_id."""
    spark = items.sparkSession
    out = spark.createDataFrame([], "item_id bigint, doc_id bigint, score bigint")
    with scratch(spark, "rmq-items") as tables:
        pairs = tables.save(item_terms(items, text, item_id))
        n_blocks = -(-pairs.count() // block_pairs)
        number = F.pmod(F.xxhash64("item"), F.lit(max(n_blocks, 1)))
        for i in range(n_blocks):
            found = [tuple(r) for r in pairs.where(number == i).collect()]
            if not found:
                continue
            block = Block(found)
            counts = index.select("term", "df", "n_docs", "n_all").mapInArrow(_block_df(block), "number bigint, n bigint")
            total = {r["number"]: r["n"] for r in counts.groupBy("number").agg(F.sum("n").alias("n")).collect()}
            if not total.get(-1):
                break
            block.weigh(np.array([total.get(t, 0) for t in range(len(block.term))]), total[-1], total[-2])
            out = out.unionAll(tables.save(index.mapInArrow(_block_best(block, k), out.schema)))
        rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        return kept(out.select("item_id", rank.alias("rank"), "doc_id", "score").where(F.col("rank") <= k))


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10, text: str = "text", doc_id: str = "doc_id",
                  item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Index documents and search them for every item (see ``search``)."""
    with scratch(docs.sparkSession, "rmq-index") as tables:
        # small row groups: a reader holds one of them, whatever a shard's size
        index = tables.save(build_index(docs, text, doc_id), **{"parquet.block.size": 16 << 20})
        return search(index, items, k, item_text, item_id)
