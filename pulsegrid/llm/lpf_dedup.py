"""Substring deduplication by longest-previous-factor (LPF) arrays.

Texts are UTF-8 bytes. A string of ``length`` bytes that starts at two places
is repeated; matches never cross documents. ``keep="first"`` removes the bytes
of every occurrence but the earliest (by doc_id, then offset); ``keep="none"``
removes those of all occurrences.

LPF[i] is the longest prefix of suffix i that also starts at an earlier place;
it is found in suffix order, between i and the nearest entries before and after
it that have a smaller position. Only whether LPF (or its mirror image, the
longest next factor) reaches ``length`` matters here, so suffixes are ordered
by their first ``length`` bytes, ties by position: then the previous smaller
position that shares the prefix is the entry just before, the next larger one
the entry just after.

One suffix array of a corpus fits no machine, so suffixes meet in buckets:

1. The smallest hash among the ``gram``-byte grams of a window of ``length``
   bytes is its anchor. Equal windows have equal anchors. Windows next to each
   other mostly share an anchor: such a run of windows is one row (anchor hash,
   hash of the whole run, place).
2. Anchors are counted. One that occurs once repeats nothing. One whose runs
   are all equal repeats wholly. Only the windows of mixed anchors go on.
3. Each task builds the suffix order of its mixed windows (prefix doubling on
   the bytes), settles what repeats there, and passes on one entry for each
   distinct window: its 64-bit name under the 64-bit anchor hash.
4. Entries are dealt by anchor hash; in name order LPF finds what repeats
   between tasks. An anchor of very many runs is dealt by anchor and part of
   the name, and a window that very many tasks hold is dealt twice: first to as
   many buckets as the square root of the anchor's runs, each of which settles
   its own and passes on one entry for each distinct window. So no anchor and
   no window is gathered in one task.

Defined cases: null and empty texts lose nothing; an empty table gives an empty
result; texts shorter than ``length`` lose nothing; with ``keep="first"`` rows
of equal id and text are one document (and are treated alike), with
``keep="none"`` they are two; a null doc_id comes first; bytes left over that
are no longer valid UTF-8 become U+FFFD in ``kept_text`` (``kept_bytes`` has
them as they are); other columns are passed on unchanged, but columns named
``spans``, ``kept_bytes`` or ``kept_text`` give way to the results; doc_ids are
whole numbers.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pulsegrid.llm.common import KEY, batch_blocks, bounded, kept, row_key, scratch, split_join, text_column

LENGTH = 400
GRAM = 160
PART = 1 << 20  # bytes or windows of one numpy pass
SPREAD = 2000  # runs of one anchor that go to one task
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8).digest(), "little") for b in range(256)], np.uint64)


def _power_table(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]))


_TABLES: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_TABLES.get("up", ())) <= n:
        _TABLES["up"] = _power_table(_BASE, max(n, PART + 4096))
        _TABLES["down"] = _power_table(pow(_BASE, -1, 1 << 64), max(n, PART + 4096))
    return _TABLES["up"], _TABLES["down"]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _prefix(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of byte values times powers, and the inverse powers."""
    up, down = _powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE[data] * up[:len(data)], out=total[1:])
    return total, down


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i:i+width] for each i (running minima from both block ends)."""
    n = len(x)
    full = -(-n // width) * width
    pad = np.full(full, np.iinfo(x.dtype).max, x.dtype)
    pad[:n] = x
    grid = pad.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def runs(data: np.ndarray, off: np.ndarray, length: int, gram: int):
    """Runs of windows of equal anchor: (text, first window, windows, anchor
    hash, hash of the run). Places are relative to the text."""
    n, n_docs = len(data), len(off) - 1
    size = np.diff(off)
    ok = np.flatnonzero(size >= length)
    if not len(ok):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    with np.errstate(over="ignore"):
        total, down = _prefix(data)
        g = _mix((total[gram:] - total[:-gram]) * down[:n - gram + 1])
        order = (g & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(g), dtype=np.uint64)
        at = (sliding_min(order, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        step = np.zeros(len(at) + 1, np.int8)
        np.add.at(step, off[ok], 1)
        np.add.at(step, off[ok] + size[ok] - length + 1, -1)
        valid = np.cumsum(step[:-1]).astype(bool)
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (at[1:] != at[:-1])
        new[off[ok]] = True
        first = np.flatnonzero(new)
        stop = np.zeros(len(at) + 1, bool)
        stop[first] = True
        stop[:-1] |= ~valid
        stop[-1] = True
        stops = np.flatnonzero(stop)
        last = stops[np.searchsorted(stops, first, side="right")]
        doc = np.searchsorted(off, first, side="right") - 1
        whole = (total[last + length - 1] - total[first]) * down[first]
        whole = _mix(_mix(whole + (at[first] - first).astype(np.uint64)) + (last - first).astype(np.uint64))
    return doc, first - off[doc], last - first, g[at[first]], whole


def _pieces(data: np.ndarray, off: np.ndarray, length: int):
    """A block, or the parts of its one very long text: (data, off, shift).
    Parts overlap by length - 1 bytes, so each window is in one part."""
    if len(off) > 2 or len(data) <= PART + length:
        yield data, off, 0
        return
    for a in range(0, len(data) - length + 1, PART):
        part = data[a:a + PART + length - 1]
        yield part, np.array([0, len(part)], np.int64), a


def _anchor_rows(length: int, gram: int):
    def run(batches):
        for rows, data, off in batch_blocks(batches, "_text", PART):
            for part, bound, shift in _pieces(data, off, length):
                doc, s, n, h, c = runs(part, bound, length, gram)
                at = pa.array(doc, pa.int32())
                yield pa.record_batch({
                    KEY[0]: rows.column(KEY[0]).take(at), KEY[1]: rows.column(KEY[1]).take(at),
                    "_id": rows.column("_id").take(at), "s": pa.array(s + shift, pa.int32()), "n": pa.array(n, pa.int32()),
                    "h": pa.array(h.view(np.int64)), "c": pa.array(c.view(np.int64))})
    return run


# --- suffix order and LPF ------------------------------------------------------

def _dense(x: np.ndarray) -> np.ndarray:
    """Ranks of values, equal for equal values."""
    order = np.argsort(x, kind="stable")
    s = x[order]
    new = np.zeros(len(x), np.int64)
    new[1:] = s[1:] != s[:-1]
    out = np.empty(len(x), np.uint64)
    out[order] = np.cumsum(new).astype(np.uint64)
    return out


def prefix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of each suffix by its first ``length`` bytes (bytes beyond the end
    count as zero): prefix doubling from 8 bytes on."""
    n = len(data)
    if length < 8:
        raise ValueError("length must be 8 or more")
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i:n + i]
    rank, have = _dense(key), 8

    def joined(shift):
        behind = np.zeros(n, np.uint64)
        behind[:max(n - shift, 0)] = rank[shift:] + np.uint64(1)
        return _dense((rank << np.uint64(32)) | behind)

    while have * 2 <= length:
        rank, have = joined(have), have * 2
    return joined(length - have) if have < length else rank


def neighbours(rank: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per entry, whether an earlier and whether a later position shares its
    rank: LPF and its mirror image against the rank's prefix length."""
    order = np.lexsort((position, rank))
    same = rank[order][1:] == rank[order][:-1]
    earlier, later = np.zeros(len(rank), bool), np.zeros(len(rank), bool)
    earlier[order[1:]] = same
    later[order[:-1]] = same
    return earlier, later


def lpf_array(data: np.ndarray) -> np.ndarray:
    """The longest previous factor of each position of one text, from its suffix
    array, LCP values and previous and next smaller positions (small texts)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    raw = data.tobytes()
    sa = sorted(range(n), key=lambda i: raw[i:])

    def lcp(i, j):
        k = 0
        while max(i, j) + k < n and raw[i + k] == raw[j + k]:
            k += 1
        return k

    out = np.zeros(n, np.int64)
    for way in (sa, sa[::-1]):
        stack: list[int] = []
        for i in way:
            while stack and stack[-1] > i:
                stack.pop()
            if stack:  # the nearest entry with a smaller position
                out[i] = max(out[i], lcp(i, stack[-1]))
            stack.append(i)
    return out


ENTRY = pa.schema([(KEY[0], pa.int64()), (KEY[1], pa.int64()), ("_id", pa.int64()), ("s", pa.int32()), ("n", pa.int32()),
                   ("h", pa.int64()), ("salt", pa.int32()), ("bucket", pa.int32()), ("place", pa.binary()), ("name", pa.binary())])
ENTRY_DDL = (f"{KEY[0]} bigint, {KEY[1]} bigint, _id bigint, s int, n int, h bigint, salt int, bucket int, place binary, name binary")


def _spans(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, length) of each run of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flag, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2] - edge[::2]


def _settle(doc, s, n, h, count, data, off, rank_of_doc, length, none):
    """Local step on runs sorted by (doc, s): (marks: doc, s, n) and entries
    (run, salt, place, name), places as offset * 2 + settled."""
    joined = np.zeros(len(s), bool)
    joined[1:] = (doc[1:] == doc[:-1]) & (s[1:] == s[:-1] + n[:-1])
    region = np.cumsum(~joined) - 1
    head = np.flatnonzero(~joined)
    windows = np.add.reduceat(n, head)
    begin = off[doc[head]] + s[head]
    take = windows + length - 1
    end = np.cumsum(take)
    place = np.arange(int(end[-1])) + np.repeat(begin - (end - take), take)
    x = data[place]
    valid = np.arange(len(x)) - np.repeat(end - take, take) < np.repeat(windows, take)
    rank = prefix_ranks(x, length)[valid]
    run = np.repeat(np.arange(len(s)), n)
    offset = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    position = rank_of_doc[doc[run]] * (1 << 40) + s[run] + offset
    earlier, later = neighbours(rank, position)
    repeated = earlier | later if none else earlier
    # marks: runs of repeated windows, cut at region ends
    grown = np.zeros(len(run), np.int64)
    grown[1:] = region[run][1:] != region[run][:-1]
    slot = np.arange(len(run)) + np.cumsum(grown)  # a gap between regions
    wide = np.zeros(int(slot[-1]) + 1, bool)
    wide[slot] = repeated
    a, size = _spans(wide)
    at = np.searchsorted(slot, a)
    marks = doc[run[at]], s[run[at]] + offset[at], size
    # entries: the first of each distinct window
    rep = np.flatnonzero(~earlier)
    total, down = _prefix(x)
    where = np.flatnonzero(valid)[rep]
    with np.errstate(over="ignore"):
        name = _mix((total[where + length] - total[where]) * down[where] + np.uint64(0x51ED27))
    mark = (offset[rep] * 2 + (repeated[rep] if none else 0)).astype(np.int32)
    parts = -(-count[run[rep]] // SPREAD)
    salt = (name % np.maximum(parts, 1).astype(np.uint64)).astype(np.int64)
    key = run[rep] * (1 << 20) + salt
    order = np.argsort(key, kind="stable")
    key, mark, name = key[order], mark[order], name[order]
    cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    stop = np.append(cut[1:], len(key))
    entries = [(int(key[i] >> 20), int(key[i] & 0xFFFFF), mark[i:j].tobytes(), name[i:j].tobytes())
               for i, j in zip(cut.tolist(), stop.tolist(), strict=True)] if len(key) else []
    return marks, entries


def _local(length: int, none: bool):
    """Texts with their mixed runs to marks (name empty) and entries."""
    def run(batches):
        for rows, data, off in batch_blocks(batches, "_text", PART):
            lists = rows.column("_runs").combine_chunks() if isinstance(rows.column("_runs"), pa.ChunkedArray) else rows.column("_runs")
            flat = lists.flatten()
            per = np.asarray(pa.compute.list_value_length(lists)).astype(np.int64)
            doc = np.repeat(np.arange(len(per)), per)
            s, n, h, count = (np.asarray(flat.field(f)).astype(np.int64) for f in ("s", "n", "h", "k"))
            order = np.lexsort((s, doc))
            doc, s, n, h, count = doc[order], s[order], n[order], h[order], count[order]
            ids = [(i is not None, i or 0, a, b) for i, a, b in zip(
                rows.column("_id").to_pylist(), rows.column(KEY[0]).to_pylist(), rows.column(KEY[1]).to_pylist(), strict=True)]
            rank_of_doc = np.empty(len(ids), np.int64)
            rank_of_doc[sorted(range(len(ids)), key=ids.__getitem__)] = np.arange(len(ids))
            part = np.cumsum(n) // PART  # bounded work, also for one long text
            for p in np.unique(part):
                pick = part == p
                marks, entries = _settle(doc[pick], s[pick], n[pick], h[pick], count[pick], data, off, rank_of_doc, length, none)
                d, ms, mn = marks
                runs_ = np.flatnonzero(pick)
                who = runs_[np.array([e[0] for e in entries], np.int64)] if entries else np.zeros(0, np.int64)
                at = pa.array(np.concatenate([d, doc[who]]), pa.int32())
                spread = np.ceil(np.sqrt(count[who])).astype(np.int64)
                bucket = np.where(count[who] > SPREAD, 1 + rows.column(KEY[0]).to_numpy()[doc[who]] % spread, 0)
                yield pa.record_batch([
                    rows.column(KEY[0]).take(at), rows.column(KEY[1]).take(at), rows.column("_id").take(at),
                    pa.array(np.concatenate([ms, s[who]]), pa.int32()), pa.array(np.concatenate([mn, n[who]]), pa.int32()),
                    pa.array(np.concatenate([np.zeros(len(d), np.int64), h[who]])),
                    pa.array([-1] * len(d) + [e[1] for e in entries], pa.int32()),
                    pa.array(np.concatenate([np.zeros(len(d), np.int64), bucket]), pa.int32()),
                    pa.array([None] * len(d) + [e[2] for e in entries], pa.binary()),
                    pa.array([None] * len(d) + [e[3] for e in entries], pa.binary())], schema=ENTRY)
    return run


def _packed_runs(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, stop) of each run of equal numbers."""
    cut = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, np.int64)
    return cut, np.append(cut[1:], len(row)) if len(row) else cut


def _judge(t: pa.Table, none: bool, pass_on: bool) -> pa.RecordBatch:
    """Entries of whole groups: marks (salt -1) of what repeats among them and,
    to ``pass_on``, one entry for each distinct window, its earliest one."""
    t = t.combine_chunks()
    names = np.frombuffer(b"".join(t.column("name").to_pylist()), np.uint64)
    place = np.frombuffer(b"".join(t.column("place").to_pylist()), np.int32)
    size = np.asarray(pa.compute.binary_length(t.column("name"))).astype(np.int64) // 8
    row = np.repeat(np.arange(len(size)), size)
    h, s = t.column("h").to_numpy(), t.column("s").to_numpy().astype(np.int64)
    # both hashes make the rank; places in order of (doc_id, key, offset)
    order = np.lexsort((names, h[row]))
    new = np.zeros(len(order), np.int64)
    new[1:] = (names[order][1:] != names[order][:-1]) | (h[row][order][1:] != h[row][order][:-1])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    id_ = t.column("_id")
    by = np.lexsort((s, t.column(KEY[1]).to_numpy(), t.column(KEY[0]).to_numpy(),
                     id_.fill_null(0).to_numpy(), ~np.asarray(id_.is_null())))
    nth = np.empty(len(by), np.int64)
    nth[by] = np.arange(len(by))
    earlier, later = neighbours(rank, nth[row] * (1 << 32) + (place >> 1))
    repeats = earlier | later if none else earlier
    hit = repeats & (place & 1 == 0)
    marked, at = row[hit], s[row[hit]] + (place[hit] >> 1)
    o = np.lexsort((at, marked))
    marked, at = marked[o], at[o]
    cut = np.flatnonzero(np.concatenate([[True], (marked[1:] != marked[:-1]) | (at[1:] != at[:-1] + 1)])) if len(at) else np.zeros(0, np.int64)
    n = np.diff(np.append(cut, len(at))) if len(at) else cut
    kept_ = np.flatnonzero(~earlier) if pass_on else np.zeros(0, np.int64)  # in row order
    first, stop = _packed_runs(row[kept_])
    settled = (place[kept_] | repeats[kept_] if none else place[kept_]).astype(np.int32)
    whose = row[kept_][first]
    pick = pa.array(np.concatenate([marked[cut], whose]))
    zero = np.zeros(len(cut), np.int64)
    own = t.take(pick).combine_chunks()
    column = lambda name: own.column(name).combine_chunks() if len(pick) else pa.array([], own.column(name).type)
    pairs = list(zip(first.tolist(), stop.tolist(), strict=True))
    return pa.record_batch([
        column(KEY[0]), column(KEY[1]), column("_id"), pa.array(np.concatenate([at[cut], s[whose]]), pa.int32()),
        pa.array(np.concatenate([n, t.column("n").to_numpy()[whose]]), pa.int32()),
        pa.array(np.concatenate([zero, h[whose]])),
        pa.array(np.concatenate([zero - 1, t.column("salt").to_numpy()[whose]]), pa.int32()), pa.array(np.zeros(len(pick), np.int64), pa.int32()),
        pa.array([None] * len(cut) + [settled[i:j].tobytes() for i, j in pairs], pa.binary()),
        pa.array([None] * len(cut) + [names[kept_[i:j]].tobytes() for i, j in pairs], pa.binary())], schema=ENTRY)


def _between_tasks(none: bool, group: tuple[str, ...], pass_on: bool):
    """Entries sorted by ``group``: windows that repeat between tasks."""
    def run(batches):
        held, weight = [], 0
        for b in batches:
            held.append(b)
            weight += b.nbytes
            if weight < 8 * PART:
                continue
            t = pa.Table.from_batches(held)
            new = np.zeros(len(t) - 1, bool)
            for c in group:
                x = t.column(c).to_numpy()
                new |= x[1:] != x[:-1]
            new = np.flatnonzero(new)
            if not len(new):
                continue
            cut = int(new[-1]) + 1
            yield _judge(t.slice(0, cut), none, pass_on)
            held = t.slice(cut).combine_chunks().to_batches()
            weight = sum(x.nbytes for x in held)
        if held and sum(map(len, held)):
            yield _judge(pa.Table.from_batches(held), none, pass_on)
    return run


def repeated_windows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH,
                     gram: int = GRAM, keep: str = "first") -> DataFrame:
    """(row key, list of (s, n)): the windows to remove start at s .. s+n-1."""
    if keep not in ("first", "none"):
        raise ValueError("keep is 'first' or 'none'")
    if not 8 <= gram <= length:
        raise ValueError("gram must be 8 to length bytes")
    none = keep == "none"
    base = docs.select(*row_key(doc_id, text), F.col(doc_id).cast("bigint").alias("_id"), text_column(text).alias("_text"))
    if not none:
        base = base.dropDuplicates([*KEY])
    with scratch(bounded(docs).sparkSession, "lpf") as tmp:
        found = tmp.save(base.mapInArrow(
            _anchor_rows(length, gram), f"{KEY[0]} bigint, {KEY[1]} bigint, _id bigint, s int, n int, h bigint, c bigint"))
        place = F.struct("_id", *KEY, "s")
        stats = [F.count("*").alias("_k"), F.min("c").alias("_c1"), F.max("c").alias("_c2")]
        if not none:
            stats.append(F.min(place).alias("_first"))
        many = (found.groupBy("h").agg(*stats).where("_k > 1").withColumn("_mixed", F.col("_c1") != F.col("_c2"))
                .withColumnRenamed("h", "_h").drop("_c1", "_c2"))
        rows = split_join(found, many, "h", "_h")
        if not none:
            rows = rows.where(F.col("_mixed") | ~place.eqNullSafe(F.col("_first")))
        rows = tmp.save(rows.select(*KEY, "s", "n", "h", F.col("_k").alias("k"), F.col("_mixed").alias("mixed")))
        mixed = (rows.where("mixed").groupBy(*[F.col(k).alias("_m" + k) for k in KEY])
                 .agg(F.collect_set(F.struct("s", "n", "h", "k")).alias("_runs")))
        local = tmp.save(base.join(mixed, (F.col(KEY[0]) == F.col("_m" + KEY[0])) & (F.col(KEY[1]) == F.col("_m" + KEY[1])))
                         .select(*KEY, "_id", "_text", "_runs").mapInArrow(_local(length, none), ENTRY_DDL))
        entries = local.where("salt >= 0")
        hot = ("h", "salt", "bucket")
        first = tmp.save(entries.where("bucket > 0").repartition(*hot).sortWithinPartitions(*hot)
                         .mapInArrow(_between_tasks(none, hot, True), ENTRY_DDL))
        entries = entries.where("bucket = 0").unionAll(first.where("salt >= 0"))
        last = (entries.repartition("h", "salt").sortWithinPartitions("h", "salt")
                .mapInArrow(_between_tasks(none, ("h", "salt"), False), ENTRY_DDL))
        marks = rows.where("not mixed").select(*KEY, "s", "n")
        for part in (local.where("salt < 0"), first.where("salt < 0"), last):
            marks = marks.unionAll(part.select(*KEY, "s", "n"))
        return kept(marks.groupBy(*KEY).agg(F.collect_set(F.struct("s", "n")).alias("marks")))


def removed_spans(marks: list | None, size: int, length: int) -> list[tuple[int, int]]:
    """Maximal byte spans that the marked windows cover."""
    out: list[list[int]] = []
    for s, n in sorted((m["s"], m["n"]) for m in marks or ()):
        e = min(s + n - 1 + length, size)
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(a, b) for a, b in out]


def _cut(length: int):
    def run(batches):
        for b in batches:
            for rows, data, off in batch_blocks([b], "_text"):
                texts, spans = [], []
                for i, m in enumerate(rows.column("_marks").to_pylist()):
                    t = data[off[i]:off[i + 1]].tobytes()
                    sp = removed_spans(m, len(t), length)
                    at, parts = 0, []
                    for a, e in sp:
                        parts.append(t[at:a])
                        at = e
                    texts.append(b"".join([*parts, t[at:]]))
                    spans.append([{"start": a, "end": e} for a, e in sp])
                yield pa.record_batch([rows.column("_row"), pa.array(texts, pa.binary()),
                                       pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                                      names=["_row", "_kept", "_spans"])
    return run


def dedup_substrings(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH,
                     gram: int = GRAM, keep: str = "first") -> DataFrame:
    """The input's rows and columns plus ``spans`` (removed bytes, as offsets in
    the original), ``kept_bytes`` and ``kept_text`` (null text: empty)."""
    from pyspark.sql import types as T
    marks = repeated_windows(docs, text, doc_id, length, gram, keep).select(
        *[F.col(k).alias("_m" + k) for k in KEY], F.col("marks").alias("_marks"))
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row")
    joined = docs.select(row, text_column(text).alias("_text"), *row_key(doc_id, text)).join(
        marks, (F.col(KEY[0]) == F.col("_m" + KEY[0])) & (F.col(KEY[1]) == F.col("_m" + KEY[1])), "left")
    cols = joined.select("_row", "_text", "_marks")
    schema = T.StructType([cols.schema["_row"], T.StructField("_kept", T.BinaryType()), T.StructField(
        "_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])
    out = cols.mapInArrow(_cut(length), schema)
    new = ("spans", "kept_bytes", "kept_text")
    return out.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns if c not in new],
                      F.col("_spans").alias("spans"), F.col("_kept").alias("kept_bytes"),
                      F.expr("decode(_kept, 'UTF-8')").alias("kept_text"))
