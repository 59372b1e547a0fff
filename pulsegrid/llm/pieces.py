"""Encoding and decoding with a SentencePiece vocabulary by batched Viterbi.

The best segmentation of a text is the one whose pieces' scores have the
largest sum; a character without a piece of its own falls back to its UTF-8
bytes, at the lowest piece score less 10. Among equal sums the longest last
piece wins. No piece crosses from a letter to a space, so a text is cut into
words (spaces, then the rest) that are solved one by one; each distinct word of
a block is solved once.

Words of equal length advance together: substring hashes, taken from prefix
hashes, probe the sorted keys of the pieces of each length, and maxima over the
candidates store backpointers. Words of over ``PAD_FROM`` bytes share a padded
matrix, those of over ``LONG`` bytes are solved alone. Every block is decoded
and compared with its input; a word that hash collisions spoilt is solved again
from its bytes.

The vocabulary file is never copied: its path is a parameter, read on the
driver, and its pieces (bounded by the vocabulary) are broadcast.

Defined cases: null and empty texts have no tokens and decode to the empty
text; a literal U+2581 is encoded by bytes, so that it survives the round trip;
ids outside the vocabulary and control ids decode to nothing; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from pulsegrid.llm.common import batch_blocks, bounded, int_lists, text_column

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CELLS = 1 << 20  # bytes of words that one matrix holds
PAD_FROM = 40
LONG = 1024
_BASE = np.uint64(0x100000001B3)


class Pieces:
    """Pieces of a vocabulary, with a space in place of the model's mark."""

    def __init__(self, pieces: list[tuple[int, bytes, float]], byte_ids: list[int], size: int):
        if any(b" " in p.lstrip(b" ") for _, p, _ in pieces):
            raise ValueError("a piece holds a space after a letter: texts cannot be cut into words")
        self.score = {}
        self.surface = [b""] * size
        for i, p, s in pieces:
            self.surface[i] = p
            if p not in self.score:
                self.score[p] = (s, i)
        for b, i in enumerate(byte_ids):
            self.surface[i] = bytes([b])
        self.byte_ids = np.array(byte_ids, np.int32)
        self.unknown = min(s for _, _, s in pieces) - 10.0
        self.tables = []
        for n in sorted({len(p) for p in self.score}, reverse=True):
            own = [(p, s, i) for p, (s, i) in self.score.items() if len(p) == n]
            x = np.frombuffer(b"".join(p for p, _, _ in own), np.uint8).reshape(-1, n)
            key = _prefix_hashes(x)[:, -1]
            order = np.argsort(key)
            self.tables.append((n, key[order], np.array([s for _, s, _ in own])[order],
                                np.array([i for _, _, i in own], np.int32)[order]))
        self.sizes = [t[0] for t in self.tables]
        self.length = np.array([len(s) for s in self.surface], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self.bytes = np.frombuffer(b"".join(self.surface), np.uint8)

    # --- encoding -----------------------------------------------------------

    def _solve_alone(self, word: bytes) -> list[int]:
        """One word from its bytes, without hashes."""
        n = len(word)
        best, back = [0.0] + [-np.inf] * n, [(1, 0)] * (n + 1)
        for e in range(1, n + 1):
            first = e - 1
            while first > 0 and word[first] & 0xC0 == 0x80 and e - first < 4:
                first -= 1
            boundary = e == n or word[e] & 0xC0 != 0x80
            known = False
            for size in self.sizes:
                s = e - size
                if s < 0 or best[s] == -np.inf:
                    continue
                hit = self.score.get(word[s:e])
                if hit is not None:
                    known |= s == first
                    if best[s] + hit[0] > best[e]:
                        best[e], back[e] = best[s] + hit[0], (size, hit[1])
            if boundary and not known and best[first] + self.unknown > best[e]:
                best[e], back[e] = best[first] + self.unknown, (e - first, -1)
        out, e = [], n
        while e > 0:
            size, i = back[e]
            if i < 0 or best[e] == -np.inf:
                size = size if i < 0 else 1
                out.extend(int(self.byte_ids[b]) for b in reversed(word[e - size:e]))
            else:
                out.append(i)
            e -= size
        return out[::-1]

    def _solve_batch(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ids per word); words are padded to the longest."""
        n, size = len(words), max(map(len, words))
        own = np.array([len(w) for w in words])
        x = np.frombuffer(b"".join(w.ljust(size, b"\0") for w in words), np.uint8).reshape(n, size)
        h = _prefix_hashes(x)
        cont = np.zeros((n, size + 1), bool)
        cont[:, :size] = (x & 0xC0) == 0x80
        best = np.full((size + 1, n), -np.inf)
        best[0] = 0.0
        step = np.ones((size + 1, n), np.uint8)
        ids = np.zeros((size + 1, n), np.int32)
        ids[1:] = self.byte_ids[x.T]
        for e in range(1, size + 1):
            top, step_e, id_e = best[e], step[e], ids[e]
            for k, key, score, piece in self.tables:
                s = e - k
                if s < 0:
                    continue
                live = np.flatnonzero(best[s] > -np.inf)
                if not len(live):
                    continue
                with np.errstate(over="ignore"):
                    probe = h[live, e] - h[live, s] * _power(k)
                at = np.minimum(np.searchsorted(key, probe), len(key) - 1)
                hit = key[at] == probe
                if k <= 4:  # a character of its own without a piece
                    lone = ~hit & ~cont[live, e] & ~cont[live, s]
                    for m in range(1, k):
                        lone &= cont[live, s + m]
                    w = live[lone]
                    better = best[s, w] + self.unknown > top[w]
                    w = w[better]
                    top[w], step_e[w], id_e[w] = best[s, w] + self.unknown, 1, self.byte_ids[x[w, e - 1]]
                w, at = live[hit], at[hit]
                total = best[s, w] + score[at]
                better = total > top[w]
                w, at = w[better], at[better]
                top[w], step_e[w], id_e[w] = total[better], k, piece[at]
        out = np.empty((n, size), np.int32)
        count = np.zeros(n, np.int64)
        row, pos = np.arange(n), own.copy()
        while len(row):
            count[row] += 1
            out[row, -count[row]] = ids[pos, row]
            pos = pos - step[pos, row]
            row, pos = row[pos > 0], pos[pos > 0]
        return out[np.arange(size)[None, :] >= size - count[:, None]], count

    def solve(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat ids, first, count) of each of the distinct words."""
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        flat, first, count = [], np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        total, i = 0, 0
        while i < len(order):
            size = len(words[order[i]])
            if size > LONG:
                got = np.array(self._solve_alone(words[order[i]]), np.int32)
                counts, j = np.array([len(got)]), i + 1
            else:
                top = size if size <= PAD_FROM else min(LONG, size + size // 4)
                j = i + 1
                while j < len(order) and len(words[order[j]]) <= top and (j - i) * top < CELLS:
                    j += 1
                got, counts = self._solve_batch([words[w] for w in order[i:j]])
            at = np.array(order[i:j])
            count[at] = counts
            first[at] = total + np.cumsum(counts) - counts
            flat.append(got)
            total += len(got)
            i = j
        return np.concatenate(flat) if flat else np.zeros(0, np.int32), first, count

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ids of each text) of a block of texts."""
        n = len(off) - 1
        full = np.flatnonzero(np.diff(off))
        spaced = np.insert(data, off[full], 32)  # the space before each text
        begin = off[full] + np.arange(len(full))
        space = spaced == 32
        head = space.copy()
        head[1:] &= ~space[:-1]
        head[begin] = True
        start = np.flatnonzero(head)
        doc = full[np.searchsorted(begin, start, side="right") - 1] if len(full) else np.zeros(0, np.int64)
        raw, bound = spaced.tobytes(), [*start.tolist(), len(spaced)]
        seen: dict[bytes, int] = {}
        word = np.fromiter((seen.setdefault(raw[a:b], len(seen)) for a, b in zip(bound, bound[1:], strict=False)),
                           np.int64, len(start))
        words = list(seen)
        flat, first, count = self.solve(words)
        ids, _ = _gather(flat, first[word], count[word])
        if not np.array_equal(_gather(self.bytes, self.start[ids], self.length[ids])[0], spaced):
            for i, w in enumerate(words):
                if b"".join(self.surface[t] for t in flat[first[i]:first[i] + count[i]]) != w:
                    again = np.array(self._solve_alone(w), np.int32)
                    first[i], count[i] = len(flat), len(again)
                    flat = np.concatenate([flat, again])
            ids, _ = _gather(flat, first[word], count[word])
        return ids, np.bincount(doc, weights=count[word], minlength=n).astype(np.int64)

    def decode(self, ids) -> bytes:
        """The text of a list of ids, without the space put before it."""
        size = len(self.surface)
        return b"".join(self.surface[i] for i in ids if i is not None and 0 <= i < size)[1:]


def _gather(values: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """values[first:first+count] of each span, one after the other."""
    end = np.cumsum(count)
    place = np.arange(int(end[-1]) if len(end) else 0) + np.repeat(first - (end - count), count)
    return values[place], end


_POWERS = [np.uint64(1)]


def _power(k: int) -> np.uint64:
    with np.errstate(over="ignore"):
        while len(_POWERS) <= k:
            _POWERS.append(_POWERS[-1] * _BASE)
    return _POWERS[k]


def _prefix_hashes(x: np.ndarray) -> np.ndarray:
    """Hash of each prefix of each row of bytes."""
    h = np.zeros((x.shape[0], x.shape[1] + 1), np.uint64)
    with np.errstate(over="ignore"):
        mixed = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        for i in range(x.shape[1]):
            h[:, i + 1] = h[:, i] * _BASE + mixed[:, i]
    return h


def read_model(path: str = MODEL) -> tuple[list, list, int]:
    """(pieces with id and score, byte ids, vocabulary size) of a model file."""
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids, size = [], [0] * 256, m.get_piece_size()
    for i in range(size):
        if m.is_byte(i):
            byte_ids[int(m.id_to_piece(i)[3:5], 16)] = i
        elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
            pieces.append((i, m.id_to_piece(i).replace("▁", " ").encode(), float(m.get_score(i))))
    return pieces, byte_ids, size


def _encode_rows(model):
    def run(batches):
        p = Pieces(*model.value)
        for rows, data, off in batch_blocks(batches, "_text"):
            ids, count = p.encode(data, off)
            texts, at = [], np.concatenate([[0], np.cumsum(count)])
            whole = _gather(p.bytes, p.start[ids], p.length[ids])[0]
            full = np.flatnonzero(np.diff(off))
            if np.array_equal(np.delete(whole, off[full] + np.arange(len(full))), data):
                same = np.ones(len(count), bool)
            else:
                texts = [data[off[i]:off[i + 1]].tobytes() for i in range(len(count))]
                same = np.array([p.decode(ids[at[i]:at[i + 1]].tolist()) == t for i, t in enumerate(texts)], bool)
            yield pa.record_batch({"doc_id": rows.column("doc_id"), "n_tokens": pa.array(count),
                                   "ids": int_lists(ids, count), "round_trip": pa.array(same)})
    return run


def encode(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", model: str = MODEL) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids, round_trip (whether the ids
    decode to the text)."""
    sent = bounded(docs).sparkSession.sparkContext.broadcast(read_model(model))
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_column(text).alias("_text")).mapInArrow(
        _encode_rows(sent), "doc_id bigint, n_tokens bigint, ids array<int>, round_trip boolean")


def _decode_rows(model):
    def run(batches):
        p = Pieces(*model.value)
        for b in batches:
            t = [p.decode(ids or []).decode("utf-8", "replace") for ids in b.column("ids").to_pylist()]
            yield pa.record_batch({"doc_id": b.column("doc_id"), "text": pa.array(t, pa.string())})
    return run


def decode(encoded: DataFrame, ids: str = "ids", doc_id: str = "doc_id", model: str = MODEL) -> DataFrame:
    """One row per input row: doc_id and the text of the ids (null: empty)."""
    sent = encoded.sparkSession.sparkContext.broadcast(read_model(model))
    return encoded.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(ids).cast("array<int>").alias("ids")).mapInArrow(
        _decode_rows(sent), "doc_id bigint, text string")
