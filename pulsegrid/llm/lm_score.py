"""Log-bilinear language model, trained by noise-contrastive estimation.

Tokens are white-space separated words (A-Z lower-cased) and one end for each
text. The model predicts symbols: the ``shortlist`` (the end, however rare, and
the most frequent training tokens), and classes (by last byte, and whether there
are other than ASCII bytes) that hold all other tokens. The two symbols before a token give the
prediction r1 C1 + r2 C2, whose product with a symbol's target vector plus its
bias is the symbol's score. Training samples noise from the symbols' training
frequencies. Scores split into one term for each context symbol, so the
normalisers of all pairs of context symbols are one matrix product of
exponentials: probabilities are normalised exactly, without a softmax a token.

Inside a class a token has its discounted training frequency; what the discount
frees is the probability of meeting a token not seen in training.

Counts (all training tokens) are one distributed group-by. One pass then encodes
all texts in blocks: symbol numbers, two bytes each, and the rare tokens of the
block. Training passes over the symbols of all training texts: each task runs
its part from the last parameters and the results are averaged by weight, a few
tasks at a time (the parameters are bounded by the shortlist). Scoring reads the
same symbols; the rare tokens of a block meet their counts in a join on the
token and come back by block, so no vocabulary is broadcast.

Defined cases: null and empty texts are one end; without training texts every
base probability is 1 and symbols are equally likely; a null doc_id counts as
the empty id for the split; repeated rows count and score each; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from itertools import count as numbers

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pulsegrid.llm.common import batch_blocks, blocks, bounded, crc_mod, kept, scratch, text_column, utf8

SHORTLIST = 2048
CLASSES = 64
DIM = 16
NOISE = 64
BATCH = 1024
RATE = 0.15
ROUNDS = (0, 1)  # the first of 16 parts of the training texts, then the other 15
FLUSH = 400_000  # distinct tokens that a task counts before it passes them on
BLOCK = 16 << 20  # a block is a whole Arrow batch
TOKENS = 1 << 20  # places that training and scoring take at once
FAN_IN = 8
END = b""


def class_of(token: bytes) -> int:
    """Class (0 to 63) of a token outside the shortlist."""
    last = token[-1]
    k = last - 96 if 97 <= last <= 122 else 27 if 48 <= last <= 57 else 28 if last > 127 else 29 if last in b".," else 30
    return k + (0 if token.isascii() else 32)


# --- counts ------------------------------------------------------------------

def _count_tokens(batches):
    seen: Counter[bytes] = Counter()

    def rows():
        keys = list(seen)
        return pa.record_batch({"token": pa.array(keys, pa.binary()),
                                "class": pa.array([class_of(t) if t else -1 for t in keys], pa.int32()),
                                "c": pa.array(list(seen.values()), pa.int64())})
    for _, data, off in batch_blocks(batches, "_text"):
        n = len(off) - 1
        bound, raw = off.tolist(), data.tobytes().lower()
        for i in range(n):
            seen.update(raw[bound[i]:bound[i + 1]].split())
        seen[END] += n
        if len(seen) >= FLUSH:
            yield rows()
            seen.clear()
    if seen:
        yield rows()


# --- the model ---------------------------------------------------------------

class LogBilinear:
    """Parameters over ``size`` symbols; symbol ``end`` opens every context."""

    def __init__(self, size: int, dim: int, unigram: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.context = (rng.standard_normal((size, dim)) * 0.1).astype(np.float32)
        self.target = (rng.standard_normal((size, dim)) * 0.1).astype(np.float32)
        self.near = np.eye(dim, dtype=np.float32) * 0.7
        self.far = np.eye(dim, dtype=np.float32) * 0.5
        self.bias = np.log(unigram).astype(np.float32)
        self.log_noise = np.log(unigram).astype(np.float32)
        self.unigram = unigram

    PARTS = ("context", "target", "near", "far", "bias")

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, p).ravel() for p in self.PARTS])

    def load(self, flat: np.ndarray) -> LogBilinear:
        at = 0
        for p in self.PARTS:
            old = getattr(self, p)
            setattr(self, p, flat[at:at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return self

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(near, far, normaliser): a symbol w after u after v has the log
        probability near[u, w] + far[v, w] - normaliser[u, v]."""
        a = (self.context @ self.near) @ self.target.T + self.bias
        b = (self.context @ self.far) @ self.target.T
        ma, mb = a.max(axis=1), b.max(axis=1)
        z = np.exp(a - ma[:, None]) @ np.exp(b - mb[:, None]).T
        return a, b, np.log(np.maximum(z, 1e-30)) + ma[:, None] + mb[None, :]


def _scatter(ids: np.ndarray, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids and the sums of their rows."""
    order = np.argsort(ids, kind="stable")
    s = ids[order]
    cut = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    return s[cut], np.add.reduceat(grad[order], cut, axis=0)


def _logistic(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)), in place."""
    np.clip(x, -30, 30, out=x)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Trainer:
    """Stochastic NCE with AdaGrad steps on batches of (far, near, token)."""

    def __init__(self, model: LogBilinear, seed: int):
        self.m, self.rng = model, np.random.default_rng(seed)
        # target vectors and biases side by side; the model's own are views of them
        self.out = np.concatenate([model.target, model.bias[:, None]], axis=1)
        model.target, model.bias = self.out[:, :-1], self.out[:, -1]
        self.shift = model.log_noise + np.float32(np.log(NOISE))
        self.past = [np.full(x.shape, 0.1, np.float32) for x in (model.context, self.out, model.near, model.far)]
        self.cdf = np.cumsum(model.unigram)
        self.cdf /= self.cdf[-1]

    @staticmethod
    def _move(value: np.ndarray, past: np.ndarray, ids, grad: np.ndarray) -> None:
        total = past[ids] + grad * grad
        past[ids] = total
        value[ids] += RATE * grad / np.sqrt(total)

    def step(self, far: np.ndarray, near: np.ndarray, word: np.ndarray) -> None:
        m, n, dim = self.m, len(word), self.m.near.shape[0]
        context_past, out_past, near_past, far_past = self.past
        noise = np.minimum(np.searchsorted(self.cdf, self.rng.random(NOISE)), len(self.cdf) - 1)
        both = np.stack([near, far], axis=1).ravel()  # a place's near and far context side by side
        mix = np.concatenate([m.near, m.far])
        r = m.context[both].reshape(-1, 2 * dim)
        q = np.ones((n, dim + 1), np.float32)  # the last column meets the bias
        np.matmul(r, mix, out=q[:, :-1])
        tw, tn = self.out[word], self.out[noise]
        gu = _logistic(self.shift[word] - np.einsum("ij,ij->i", q, tw))
        tn[:, -1] -= self.shift[noise]
        gd = _logistic(q @ tn.T)
        scale = np.float32(1.0 / np.sqrt(n))
        gu *= scale
        gd *= -scale
        dq = gd @ tn[:, :-1]
        dq += gu[:, None] * tw[:, :-1]
        self._move(self.out, out_past, *_scatter(word, gu[:, None] * q))
        self._move(self.out, out_past, *_scatter(noise, gd.T @ q))
        turn = r.T @ dq
        ids, g = _scatter(both, (dq @ mix.T).reshape(-1, dim))
        self._move(m.near, near_past, ..., turn[:dim])
        self._move(m.far, far_past, ..., turn[dim:])
        self._move(m.context, context_past, ids, g)


class Symbols:
    """Symbol numbers: shortlist tokens (END is one of them), then classes."""

    def __init__(self, shortlist: list[bytes]):
        self.short = {t: i for i, t in enumerate(shortlist)}
        self.size = len(shortlist) + CLASSES
        self.end = self.short[END]

    def of(self, token: bytes) -> int:
        s = self.short.get(token)
        return s if s is not None else len(self.short) + class_of(token)

    def encode(self, data: np.ndarray, off: np.ndarray):
        """(distinct tokens, token number of each place, tokens of each text) of
        a block; every text ends with END (number 0)."""
        seen: dict[bytes, int] = defaultdict(numbers().__next__)
        flat, count, end = [], [], seen[END]
        raw, bound, number = data.tobytes().lower(), off.tolist(), seen.__getitem__
        for i in range(len(bound) - 1):
            w = raw[bound[i]:bound[i + 1]].split()
            flat.extend(map(number, w))
            flat.append(end)
            count.append(len(w) + 1)
        return list(seen), np.array(flat, np.int64), np.array(count, np.int64)


def contexts(symbol: np.ndarray, count: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(far, near) symbols before each place; texts start after ends."""
    near = np.empty_like(symbol)
    near[1:] = symbol[:-1]
    far = np.empty_like(symbol)
    far[2:] = symbol[:-2]
    first = np.cumsum(count) - count
    near[first] = end
    far[first] = end
    second = first[count > 1] + 1
    far[second] = end
    return far, near


def width(size: int) -> type:
    """Number type that holds the symbols."""
    return np.uint16 if size <= 1 << 16 else np.uint32


def symbol_blocks(batches, kind: type):
    """(rows, symbols, symbols of each text) of encoded texts, about TOKENS at a
    time (a longer text is taken whole)."""
    for b in batches:
        data, off = utf8(b.column(b.schema.get_field_index("symbols")))
        size = np.dtype(kind).itemsize
        for i, j in blocks(off, TOKENS * size):
            yield b.slice(i, j - i), np.frombuffer(data[off[i]:off[j]].tobytes(), kind).astype(np.int64), np.diff(off[i:j + 1]) // size


def _train(end: int, unigram: np.ndarray, start: np.ndarray | None, seed: int):
    """Run NCE over the task's texts; one row: parameters times tokens seen."""
    def run(batches):
        model = LogBilinear(len(unigram), DIM, unigram)
        if start is not None:
            model.load(start)
        trainer, seen = Trainer(model, seed), 0
        for _, symbol, count in symbol_blocks(batches, width(len(unigram))):
            far, near = contexts(symbol, count, end)
            order, kind = trainer.rng.permutation(len(symbol)), width(len(unigram))  # 16-bit numbers sort by radix
            far, near, symbol = (x.astype(kind)[order] for x in (far, near, symbol))
            for i in range(0, len(symbol), BATCH):
                trainer.step(far[i:i + BATCH], near[i:i + BATCH], symbol[i:i + BATCH])
            seen += len(symbol)
        if seen:
            yield _weighted(model.flat().astype(np.float64) * seen, seen)
    return run


def _weighted(flat: np.ndarray, weight: int) -> pa.RecordBatch:
    return pa.record_batch({"flat": pa.array([flat.tobytes()], pa.binary()), "weight": pa.array([weight], pa.int64())})


def _add_up(batches):
    total, weight = None, 0
    for b in batches:
        for flat, w in zip(b.column("flat").to_pylist(), b.column("weight").to_pylist(), strict=True):
            x = np.frombuffer(flat, np.float64)
            total = x.copy() if total is None else total + x
            weight += w
    if total is not None:
        yield _weighted(total, weight)


def train(texts: DataFrame, tmp, shortlist: list[bytes], unigram: np.ndarray) -> np.ndarray | None:
    """Averaged parameters after all rounds; ``texts`` has symbols and part (0-15)."""
    flat, ddl, end = None, "flat binary, weight bigint", shortlist.index(END)
    for r in ROUNDS:
        part = texts.where("part = 0" if r == 0 else "part > 0").select("symbols")
        done = tmp.save(part.mapInArrow(_train(end, unigram, flat, 11 + r), ddl))
        n = done.count()
        while n > FAN_IN:  # a tree of sums: the driver gets at most FAN_IN rows
            n = -(-n // FAN_IN)
            done = tmp.save(done.repartition(n).mapInArrow(_add_up, ddl))
        rows = done.collect()
        weight = sum(x["weight"] for x in rows)
        if weight:
            flat = sum(np.frombuffer(x["flat"], np.float64) for x in rows) / weight
    return flat


# --- scoring -----------------------------------------------------------------

ENCODED = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("part", pa.int32()), ("n_tokens", pa.int64()),
                     ("known", pa.int64()), ("base", pa.float64()), ("rare", pa.binary()), ("symbols", pa.binary()),
                     ("token", pa.binary()), ("class", pa.int32()), ("local", pa.int32())])
ENCODED_DDL = ("block bigint, doc_id bigint, held_out boolean, part int, n_tokens bigint, known bigint, base double, "
               "rare binary, symbols binary, token binary, class int, local int")


def _encode(sent):
    """Blocks of texts: a row per text with its symbols, what the shortlist
    gives the base and its rare tokens by number, and a row per distinct rare
    token of the block."""
    def run(batches):
        shortlist, counts = sent.value
        sym = Symbols(shortlist)
        kind = width(sym.size)
        log_count = np.concatenate([np.log10(counts + 1.0), np.zeros(CLASSES)])
        done = 0
        for rows, data, off in batch_blocks(batches, "_text", BLOCK):
            tokens, number, count = sym.encode(data, off)
            of = np.array([sym.of(t) for t in tokens], np.int64)
            symbol = of[number]
            first = np.cumsum(count) - count
            is_rare = of >= len(shortlist)
            local = np.cumsum(is_rare) - 1
            rare = is_rare[number]
            n_rare = np.add.reduceat(rare.astype(np.int64), first)
            flat_rare, packed = local[number][rare].astype(np.int32), symbol.astype(kind)
            end, last = np.cumsum(n_rare).tolist(), np.cumsum(count).tolist()
            n, words = rows.num_rows, np.flatnonzero(is_rare).tolist()
            block = (rows.column("_task")[0].as_py() << 24) + done
            done += 1
            none = pa.nulls
            yield pa.record_batch([
                pa.array(np.full(n, block)), rows.column("doc_id"), rows.column("held_out"), rows.column("_part"), pa.array(count),
                pa.array(count - n_rare), pa.array(np.add.reduceat(log_count[symbol], first)),
                pa.array([flat_rare[b - k:b].tobytes() for b, k in zip(end, n_rare.tolist(), strict=True)], pa.binary()),
                pa.array([packed[b - k:b].tobytes() for b, k in zip(last, count.tolist(), strict=True)], pa.binary()),
                none(n, pa.binary()), none(n, pa.int32()), none(n, pa.int32())], schema=ENCODED)
            k = len(words)
            yield pa.record_batch([
                pa.array(np.full(k, block)), none(k, pa.int64()), none(k, pa.bool_()), none(k, pa.int32()), none(k, pa.int64()),
                none(k, pa.int64()), none(k, pa.float64()), none(k, pa.binary()), none(k, pa.binary()),
                pa.array([tokens[i] for i in words], pa.binary()),
                pa.array([of[i] - len(shortlist) for i in words], pa.int32()),
                pa.array(local[words], pa.int32())], schema=ENCODED)
    return run


TEXTS = ("block", "doc_id", "held_out", "n_tokens", "known", "base", "rare")


def _neural(sent):
    """Encoded texts: the model's log10 probability of their symbols."""
    def run(batches):
        end, unigram, flat = sent.value
        model = LogBilinear(len(unigram), DIM, unigram)
        near_t, far_t, norm = (model.load(flat) if flat is not None else model).tables()
        for rows, symbol, count in symbol_blocks(batches, width(len(unigram))):
            far, near = contexts(symbol, count, end)
            logp = (near_t[near, symbol] + far_t[far, symbol] - norm[near, far]).astype(np.float64) / np.log(10.0)
            yield pa.RecordBatch.from_arrays([*[rows.column(rows.schema.get_field_index(c)) for c in TEXTS],
                                              pa.array(np.add.reduceat(logp, np.cumsum(count) - count))], names=[*TEXTS, "neural"])
    return run


SCORED_DDL = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
              "base_score double, score double")


def _finish(stats: dict):
    """A block's texts and the counts of its rare tokens to scores."""
    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        c = np.zeros(words.num_rows, np.float64)
        kind = np.zeros(words.num_rows, np.int64)
        packed = words.column("local_class").to_numpy()
        c[packed >> 8] = words.column("c").to_numpy()
        kind[packed >> 8] = (packed & 0xFF) - 1
        mass, distinct, off = stats["mass"][kind], stats["distinct"][kind], stats["discount"]
        seen = c > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            p = np.where(seen, (c - off) / mass, np.where(mass > 0, off * distinct / mass, 1.0))
        logp = np.log10(np.maximum(p, 1e-300))
        log_count = np.log10(c + 1.0)
        known, base, score = [], [], []
        for blob, k, b, s in zip(*(texts.column(x).to_pylist() for x in ("rare", "known", "base", "neural")), strict=True):
            ids = np.frombuffer(blob, np.int32)
            known.append(k + int(seen[ids].sum()) if stats["tokens"] else 0)
            base.append(b + float(log_count[ids].sum()))
            score.append(s + float(logp[ids].sum()))
        n = texts.column("n_tokens").to_numpy()
        return pa.table({
            "doc_id": texts.column("doc_id"), "held_out": texts.column("held_out"), "n_tokens": texts.column("n_tokens"),
            "n_known": pa.array(known, pa.int64()), "train_tokens": pa.array(np.full(len(n), stats["tokens"])),
            "base_score": pa.array(np.array(base) - n * np.log10(stats["tokens"] + stats["types"] + 1.0)),
            "score": pa.array(score, pa.float64())})
    return run


def score(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", held_out_mod: tuple[int, int] = (7, 2),
          shortlist_size: int = SHORTLIST) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score (add-one unigram) and score (the model), both log10. Rows whose
    crc32 of the id is held_out_mod[1] modulo held_out_mod[0] are not learnt."""
    spark = bounded(docs).sparkSession
    m, r = held_out_mod
    base = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), (crc_mod(doc_id, m) == r).alias("held_out"),
                       F.floor(crc_mod(doc_id, 16 * m) / m).cast("int").alias("_part"), text_column(text).alias("_text"))
    learn = base.where("not held_out")
    with scratch(spark, "lm") as tmp:
        counts = tmp.save(learn.select("_text").mapInArrow(_count_tokens, "token binary, class int, c bigint")
                          .groupBy("token").agg(F.first("class").alias("class"), F.sum("c").alias("c")))
        word = F.col("token") != F.lit(END)
        top = [(x["c"], bytes(x["token"])) for x in
               counts.orderBy(word, F.desc("c"), "token").limit(max(shortlist_size, 1)).collect()]
        is_rare = word
        if len(top) > 1:
            least, last = top[-1]
            is_rare = word & ((F.col("c") < least) | ((F.col("c") == least) & (F.col("token") > F.lit(last))))
        top = sorted(top or [(0, END)], key=lambda x: (-x[0], x[1]))
        shortlist = [t for _, t in top]
        short_counts = np.array([c for c, _ in top], np.float64)
        mass, distinct, ones, twos = np.zeros(CLASSES), np.zeros(CLASSES), 0, 0
        for x in counts.where(is_rare).groupBy("class").agg(
                F.sum("c").alias("m"), F.count("*").alias("d"), F.sum((F.col("c") == 1).cast("long")).alias("o"),
                F.sum((F.col("c") == 2).cast("long")).alias("t")).collect():
            mass[x["class"]], distinct[x["class"]] = x["m"], x["d"]
            ones, twos = ones + x["o"], twos + x["t"]
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        stats = {"mass": mass, "distinct": distinct, "discount": discount,
                 "tokens": int(short_counts.sum() + mass.sum()), "types": int((short_counts > 0).sum() + distinct.sum())}
        unigram = np.concatenate([short_counts, mass]) + 0.5
        unigram /= unigram.sum()
        sent = spark.sparkContext.broadcast((shortlist, short_counts))
        encoded = tmp.save(base.select(F.spark_partition_id().cast("bigint").alias("_task"), "doc_id", "held_out", "_part", "_text")
                           .mapInArrow(_encode(sent), ENCODED_DDL))
        texts, end = encoded.where("n_tokens is not null"), shortlist.index(END)
        flat = train(texts.where("not held_out"), tmp, shortlist, unigram)
        sent = spark.sparkContext.broadcast((end, unigram, flat))
        texts = texts.select(*TEXTS, "symbols").mapInArrow(
            _neural(sent), "block bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, rare binary, neural double")
        words = encoded.where("local is not null").select("block", "token", "class", "local")
        found = counts.select(F.col("token").alias("_t"), F.col("c"))
        words = words.join(found, F.col("token") == F.col("_t"), "left").select(
            F.col("block").alias("in_block"), (F.col("local").cast("bigint") * 256 + F.col("class") + 1).alias("local_class"),
            F.coalesce("c", F.lit(0)).cast("bigint").alias("c"))
        return kept(texts.groupBy("block").cogroup(words.groupBy("in_block")).applyInArrow(_finish(stats), SCORED_DDL))
