"""Toxicity scores: gradient-boosted trees over dense text features, calibrated
by isotonic regression.

The training rows are labelled rows outside the held-out fold, at most
``MAX_LABELS`` (those with the smallest id hashes); a hash of the id deals them
to two halves and a calibration part. The trees see each half through the
lexicon of the other, so no document is judged by words learnt from itself; the
calibration and all scores use the lexicon of both halves. The lexicon holds words and word beginnings
(4 to 9 bytes) that are far more frequent in toxic documents. Features: lexicon
densities (overall, in the densest stretch, weighted by log odds, near a
second-person pronoun), capitals, shouted words, punctuation, other symbols,
obfuscated words (symbols or digits between letters), repeated words, length.

Trees and calibration are fitted on the driver on features of the bounded
sample; every document of the table is scored in one narrow pass.

Defined cases: null and empty texts have zero features and a score like any
other; null labels and labels without a document are ignored; labels that
contradict each other count as toxic if one says so; without toxic or without
clean training rows the score is the training share of toxic rows (0 without
labels); a null doc_id counts as the empty id; repeated rows are scored each, but
of rows that share a labelled id only one (by a hash of its text) is learnt from; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pulsegrid.llm.common import batch_blocks, bounded, crc_mod, scratch, text_column

MAX_LABELS = 20_000
LEXICON = 800
MIN_ODDS = 1.8  # natural log of the odds ratio a lexicon entry needs
CANDIDATES = 20_000
STRETCH = 50
NEAR = 5
THRESHOLD = 0.3
N_TREES, DEPTH, SHRINK, N_BINS = 60, 3, 0.2, 32
CACHE = 300_000

# Second-person pronouns of English, German, French and Spanish.
SECOND_PERSON = {w.encode() for w in (
    "you your yours yourself yourselves u ur du dich dir dein deine deinen deiner ihr euch euer tu te toi ton ta tes "
    "vous votre vos tú ti tus usted ustedes vosotros vuestro").split()}

_WORD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
N_FEATURES = 12


def units(word: bytes) -> list[bytes]:
    """A word and its beginnings, which end in ``*``."""
    return [word, *[word[:k] + b"*" for k in range(4, 10) if len(word) > k]]


class _Weights(dict):
    """Word to its largest lexicon weight (0: none), worked out once."""

    def __init__(self, lexicon: dict[bytes, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: bytes) -> float:
        if len(self) > CACHE:
            self.clear()
        w = max(self.lexicon.get(u, 0.0) for u in units(word))
        self[word] = w
        return w


def _share(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of True of each text."""
    total = np.concatenate([[0], np.cumsum(mask)])
    return (total[off[1:]] - total[off[:-1]]).astype(np.float64)


def features(data: np.ndarray, off: np.ndarray, weights: _Weights) -> np.ndarray:
    """Feature rows of a block of texts."""
    n = len(off) - 1
    x = np.zeros((n, N_FEATURES))
    upper = (data >= 65) & (data <= 90)
    letter = upper | ((data >= 97) & (data <= 122)) | (data > 127)
    digit = (data >= 48) & (data <= 57)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    mark = (data == 33) | (data == 63)
    symbol = ~(letter | digit | space)
    inside = np.zeros(len(data), bool)  # a symbol or digit between letters
    shout = np.zeros(len(data), bool)  # two capitals in a row
    if len(data) > 2:
        inside[1:-1] = (symbol | digit)[1:-1] & letter[:-2] & letter[2:] & (data[1:-1] != 39) & (data[1:-1] != 45)
        shout[1:] = upper[1:] & upper[:-1]
    first, last = off[:-1][off[1:] > off[:-1]], off[1:][off[1:] > off[:-1]] - 1
    shout[first] = inside[first] = inside[last] = False  # texts that touch
    size = np.maximum(np.diff(off), 1)
    x[:, 4] = _share(upper, off) / np.maximum(_share(letter, off), 1)
    x[:, 5] = _share(shout, off) / size
    x[:, 6] = _share(mark, off) / size
    x[:, 7] = _share(symbol & ~mark, off) / size
    raw, bound = data.tobytes().translate(_WORD), off.tolist()
    hidden = _share(inside, off)
    for i in range(n):
        words = raw[bound[i]:bound[i + 1]].split()
        m = len(words)
        if not m:
            continue
        w = np.fromiter(map(weights.__getitem__, words), np.float64, m)
        at = np.flatnonzero(w)
        x[i, 8] = hidden[i] / m
        x[i, 9] = np.log1p(m)
        x[i, 11] = sum(a == b for a, b in zip(words, words[1:], strict=False)) / m
        if len(at):
            x[i, 0] = len(at) / m
            x[i, 1] = np.log1p(len(at))
            x[i, 2] = np.bincount(at // STRETCH).max() / min(m, STRETCH)
            x[i, 10] = w.sum() / m
            you = np.array([k for k, word in enumerate(words) if word in SECOND_PERSON], np.int64)
            if len(you):
                k = np.searchsorted(you, at)
                gap = np.minimum(np.abs(at - you[np.minimum(k, len(you) - 1)]), np.abs(at - you[np.maximum(k - 1, 0)]))
                x[i, 3] = (gap <= NEAR).mean()
    return x


# --- trees ---------------------------------------------------------------------

class Boosted:
    """Boosted trees for a 0/1 target, split on feature histograms."""

    def __init__(self, edges: list[np.ndarray], base: float, trees: list):
        self.edges, self.base, self.trees = edges, base, trees

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        b, out = self._binned(x), np.full(len(x), self.base)
        for feature, cut, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                f = feature[node]
                node = 2 * node + 1 + (b[np.arange(len(x)), f] > cut[node])
            out += leaf[node - (2**DEPTH - 1)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray) -> Boosted:
    """Newton boosting of the logistic loss."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, N_BINS + 1)[1:-1])) for j in range(x.shape[1])]
    share = y.mean()
    model = Boosted(edges, float(np.log(share / (1 - share))), [])
    b = model._binned(x)
    margin = np.full(len(y), model.base)
    inner = 2**DEPTH - 1
    for _ in range(N_TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, cut, leaf = np.zeros(inner, np.int64), np.full(inner, N_BINS), np.zeros(2**DEPTH)
        node = np.zeros(len(y), np.int64)
        for depth in range(DEPTH):
            for k in range(2**depth - 1, 2**(depth + 1) - 1):
                rows = np.flatnonzero(node == k)
                best = 1e-3
                for j in range(x.shape[1]):
                    gs = np.cumsum(np.bincount(b[rows, j], g[rows], N_BINS + 1))
                    hs = np.cumsum(np.bincount(b[rows, j], h[rows], N_BINS + 1))
                    left, right = hs[:-1], hs[-1] - hs[:-1]
                    gain = gs[:-1]**2 / (left + 1) + (gs[-1] - gs[:-1])**2 / (right + 1) - gs[-1]**2 / (hs[-1] + 1)
                    gain[(left < 1e-2) | (right < 1e-2)] = 0
                    c = int(gain.argmax())
                    if gain[c] > best:
                        best, feature[k], cut[k] = gain[c], j, c
                node[rows] = 2 * k + 1 + (b[rows, feature[k]] > cut[k])
        for i in range(2**DEPTH):
            rows = node == inner + i
            leaf[i] = SHRINK * g[rows].sum() / (h[rows].sum() + 1) if rows.any() else 0.0
        margin += leaf[node - inner]
        model.trees.append((feature, cut, leaf))
    return model


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators fit: knots of a non-decreasing function."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # mean, weight, first x, last x
    for a, b in zip(x[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([b, 1.0, a, a])
        while len(blocks) > 1 and (blocks[-2][0] >= blocks[-1][0] or blocks[-2][3] == blocks[-1][2]):
            m, w, _, last = blocks.pop()
            p = blocks[-1]
            p[0] = (p[0] * p[1] + m * w) / (p[1] + w)
            p[1] += w
            p[3] = last
    return (np.array([v for b in blocks for v in (b[2], b[3])]), np.array([b[0] for b in blocks for _ in (0, 1)]))


def _calibrated(margin: np.ndarray, knots) -> np.ndarray:
    """Isotonic probability, with a thousandth of the plain one to keep order
    where the fit is flat."""
    p = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
    if knots is None:
        return p
    return 0.999 * np.interp(margin, *knots) + 0.001 * p


# --- fitting -------------------------------------------------------------------

def _lookup(ids: np.ndarray, rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(place in sorted ids, found) of each row's id."""
    d = np.asarray(rows.fill_null(-1))
    at = np.minimum(np.searchsorted(ids, d), max(len(ids) - 1, 0))
    found = (ids[at] == d) & ~np.asarray(rows.is_null()) if len(ids) else np.zeros(len(d), bool)
    return at, found


def _labelled(sent):
    """The training rows of a table, with their label and role."""
    def run(batches):
        ids, toxic, role = sent.value
        for b in batches:
            at, found = _lookup(ids, b.column("doc_id"))
            pick = np.flatnonzero(found)
            yield pa.record_batch({"id": b.column("doc_id").take(pa.array(pick)), "_text": b.column("_text").take(pa.array(pick)),
                                   "toxic": pa.array(toxic[at[pick]]), "role": pa.array(role[at[pick]])})
    return run


def _unit_counts(only: set | None):
    """(unit, documents with it) over the texts, of the units in ``only``."""
    def run(batches):
        seen: dict[bytes, int] = {}
        for _, data, off in batch_blocks(batches, "_text"):
            raw, bound = data.tobytes().translate(_WORD), off.tolist()
            for i in range(len(bound) - 1):
                words = set(raw[bound[i]:bound[i + 1]].split())
                for u in {u for w in words for u in units(w)}:
                    if only is None or u in only:
                        seen[u] = seen.get(u, 0) + 1
            if len(seen) > CACHE:
                yield _unit_rows(seen)
                seen = {}
        if seen:
            yield _unit_rows(seen)
    return run


def _unit_rows(seen: dict) -> pa.RecordBatch:
    return pa.record_batch({"unit": pa.array(list(seen), pa.binary()), "n": pa.array(list(seen.values()), pa.int64())})


def _sample_features(lexicon: dict):
    def run(batches):
        weights = _Weights(lexicon)
        for rows, data, off in batch_blocks(batches, "_text"):
            x = features(data, off, weights)
            yield pa.record_batch({"x": pa.array(list(x), pa.list_(pa.float64())), "toxic": rows.column("toxic"),
                                   "role": rows.column("role")})
    return run


def learn_lexicon(texts: DataFrame, max_size: int = LEXICON) -> dict[bytes, float]:
    """Units that toxic texts hold far more often, with their log odds. ``texts``
    has _text and toxic; at most CANDIDATES units reach the driver."""
    size = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    bad, good = size.get(1, 0), size.get(0, 0)
    if not bad or not good:
        return {}
    least = max(3, int(0.01 * bad))
    count = "unit binary, n bigint"
    top = (texts.where("toxic = 1").mapInArrow(_unit_counts(None), count).groupBy("unit").agg(F.sum("n").alias("n"))
           .where(F.col("n") >= least).orderBy(F.desc("n"), "unit").limit(CANDIDATES).collect())
    t = {bytes(r["unit"]): r["n"] for r in top}
    c = {bytes(r["unit"]): r["n"] for r in texts.where("toxic = 0").mapInArrow(_unit_counts(set(t)), count)
         .groupBy("unit").agg(F.sum("n").alias("n")).collect()}
    odds = {u: float(np.log((n + 0.5) / (bad - n + 0.5)) - np.log((c.get(u, 0) + 0.5) / (good - c.get(u, 0) + 0.5)))
            for u, n in t.items()}
    best = sorted((u for u in odds if odds[u] >= MIN_ODDS), key=lambda u: (-odds[u] * np.log1p(t[u]), u))
    return {u: odds[u] for u in best[:max_size]}


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
        held_out_mod: tuple[int, int] = (4, 2), max_labels: int = MAX_LABELS) -> tuple:
    """(lexicon, trees, calibration knots, share of toxic rows) as plain values."""
    spark = bounded(docs).sparkSession
    m, r = held_out_mod
    s = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).where(crc_mod("doc_id", m) != r)
         .groupBy(F.col("doc_id").cast("bigint").alias("i")).agg((F.max(label) > 0).cast("int").alias("t"))
         .withColumn("h", F.xxhash64("i")).orderBy("h", "i").limit(max_labels)
         .withColumn("role", F.when(F.pmod("h", F.lit(20)) < 8, 0).when(F.pmod("h", F.lit(20)) < 16, 1).otherwise(2)).toArrow())
    ids = s.column("i").to_numpy()
    o = np.argsort(ids, kind="stable")
    sent = spark.sparkContext.broadcast((ids[o], s.column("t").to_numpy()[o], s.column("role").to_numpy()[o]))
    with scratch(spark, "toxic") as tmp:
        # of rows that share an id one is read, whatever their number
        rows = tmp.save(docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_column(text).alias("_text"))
                        .mapInArrow(_labelled(sent), "id bigint, _text string, toxic int, role int")
                        .groupBy("id", "toxic", "role").agg(F.min(F.struct(F.xxhash64("_text").alias("h"), "_text")).alias("s"))
                        .select("s._text", "toxic", "role"))
        half = [learn_lexicon(rows.where(f"role = {i}")) for i in (0, 1)]
        lexicon = learn_lexicon(rows.where("role < 2"))
        got = pa.concat_tables([
            rows.where(f"role = {i}").mapInArrow(_sample_features(seen_by), "x array<double>, toxic int, role int").toArrow()
            for i, seen_by in enumerate([half[1], half[0], lexicon])])
        share = rows.agg(F.avg("toxic").alias("m")).first()["m"] or 0.0
    x = np.array(got.column("x").to_pylist(), np.float64).reshape(-1, N_FEATURES)
    y, role = got.column("toxic").to_numpy().astype(np.float64), got.column("role").to_numpy()
    a, c = role < 2, role == 2
    if not a.any() or y[a].min() == y[a].max():
        return lexicon, None, None, float(share)
    trees = fit_trees(x[a], y[a])
    knots = isotonic(trees.margin(x[c]), y[c]) if c.any() and y[c].min() < y[c].max() else None
    return lexicon, (trees.edges, trees.base, trees.trees), knots, float(share)


def _score(sent):
    def run(batches):
        lexicon, trees, knots, share = sent.value
        weights = _Weights(lexicon)
        model = Boosted(*trees) if trees is not None else None
        for rows, data, off in batch_blocks(batches, "_text"):
            x = features(data, off, weights)
            s = _calibrated(model.margin(x), knots) if model is not None else np.full(len(x), share)
            yield pa.record_batch({"doc_id": rows.column("doc_id"), "held_out": rows.column("held_out"),
                                   "score": pa.array(s), "predicted": pa.array((s >= THRESHOLD).astype(np.int32))})
    return run


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
             held_out_mod: tuple[int, int] = (4, 2), max_labels: int = MAX_LABELS) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1), predicted."""
    model = fit(docs, labels, text, doc_id, label, held_out_mod, max_labels)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    m, r = held_out_mod
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), (crc_mod(doc_id, m) == r).alias("held_out"),
                       text_column(text).alias("_text")).mapInArrow(
        _score(sent), "doc_id bigint, held_out boolean, score double, predicted int")
