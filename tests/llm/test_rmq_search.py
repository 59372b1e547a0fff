"""Ranked search by range-maximum queries against scoring every document."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from pulsegrid.llm import rmq_search as R
from pulsegrid.llm.common import utf8

ITEMS = "item_id long, text string"


def terms(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(rows, items, k=10):
    tf = [Counter(terms(t)) for _, t in rows]
    sizes = [sum(c.values()) for c in tf]
    n_docs, n_all = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for c in tf for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        if i is not None:
            wanted[i] |= set(terms(t))
    out = []
    for item, ts in wanted.items():
        found = []
        for (doc_id, _), c, n in zip(rows, tf, sizes, strict=True):
            if not n:
                continue
            m = 10 + 90 * n * n_docs // n_all
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if c[t])
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        for r, (s, none, d) in enumerate(sorted(found)[:k], 1):
            out.append((item, r, None if none else d, -s))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(rng, n, vocab=150, size=40):
    word = [f"w{i}" for i in range(vocab)]
    weight = [1 / (i + 1) for i in range(vocab)]
    return [" ".join(rng.choices(word, weight, k=rng.randrange(1, size))) for _ in range(n)]


def test_sparse_table_answers_the_first_largest_gain_of_any_range():
    rng = np.random.default_rng(1)
    for _ in range(30):
        count = rng.integers(1, 40, 6)
        gain = rng.integers(0, 12, count.sum())
        doc = np.concatenate([np.sort(rng.choice(60, c, replace=False)) for c in count])
        x = R.Lists(doc, gain, count, 60)
        for _ in range(60):
            i = rng.integers(0, 6)
            a, b = np.sort(rng.integers(x.first[i], x.end[i] + 1, 2))
            if a < b:
                assert x.argmax(np.array([a]), np.array([b]))[0] == a + np.argmax(gain[a:b])


def test_bounds_hold_and_splitting_loses_no_document():
    rng = np.random.default_rng(2)
    count = np.array([50, 20, 3])
    doc = np.concatenate([np.sort(rng.choice(80, c, replace=False)) for c in count])
    x = R.Lists(doc, rng.integers(1, 1000, count.sum()), count, 80)
    every = np.zeros(80, np.int64)
    np.add.at(every, x.doc, x.gain)
    zero = np.zeros(1, np.int64)
    todo, seen = R.Intervals(x, zero, zero, zero + 80, np.array([3]), x.first, x.end), {}
    while len(todo.item):
        for i in range(len(todo.item)):
            assert every[todo.lo[i]:todo.hi[i]].max() <= todo.bound[i]
        _, d, s = todo.scores()
        assert all(every[a] == b for a, b in zip(d, s, strict=True))
        todo, _, doc, score = todo.split()
        seen |= dict(zip(doc.tolist(), score.tolist(), strict=True))
    assert seen == {d: s for d, s in enumerate(every.tolist()) if s}


def test_search_against_brute_force(docs, spark):
    rng = random.Random(3)
    texts = corpus(rng, 400)
    rows = [(i * 3 % 1201, t) for i, t in enumerate(texts)]
    rows += [(5000 + i, texts[7]) for i in range(60)] + [(None, texts[9]), (None, "w3 w3"), (3, None), (4, ""), (5, "?! .,\n"), (6, texts[7]), (6, texts[7])]
    rows += [(7000, "W1 w1_w2-w3Ä ß→𝄞 9w " * 20_000), (7001, "solitary")]
    items = [(i, t) for i, t in enumerate(corpus(rng, 40, size=15))]
    items += [(100, texts[7]), (101, None), (102, "…!"), (103, "nowhere to be found"), (104, "W1"), (104, "w9 w12"), (None, "w1"), (105, "ß→𝄞 Solitary"), (2**40, "w0")]
    frame = spark.createDataFrame(items, ITEMS).selectExpr("*", "'x' as _id", "'x' as item", "'x' as term", "'x' as doc_id", "'x' as score")
    want = brute(rows, items)
    assert found(R.top_documents(docs(rows, extra=True), frame)) == want
    assert found(R.search(R.build_index(docs(rows)), frame, block_pairs=30)) == want  # many blocks
    assert found(R.search(R.build_index(docs(rows)), frame, k=3)) == brute(rows, items, 3)


def test_small_shards_carry_the_best_along(monkeypatch):
    rng = random.Random(4)
    rows = [(i, t) for i, t in enumerate(corpus(rng, 600))]
    rng.shuffle(rows)
    items = [(i, t) for i, t in enumerate(corpus(rng, 30, size=12))]
    sets = [(i, h) for i, t in items for h in hashes_of(t)]
    for size in (1, 7, 150, 600):
        block, shards = R.Block(sets), []
        for a in range(0, 600, size):
            part = rows[a:a + size]
            shards.append(R.shard(np.array([i for i, _ in part]), *utf8(pa.array([t for _, t in part], pa.large_string()))))
        df = np.zeros(len(block.term), np.int64)
        for s in shards:
            ts = np.frombuffer(s["term"], "<u8")
            mine, at = block.found(ts)
            df[mine] += R._unpacked(s["df"], len(ts))[at]
        block.weigh(df, sum(s["n_docs"] for s in shards), sum(s["n_all"] for s in shards))
        best = R.Best(len(block.item_id), 10)
        for s in shards:
            block.search(s, best)
        got = list(zip(block.item_id[best.item].tolist(), best.id.tolist(), best.score.tolist(), strict=True))
        assert sorted(got) == sorted((a, d, s) for a, _, d, s in brute(rows, items))


def hashes_of(text):
    data, off = utf8(pa.array([text], pa.large_string()))
    start, end, _ = R.spans(R.LOWER[data], off, R.ALPHANUMERIC)
    return R.hashes(R.LOWER[data], start, end).view(np.int64).tolist()


def test_large_sums_are_exact():
    n = 40
    doc, gain = np.tile(np.arange(n), 3), np.full(3 * n, 2**53 // 3 + 1) + np.arange(3 * n)
    x = R.Lists(doc, gain, np.array([n] * 3), n)
    zero = np.zeros(1, np.int64)
    _, d, s = R.Intervals(x, zero, zero, zero + n, np.array([3]), x.first, x.end).scores()
    assert s.tolist() == [int(gain[i]) + int(gain[n + i]) + int(gain[2 * n + i]) for i in range(n)]


@pytest.mark.parametrize("rows, items", [([], []), ([], [(1, "a")]), ([(1, "a b")], []), ([(1, None), (2, " ")], [(1, "a")]), ([(1, "a")], [(1, "a")])])
def test_empty_and_tiny_tables(docs, spark, rows, items):
    got = R.top_documents(docs(rows), spark.createDataFrame(items, ITEMS))
    assert found(got) == brute(rows, items) and got.columns == ["item_id", "rank", "doc_id", "score"]
