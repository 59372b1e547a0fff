"""Exact, line, SimHash and substring deduplication against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pulsegrid.llm import components, cuckoo_dedup, golay_simhash, line_dedup, lpf_dedup

EDGE = [(None, "same text"), (1, None), (2, ""), (3, ""), (4, "same text"), (4, "same text"), (5, "x" * 5000), (6, "x" * 5000),
        (7, " \n\n \t"), (8, "zß→𝄞 " * 40)]


def words(rng, n, vocab=400):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


# --- cuckoo ------------------------------------------------------------------

def test_cuckoo_index_inserts_finds_deletes_and_resizes():
    index, rng = cuckoo_dedup.CuckooIndex(2), random.Random(1)
    keys = [hashlib.sha256(str(i).encode()).digest() + i.to_bytes(8, "big") for i in range(3000)]
    for i, k in enumerate(keys):
        index.insert(k, i)
    assert len(index) == 3000 and index.n > 2
    assert all(index.find(k) == i for i, k in enumerate(keys))
    gone = set(rng.sample(range(3000), 1500))
    for i in gone:
        assert index.delete(keys[i])
    assert not index.delete(keys[next(iter(gone))])
    assert all((index.find(k) is None) == (i in gone) for i, k in enumerate(keys))
    for i in gone:
        index.insert(keys[i], -i)
    assert all(index.find(keys[i]) == -i for i in gone) and len(index) == 3000


def test_cuckoo_fingerprint_hit_is_verified_against_the_key():
    index = cuckoo_dedup.CuckooIndex(8)
    a = bytes(40)
    b = bytes(39) + b"\1"  # same fingerprint and bucket
    index.insert(a, "a")
    assert index.find(b) is None and not index.delete(b) and index.find(a) == "a"


def test_exact_duplicates(docs):
    rng = random.Random(2)
    rows = EDGE + [(100 + i, f"t{rng.randrange(30)}") for i in range(300)]
    got = cuckoo_dedup.exact_duplicates(docs(rows, extra=True)).collect()
    assert len(got) == len(rows)
    group = defaultdict(list)
    for i, t in rows:
        group[t or ""].append(i)
    want = Counter()
    for i, t in rows:
        g = group[t or ""]
        best = max((x for x in g if x is not None), default=None)
        want[(i, best, len(g), i == best, hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in got) == want
    left = cuckoo_dedup.drop_duplicates(docs(rows, extra=True))
    assert left.columns == docs(rows, extra=True).columns
    assert left.count() == sum(k[3] * n for k, n in want.items())
    assert cuckoo_dedup.exact_duplicates(docs([])).count() == 0


def test_texts_of_equal_digest_are_compared(docs, monkeypatch):
    """With digests that tell texts by length only, groups are still those of equal texts."""
    def weak(df, text="text", doc_id="doc_id", normalise=None, *more):
        size = F.lpad(F.hex(F.octet_length(F.coalesce(text, F.lit("")))), 80, "0")
        return df.select(F.unhex(size).alias("digest"), F.col(doc_id).cast("bigint").alias("doc_id"), *more)
    rows = [(i, f"t{i % 4}") for i in range(40)] + [(50, "alone"), (51, None), (52, ""), (None, "t1"), (None, "pairs"), (60, "t5")]
    group = defaultdict(list)
    for i, t in rows:
        group[t or ""].append(i)
    want = Counter((i, max((x for x in group[t or ""] if x is not None), default=None), len(group[t or ""])) for i, t in rows)
    monkeypatch.setattr(cuckoo_dedup, "digests", weak)
    got = cuckoo_dedup.exact_duplicates(docs(rows, extra=True)).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_cuckoo_index_table(docs, spark):
    base = [(i, f"text {i}") for i in range(50)]
    index = cuckoo_dedup.update_index(None, docs(base), spark=spark).checkpoint()
    index = cuckoo_dedup.update_index(index, docs([(90, "text 3"), (91, "new")]), docs([(3, "text 3"), (4, "text 4"), (0, "unknown")]))
    probe = {r.doc_id: r.live for r in cuckoo_dedup.probe_index(index, docs([(1, "text 3"), (2, "text 4"), (3, "new"), (4, "no"), (5, "text 5")])).collect()}
    assert probe == {1: True, 2: False, 3: True, 4: False, 5: True}


def test_cuckoo_index_meets_a_digest_once(docs, spark, monkeypatch):
    """A text that most rows carry reaches its bucket as one row, and counts as many."""
    apply, look = cuckoo_dedup._apply, cuckoo_dedup._look

    def once(f):
        def run(state, rows):
            assert len(set(rows.column("digest").to_pylist())) == rows.num_rows
            return f(state, rows)
        return run
    monkeypatch.setattr(cuckoo_dedup, "_apply", once(apply))
    monkeypatch.setattr(cuckoo_dedup, "_look", once(look))
    hot = [(i, "hot") for i in range(300)] + [(None, "hot"), (400, "cold"), (401, None)]
    index = cuckoo_dedup.update_index(None, docs(hot), docs([(0, "hot"), (1, "hot"), (2, "cold"), (3, "cold")]), spark=spark).checkpoint()
    assert sorted((list(r.doc_ids), list(r.members)) for r in index.collect() if r.live) == [([299], [299]), ([401], [1])]
    probe = cuckoo_dedup.probe_index(index, docs([*hot, (None, "no")])).collect()
    assert Counter((r.doc_id, r.live) for r in probe) == Counter([(i, t != "cold") for i, t in hot] + [(None, False)])
    index = cuckoo_dedup.update_index(index, None, docs([(i, "hot") for i in range(299)]))
    assert [list(r.doc_ids) for r in index.collect() if r.live] == [[401]]


# --- lines -------------------------------------------------------------------

def brute_lines(rows, unit, least):
    sep = "\n"
    seen, out = {}, {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (t or "").encode()
        kept, at, no = b"", 0, 0
        spans = []
        for a, b, c in line_dedup.cut(raw, unit):
            w = raw[a:b].lower().split()
            if len(w) >= least and b" ".join(w) in seen:
                kept += raw[at:a]
                at = c
                spans.append((a, c, no))
            elif len(w) >= least:
                seen[b" ".join(w)] = i
            no += 1
        out[i] = (spans, (kept + raw[at:]).decode())
    assert sep
    return out


@pytest.mark.parametrize("unit", ["line", "paragraph"])
def test_line_dedup(docs, unit):
    rng = random.Random(3)
    pool = [words(rng, rng.randrange(1, 12), 60) for _ in range(40)]
    join = "\n" if unit == "line" else "\n\n"
    rows = [(i, join.join(rng.choice(pool).upper() if rng.random() < .2 else rng.choice(pool) for _ in range(rng.randrange(0, 9))))
            for i in range(120)]
    rows += [(500, None), (501, ""), (502, "\n\n\n"), (None, pool[0] + " and more words here"), (503, "α β γ δ ε ζ\nα β γ δ ε ζ")]
    df = docs(rows, extra=True)
    got = line_dedup.dedup_lines(df, unit=unit, min_words=5)
    assert got.columns == [*df.columns, "removed_spans", "kept_text"]
    want = brute_lines(rows, unit, 5)
    for r in got.collect():
        spans, text = want[r.doc_id]
        assert [tuple(s) for s in r.removed_spans] == spans
        assert r.kept_text == (None if r.text is None else text)
    assert line_dedup.dedup_lines(docs([])).count() == 0


def test_line_dedup_without_a_floor_removes_short_lines(docs):
    rows = [(1, "a\nb c\none two three four five"), (2, "A\nx"), (3, "b  c\nx\nx\n \none two three four five")]
    df = docs(rows)
    for least in (1, 5):
        want = brute_lines(rows, "line", max(least, 1))
        got = {r.doc_id: ([tuple(s) for s in r.removed_spans], r.kept_text) for r in line_dedup.dedup_lines(df, min_words=least).collect()}
        assert sum(len(s) for s, _ in got.values()) == (5 if least == 1 else 1) and got == want


def test_line_dedup_repeated_rows_are_one_document(docs):
    t = "one two three four five six\none two three four five six"
    got = line_dedup.dedup_lines(docs([(1, t), (1, t), (2, t)])).collect()
    assert sorted((r.doc_id, r.kept_text) for r in got) == [(1, "one two three four five six\n")] * 2 + [(2, "")]


# --- SimHash -------------------------------------------------------------------

def test_golay_decoder_is_perfect():
    g = golay_simhash.Golay()
    code = np.array([(i << 11) for i in range(4096)], np.int64)
    code ^= golay_simhash._syndromes(code)
    assert (golay_simhash._syndromes(code) == 0).all()
    rng = np.random.default_rng(1)
    for bits in range(4):
        err = np.array([sum(1 << int(b) for b in rng.choice(23, bits, replace=False)) for _ in code], np.int64)
        assert (g.decode(code ^ err) == np.arange(4096)).all()


def test_keys_meet_within_four_bits():
    rng = np.random.default_rng(4)
    x = rng.integers(-2**63, 2**63 - 1, 3000)
    y = x.copy()
    for i in range(len(y)):
        for b in rng.choice(64, i % 5, replace=False):
            y[i] ^= np.int64(np.uint64(1 << int(b)).view(np.int64))
    g = golay_simhash.Golay()
    a, b = (set(zip(r.tolist(), k.tolist(), strict=True)) for r, k in (golay_simhash.keys(x, g), golay_simhash.keys(y, g)))
    assert {r for r, _ in a & b} == set(range(3000)) and len(a) <= 33 * 3000


def brute_fingerprint(text, shingle):
    w = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    w = [x for x in w.replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\x0b", b" ").replace(b"\x0c", b" ").replace(b"\r", b" ").split(b" ") if x]
    if not w:
        return 0
    s = [b" ".join(w)] if len(w) < shingle else [b" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, shingle, bits):
    fp = [brute_fingerprint(t, shingle) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if bin(fp[i] ^ fp[j]).count("1") <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return Counter((d, f"{fp[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("chunk", [4096, 3])
def test_near_duplicates(docs, monkeypatch, chunk):
    monkeypatch.setattr(golay_simhash, "CHUNK", chunk)
    rng = random.Random(5)
    rows = list(EDGE) + [(900, "one two"), (901, "ONE\ttwo")]
    for f in range(12):
        base = words(rng, 300).split()
        for k in range(12):
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = "changed"
            rows.append((1000 + f * 20 + k, " ".join(w)))
    df = docs(rows, extra=True)
    got = golay_simhash.near_duplicates(df, shingle=4, max_bits=4).collect()
    assert Counter(tuple(r) for r in got) == brute_components(rows, 4, 4)
    assert golay_simhash.keep_one_each(df).columns == df.columns


def test_near_duplicates_of_an_empty_table(docs):
    assert golay_simhash.near_duplicates(docs([])).count() == 0
    with pytest.raises(ValueError):
        golay_simhash.near_duplicates(docs([]), max_bits=5)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(5000, 5000), (None, 3), (70, 71), (71, 70)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(80)} | {70: 70, 71: 70}
    assert got == want


# --- substrings ------------------------------------------------------------------

def brute_substrings(rows, length, keep):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    if keep == "first":
        rows = list(dict.fromkeys(rows))
    raw = [(t or "").encode() for _, t in rows]
    seen = defaultdict(list)
    for d, t in enumerate(raw):
        for k in range(len(t) - length + 1):
            seen[t[k:k + length]].append((d, k))
    out = []
    hit = [bytearray(len(t)) for t in raw]
    for v in seen.values():
        if len(v) > 1:
            for d, k in v if keep == "none" else v[1:]:
                hit[d][k:k + length] = b"\1" * length
    for (i, _), t, h in zip(rows, raw, hit, strict=True):
        out.append((i, bytes(c for c, x in zip(t, h, strict=True) if not x), sum(h)))
    return out


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("spread", [2000, 2])
def test_substrings(docs, monkeypatch, keep, spread):
    monkeypatch.setattr(lpf_dedup, "SPREAD", spread)
    monkeypatch.setattr(lpf_dedup, "PART", 4096)
    rng = random.Random(6)
    passage = [words(rng, 30) for _ in range(4)]
    rows = [r for r in EDGE if r != (4, "same text")] + [(4, "same text")]
    rows += [(700, "ab" * 900), (701, "€" * 100)]
    for i in range(60):
        t = words(rng, 40)
        for _ in range(rng.randrange(3)):
            p = rng.choice(passage)
            a, b = sorted((rng.randrange(len(p)), rng.randrange(len(p))))
            t = t[:50] + p[a:b + 1] + t[50:]
        rows.append((i + 20, t))
    if keep == "none":
        rows += [(800, passage[0] * 3)] * 2
    df = docs(rows, extra=True)
    got = lpf_dedup.dedup_substrings(df, length=48, gram=20, keep=keep)
    assert got.columns == [*df.columns, "spans", "kept_bytes", "kept_text"]
    have = Counter((r.doc_id, bytes(r.kept_bytes), sum(s["end"] - s["start"] for s in r.spans)) for r in got.collect())
    assert have == Counter(brute_substrings(rows, 48, keep))


def test_substring_of_first_keeps_repeated_rows_alike(docs):
    t = "abcdefghijklmnopqrstuvwxyz" * 2
    got = lpf_dedup.dedup_substrings(docs([(1, t), (1, t), (2, t)]), length=40, gram=20).collect()
    assert sorted((r.doc_id, len(r.kept_bytes)) for r in got) == [(1, 52), (1, 52), (2, 0)]
    assert lpf_dedup.dedup_substrings(docs([]), length=40, gram=20).count() == 0


def test_lpf_array_and_ranks_against_brute_force():
    rng = random.Random(7)
    for _ in range(30):
        t = bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 60)))
        want = [max((next((k for k in range(len(t) - i) if t[i + k] != t[j + k]), len(t) - i) for j in range(i)), default=0)
                for i in range(len(t))]
        assert lpf_dedup.lpf_array(np.frombuffer(t, np.uint8)).tolist() == want
    t = bytes(rng.choice(b"ab") for _ in range(400))
    for length in (8, 13, 16, 40):
        rank = lpf_dedup.prefix_ranks(np.frombuffer(t, np.uint8), length)
        full = [t[i:i + length] for i in range(len(t) - length + 1)]
        order = sorted(set(full))
        of = {x: i for i, x in enumerate(order)}
        same = {(of[x], int(r)) for x, r in zip(full, rank.tolist(), strict=False)}
        assert len(same) == len(order) and [r for _, r in sorted(same)] == sorted(r for _, r in same)


def test_sliding_minimum():
    x = np.random.default_rng(8).integers(0, 1000, 500).astype(np.uint64)
    for w in (1, 2, 7, 100, 500):
        assert lpf_dedup.sliding_min(x, w).tolist() == [x[i:i + w].min() for i in range(501 - w)]
