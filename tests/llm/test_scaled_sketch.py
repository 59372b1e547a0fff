"""Threshold-scaled sketches against a plain re-statement."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from pulsegrid.llm import scaled_sketch as S
from pulsegrid.llm.common import utf8
from pulsegrid.llm.words import ALPHANUMERIC, NOT_BLANK, hashes, spans
import pyarrow as pa

EDGE = [None, "", " \t\n ", "one", "One two", "a b c d e", "a b c d e f", "x" * 5000, "zß→𝄞 " * 40, "Ä ä É", "a\x1cb c\x00d e f g h"]


def block(texts):
    return utf8(pa.array(texts, pa.large_string()))


def naive_shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def prose(rng, n, vocab=3000):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


@pytest.mark.parametrize("table, pattern", [(NOT_BLANK, rb"[^\x20\x09-\x0D]+"), (ALPHANUMERIC, rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")])
def test_spans_and_hashes_are_those_of_the_words(table, pattern):
    rng = random.Random(1)
    texts = EDGE[1:] + ["".join(rng.choice("ab Z9_\x00\t-é") for _ in range(rng.randrange(40))) for _ in range(300)]
    data, off = block(texts)
    start, end, doc = spans(data, off, table)
    raw = data.tobytes()
    got = [(d, raw[a:b]) for a, b, d in zip(start, end, doc, strict=True)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in re.findall(pattern, t.encode())]
    h = hashes(data, start, end)
    name = {}
    for (_, w), x in zip(got, h.tolist(), strict=True):
        assert name.setdefault(w, x) == x
    assert len(set(name.values())) == len(name)


def test_shingles_are_the_distinct_word_sequences():
    rng = random.Random(2)
    texts = EDGE + [prose(rng, rng.randrange(60), 12) for _ in range(200)]
    data, off = block(texts)
    doc, h = S.shingles(data, off)
    names = {}
    for i, t in enumerate(texts):
        mine, want = set(h[doc == i].tolist()), naive_shingles(t)
        assert len(mine) == len(want)
        for s in want:
            names.setdefault(s, mine if s not in names else names[s])
            names[s] = names[s] & mine
    assert all(names.values())  # a shingle has one hash wherever it stands


def test_sketch_keeps_the_hashes_below_the_fraction_and_the_smallest_of_short_texts():
    rng = random.Random(3)
    texts = EDGE + [prose(rng, n) for n in (3, 30, 36, 37, 300, 5000)]
    data, off = block(texts)
    doc, h = S.shingles(data, off)
    top = int(S.threshold(1 / 8))
    for i, s in enumerate(S.sketches(data, off)):
        every = sorted(set(h[doc == i].tolist()))
        assert s.tolist() == [x for r, x in enumerate(every) if x < top or r < S.AT_LEAST]
        assert S.from_text(S.as_text(s)).tolist() == s.tolist()
        assert len(every) >= S.AT_LEAST or S.limit(s) == S.END


def test_containment_estimates_hold_between_very_unequal_texts():
    rng = random.Random(4)
    short, others = prose(rng, 400), [prose(rng, 4000) for _ in range(5)]
    long_ = " ".join([*others, short, prose(rng, 3000)])
    a, b, c = (S.sketches(*block([t]))[0] for t in (short, long_, prose(rng, 400)))
    assert S.containment(a, b) == 1.0 and S.containment(a, c) == 0.0 and S.containment(b, a) < .05
    half = S.sketches(*block([" ".join([*short.split()[:200], *prose(rng, 20_000).split()])]))[0]
    assert abs(S.containment(a, half) - .5) < .2
    errors = []
    for seed in range(60):
        r = random.Random(seed)
        x, y = prose(r, 500).split(), prose(r, 500).split()
        p, q = S.sketches(*block([" ".join(x), " ".join(x[:350] + y)]))
        errors.append(S.containment(p, q) - 346 / 496)
    assert abs(np.mean(errors)) < .03


def brute(rows, ranges_do_not_matter=None):
    docs = sorted({(i is not None, i or 0, t or "") for i, t in rows}, key=lambda d: d[:2], reverse=True)
    out = {}
    for k, d in enumerate(docs):
        nxt = docs[(k + 1) % len(docs)][2]
        half = len(d[2]) // 2
        changed = d[2][:len(d[2]) - half] + nxt[:half]
        mine, ed, nx = (S.sketches(*block([t]))[0] for t in (d[2], changed, nxt))
        out[d[1] if d[0] else None, hashlib.sha256(d[2].encode()).hexdigest()] = (
            len(d[2]), hashlib.sha256(changed.encode()).hexdigest(), S.as_text(mine), S.as_text(ed), S.containment(mine, ed), S.containment(mine, nx))
    return out


@pytest.mark.parametrize("ranges", [1, 4, 40])
def test_neighbours_against_brute_force(docs, ranges):
    rng = random.Random(5)
    rows = list(enumerate(EDGE)) + [(100 + 3 * i, prose(rng, rng.choice([1, 4, 30, 200]))) for i in range(120)]
    rows += [(None, "no id"), (7000, "same words here " * 30), (7001, "same words here " * 30), (7002, prose(rng, 60_000))]
    rows += [(50, "said twice, one document")] * 2 + [(106, rows[13][1])] * 40
    want = brute(rows)
    got = S.neighbours(docs(rows, extra=True), ranges=ranges).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    text_of = {(i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows}
    assert set(want) == text_of
    by_id = {k[0]: v for k, v in want.items()}
    assert all(tuple(r)[1:] == by_id[r["doc_id"]] for r in got)
    same = {r["fingerprint"] for r in got if r["doc_id"] in (7000, 7001)}
    assert len(same) == 1 and next(r for r in got if r["doc_id"] == 7001)["near_next"] == 1.0


def test_neighbours_of_equal_ids_one_document_and_none(docs):
    assert S.neighbours(docs([])).collect() == []
    one = S.neighbours(docs([(1, "a b c d e f g h")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0 and one[0]["n_chars"] == 15
    rows = [(9, f"text number {i} " * 8) for i in range(200)] + [(8, "x y z")] * 200
    got = S.neighbours(docs(rows), ranges=16).collect()
    assert Counter(r["doc_id"] for r in got) == {9: 200, 8: 200}
    assert len({r["edited_sha256"] for r in got if r["doc_id"] == 9}) == 200


def test_merged_fingerprints_are_those_of_the_whole(docs):
    rng = random.Random(6)
    rows = [(i, prose(rng, 300)) for i in range(40)]
    prints = S.fingerprints(docs(rows, extra=True))
    whole = S.merged(prints.selectExpr("doc_id % 4 as g", "fingerprint"), "g")
    got = {}
    for r in whole.collect():
        got.setdefault(r["g"], set()).add(int(r["hash"], 16))
    top = int(S.threshold())
    for g in range(4):
        every = set()
        for i, t in rows:
            if i % 4 == g:
                every |= set(S.shingles(*block([t]))[1].tolist())
        assert got[g] == {h for h in every if h < top}
    share = {r["doc_id"]: r["containment"] for r in S.covered_by(prints, whole.where("g = 1")).collect()}
    assert all((share[i] == 1.0) == (i % 4 == 1) and (i % 4 == 1 or share[i] < .1) for i in share) and len(share) == 40


def test_held_out_likeness_on_the_given_documents(spark):
    r = S.neighbours(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).where("n_chars > 400")
    got = r.selectExpr("avg(cast(near_edited > near_next as int)) as a", "avg(near_edited) as e", "avg(near_next) as n").first()
    assert got["a"] > .95 and .4 < got["e"] < .6 and got["n"] < .1
