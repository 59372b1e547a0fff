"""Language model, pieces, toxicity, importance resampling, decontamination,
url equivalence and the pipeline against brute force or held-out rows."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from pulsegrid.llm import common, decontaminate, importance, lm_score, pieces, toxicity, url_equivalence

EDGE = [(None, "some words"), (1, None), (2, ""), (3, " \t\n"), (4, "dup dup"), (4, "dup dup"), (5, "y" * 6000), (6, "zß→𝄞 ▁ é")]
TOKEN = re.compile(rb"[^\x20\x09-\x0D]+")


def crc(i):
    return zlib.crc32(str(i).encode() if i is not None else b"")


def lower(t):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode())


# --- language model -------------------------------------------------------------

def language(rng, n):
    first = rng.choice(["de", "fr"])
    return " ".join(f"{first}{rng.randrange(30)}" if rng.random() < .8 else f"rare{rng.randrange(5000)}" for _ in range(n))


def test_counts_and_base_scores(docs):
    rng = random.Random(1)
    rows = EDGE + [(10 + i, language(rng, rng.randrange(1, 60))) for i in range(200)]
    got = lm_score.score(docs(rows, extra=True), shortlist_size=20).collect()
    count = Counter(w for i, t in rows if crc(i) % 7 != 2 for w in [*TOKEN.findall(lower(t)), b""])
    n, v = sum(count.values()), len(count)
    want = Counter()
    for i, t in rows:
        w = [*TOKEN.findall(lower(t)), b""]
        base = sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w)
        want[(i, crc(i) % 7 == 2, len(w), sum(count[x] > 0 for x in w), n, round(base, 6))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)


def test_the_end_is_a_symbol_below_the_rank_of_the_shortlist(docs, monkeypatch):
    """Few long texts: every word is more frequent than the end."""
    rng, sent = random.Random(9), []
    rows = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(2000))) for i in range(12)]
    train = lm_score.train
    monkeypatch.setattr(lm_score, "train", lambda t, tmp, s, u: sent.append((s, u)) or train(t, tmp, s, u))
    got = lm_score.score(docs(rows), shortlist_size=5).collect()
    learnt = [t for i, t in rows if crc(i) % 7 != 2]
    count = Counter(w for t in learnt for w in [*t.split(), ""])
    assert sorted(count.values())[0] == count[""] == len(learnt)
    (shortlist, unigram), n = sent[0], sum(count.values())
    assert len(shortlist) == 5 and {*shortlist} == {b"", *(w.encode() for w, _ in sorted(count.items(), key=lambda x: (-x[1], x[0]))[:4])}
    size = 5 + lm_score.CLASSES
    assert abs(unigram[shortlist.index(b"")] - (len(learnt) + 0.5) / (n + size / 2)) < 1e-12
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    base = {i: sum(math.log10((count[w] + 1) / (n + len(count) + 1)) for w in [*t.split(), ""]) for i, t in rows}
    assert all(r.n_known == r.n_tokens == 2001 and abs(r.base_score - base[r.doc_id]) < 1e-6 for r in got)


def test_model_beats_the_base_on_held_out_rows(docs):
    rng = random.Random(2)
    rows = [(i, language(rng, 80)) for i in range(500)]
    got = [r for r in lm_score.score(docs(rows), shortlist_size=80).collect() if r.held_out]
    assert len(got) > 40
    assert sum(r.score for r in got) > sum(r.base_score for r in got) + 0.1 * sum(r.n_tokens for r in got)


def test_symbol_probabilities_are_normalised_and_equal_brute_force(monkeypatch):
    rng = np.random.default_rng(3)
    uni = rng.random(30)
    m = lm_score.LogBilinear(30, 8, uni / uni.sum())
    m.near, m.far = rng.standard_normal((2, 8, 8)).astype(np.float32)
    near, far, norm = m.tables()
    for u, v in itertools.product(range(0, 30, 7), repeat=2):
        q = m.context[u] @ m.near + m.context[v] @ m.far
        s = m.target @ q + m.bias
        p = np.exp(s - np.log(np.exp(s).sum()))
        mine = np.exp(near[u] + far[v] - norm[u, v])
        assert abs(mine.sum() - 1) < 1e-4 and np.allclose(p, mine, rtol=1e-3)


def test_class_probabilities_sum_to_one(docs):
    """All training tokens of a class and its unseen slot share the class."""
    stats = {"mass": np.array([10.0]), "distinct": np.array([4.0]), "discount": 0.6}
    counts = [4, 3, 2, 1]
    p = sum((c - 0.6) / 10 for c in counts) + 0.6 * 4 / 10
    assert abs(p - 1) < 1e-12 and stats["mass"][0] == sum(counts)


def test_scoring_without_training_rows_and_empty_table(docs):
    held = [i for i in range(2000) if crc(i) % 7 == 2][:5]
    got = lm_score.score(docs([(i, "a b") for i in held])).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in got] == [(0, 0, 0.0)] * 5 and all(r.score <= 0 for r in got)
    assert lm_score.score(docs([])).count() == 0


# --- pieces ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(*pieces.read_model())


def best_brute(p, word):
    """Best score of a short word over all segmentations."""
    best = {0: 0.0}
    for e in range(1, len(word) + 1):
        if e < len(word) and word[e] & 0xC0 == 0x80:
            continue
        c = []
        for s in best:
            if word[s:e] in p.score:
                c.append(best[s] + p.score[word[s:e]][0])
            elif len(word[s:e].decode("utf-8", "replace")) == 1:
                c.append(best[s] + p.unknown)
        best[e] = max(c)
    return best[len(word)]


def value(p, ids, word):
    """Score of a segmentation; a character in bytes costs the unknown score."""
    total, at = 0.0, 0
    for i in ids:
        s = p.surface[i]
        if s in p.score and p.score[s][1] == i:
            total += p.score[s][0]
        elif word[at] & 0xC0 != 0x80:
            total += p.unknown
        at += len(s)
    return total


def test_batched_viterbi_is_optimal_and_equals_the_lone_solution(model):
    rng = random.Random(4)
    alphabet = ["the", "ing", "a", "b", "é", "zß", "→", "𝄞", "ion", "x9", "\n", "\t", "ment"]
    words = [(" " * rng.randrange(3) + "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 9)))).encode() for _ in range(400)]
    flat, first, count = model.solve(words)
    for w, f, c in zip(words, first, count, strict=True):
        ids = flat[f:f + c].tolist()
        assert b"".join(model.surface[i] for i in ids) == w
        assert ids == model._solve_alone(w)
        assert value(model, ids, w) == best_brute(model, w)


def test_pieces_against_the_library_reading_the_file_as_unigram(model):
    m = sentencepiece_model_pb2.ModelProto()
    with open(pieces.MODEL, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    lib = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    rng = random.Random(5)
    words = ["".join(rng.choice(["the", "er", "an", "on", "ti", "en", "qu"]) for _ in range(rng.randrange(1, 5))) for _ in range(500)]
    same = 0
    for w in words:
        # the best of its n-best list; its faster search can miss the optimum
        mine, its = model._solve_alone(b" " + w.encode()), lib.nbest_encode_as_ids(w, 2)[0]
        assert lib.decode(mine) == w
        assert value(model, mine, b" " + w.encode()) == value(model, its, b" " + w.encode())
        same += mine == its
    assert same >= 0.99 * len(words)  # equal sums may be told apart differently


def test_round_trip(docs):
    rng = random.Random(6)
    rows = EDGE + [(10 + i, "".join(rng.choice(["the ", "  ", "\n", "é", "▁", "𝄞", "word", "\x00"]) for _ in range(rng.randrange(60))))
                   for i in range(100)]
    rows.append((900, "ab\u00e9" * 2000))
    got = pieces.encode(docs(rows, extra=True))
    assert got.columns == ["doc_id", "n_tokens", "ids", "round_trip"]
    out = got.collect()
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in out)
    back = Counter((r.doc_id, r.text) for r in pieces.decode(got).collect())
    assert back == Counter((i, t or "") for i, t in rows)
    assert pieces.encode(docs([])).count() == 0


def test_spoilt_hashes_are_solved_again(model, monkeypatch):
    data = np.frombuffer(b"the thing", np.uint8)
    want = model.encode(data, np.array([0, 9]))[0].tolist()
    real = model._solve_batch
    monkeypatch.setattr(model, "_solve_batch", lambda words: (lambda r: (np.full_like(r[0], 300), r[1]))(real(words)))
    assert model.encode(data, np.array([0, 9]))[0].tolist() == want


def test_decode_ignores_foreign_ids(docs, spark):
    df = spark.createDataFrame([(1, [300, -5, 99999, None]), (2, None)], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in pieces.decode(df).collect()}[2] == ""


# --- toxicity ------------------------------------------------------------------------

def test_toxicity_on_held_out_rows(docs, labels):
    rng = random.Random(7)

    def text(bad):
        w = [f"w{rng.randrange(800)}" for _ in range(rng.randrange(20, 120))]
        if bad:
            for _ in range(max(2, len(w) // 25)):
                w[rng.randrange(len(w))] = rng.choice(["snark", "grobian", "blurgh"]) + rng.choice(["", "en", "ito"])
        return " ".join(w)
    y = {i: int(rng.random() < .2) for i in range(10, 900)}
    rows = EDGE + [(i, text(b)) for i, b in y.items()]
    got = toxicity.toxicity(docs(rows, extra=True), labels([(i, 1, b) for i, b in y.items()] + [(10, 1, None), (None, 0, 1)])).collect()
    assert len(got) == len(rows)
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [(y[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in y]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


def naive_features(text, lexicon):
    """The twelve features of one text, told word by word and byte by byte."""
    raw = text.encode()

    def letter(c):
        return 65 <= c <= 90 or 97 <= c <= 122 or c > 127
    plain = [c for c in raw if not (letter(c) or 48 <= c <= 57 or c == 32 or 9 <= c <= 13)]
    capital = [65 <= c <= 90 for c in raw]
    words = re.findall(rb"[0-9a-z\x80-\xff]+", lower(text))
    m, size = len(words), max(len(raw), 1)
    x = [0.0] * 12
    x[4] = sum(capital) / max(sum(map(letter, raw)), 1)
    x[5] = sum(a and b for a, b in itertools.pairwise(capital)) / size
    x[6] = sum(c in b"!?" for c in plain) / size
    x[7] = sum(c not in b"!?" for c in plain) / size
    if not m:
        return x
    hidden = sum(letter(a) and letter(c) and not letter(b) and not (b == 32 or 9 <= b <= 13) and b not in b"'-"
                 for a, b, c in zip(raw, raw[1:], raw[2:], strict=False))
    weight = [max([lexicon.get(w, 0.0)] + [lexicon.get(w[:k] + b"*", 0.0) for k in range(4, 10) if k < len(w)]) for w in words]
    at = [i for i, w in enumerate(weight) if w]
    you = [i for i, w in enumerate(words) if w in toxicity.SECOND_PERSON]
    x[8], x[9], x[11] = hidden / m, math.log1p(m), sum(a == b for a, b in itertools.pairwise(words)) / m
    if at:
        x[0], x[1], x[10] = len(at) / m, math.log1p(len(at)), sum(weight) / m
        x[2] = max(Counter(i // toxicity.STRETCH for i in at).values()) / min(m, toxicity.STRETCH)
        x[3] = sum(any(abs(i - k) <= toxicity.NEAR for k in you) for i in at) / len(at)
    return x


def test_features_equal_naive_ones_in_any_block():
    rng = random.Random(41)
    lexicon = {b"snark": 2.0, b"grob*": 3.0, b"idiot": 2.5, b"blurgh*": 4.0}
    bits = ["you", "DU", "vous", "snark", "Grobian", "i.d1ot", "idiot", "blurghen", "A", "ABC", "é", "É!", "x-y", "it's", "!?", "#1", "a\tb", "\n", "w7 w7"]
    texts = ["", " ", "A", "ABC", "XYZ", "a", "1", "b", "?", "c"] + [
        " ".join(rng.choice(bits) for _ in range(rng.choice([1, 3, 20, 200]))) for _ in range(120)]
    rng.shuffle(texts)
    raw = [t.encode() for t in texts]
    off = np.cumsum([0, *map(len, raw)])
    got = toxicity.features(np.frombuffer(b"".join(raw), np.uint8), off, toxicity._Weights(lexicon))
    assert np.allclose(got, [naive_features(t, lexicon) for t in texts], atol=1e-12)


def test_one_row_of_a_repeated_labelled_id_is_learnt_from(docs, labels):
    lab = labels([(1, 1, 1), (2, 1, 0), (4, 1, 0)])
    rows = [(1, "bad words"), (2, "good words"), (4, "fine words")]
    once = toxicity.fit(docs(rows), lab)
    assert toxicity.fit(docs(rows + [rows[0]] * 50), lab) == once and once[3] == 1 / 3


@pytest.mark.parametrize("rows", [[], [(10, 1, 0), (11, 1, 0)], [(None, 1, 1), (10, None, None)]])
def test_toxicity_without_two_classes(docs, labels, rows):
    got = toxicity.toxicity(docs([(10, "a b"), (11, None)]), labels(rows)).collect()
    assert sorted((r.doc_id, r.score, r.predicted) for r in got) == [(10, 0.0, 0), (11, 0.0, 0)]
    assert toxicity.toxicity(docs([]), labels(rows)).count() == 0


def test_isotonic_fit_is_the_monotone_mean():
    x, y = np.array([1., 2, 3, 4, 4, 5]), np.array([0., 1, 0, 1, 0, 1])
    knots = toxicity.isotonic(x, y)
    assert np.allclose(np.interp(x, *knots), [0, .5, .5, .5, .5, 1])


def test_trees_fit_an_interaction():
    rng = np.random.default_rng(8)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > .5) & (x[:, 2] < .3)).astype(float)
    m = toxicity.fit_trees(x, y)
    assert ((m.margin(x) > 0) == (y > 0)).mean() > 0.97


# --- importance resampling -----------------------------------------------------------

def brute_ngrams(text):
    """Word counts that the hashed form must reproduce."""
    return len(TOKEN.findall((text or "").encode())) * 4


def test_ngram_blocks_do_not_depend_on_the_block():
    rng = random.Random(9)
    texts = [t or "" for _, t in EDGE] + [" ".join(rng.choice(["Ab", "ab", "x1!", "É", "ab"]) for _ in range(rng.randrange(20))) for _ in range(50)]
    raw = [t.encode() for t in texts]
    off = np.cumsum([0, *map(len, raw)])
    b, n = importance.ngrams(np.frombuffer(b"".join(raw), np.uint8), off)
    end = np.cumsum(n)
    for i, r in enumerate(raw):
        own, k = importance.ngrams(np.frombuffer(r, np.uint8), np.array([0, len(r)]))
        assert k[0] == n[i] == brute_ngrams(texts[i]) and own.tolist() == b[end[i] - n[i]:end[i]].tolist()


def naive_ngrams(text):
    """Four keys of each word, as values in place of hashes."""
    out, before, shape_before = [], None, None
    for w in TOKEN.findall((text or "").encode()):
        kinds = ["cap" if 65 <= c <= 90 else "low" if 97 <= c <= 122 or c > 127 else "dig" if 48 <= c <= 57 else c for c in w]
        for i, (a, b) in enumerate(itertools.pairwise(w)):
            if a == 0xC3 and 0x80 <= b <= 0x9E:
                kinds[i] = kinds[i + 1] = "cap"
        word = bytes(c + 32 if 65 <= c <= 90 else c for c in w)
        shape = (tuple(k for k, _ in itertools.groupby(kinds)), word == before)
        out += [("w", word), ("twice",) if word == before else ("ww", before, word), ("s", shape), ("ss", shape_before, shape)]
        before, shape_before = word, shape
    return out


def test_ngram_bins_stand_for_naive_ngrams_and_ratios_for_their_counts(docs, labels):
    rng = random.Random(43)
    bits = ["Ab", "ab", "x1!", "É", "é", "Été", "7", "...", "AB", "w-w", "ab"]
    rows = EDGE + [(i, " ".join(rng.choice(bits) + rng.choice(["", "q", "Z"]) for _ in range(rng.randrange(30)))) for i in range(100, 220)]
    own = {t: importance.ngrams(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())]), 1 << 24)[0].tolist()
           for _, t in rows}
    pairs = {(k, b) for t, bins in own.items() for k, b in zip(naive_ngrams(t), bins, strict=True)}
    assert len(pairs) == len({k for k, _ in pairs}) and len({b for _, b in pairs}) > 0.999 * len(pairs)

    good = {i for i in range(100, 220) if i % 3 == 0}
    got = importance.importance(docs(rows, extra=True), labels([(i, int(i in good), 0) for i in range(100, 220, 1) if i % 2 or i in good])).collect()
    def bins(t):
        return importance.ngrams(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())]))[0].tolist()
    target, raw = Counter(b for i, t in rows if i in good for b in bins(t)), Counter(b for _, t in rows for b in bins(t))
    nt, nr = target.total(), raw.total()

    def ratio(b):
        p = (raw[b] + 0.5) / (nr + 0.5 * importance.BINS)
        return math.log((target[b] + 0.0005 * nt * p) / (nt + 0.0005 * nt)) - math.log(p)
    want = Counter((i, round(sum(map(ratio, bins(t))), 6)) for i, t in rows)
    assert Counter((r.doc_id, round(r.log_ratio, 6)) for r in got) == want


def test_quality_selection(docs, labels):
    rng = random.Random(10)

    def text(good):
        w = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(20, 80))]
        return " ".join(w if good else [x.upper() + "!!" for x in w])
    y = {i: int(rng.random() < .8) for i in range(10, 600)}
    rows = EDGE + [(i, text(g)) for i, g in y.items()]
    df = docs(rows, extra=True)
    lab = labels([(i, g, 0) for i, g in y.items() if i % 2])
    got = importance.importance(df, lab).collect()
    assert len(got) == len(rows)
    picked = {r.doc_id for r in got if r.selected}
    assert all((i in picked) == bool(g) for i, g in y.items())
    assert all(r.log_weight == 0 for r in got if r.n_grams == 0)
    left = importance.select_quality(df, lab)
    assert left.columns == df.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(r.doc_id for r in got if r.selected)


def test_gumbel_top_k_is_exact_and_repeatable(docs, labels):
    rng = random.Random(11)
    df = docs([(i, " ".join(f"w{rng.randrange(50)}" for _ in range(20))) for i in range(300)])
    lab = labels([(i, i % 2, 0) for i in range(0, 300, 3)])
    for k in (0, 1, 37, 300, 1000):
        got = importance.importance(df, lab, k=k).collect()
        best = sorted(got, key=lambda r: -r.gumbel_key)[:k]
        assert {r.doc_id for r in got if r.selected} == {r.doc_id for r in best}
    again = importance.importance(df.repartition(7), lab, k=37).collect()
    assert {r.doc_id for r in again if r.selected} == {r.doc_id for r in sorted(got, key=lambda r: -r.gumbel_key)[:37]}


def test_importance_without_labels_or_rows(docs, labels):
    got = importance.importance(docs(EDGE), labels([])).collect()
    assert len(got) == len(EDGE) and all(r.log_weight == 0 and r.selected for r in got)
    assert importance.importance(docs([]), labels([(1, 1, 1)])).count() == 0
    assert importance.select_quality(docs([]), labels([])).count() == 0


# --- decontamination -------------------------------------------------------------------

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_contamination(rows, items, window):
    wins = defaultdict(set)
    for i, t in items:
        w = WORD.findall(lower(t))
        if i is not None and w:
            k = min(window, len(w))
            for a in range(len(w) - k + 1):
                wins[tuple(w[a:a + k])].add(str(i))
    out = Counter()
    for d, t in rows:
        w, hit, found = WORD.findall(lower(t)), set(), set()
        for k in {len(x) for x in wins}:
            for a in range(len(w) - k + 1):
                if tuple(w[a:a + k]) in wins:
                    hit.update(range(a, a + k))
                    found |= wins[tuple(w[a:a + k])]
        out[(d, len(w), len(hit), tuple(sorted(found)))] += 1
    return out


@pytest.mark.parametrize("block", [100_000, 40])
def test_contamination(docs, spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    rng = random.Random(12)
    items = [(i, " ".join(f"W{rng.randrange(6)}" for _ in range(rng.randrange(0, 14)))) for i in range(40)]
    items += [(None, "w1 w2 w3 w4 w5"), (77, None), (78, "..."), (5, "w9 w9 w9 w9 w9 w9"), (79, "é-ß é ß")]
    rows = EDGE + [(100 + i, ", ".join(f"w{rng.randrange(6)}" for _ in range(rng.randrange(60)))) for i in range(150)]
    rows += [(900, "x é ß É ß é ß y"), (901, "w9! w9? w9 W9 w9 w9 w9")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(docs(rows, extra=True), bench, window=5).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in got) == brute_contamination(rows, items, 5)
    text = dict(rows)
    for r in got:
        raw = (text[r.doc_id] or "").encode()
        assert sum(len(WORD.findall(lower(raw[s["start"]:s["end"]].decode()))) for s in r.spans) == r.n_hit


def test_long_items_and_many_blocks(docs, spark, monkeypatch):
    """An item of many blocks, and texts repeated under one id: the tables
    written do not depend on the number of blocks, the rows equal brute force."""
    rng = random.Random(31)
    long = [f"w{rng.randrange(400)}" for _ in range(900)]
    items = [(1, " ".join(long)), (2, "w1 w2 w3"), (3, " ".join(long[17:33]))] + [
        (10 + i, " ".join(f"v{rng.randrange(50)}" for _ in range(rng.randrange(3, 30)))) for i in range(40)]
    rows = EDGE + [(100 + i, " ".join(long[a:a + rng.randrange(30)] + ["X"] + items[3 + i % 40][1].upper().split()[:12]))
                   for i, a in enumerate(range(0, 900, 13))]
    rows += [(7, " ".join(long))] * 30 + [(8, "w1, W2; w3")] * 30
    saved = []
    save = common.Scratch.save
    monkeypatch.setattr(common.Scratch, "save", lambda *a, **k: saved.append(1) or save(*a, **k))
    bench = spark.createDataFrame(items, "item_id long, text string")
    tables = []
    for size in (40, 700):
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", size)
        saved.clear()
        got = decontaminate.contamination(docs(rows, extra=True), bench, window=8).collect()
        assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in got) == brute_contamination(rows, items, 8)
        tables.append(len(saved))
    assert tables == [3, 3]


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 39, 40, 41, 73, 74, 500])
def test_pieces_hold_every_window(n):
    words = [b"%d" % i for i in range(n)]
    parts = decontaminate.cut(words, 40, 8)
    k = min(8, n)
    wins = {tuple(p[a:a + 8]) for p in parts for a in range(max(len(p) - 7, 1))}
    assert wins == {tuple(words[a:a + 8]) for a in range(n - k + 1)}
    assert all(len(p) <= 40 for p in parts) and (n < 8 or min(map(len, parts)) >= 8)


def test_remove_contamination(docs, spark):
    bench = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    rows = [(1, "Before. One, two three FOUR! After it all is well."), (2, "one two three four"), (3, None), (4, ""), (5, "clean É text")]
    df = docs(rows, extra=True)
    out = decontaminate.remove_contamination(df, bench, window=4)
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "Before. ! After it all is well.", 3: None, 4: "", 5: "clean É text"}
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.remove_contamination(df, none).count() == len(rows)
    assert decontaminate.contamination(docs([]), bench).count() == 0
    digest = decontaminate.contamination(df, bench, window=4).select("doc_id", decontaminate.items_digest().alias("d"))
    assert {r.doc_id: r.d for r in digest.collect()}[2] == hashlib.sha256(b"1").hexdigest() == decontaminate.digest_of([1])


# --- urls --------------------------------------------------------------------------------

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def brute_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    fit = [(len(r), k, r) for k, r in RULES
           if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    _, kind, rule = max(fit, default=(0, None, None))
    return host, path, rule, kind


@pytest.mark.parametrize("hub", [0, 60])
def test_url_equivalence(spark, hub):
    rng = random.Random(13)
    hosts = ["a.org", "B.net", "example.com", "WWW.example.com", "m.example.com", "example.com.evil.org", "net", "xnet"]
    urls = [f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}/{rng.choice(['en/', 'fr/', 'es/', 'en', ''])}{i}" for i in range(120)]
    urls += ["http://a.org", "http://a.org?x=://y", "no scheme", "", None, "http://[bad", "://", "x://Q.net/fr/#f"]
    urls += [f"http://leaf{i}.org/" for i in range(hub)]
    rows, links = [], []
    for i, u in enumerate(urls):
        html = "<html></html>"
        if u and "leaf" in u:
            target = "http://B.net/fr/hub"
        elif rng.random() < .4:
            target = rng.choice([x for x in urls[:120]] + ["http://new.org/1", "http://c.net/es/2"])
        else:
            target = None
        if target:
            html = rng.choice([f'<link rel="canonical" href="{target}">', f"<LINK href='{target}' REL=canonical />",
                               f'<meta http-equiv="refresh" content="0; URL={target}">'])
            links.append((u, target))
        rows.append((i, u, html))
    rows.append((None, urls[0], None))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", *[f"'x' as {c}" for c in ("a", "b", "node", "root", "host", "rule", "own", "_n", "_url", "by")])
    got = url_equivalence.judge(pages, RULES).collect()

    def node(u):
        u = u.split("#")[0]
        m = re.match(r"([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)(.*)", u)
        if not m:
            return None
        rest = m[2] if m[2][:1] == "/" else "/" + m[2]
        return m[1].lower() + rest
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for u, t in links:
        if u and node(u) and node(t):
            root[find(node(u))] = find(node(t))
    said = defaultdict(set)
    for x in list(root):
        said[find(x)].add(brute_rule(x)[3])
    want = Counter()
    for i, u, _ in rows:
        h, p, rule, kind = brute_rule(u)
        if kind is None:
            c = said[find(node(u))] if u and node(u) in root else set()
            kind = "allow" if "allow" in c else "block" if "block" in c else "allow"
        want[(i, h, p, rule, kind)] += 1
    assert Counter(tuple(r) for r in got) == want


def test_very_long_urls_and_pages(spark):
    n = 300_000
    pages = spark.createDataFrame([
        (1, "x" * n + "://b.net/fr/" + "y" * n, "<link " * 20_000), (2, "http://q.org/" + "a/" * n, "<p>" * n + '<link rel=canonical href="http://b.net/fr/1">'),
        (3, "x" * n, "http-equiv" * n)], "page_id long, url string, html string")
    got = {r.page_id: (r.host, len(r.path), r.verdict) for r in url_equivalence.judge(pages, RULES).collect()}
    assert got == {1: ("b.net", n + 4, "block"), 2: ("q.org", 2 * n + 1, "block"), 3: ("", 0, "allow")}


def test_relative_targets_and_redirect_table(spark):
    pages = spark.createDataFrame([
        (1, "http://a.org/x/y?q", '<link rel="canonical" href="/fr/z">'), (2, "http://a.org/x/y", '<link rel=canonical href="z&amp;k">'),
        (3, "http://a.org/x", "<link rel='canonical' href='//b.net/fr/1'>"), (4, "http://a.org/w", '<link rel=canonical href="mailto:x">'),
        (5, "http://a.org/r", "")], "page_id long, url string, html string")
    edges = {(r.a, r.b) for r in url_equivalence.link_edges(pages).collect()}
    assert edges == {("http://a.org/x/y?q", "http://a.org/fr/z"), ("http://a.org/x/y", "http://a.org/x/z&k"),
                     ("http://a.org/x", "http://b.net/fr/1"), ("http://a.org/w", None)}
    moved = spark.createDataFrame([("http://a.org/r#top", "http://q.net/es/1"), (None, "http://a.org/w")], "source string, target string")
    got = {r.page_id: r.verdict for r in url_equivalence.judge(pages, RULES, moved).collect()}
    assert got == {1: "allow", 2: "allow", 3: "block", 4: "allow", 5: "block"}
    assert url_equivalence.judge(pages.limit(0), RULES).count() == 0
