"""Repeated ids, ties of rules, and models against naive counts."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pulsegrid.llm import cuckoo_dedup, golay_simhash, importance, toxicity, url_equivalence

TEXT_A, TEXT_B = "one two three four five six " * 5, "alpha beta gamma delta epsilon zeta " * 5


def test_a_repeated_id_with_another_text_is_no_other_component(docs):
    rows = [(5, TEXT_A), (9, TEXT_A), (3, TEXT_B), (5, TEXT_B)]
    got = golay_simhash.keep_one_each(docs(rows, extra=True)).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(3, TEXT_B), (5, TEXT_A)]
    twice = golay_simhash.keep_one_each(docs([(5, TEXT_A), (5, TEXT_A), (6, TEXT_A)])).collect()
    assert [(r.doc_id, r.text) for r in twice] == [(5, TEXT_A)] * 2  # rows of the kept id and component stay


def test_dropped_duplicates_with_clashing_names(docs):
    rows = [(5, TEXT_A), (9, TEXT_A), (9, TEXT_A), (3, TEXT_B), (None, TEXT_B), (None, None), (1, "")]
    df = docs(rows, extra=True)
    out = cuckoo_dedup.drop_duplicates(df)
    assert out.schema == df.schema
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter({(9, TEXT_A): 2, (3, TEXT_B): 1, (1, ""): 1})


@pytest.mark.parametrize("rules, verdict, rule", [
    ([("allow", "a.com/x"), ("block", "com/xyz")], "allow", "a.com/x"),
    ([("block", "com/xyz"), ("allow", "a.com/x")], "block", "com/xyz"),
    ([("allow", "a.com/x"), ("allow", "a.com/x"), ("block", "a.com/x")], "allow", "a.com/x"),
    ([("block", "a.com/"), ("allow", "a.com/xy"), ("block", "com/")], "allow", "a.com/xy")])
def test_of_rules_of_equal_length_the_first_wins(spark, rules, verdict, rule):
    page = spark.createDataFrame([(1, "http://a.com/xyz/1")], "id long, url string")
    r, v = url_equivalence.matched_rule(rules, url_equivalence.host_of("url"), url_equivalence.path_of("url"))
    assert tuple(page.select(v, r).first()) == (verdict, rule)


def test_log_ratio_against_naive_counts_of_both_models(docs, labels):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(["alpha", "Beta", "x1!", "É", "gamma"][: 2 + i % 4]) for _ in range(rng.randrange(30)))) for i in range(60)]
    rows += [(100, None), (None, "beta beta"), (101, "")]
    marks = [(i, int(i % 3 == 0), 0) for i in range(0, 40)]
    bins = 1 << 12
    own = {}
    for i, t in rows:
        raw = (t or "").encode()
        own[i, t] = importance.ngrams(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), bins)[0].tolist()
    good = {i for i, q, _ in marks if q}
    every = Counter(b for bs in own.values() for b in bs)
    target = Counter(b for (i, _), bs in own.items() if i in good for b in bs)
    n, m = sum(every.values()), sum(target.values())

    def ratio(b):
        raw = (every[b] + .5) / (n + .5 * bins)
        return math.log((target[b] + .0005 * m * raw) / (m + .0005 * m)) - math.log(raw)

    got = importance.importance(docs(rows), labels(marks), bins=bins).collect()
    want = Counter((i, len(bs), round(sum(map(ratio, bs)), 6) + 0.0) for (i, _), bs in own.items())
    assert Counter((r.doc_id, r.n_grams, round(r.log_ratio, 6) + 0.0) for r in got) == want


def naive_features(text, weights):
    """The twelve features of a text, one character and word at a time."""
    raw = text.encode()
    letter = lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b > 127
    digit, space, mark = (lambda b: 48 <= b <= 57), (lambda b: b in (9, 10, 11, 12, 13, 32)), (lambda b: b in b"!?")
    symbol = lambda b: not (letter(b) or digit(b) or space(b))
    upper, size = sum(65 <= b <= 90 for b in raw), max(len(raw), 1)
    x = [0.0] * toxicity.N_FEATURES
    x[4] = upper / max(sum(map(letter, raw)), 1)
    x[5] = sum(65 <= a <= 90 and 65 <= b <= 90 for a, b in zip(raw, raw[1:])) / size
    x[6] = sum(map(mark, raw)) / size
    x[7] = sum(symbol(b) and not mark(b) for b in raw) / size
    words = raw.translate(toxicity._WORD).split()
    if not words:
        return x
    hidden = sum(letter(a) and (symbol(b) or digit(b)) and b not in b"'-" and letter(c) for a, b, c in zip(raw, raw[1:], raw[2:]))
    m, w = len(words), [weights[x] for x in words]
    at = [i for i, v in enumerate(w) if v]
    x[8], x[9] = hidden / m, math.log1p(m)
    x[11] = sum(a == b for a, b in zip(words, words[1:])) / m
    if at:
        x[0], x[1], x[10] = len(at) / m, math.log1p(len(at)), sum(w) / m
        x[2] = max(Counter(i // toxicity.STRETCH for i in at).values()) / min(m, toxicity.STRETCH)
        you = [i for i, v in enumerate(words) if v in toxicity.SECOND_PERSON]
        if you:
            x[3] = sum(min(abs(i - j) for j in you) <= toxicity.NEAR for i in at) / len(at)
    return x


def test_features_against_naive_ones():
    rng = random.Random(8)
    pool = ["you", "your", "idiot", "stup1d", "f*ck", "HELLO", "nice", "day", "it's", "well-known", "É", "a1b", "!!", "?", "#$%", "you're", "tú", "du"]
    lexicon = {b"idiot": 2.0, b"stup1d": 1.5, b"hello": -0.5, b"nice": 0.25}
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randrange(90))) for _ in range(80)] + ["", " ", "A", "ab\ncd", "!?", "x" * 400]
    raw = [t.encode() for t in texts]
    weights = toxicity._Weights(lexicon)
    got = np.concatenate([toxicity.features(np.frombuffer(r, np.uint8), np.array([0, len(r)]), weights) for r in raw])
    want = np.array([naive_features(t, toxicity._Weights(lexicon)) for t in texts])
    assert np.allclose(got, want), np.argwhere(~np.isclose(got, want))[:5]
    assert re.search("stup1d", " ".join(texts)) and (want[:, 3] > 0).any() and (want[:, 8] > 0).any()
