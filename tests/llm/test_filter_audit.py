"""Filter interaction audit against applying the filters order by order."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations
from math import factorial

import pytest

from pulsegrid.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int"


def apply_orders(docs, labels, filters="ABCDE"):
    """Rows of the audit from documents as (part, set of failed filters, good, toxic)."""
    out = {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        shapley = Counter()
        for order in permutations(filters):
            left = mine
            for step, f in enumerate(order, 1):
                gone, stay = [d for d in left if f in d[1]], [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                fails = sum(f in d[1] for d in mine)
                out[part, "".join(order), step] = [len(stay), len(gone), fails - len(gone), sum(d[1] == {f} for d in mine),
                                                   sum(d[2] for d in gone), sum(d[3] for d in gone), f]
                left = stay
        for key, v in out.items():
            if key[0] == part:
                v[6] = shapley[v[6]]
    return {k: tuple(v) for k, v in out.items()}


def brute(rows, labels):
    """rows: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good, toxic = defaultdict(bool), defaultdict(bool)
    for i, q, x in labels:
        if i is not None:
            good[i] |= q == 1
            toxic[i] |= x == 1
    docs = []
    for i, t, lang in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        tests = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and t in first and i > first[t]}
        docs.append((lang or "", {k for k, v in tests.items() if v}, good[i], toxic[i]))
    return apply_orders(docs, labels)


def collected(df):
    rows = df.collect()
    got = {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"],
                                                       r["toxic_lost"], r["shapley"]) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_intervals_are_the_orders_that_remove_a_mask_at_a_step(n):
    orders = list(permutations(range(n)))
    assert filter_audit.removal_intervals(n, 0) == []
    for mask in range(1, 1 << n):
        step_of = {}
        for step, lo, hi in filter_audit.removal_intervals(n, mask):
            for rank in range(lo, hi):
                assert rank not in step_of
                step_of[rank] = step
        assert step_of == {r: next(i for i, f in enumerate(p, 1) if mask >> f & 1) for r, p in enumerate(orders)}
    assert all(0 <= rank < factorial(n) for _, _, rank, _ in filter_audit.interval_ends(n))


def texts(rng, n):
    out = []
    for _ in range(n):
        k = rng.choice([0, 1, 99, 100, 101, 150])
        w = [f"w{rng.randrange(rng.choice([20, 5000]))}" for _ in range(k)]
        if rng.random() < .3:
            w += ["SHOUT"] * (k // 5 + 1)
        if rng.random() < .3:
            w.append(rng.choice(["50%", "a|b", "#x", "c&d", "e*f", "$1"]))
        out.append(rng.choice([" ", "\t", "\x0b", " \r\n "]).join(w))
    return out


def test_audit_against_brute_force(spark):
    rng = random.Random(13)
    pool = texts(rng, 120)
    rows = [(i, rng.choice(pool), rng.choice(["en", "de", None, ""])) for i in range(300)]
    rows += [(None, pool[0], "en"), (None, None, "fr"), (7, None, "en"), (7, "", "en"), (7, "", "en"), (8, "x", "en"), (8, "x", "en"),
             (900, "zß→𝄞Ä " * 3000, "fr"), (901, "A\u0085B " * 40_000, "fr")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 320, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    clash = ("mask", "n", "t", "part", "digest", "d", "rank", "step", "good", "toxic", "first_id", "l_id", "filter", "total", "fails")
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", *[f"'x' as {c}" for c in clash])
    lab = spark.createDataFrame(labels, LABELS).selectExpr("*", "'x' as text", "'x' as good", "'x' as l_id")
    assert collected(filter_audit.filter_audit(df.repartition(5), lab.repartition(3))) == brute(rows, labels)


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], "doc_id long, text string, lang string"), spark.createDataFrame([], LABELS)
    got = filter_audit.filter_audit(docs, labels)
    assert got.collect() == [] and got.columns[:4] == ["part", "filter_order", "step", "kept"]
    one = spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string")
    assert collected(filter_audit.filter_audit(one, labels)) == brute([(1, None, None)], [])


def test_interactions_of_three_filters_and_rows_of_a_mask_added_up(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.randrange(8), rng.randrange(5), 0) for _ in range(60)]
    docs = [(p, {f for i, f in enumerate("XYZ") if m >> i & 1}, 0, 0) for p, m, n, _ in rows for _ in range(n)]
    got = filter_audit.interactions(spark.createDataFrame(rows, "part string, mask int, n long, hit long"), "XYZ", ["hit"]).collect()
    want = apply_orders(docs, [], "XYZ")
    assert {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["hit_lost"], 0,
                                                       r["shapley"]) for r in got} == want
    with pytest.raises(ValueError):
        filter_audit.interactions(spark.createDataFrame([], "part string, mask int, n long"), "ABCDEFG")
