"""The pipeline against a brute-force run of its stages, and the registration."""

import hashlib
import random
from collections import Counter

import corpus_pipeline
import __spark_entry__
from pulsegrid.llm import catalog, decontaminate, importance, pieces
from tests.llm.test_dedup import brute_components, brute_fingerprint
from tests.llm.test_models import WORD, brute_contamination, lower

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    # quality: the operator's own decision, held against the labels
    drawn = {r.doc_id for r in importance.importance(docs, labels).collect() if r.selected}
    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    assert len(good - drawn) <= 0.02 * len(good)
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in drawn]
    best = {}
    for i, t in rows:
        h = hashlib.sha256((t or "").encode()).digest()
        best[h] = max(best.get(h, -1), i)
    rows = [(i, t) for i, t in rows if best[hashlib.sha256((t or "").encode()).digest()] == i]
    keep = {d for d, _, c in brute_components(rows, 4, 4) if d == c}
    rows = [(i, t) for i, t in rows if i in keep]
    hits = {d: (n, h) for d, n, h, _ in brute_contamination(rows, items, decontaminate.WINDOW)}
    rows = [(i, t) for i, t in rows if not hits[i][1] or hits[i][1] <= 0.8 * hits[i][0]]
    assert set(got) == {i for i, _ in rows}
    model = pieces.Pieces(*pieces.read_model())
    for i, t in rows:
        text = model.decode(got[i].ids).decode()
        if not hits[i][1]:
            assert text == (t or "")
        else:
            assert len(WORD.findall(lower(text))) == hits[i][0] - hits[i][1]


def test_every_stage_but_the_last_returns_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "tokens"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).schema == docs.schema


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def odd_documents():
    """Nulls, ties, repeated rows, empty and very long texts."""
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(1, 80)))) for i in range(60)]
    long_ = " ".join(f"v{rng.randrange(3000)}" for _ in range(60_000))
    rows += [(None, None), (None, "no id"), (200, None), (201, ""), (202, " \n"), (203, rows[3][1]), (204, rows[3][1]), (205, long_),
             (206, long_), (5, rows[5][1]), (5, "another text of the id five " * 3), (207, "zß→𝄞 " * 30)]
    return rows


def test_stages_on_odd_documents_with_clashing_names(spark, docs):
    rows = odd_documents()
    df = docs(rows, extra=True)
    text_of = Counter((i, t) for i, t in rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, SF)
        got = out.collect()
        if name == "tokens":
            assert len(got) == len(rows)
            continue
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in df.schema]
        assert all(r["_k"] == r["_row"] == r["symbols"] == "x" for r in got)
        kept = Counter((r.doc_id, r.text) for r in got)
        if name == "decontamination":
            assert kept == text_of  # no item occurs
        elif name == "quality":
            assert not kept - text_of
        elif name == "exact_dedup":
            best = {}
            for i, t in rows:
                best[t or ""] = max(best.get(t or "", -1), -1 if i is None else i)
            assert kept == Counter((i, t) for i, t in rows if (-1 if i is None else i) == best[t or ""])
        else:
            want = Counter()
            for (i, t), (_, _, c) in zip(rows, in_order(rows), strict=True):
                want[i, t] += i == c
            assert kept == +want


def in_order(rows):
    """(doc_id, fingerprint, component) of each row, in the order of the rows."""
    fp = [brute_fingerprint(t, 4) for _, t in rows]
    named = {}
    for (_, f, c), n in brute_components(rows, 4, 4).items():
        named[f] = c
    return [(i, f, named[f"{f:016x}"]) for (i, _), f in zip(rows, fp, strict=True)]


def test_registration():
    q = __spark_entry__.queries()
    numbers = Counter(n.split("_")[0] for n in catalog.QUERIES)
    assert numbers == Counter(f"op{i}" for i in range(1, 14))
    assert set(catalog.QUERIES) | {"pipeline"} <= set(q)
    assert set(__spark_entry__.oracle_sql()) <= set(q)
