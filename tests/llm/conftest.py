import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    """Build a documents frame from (doc_id, text) pairs, with extra columns
    whose names clash with those the operators use inside."""
    def make(rows, extra=False):
        df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).repartition(3)
        if extra:
            for c in ("_text", "_row", "_rk1", "_id", "digest", "unit", "h", "c", "s", "n", "fp", "key", "block", "token",
                      "start", "_marks", "_runs", "bits", "good", "a", "b", "root", "node", "keep_id", "label", "_k", "_k_id", "_k_sha",
                      "_sha", "_k_rk1", "_k_rk2", "_rk2", "_fp", "_root", "least", "component_id", "_d", "_m_rk1", "_m_rk2", "_removed",
                      "_h", "_h_rk1", "_hits", "_found", "_task", "_part", "symbols", "bucket", "salt", "part", "block_id", "_n",
                      "_range", "_ahead", "_known", "_doc", "unit_id", "mask", "_crc"):
                df = df.selectExpr("*", f"'x' as {c}")
        return df
    return make


@pytest.fixture()
def labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    return make
