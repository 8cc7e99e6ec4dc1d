import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dqlake.llm import topk

NAN = float("nan")


@pytest.mark.parametrize(("bins", "few", "block"), [(256, 64, 1024), (4, 2, 3)])
def test_exact_topk(spark, monkeypatch, bins, few, block):
    for k, v in (("BINS", bins), ("FEW", few), ("BLOCK", block), ("CHUNK", 32)):
        monkeypatch.setattr(topk, k, v)
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(120, 6)).round(2)
    vectors[40:90] = vectors[3]  # ties
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    rows += [(200, None, "x"), (250, [1.0, None, 0.0, 0.0, 0.0, 0.0], "x"), (300, [NAN] * 6, "x"), (350, [], "x"), (None, [1.0] * 6, "x"), (400, [1.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.exact_topk(df, F.col("vec_id") % 10 == 0).collect()}
    m = np.floor(256 * vectors).astype(int)
    want = {}
    for q in range(0, 120, 10):
        best = sorted((-int(m[q] @ m[i]), i) for i in range(120) if i != q)[:5]
        want |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(best)}
    assert got == want
    assert topk.exact_topk(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == list(corpus_pipeline.COLUMNS), name
        docs = out.cache()
        assert 0 < docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert packed.select("doc_id").distinct().count() == before
