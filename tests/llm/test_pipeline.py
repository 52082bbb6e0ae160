"""The pipeline against a brute-force version of its stages."""


import pytest

import corpus_pipeline as P
from regiscope.llm import decontam

from ..conftest import SF_SMALL
from .test_operators import SCHEMA, brute_components, library, naive_tiles, odd_rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def test_run_equals_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    rows = [(i, t) for i, t in rows if t and any(map(str.isalpha, t))]
    last = {}
    for i, t in rows:
        last[t] = max(i, last.get(t, i))
    rows = [(i, t) for i, t in rows if last[t] == i]
    comp = brute_components(rows, 5, 80, 100)
    rows = [(i, t) for i, t in rows if comp[i][1] == i]
    grams = [{tuple(w[j:j + 5]) for j in range(len(w) - 4)} for w in map(decontam.tokens, items)]
    kept = []
    for i, t in rows:
        w = decontam.tokens(t)
        seen = {tuple(w[j:j + 5]) for j in range(len(w) - 4)}
        hits = [s for s, g in zip(items, grams) if not g.isdisjoint(seen)]
        if not any(2 * naive_tiles(decontam.tokens(s), w, 5) >= len(decontam.tokens(s)) for s in hits):
            kept.append((i, t))
    got = {}
    for r in P.run(spark, SF_SMALL).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    assert set(got) == {i for i, _ in kept} and 0 < len(kept) < docs.count()
    for i, t in kept:
        n = len(library(t)) + 1
        assert sum(x[1] for x in got[i]) == n and {x[2] for x in got[i]} == {n}
        assert sorted(got[i])[0][0] == 0


def test_stages_on_odd_rows(spark):
    odd = spark.createDataFrame(odd_rows(), SCHEMA)
    kept = odd
    for name, stage in P.STAGES[:-1]:
        kept = stage(spark, kept, SF_SMALL)
        assert kept.columns == odd.columns
    ids = sorted((r.doc_id, r.text[:9]) for r in kept.where("doc_id is not null").collect())
    assert ids == [(3, "w0 w1 w2 "), (5, "same text"), (8, "xxxxxxxxx")]
    assert kept.where("doc_id is null").count() == 1
    assert P.pack(spark, kept, SF_SMALL).count() > 3
    none = odd.limit(0)
    for name, stage in P.STAGES:
        assert stage(spark, none, SF_SMALL).count() == 0
    assert [n for n, _ in P.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontamination", "packing"]
