"""The pipeline's stages do what their operators decide."""

import corpus_pipeline
import duckdb
import pytest
from affinity.llm import contamination, jaccard, langid, lines
from affinity.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["language_id"](spark, docs, DATA).cache()
    predicted = {r.doc_id: r for r in langid.identify(docs).collect()}
    good = {i for i, r in predicted.items() if r.lang_pred != "und" and r.score >= 0.5}
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == good

    cut = stages["line_dedup"](spark, kept, DATA).cache()
    want = {r.doc_id: r.text for r in lines.dedup_lines(kept).collect()}
    assert cut.columns == columns
    assert {r.doc_id: r.text for r in cut.collect()} == want
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    one = stages["jaccard_join"](spark, cut, DATA).cache()
    groups = {}
    for r in jaccard.jaccard_components(cut).collect():
        groups.setdefault(r.component_id, set()).add(r.doc_id)
    assert one.columns == columns
    assert {r.doc_id for r in one.collect()} == {min(g) for g in groups.values()}

    clean = stages["decontamination"](spark, one, DATA).cache()
    items = spark.read.parquet(f"{DATA}/benchmark.parquet")
    bad = {r.doc_id for r in contamination.contamination(one, items).collect() if r.contaminated}
    assert clean.columns == columns
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in one.collect()} - bad

    packed = stages["packing"](spark, clean, DATA).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in clean.collect()}
    assert sorted(tuple(r)[:5] for r in corpus_pipeline.run(spark, DATA).collect()) == sorted(tuple(r)[:5] for r in packed)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    result = duck.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    expected = [tuple(row[names.index(c)] for c in columns) for row in result.fetchall()]
    assert sorted(map(str, map(tuple, df.select(*columns).collect()))) == sorted(map(str, expected))
