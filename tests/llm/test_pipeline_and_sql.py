import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pitchlake.llm import catalog, decontaminate, packing, quality
from pitchlake.llm.common import table
from tests.conftest import SF01, SF001
from tests.llm.helpers import docs_of, edge_rows
from tests.llm.test_exact_and_near import brute_components, brute_fingerprint

TABLES = ("documents", "pages", "benchmark", "labels", "embeddings")


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
@pytest.mark.parametrize("sf", [SF001, SF01])
def test_query_matches_sql(spark, name, sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = con.sql(catalog.ORACLES[name])
    got = catalog.QUERIES[name](spark, sf)
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    rows = sorted(tuple(map(str, (r[c] for c in cols))) for r in got.collect())
    at = [want.columns.index(c) for c in cols]
    assert rows == sorted(tuple(str(r[k]) for k in at) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_every_query_answers_for_the_whole_table(spark, name):
    got = catalog.QUERIES[name](spark, SF001)
    if "doc_id" in got.columns:
        ids = {r[0] for r in got.select("doc_id").collect()}
        assert ids == {r[0] for r in table(spark, SF001, "documents").select("doc_id").collect()}
    else:
        assert got.count() >= table(spark, SF001, "pages").count()


def test_pipeline_matches_brute_force(spark):
    docs = {r["doc_id"]: r for r in table(spark, SF001, "documents").collect()}
    scores = quality.scored(table(spark, SF001, "documents"), table(spark, SF001, "labels")).collect()
    kept = {r["doc_id"] for r in scores if r["predicted"]}
    last: dict[str, int] = {}
    for d in kept:
        last[docs[d]["text"]] = max(d, last.get(docs[d]["text"], d))
    kept = sorted(last.values())
    comp = brute_components([brute_fingerprint(docs[d]["text"]) for d in kept], kept)
    kept = sorted(set(comp))
    items = [(r["item_id"], r["text"]) for r in table(spark, SF001, "benchmark").collect()]
    matcher = decontaminate.Matcher(items)
    kept = [d for d in kept if not matcher.matches(docs[d]["text"])]
    got = corpus_pipeline.run(spark, SF001).collect()
    assert {r["doc_id"] for r in got} == set(kept)
    for d in kept:
        own = sorted((r for r in got if r["doc_id"] == d), key=lambda r: r["piece"])
        assert "".join(docs[d]["text"][r["start"]:r["start"] + r["length"]] for r in own) == docs[d]["text"]


def test_stages_take_awkward_rows_and_keep_the_columns(spark):
    docs = docs_of(spark, edge_rows(), clash=True)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF001)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            assert out.exceptAll(docs).count() == 0
        out.count()
        assert stage(spark, docs.filter(F.lit(False)), SF001).count() == 0
    assert packing.CAPACITY > 0
