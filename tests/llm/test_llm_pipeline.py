"""The corpus pipeline's stages, each on what the one before kept, and the SQL of the queries."""

import re
from collections import Counter

import pytest
from test_llm_operators import bag, base_spans, check_packing, linked

import __spark_entry__ as entry_point
import corpus_pipeline
from starweir.llm import oracle, queries
from starweir.llm.shipping import ship
from starweir.staging import stage


@pytest.fixture(autouse=True, scope="module")
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="module")
def staged(spark, sf_dir):
    """The documents, and what each stage made of them."""
    tables = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for _, function in corpus_pipeline.STAGES:
        tables.append(stage(function(spark, tables[-1], sf_dir), "test-stage"))
    return tables


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_registered():
    assert {"pipeline", *queries.queries()} <= set(entry_point.queries())
    assert set(oracle.oracle_sql()) <= set(entry_point.oracle_sql())
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.queries())
    assert numbers == list(range(1, 11))


def test_columns(staged):
    for df in staged[1:-1]:
        assert df.columns == staged[0].columns


def test_clean_documents_stay_and_junk_goes(spark, sf_dir, staged):
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {i for i, _ in pairs(staged[1])}
    good = [i for i, t in pairs(staged[0]) if labels.get(i) == (1, 0) and len(t.split()) >= 50]
    assert sum(i in kept for i in good) >= 0.97 * len(good)
    assert len(kept) < staged[0].count()


def test_one_of_each_group_of_near_copies_stays(staged):
    before, after = pairs(staged[1]), pairs(staged[2])
    assert bag(i for i in after) == bag(
        (i, t) for i, t in before if i in {c for _, _, c in linked(before, 5, 80)}
    )


def test_documents_with_benchmark_items_go(spark, sf_dir, staged):
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    holds = lambda t: any(item in t for item in items)
    before, after = pairs(staged[2]), pairs(staged[3])
    assert bag(after) == bag(row for row in before if not holds(row[1]))
    assert len(after) < len(before)


def test_secrets_are_redacted(staged):
    before, after = dict(pairs(staged[3])), dict(pairs(staged[4]))
    assert before.keys() == after.keys()
    for doc_id, text in after.items():
        assert (text == before[doc_id]) == (not base_spans(before[doc_id]))
        assert not base_spans(text)
    assert all(r.n_chars == len(r.text) for r in staged[4].collect() if "<secret>" in r.text)


def test_everything_is_packed(staged):
    check_packing(staged[5].collect(), pairs(staged[4]), 2048)


def test_run_is_the_stages(spark, sf_dir, staged):
    out = corpus_pipeline.run(spark, sf_dir)
    count = lambda df: Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in df.collect())
    assert count(out) == count(staged[5])


@pytest.mark.parametrize("name", oracle.oracle_sql())
def test_same_rows_as_sql(spark, duck, sf_dir, name):
    df = queries.queries()[name](spark, sf_dir)
    result = duck.execute(oracle.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert bag(df.select(*names).collect()) == bag(result.fetchall())
