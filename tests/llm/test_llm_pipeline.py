"""The pipeline, stage by stage against plain Python, and as one query; the queries with SQL against DuckDB."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from test_llm_mixing import WORD, plain_mix
from test_llm_near_dup import plain_groups
from test_llm_token_store import got, plain

import corpus_pipeline
from compare import compare
from shelfwise.llm import queries
from shelfwise.sources.checkpoints import stored


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        result = stored(stage(spark, docs, sf_dir), "stage")
        out.append((name, docs, result))
        docs = result
    return out


def test_every_stage_but_the_last_keeps_the_columns(stages):
    for _, docs, result in stages[:-1]:
        assert result.columns == docs.columns


def test_low_quality_goes(spark, sf_dir, stages):
    _, docs, result = stages[0]
    kept = {r.doc_id for r in result.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert np.mean([(d in kept) == bool(q) for d, q in labels.items()]) > 0.9


def test_one_of_each_group_stays(stages):
    _, docs, result = stages[1]
    groups = plain_groups({r.doc_id: r.text for r in docs.collect()}, 5)
    assert {r.doc_id for r in result.collect()} == {i for i, (_, root) in groups.items() if i == root}


def test_leaks_go(spark, sf_dir, stages):
    _, docs, result = stages[2]
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert {r.doc_id for r in result.collect()} == {
        r.doc_id for r in docs.collect() if not any(i in r.text for i in items)}


def test_sources_are_mixed(stages):
    _, docs, result = stages[3]
    want = {d: taken for d, _, _, _, taken in plain_mix([(r.doc_id, r.text, r.source) for r in docs.collect()])}
    taken = dict.fromkeys(want, 0)
    for r in result.collect():
        taken[r.doc_id] += len(WORD.findall(r.text))
    assert taken == want


def test_token_files_hold_the_mix(stages):
    _, docs, result = stages[4]
    assert got(result) == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_run_is_all_stages(spark, sf_dir, stages):
    assert got(corpus_pipeline.run(spark, sf_dir)) == got(stages[-1][2])


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, con, sf_dir, name):
    verdict, _ = compare(spark, con, name, queries.QUERIES[name], queries.ORACLE[name], sf_dir)
    assert verdict.startswith("ok"), verdict


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))


def test_folds_follow_crc32_of_the_id_as_text(spark):
    from shelfwise.llm.common import is_in_fold

    rows = spark.createDataFrame([(i,) for i in (0, 17, -3, 2**40)], "doc_id long").select(
        "doc_id", is_in_fold("doc_id", 5, 0).alias("f")).collect()
    assert all(r.f == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert public_tokenizers.path("byte_bpe_50k.json")
