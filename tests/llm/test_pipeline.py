"""The pipeline, and the registered queries with SQL, on the smallest tables."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rollbook.llm import queries
from tests.llm.fixtures import empty, sentence

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_against_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark"):
        duck.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    frame = queries.QUERIES[name](spark, SF_DIR)
    result = duck.execute(queries.ORACLES[name])
    order = [c[0] for c in result.description]
    assert sorted(order) == sorted(frame.columns)
    expected = sorted(map(str, result.fetchall()))
    assert sorted(str(tuple(r)) for r in frame.select(*order).collect()) == expected
    assert expected


def test_stages_keep_the_columns_and_the_clean_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.write_scratch(stage(spark, docs, SF_DIR), name)
        assert docs.columns == corpus_pipeline.COLUMNS
        assert before * 0.5 < docs.count() <= before
    last = corpus_pipeline.encode_text(spark, docs, SF_DIR)
    assert last.count() == docs.count()
    assert last.where("NOT exact").count() == 0
    assert last.where(F.size("ids") != F.col("n_tokens")).count() == 0


def test_stages_on_no_rows(spark):
    docs = empty(spark).drop("toxic")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).count() == 0


def test_odd_rows_go_through(spark):
    from tests.llm.fixtures import documents

    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        docs = corpus_pipeline.write_scratch(stage(spark, docs, SF_DIR), name)
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert 0 in left and left[0] is None
    assert 7 not in left and 6 in left
    assert None in left


def _rows(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def _left(frame):
    return sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=str)


def _item(spark):
    return spark.read.parquet(f"{SF_DIR}/benchmark.parquet").orderBy("item_id").first()["text"]


def test_unlike_texts_under_one_id_are_judged_each(spark):
    copied, unlike, third = (sentence(random.Random(n), 80) for n in (1, 2, 3))
    rows = [(3, copied), (7, copied), (7, unlike), (7, unlike), (7, third)]
    assert _left(corpus_pipeline.drop_near_copies(spark, _rows(spark, rows), SF_DIR)) == sorted([(3, copied), (7, third), (7, unlike)], key=str)
    rows = [(7, f"{unlike} {_item(spark)} {third}"), (7, unlike), (8, third)]
    assert _left(corpus_pipeline.drop_contaminated(spark, _rows(spark, rows), SF_DIR)) == sorted(rows[1:], key=str)


def test_rows_without_an_id_are_judged_too(spark):
    copied, unlike, third = (sentence(random.Random(n), 80) for n in (1, 2, 3))
    rows = [(None, copied), (None, copied), (None, unlike), (5, unlike), (None, third), (None, ""), (None, "")]
    expected = sorted([(None, copied), (5, unlike), (None, third), (None, ""), (None, "")], key=str)
    assert _left(corpus_pipeline.drop_near_copies(spark, _rows(spark, rows), SF_DIR)) == expected
    rows = [(None, f"{unlike} {_item(spark)} {third}"), (None, unlike), (8, third)]
    assert _left(corpus_pipeline.drop_contaminated(spark, _rows(spark, rows), SF_DIR)) == sorted(rows[1:], key=str)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_a_task_of_a_stage_holds_one_python_worker(spark, name, stage):
    # Workers that run one after the other in a task live at the same time, and Spark keeps them for the stages after.
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(50)
    plan = stage(spark, corpus_pipeline.write_scratch(docs, name), SF_DIR)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("MapInArrow") <= 1
