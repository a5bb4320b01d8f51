"""What an executor holds at once: a text once a row, one Python worker a task, none for the driver's rows."""

import pytest

from lodgegrid.llm import qda
from lodgegrid.llm.common import small_table
from lodgegrid.llm.mixing import mix, mixed_texts, placed_documents, sized_documents, source_table

ROWS = [(i, f"one two three {i} four. Five six!", f"s{i % 3}") for i in range(40)]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_text_moves_once_a_row(make_docs):
    docs = make_docs(ROWS * 2)
    spans, _ = mix(docs, block=4, per_shard=8)
    plan = plan_of(mixed_texts(docs, spans))
    assert plan.count("first(") == 1


def test_vectors_are_written_before_they_are_summed(spark, make_docs, monkeypatch):
    plans, own = [], qda.class_sums
    monkeypatch.setattr(qda, "class_sums", lambda labelled: plans.append(plan_of(labelled)) or own(labelled))
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    qda.keep_good(make_docs(ROWS), labels).count()
    assert len(plans) == 1 and "MapInPandas" not in plans[0] and "Join" in plans[0]


@pytest.mark.parametrize("rows", [[], [(1, "a", 2.5), (2, None, None), (None, "é", -1.0)]])
def test_rows_of_the_driver_need_no_worker(spark, rows):
    df = small_table(spark, rows, "n long, s string, x double")
    assert [tuple(r) for r in df.collect()] == rows and df.dtypes == [("n", "bigint"), ("s", "string"), ("x", "double")]
    assert "ExistingRDD" not in df._jdf.queryExecution().executedPlan().toString()


def test_sources_are_joined_without_a_worker(make_docs):
    sized = sized_documents(make_docs(ROWS))
    plan = placed_documents(sized, source_table(sized))._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan
