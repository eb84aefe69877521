"""Physical plans of the training-data operators: what may run in Python workers, and no cross join."""

import re

import pytest

from tidemart.llm import queries, rules
from tidemart.session import build_session  # noqa: F401  (the session of the tests is made by it)

PYTHON = re.compile(r"\b(MapIn\w+|FlatMap\w*In\w+|\w*EvalPython\w*|AggregateIn\w+|WindowIn\w+|PythonMap\w*)")
# The last part of each plan: what lies before a written table is not in it.
USES_PYTHON = {"op1_toxicity", "op2_class_ngrams", "op3_token_counts", "op8_chat", "op12_private_spans"}


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_cross_join_and_only_stated_python(spark, small, name):
    plan = plan_of(queries.QUERIES[name](spark, small))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert bool(PYTHON.search(plan)) == (name in USES_PYTHON)


def test_quality_rules_never_run_python(spark, small, monkeypatch):
    """Every table that the native operator writes is planned without Python workers."""
    seen = []
    monkeypatch.setattr(rules, "stored", lambda df, name, keep=rules.stored: seen.append(plan_of(df)) or keep(df, name))
    seen.append(plan_of(queries.op6_quality_rules(spark, small)))
    assert len(seen) >= 3 and not any(PYTHON.search(p) for p in seen)


def test_quality_rules_shuffle_no_text_of_unlabelled_documents(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{n}.parquet") for n in ("documents", "labels"))
    trusted = rules.trusted_labels(labels)
    ids = trusted.select("doc_id").distinct()
    likely = rules.may_be_in(docs.select("doc_id", "text"), "doc_id", ids)
    found = {r.doc_id for r in likely.select("doc_id").collect()}
    wanted = {r.doc_id for r in docs.join(ids, "doc_id", "left_semi").select("doc_id").collect()}
    assert wanted <= found and len(found) <= len(wanted) + 2
