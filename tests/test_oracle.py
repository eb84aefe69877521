"""Every registered query against its reference SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import differences, reference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return reference(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_agrees_with_sql(spark, con, name):
    assert differences(spark, FOLDER, name, con) is None


def test_sketch_is_close_to_exact_count(spark):
    every = entry.queries()
    keys = ["stt", "edt", "event_type"]
    exact = every["slide_distinct"](spark, FOLDER)
    sketch = every["slide_distinct_sketch"](spark, FOLDER).withColumnRenamed("ct", "about")
    rows = exact.join(sketch, keys, "full").collect()
    assert rows and all(abs(r.ct - r.about) <= max(1, 0.05 * r.ct) for r in rows)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
