"""Targets are met whatever the ids are."""

import pytest

from ledgerleaf.llm import mixing


@pytest.mark.parametrize("ids", ["null", "one", "few"])
def test_targets_without_distinct_ids(spark, ids):
    pick = {"null": lambda i: None, "one": lambda i: 7, "few": lambda i: i % 3}[ids]
    rows = [(pick(i), f"word{i} " * 100, "a") for i in range(400)] + [(1000 + i, f"other{i} " * 100, "b") for i in range(400)]
    found = mixing.mixture(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    first = found[(found.doc_id < 1000) | found.doc_id.isna()]
    assert len(first) == 400 and abs(first.taken.sum() - first.target.iloc[0]) <= 100
    assert (first.taken <= 3 * first["size"]).all()


def test_rows_that_repeat_are_taken_alike(spark):
    rows = [(1, "same words here", "a")] * 50 + [(2, "x " * 30, "b")]
    taken = {r.taken for r in mixing.mixture(spark.createDataFrame(rows, "doc_id long, text string, source string")).filter("doc_id = 1").collect()}
    assert len(taken) == 1
